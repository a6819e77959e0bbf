"""Small catalogs for tests."""

from rosterforge import schema as S

BY = {"name": S.NAME, "site": S.WEBSITE, "notes": S.NOTES, "ev": S.EVIDENCE, "src": S.SOURCE, "cat": S.CATEGORY, "usdt": S.USDT, "web3": S.WEB3, "stable": S.STABLE, "root": S.ROOT, "url": S.MATCHED_URL, "status": S.STATUS, "profile": S.PROFILE, "handle": S.X_HANDLE, "eco": S.CHAIN}


def catalog(spark, rows):
    """Catalog rows from dicts with short keys; ids in order."""
    full = [{"row_id": r.get("id", i), **{c: "" for c in S.CATALOG}, **{BY[k]: v for k, v in r.items() if k != "id"}} for i, r in enumerate(rows)]
    schema = "row_id long, " + ", ".join(f"`{c}` string" for c in S.CATALOG)
    return spark.createDataFrame([tuple(r.values()) for r in full], schema)


def values(df, c):
    return {r["row_id"]: r[c] for r in df.collect()}
