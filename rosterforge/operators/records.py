"""Records in pages whose JSON has no known layout.

Every JSON script block is walked level by level as a variant: one generator a
level gives a node and its children, so the walk is one pass over the pages
without joins.  Arrays and maps are scored by how much their items look like
records; the best of a page is taken.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from rosterforge.functions.text import sanitized

#: Levels of objects below a block's root that are searched (fixed value).
LEVELS = 5
#: Entries from which an array or a map can be a list of records (fixed value).
LEAST = 5
#: Items of an array or map that are looked at for its score (fixed value).
LOOKED_AT = 10
#: Score from which an array of a block that is not the framework's counts (fixed value).
LEAST_SCORE = 10
#: Fields that name a record, fields that make one likelier, fields that hold its inner part (fixed values).
NAMES = ["name", "title", "projectName", "label"]
FIELDS = ["description", "website", "url", "twitter", "category", "categories", "slug", "tagline", "tags"]
INNER = ["profile", "info", "meta"]
LINKS = ["linktree", "links", "social", "socials"]

_SCRIPT = r"(?is)<script\b([^>]*)>(.*?)</script>"
_NODE = "array<struct<path:string,depth:int,v:variant>>"


def _field(v: Column, name: str) -> Column:
    return F.try_variant_get(v, f"$.{name}", "variant")


def _map(v: Column) -> Column:
    """The fields of an object; null for anything else."""
    return F.try_variant_get(v, "$", "map<string, variant>")


def _text(v: Column) -> Column:
    return F.try_variant_get(v, "$", "string")


def present(v: Column) -> Column:
    """Whether a value counts as given: not missing, null, false, zero or the empty string.

    Asked of the value's text, so that each value stands once in the expression: fields
    of fields would make it too large to compile else."""
    return ~F.coalesce(F.to_json(v), F.lit("null")).rlike(r'^(null|false|""|-?0(\.0+)?([eE][+-]?[0-9]+)?)$')


def first_present(*values: Column) -> Column:
    return F.coalesce(*[F.when(present(v), v) for v in values])


def json_blocks(pages: DataFrame) -> DataFrame:
    """``page_id, block, framework, v``: the JSON script blocks of each page in order that parse.
    Null pages, and pages without such a block, have none."""
    tags = F.regexp_extract_all("html", F.lit(_SCRIPT), F.lit(1))
    texts = F.regexp_extract_all("html", F.lit(_SCRIPT), F.lit(2))
    blocks = pages.select("page_id", F.posexplode(F.arrays_zip(tags.alias("tag"), texts.alias("text"))).alias("block", "x"))
    framework = F.col("x.tag").rlike(r"(?i)\bid\s*=\s*[\"']?__NEXT_DATA__\b")
    json = F.col("x.tag").rlike(r"(?i)\btype\s*=\s*[\"']?application/json\b")
    blocks = blocks.where(framework | json).select("page_id", "block", framework.alias("framework"), json.alias("typed"), F.try_parse_json("x.text").alias("v"))
    return blocks.where("v IS NOT NULL")


def nodes(blocks: DataFrame, levels: int = LEVELS) -> DataFrame:
    """All values of ``blocks(..., v)`` that objects nest down to ``levels``, with ``path`` and
    ``depth``.  Arrays are values, not searched; fields come in order of their names."""
    other = [c for c in blocks.columns if c != "v"]
    out = blocks.withColumns({"path": F.lit("$"), "depth": F.lit(0)})
    for level in range(levels):
        own = F.array(F.struct("path", "depth", "v")).cast(_NODE)
        deeper = F.lit(level + 1).alias("depth")
        inner = F.transform(F.map_entries(_map(F.col("v"))), lambda e: F.struct(F.concat("path", F.lit("."), e["key"]).alias("path"), deeper, e["value"].alias("v")))  # noqa: B023
        below = F.when(F.col("depth") == level, inner.cast(_NODE))
        out = out.select(*other, F.explode(F.concat(own, F.coalesce(below, F.array().cast(_NODE)))).alias("x")).select(*other, "x.*")
    return out


def array_score(items: Column) -> Column:
    """Two for each named object among the first items, and one for each further field it has."""

    def one(v: Column) -> Column:
        named = reduce(lambda a, b: a | b, [(F.schema_of_variant(_field(v, f)) == "STRING") & (F.length(_text(_field(v, f))) > 1) for f in NAMES])
        more = sum((present(_field(v, f)).cast("int") for f in FIELDS), F.lit(2))
        return F.when(_map(v).isNotNull() & F.coalesce(named, F.lit(False)), more).otherwise(0)

    return F.aggregate(F.slice(items, 1, LOOKED_AT), F.lit(0), lambda n, v: n + one(v))


def map_score(entries: Column) -> Column:
    """The record-like objects among a map's first entries (3 at least, else 0), times its size."""

    def like(e: Column) -> Column:
        fields = F.map_keys(_map(e["value"]))
        return F.coalesce(F.exists(fields, lambda k: k.rlike("(?i)^(name|title|label)$") | k.isin(INNER)), F.lit(False))

    n = F.size(F.filter(F.slice(entries, 1, LOOKED_AT), like))
    return F.when(n >= 3, n * F.size(entries)).otherwise(0)


def found_records(pages: DataFrame) -> DataFrame:
    """``page_id, path, score, place, map_key, record`` (JSON text): the records of each page.

    They are the items of the best array of a framework's block; where it has none,
    of the first JSON block whose best array reaches ``LEAST_SCORE``; else the
    entries of the framework's best map.  Equal scores are settled by path (the
    first by name).  Blocks that do not parse, null pages and pages without records give no
    rows.  ``page_id`` must be unique."""
    found = nodes(json_blocks(pages))
    items, entries = F.try_variant_get("v", "$", "array<variant>"), F.map_entries(_map(F.col("v")))
    listed = found.withColumn("items", items).where(F.size("items") >= LEAST).withColumn("score", array_score(F.col("items")))
    keyed = found.where("framework").withColumn("entries", entries).where(F.size("entries") >= LEAST).withColumn("score", map_score(F.col("entries")))
    rank = F.when(F.col("framework"), F.struct(F.lit(0).alias("tier"), F.lit(0).alias("block"))).otherwise(F.struct(F.lit(1).alias("tier"), F.col("block")))
    kind = "array<struct<key:string,value:variant>>"
    a = listed.where((F.col("framework") & (F.col("score") > 0)) | (F.col("typed") & (F.col("score") >= LEAST_SCORE)))
    a = a.select("page_id", "path", "score", rank.alias("rank"), F.transform("items", lambda v: F.struct(F.lit(None).cast("string").alias("key"), v.alias("value"))).cast(kind).alias("items"))
    b = keyed.where("score > 0").select("page_id", "path", "score", F.struct(F.lit(2).alias("tier"), F.lit(0).alias("block")).alias("rank"), F.col("entries").cast(kind).alias("items"))
    best = a.unionByName(b).withColumn("nth", F.row_number().over(W.partitionBy("page_id").orderBy("rank", F.desc("score"), "path"))).where("nth = 1")
    out = best.select("page_id", "path", "score", F.posexplode("items").alias("place", "x"))
    return out.select("page_id", "path", "score", "place", F.col("x.key").alias("map_key"), F.to_json("x.value").alias("record"))


def _handle(text: Column) -> Column:
    """A profile's handle, from a link or bare."""
    linked = F.regexp_extract(text, r"(?:twitter\.com|x\.com)/([^/?#]+)", 1)
    return F.when(linked != "", F.concat(F.lit("@"), linked)).when((text == "") | text.startswith("@") | text.startswith("http"), text).otherwise(F.concat(F.lit("@"), text))


def normalized(df: DataFrame, record: str = "record", map_key: str | None = None) -> DataFrame:
    """``df`` with the fields of a scraped record, from JSON text of unknown shape.

    Each field is the first of its usual names that is given; fields of an inner
    profile stand before those of the record itself, links are also looked for in an
    object of links.  Records that are no objects, or whose name is no text of 2
    characters, drop out."""
    key = F.try_parse_json(F.to_json(F.array(map_key))) if map_key else F.lit(None).cast("variant")
    key = F.try_variant_get(key, "$[0]", "variant") if map_key else key
    df = df.withColumn("_v", F.try_parse_json(F.col(record))).where(_map(F.col("_v")).isNotNull())
    inner = first_present(*[_field(F.col("_v"), f) for f in INNER])
    df = df.withColumns({"_p": F.when(_map(inner).isNotNull(), inner), "_k": key})

    def of(name: str) -> Column:
        return F.coalesce(_field(F.col("_p"), name), _field(F.col("_v"), name))

    links = first_present(*[of(f) for f in LINKS])
    df = df.withColumn("_l", F.when(_map(links).isNotNull(), links))
    named = first_present(*[of(f) for f in NAMES], F.col("_k"))
    df = df.withColumn("_n", named).where((F.schema_of_variant("_n") == "STRING") & (F.length(_text(F.col("_n"))) >= 2))

    def text(*names: str, more: tuple[Column, ...] = ()) -> Column:
        return F.coalesce(_text(first_present(*[of(f) for f in names], *more)), F.lit(""))

    def link(name: str) -> Column:
        return text(name, more=(_field(F.col("_l"), name),))

    name = _text(F.col("_n"))
    handle = _handle(text("twitter", "twitterHandle", "x"))
    linked = F.coalesce(_text(first_present(_field(F.col("_l"), "twitter"), _field(F.col("_l"), "x"))), F.lit(""))
    linked = F.when(linked.rlike(r"(?:twitter\.com|x\.com)/[^/?#]"), _handle(linked)).when((linked == "") | linked.startswith("@"), linked).otherwise(F.concat(F.lit("@"), linked))
    kind = first_present(*[of(f) for f in ("category", "categories", "tags", "type")])
    listed = F.try_variant_get(kind, "$", "array<string>")
    flat = F.flatten(F.transform(F.map_values(_map(kind)), lambda v: F.coalesce(F.try_variant_get(v, "$", "array<string>"), F.array(_text(v)))))
    values = {
        "name": F.substring(name, 1, 100),
        "slug": F.coalesce(_text(first_present(of("slug"), of("id"), F.col("_k"))), F.regexp_replace(F.lower(name), "[^a-z0-9]+", "-")),
        "description": F.substring(text("description", "tagline", "summary", "oneliner"), 1, 500),
        "category": F.coalesce(F.array_join(listed, "; "), F.array_join(flat, "; "), _text(kind), F.lit("")),
        "website": text("website", "url", "homepage", "dapp"),
        "twitter": F.when(handle != "", handle).otherwise(linked),
        "telegram": link("telegram"),
        "discord": link("discord"),
        "github": link("github"),
        "chain": sanitized(text("chain", "network", "chains")),
    }
    return df.withColumns(values).drop("_v", "_p", "_k", "_l", "_n")


# -- streamed payloads ------------------------------------------------------

#: A string with its escapes, a brace, or what stands between; no part can backtrack.
_TOKEN = r'(?s)"[^"\\]*+(?:\\.[^"\\]*+)*+"|[{}]|[^"{}]++|"'
_CHUNK = r'(?s)self\.__next_f\.push\(\s*+\[\s*+1\s*+,\s*+"([^"\\]*+(?:\\.[^"\\]*+)*+)"\s*+\]\s*+\)'


def first_object(text: Column) -> Column:
    """The first balanced JSON object that begins with a field, as text; null if there is none.

    A depth runs over the text's tokens.  Braces in strings, escaped quotes and
    what follows the object do not count."""
    start = F.regexp_extract(text, r'(?s)(\{".*)', 1)
    zero = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("length"), F.lit(False).alias("ended"))

    def step(a: Column, token: Column) -> Column:
        depth = a["depth"] + F.when(token == "{", 1).when(token == "}", -1).otherwise(0)
        return F.when(a["ended"], a).otherwise(F.struct(depth.alias("depth"), (a["length"] + F.length(token)).alias("length"), (depth == 0).alias("ended")))

    end = F.aggregate(F.regexp_extract_all(start, F.lit(_TOKEN), F.lit(0)), zero, step)
    return F.when(end["ended"], F.substring(start, F.lit(1), end["length"]))


def streamed_object(html: str | Column, least: int = 100) -> Column:
    """The first object of at least ``least`` characters' text that a page streams in escaped
    chunks, as a variant; chunks that do not decode are left out; null if there is no such object."""
    page = F.coalesce(F.col(html) if isinstance(html, str) else html, F.lit(""))
    chunks = F.regexp_extract_all(page, F.lit(_CHUNK), F.lit(1))
    decoded = F.transform(chunks, lambda c: F.coalesce(F.try_variant_get(F.try_parse_json(F.concat(F.lit('["'), c, F.lit('"]'))), "$[0]", "string"), F.lit("")))
    found = first_object(F.array_join(decoded, ""))
    return F.when(F.length(found) > least, F.try_parse_json(found))


def streamed_records(pages: DataFrame, least_keys: int = 6) -> DataFrame:
    """``page_id, map_key, record`` (JSON text) of a streamed map of at least ``least_keys`` profiles."""
    maps = pages.select("page_id", _map(streamed_object("html")).alias("m")).where(F.size("m") >= least_keys)
    first = _field(F.get(F.map_values("m"), F.lit(0)), "profile")
    rows = maps.where(present(first)).select("page_id", F.explode("m").alias("map_key", "v"))
    return rows.select("page_id", "map_key", F.to_json("v").alias("record"))
