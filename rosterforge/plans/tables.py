"""Catalog-shaped tables derived from the benchmark tables by portable SQL.

The same text runs on Spark and on DuckDB, so a query and its SQL see the same
rows.  Columns have short names in SQL; ``catalog`` gives them the canonical ones.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rosterforge import schema as S

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages")

SHORT = {
    "name": S.NAME,
    "website": S.WEBSITE,
    "x_link": S.X_LINK,
    "x_handle": S.X_HANDLE,
    "telegram": S.TELEGRAM,
    "category": S.CATEGORY,
    "source": S.SOURCE,
    "notes": S.NOTES,
    "evidence": S.EVIDENCE,
    "status": S.STATUS,
    "profile": S.PROFILE,
    "root_id": S.ROOT,
    "matched_url": S.MATCHED_URL,
    "via": S.VIA,
    "eco": S.CHAIN,
    "usdt": S.USDT,
    "web3": S.WEB3,
    "stable": S.STABLE,
    "skip": "Skip",
    "added": "Added",
    "processed": "Processed?",
    "in_admin": "In Admin",
}

CATALOG = """
SELECT p_partkey AS row_id,
  CASE WHEN p_partkey % 53 = 0 THEN '' ELSE concat(p_name, ' ', CAST(p_partkey % 89 AS STRING),
    CASE p_partkey % 6 WHEN 0 THEN ' Protocol' WHEN 1 THEN ' Finance V2' WHEN 2 THEN '' WHEN 3 THEN ' Labs' WHEN 4 THEN ' Swap' ELSE ' Network' END) END AS name,
  CASE p_partkey % 4 WHEN 0 THEN '' WHEN 1 THEN concat('https://www.', replace(p_name, ' ', '-'), '.example.com/')
    WHEN 2 THEN concat('http://', replace(p_name, ' ', '-'), '.example.com:8080/path?x=1') ELSE concat(replace(p_name, ' ', '-'), CAST(p_partkey % 3 AS STRING), '.example.org') END AS website,
  '' AS x_link,
  CASE p_partkey % 3 WHEN 0 THEN '' WHEN 1 THEN concat('@h', CAST(p_partkey % 500 AS STRING)) ELSE concat('https://twitter.com/h', CAST(p_partkey % 500 AS STRING), '/') END AS x_handle,
  CASE WHEN p_partkey % 11 = 0 THEN 't.me/x' ELSE '' END AS telegram,
  CASE p_partkey % 5 WHEN 0 THEN '' WHEN 1 THEN 'Dexes; lending' WHEN 2 THEN 'liquid-staking' WHEN 3 THEN 'Bridge' ELSE concat('kind ', CAST(p_size % 7 AS STRING)) END AS category,
  CASE p_partkey % 4 WHEN 0 THEN 'DefiLlama' WHEN 1 THEN 'NEARCatalog; DefiLlama' WHEN 2 THEN 'Generic Scraper; defillama' ELSE p_brand END AS source,
  CASE p_partkey % 6 WHEN 0 THEN '' WHEN 1 THEN concat('DEX from NEARCatalog - Great ', p_name, ', swap! | Grid confirms: USDT')
    WHEN 2 THEN '[UNVERIFIED website-scan] USDT keywords (usdt; tether) | stablecoin mentions | other' WHEN 3 THEN 'Bridge from Generic Scraper'
    WHEN 4 THEN '[UNVERIFIED website-scan] USDC keywords (usdc)' ELSE concat('note  ', p_type, ' &amp; more') END AS notes,
  CASE p_partkey % 7 WHEN 0 THEN '' WHEN 1 THEN 'USDT: $217;797 | https://defillama.com/x' WHEN 2 THEN 'SOL: deployed on solana (CoinGecko)' WHEN 3 THEN 'Grid: USDT (supported_by)'
    WHEN 4 THEN 'website-scan: scanned | health-check: alive (200)' WHEN 5 THEN 'health-check: dead (404)' ELSE 'health-check: timeout (timeout)' END AS evidence,
  CASE p_partkey % 3 WHEN 0 THEN 'Active' WHEN 1 THEN '' ELSE 'Not found' END AS status,
  CASE WHEN p_partkey % 3 = 0 THEN p_name ELSE '' END AS profile,
  CASE WHEN p_partkey % 9 = 0 THEN concat('r', CAST(p_partkey % 100 AS STRING)) ELSE '' END AS root_id,
  CASE p_partkey % 10 WHEN 0 THEN concat('https://admin.thegrid.id/?rootId=r', CAST(p_partkey % 100 AS STRING), '&x=1') WHEN 1 THEN concat('https://', replace(p_name, ' ', '-'), '.example.com') ELSE '' END AS matched_url,
  CASE p_partkey % 3 WHEN 0 THEN CASE WHEN p_partkey % 2 = 0 THEN 'name' ELSE 'url' END ELSE '' END AS via,
  CASE p_partkey % 6 WHEN 0 THEN 'nation_3' WHEN 1 THEN ' NATION_5 ' WHEN 2 THEN 'the nation_7 chain' WHEN 3 THEN 'Elsewhere' WHEN 4 THEN '' ELSE '11' END AS eco,
  CASE p_partkey % 4 WHEN 0 THEN 'TRUE' WHEN 1 THEN 'yes' WHEN 2 THEN 'FALSE' ELSE '' END AS usdt,
  CASE p_partkey % 5 WHEN 0 THEN 'TRUE' ELSE '' END AS web3,
  CASE p_partkey % 6 WHEN 0 THEN '1' WHEN 1 THEN 'TRUE' ELSE '' END AS stable,
  CASE p_partkey % 8 WHEN 0 THEN 'TRUE' ELSE 'FALSE' END AS skip,
  CASE p_partkey % 3 WHEN 0 THEN 'TRUE' ELSE 'FALSE' END AS added,
  CASE p_partkey % 2 WHEN 0 THEN 'true' ELSE '' END AS processed,
  CASE p_partkey % 7 WHEN 0 THEN ' TRUE ' ELSE '' END AS in_admin
FROM part
"""

#: A second catalog to import: names and sites overlap with the first in part.
INCOMING = """
SELECT s_suppkey AS row_id,
  CASE s_suppkey % 5 WHEN 0 THEN '' WHEN 1 THEN concat(p_name, ' ', CAST(p_partkey % 89 AS STRING)) WHEN 2 THEN concat(upper(p_name), ' ', CAST(p_partkey % 89 AS STRING), ' Exchange')
    WHEN 3 THEN concat('Entity ', CAST(s_suppkey % 40 AS STRING)) ELSE concat('New ', p_name) END AS name,
  CASE s_suppkey % 3 WHEN 0 THEN '' WHEN 1 THEN concat('http://', replace(p_name, ' ', '-'), '.example.com/path?x=1') ELSE concat('https://e', CAST(s_suppkey % 60 AS STRING), '.example.net') END AS website,
  CASE s_suppkey % 2 WHEN 0 THEN 'Bridge' ELSE '' END AS category,
  CASE s_suppkey % 3 WHEN 0 THEN 'Import' ELSE 'DefiLlama' END AS source,
  CASE s_suppkey % 4 WHEN 0 THEN 'from sheet' ELSE '' END AS notes,
  CASE s_suppkey % 6 WHEN 0 THEN 'nation_3' WHEN 1 THEN 'NATION_5' WHEN 2 THEN 'the nation_7 chain' WHEN 3 THEN 'Elsewhere' WHEN 4 THEN '' ELSE '11' END AS eco
FROM supplier JOIN part ON p_partkey = s_suppkey * 3
"""

CHAINS = """
SELECT CAST(n_nationkey AS STRING) AS id, n_name AS name, CAST(n_nationkey AS BIGINT) AS pos FROM nation
"""

#: Registry entries: one profile for each name that the parts make, with its root.
ENTRIES = """
SELECT 'profile' AS kind, 0 AS kind_rank, concat('p', lpad(CAST(k AS STRING), 9, '0')) AS entry_id,
  concat(p_name, ' ', CAST(nr AS STRING)) AS name, '' AS type, CASE k % 3 WHEN 0 THEN 'Active' WHEN 1 THEN 'Live' ELSE 'Closed' END AS status,
  concat('r', CAST(k AS STRING)) AS root_id, concat(replace(p_name, ' ', '_'), '_', CAST(nr AS STRING)) AS slug,
  concat('https://', replace(p_name, ' ', '-'), CAST(k % 7 AS STRING), '.example.org/') AS url
FROM (SELECT p_name, (p_partkey * 7) % 89 AS nr, min(p_partkey) AS k FROM part GROUP BY 1, 2) x
"""


#: Pages with what detail pages hold beside their heading: a description, a section, profile links.
DETAIL_PAGES = """
SELECT page_id, url, concat(html, CASE page_id % 2 WHEN 0 THEN concat('<meta name="description" content="About ', url, '"><a href="https://x.com/u', CAST(page_id AS STRING), '">x</a>') ELSE '' END,
  CASE page_id % 3 WHEN 0 THEN concat('<meta property="article:section" content="News"><a href="https://t.me/u', CAST(page_id AS STRING), '">t</a>') ELSE '' END,
  CASE page_id % 5 WHEN 0 THEN concat('<a href="https://discord.gg/u', CAST(page_id AS STRING), '">d</a>') ELSE '' END,
  CASE page_id % 7 WHEN 0 THEN concat('<a href="https://github.com/u', CAST(page_id AS STRING), '">g</a>') ELSE '' END,
  concat('<a href="https://other', CAST(page_id AS STRING), '.example.com/a">o</a>')) AS html FROM pages
"""

#: Pages with records: embedded JSON (30, or 10 and repeated links), or a table.
RECORD_PAGES = """
SELECT page_id, url, concat(html, CASE page_id % 3
  WHEN 2 THEN concat('<table>', array_join(transform(sequence(0, 6), i -> concat('<tr><td>Cell ', CAST(i AS STRING), '</td><td>x</td></tr>')), ''), '</table>')
  ELSE concat('<script id="__NEXT_DATA__" type="application/json">{{"projects":[', array_join(transform(sequence(0, CASE page_id % 3 WHEN 0 THEN 29 ELSE 9 END), i -> concat('{{"name":"Record ', CAST(page_id AS STRING), '-', CAST(i AS STRING), '"}}')), ','), ']}}</script>',
    CASE page_id % 3 WHEN 1 THEN array_join(transform(sequence(0, 5), i -> concat('<a href="/dapps/entry-', CAST(i AS STRING), '">e</a>')), '') ELSE '' END) END) AS html FROM pages
"""

#: Pages whose JSON has no fixed layout: an array under changing keys beside a lesser one; a weak
#: block before a good one; a map of profiles; records nested too deeply; text that is no JSON.
SEARCH_PAGES = """
SELECT page_id, url, concat(html, CASE page_id % 5
  WHEN 0 THEN concat('<script id="__NEXT_DATA__" type="application/json">{{"props":{{"k', CAST(page_id % 9 AS STRING), '":{{"inner":[', array_join(transform(sequence(0, CAST(4 + page_id % 11 AS INT)),
      i -> concat('{{"name":"Entry ', CAST(page_id AS STRING), '-', CAST(i AS STRING), '","website":"https://e', CAST(i AS STRING), '.example.com","tags":["t', CAST(i AS STRING), '"]}}')), ','),
    ']}}}},"nav":[', array_join(transform(sequence(0, 5), i -> '{{"title":"Nav"}}'), ','), ']}}</script>')
  WHEN 1 THEN concat('<script type="application/json">{{"weak":[1,', array_join(transform(sequence(0, 3), i -> '{{"name":"Weak"}}'), ','), ']}}</script><p>x</p><script type="application/json" id="b">{{"data":[',
    array_join(transform(sequence(0, 5), i -> concat('{{"label":"Label ', CAST(i AS STRING), '","url":"https://l', CAST(page_id AS STRING), '.example.com"}}')), ','), ']}}</script>')
  WHEN 2 THEN concat('<script id="__NEXT_DATA__" type="application/json">{{"p":{{"all":{{', array_join(transform(sequence(0, 11),
      i -> concat('"s', lpad(CAST(i AS STRING), 2, '0'), '":{{"profile":{{"name":"Profile ', CAST(page_id AS STRING), '-', CAST(i AS STRING), '","linktree":{{"twitter":"https://x.com/h', CAST(i AS STRING), '"}}}}}}')), ','), '}}}}}}</script>')
  WHEN 3 THEN concat('<script id="__NEXT_DATA__" type="application/json">{{"a":{{"b":{{"c":{{"d":{{"e":{{"f":[', array_join(transform(sequence(0, 5), i -> '{{"name":"Deep"}}'), ','), ']}}}}}}}}}}}}</script>')
  ELSE '<script type="application/json">[{{"name":</script>' END) AS html FROM pages
"""

#: Protocols: repeated names, some of the catalog's, on one chain in two spellings or on none.
PROTOCOLS = """
SELECT p_partkey AS row_id, CASE p_partkey % 17 WHEN 0 THEN ' ' WHEN 1 THEN concat(p_name, ' ', CAST(p_partkey % 89 AS STRING)) ELSE concat('Found ', CAST(p_partkey % 611 AS STRING)) END AS name,
  CASE p_partkey % 4 WHEN 0 THEN '' ELSE concat('s', CAST(p_partkey AS STRING)) END AS slug, concat('https://p', CAST(p_partkey AS STRING), '.example.com/x') AS url,
  CASE p_partkey % 3 WHEN 0 THEN '' ELSE concat('at', CAST(p_partkey AS STRING)) END AS twitter, p_type AS category, CASE p_partkey % 5 WHEN 0 THEN 0.0 ELSE 1234000.0 + p_size END AS tvl,
  CASE p_partkey % 3 WHEN 0 THEN 'Near' WHEN 1 THEN 'near' ELSE '' END AS chain FROM part
"""


def base(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def derived(spark: SparkSession, sf_dir: str, sql: str, deal: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """The portable SQL over the tables it names, each through ``deal`` if given."""
    used = {t: base(spark, sf_dir, t) for t in TABLES if f" {t}" in sql.replace("\n", " ")}
    used = {t: deal(df) for t, df in used.items()} if deal else used
    for t in used:
        sql = sql.replace(f"FROM {t}", f"FROM {{{t}}}").replace(f"JOIN {t}", f"JOIN {{{t}}}")
    return spark.sql(sql, **used)


def dealt(df: DataFrame) -> DataFrame:
    """Rows dealt over all cores where their files make fewer tasks: these tables hold many
    narrow rows in few bytes, and what is derived from a row costs far more than to move it."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def catalog(spark: SparkSession, sf_dir: str, sql: str = CATALOG) -> DataFrame:
    df = derived(spark, sf_dir, sql, dealt if " JOIN " not in sql else None)
    return S.with_columns_of(df.withColumnsRenamed({k: v for k, v in SHORT.items() if k in df.columns}))


def shortened(df: DataFrame) -> DataFrame:
    """Canonical columns under their short names; columns without one are left out."""
    back = {v: k for k, v in SHORT.items()}
    return df.select(*[f"`{c}`" for c in df.columns if c not in S.CATALOG or c in back]).withColumnsRenamed(back)
