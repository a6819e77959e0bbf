"""Tables that stand for the outside: chains, registry, protocols, coins, pages, fetch log.

Each is read with an explicit schema, so nothing is inferred and only the
columns in use are parsed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHAINS = "id string, name string, target_assets array<string>, sources map<string, struct<chain_slug: string, protocol_slug: string, category_slug: string, url: string, _status: string>>"
PROTOCOLS = "name string, slug string, url string, twitter string, category string, chains array<string>, tvl double"
HOLDINGS = "array<struct<date: bigint, tokens: map<string, double>>>"
PROTOCOL_DETAIL = f"slug string, chains array<string>, chainTvls map<string, struct<tokensInUsd: {HOLDINGS}>>, tokensInUsd {HOLDINGS}"
COINS = "pos bigint, id string, name string, symbol string, platforms map<string, string>"
STABLECOINS = "symbol string, name string, market_cap double"
SCRAPED = "name string, slug string, description string, category string, website string, url string, twitter string, telegram string, discord string, github string, chain string, tvl double"
PAGES = "page_id bigint, url string, html string"
FETCH_LOG = "url string, http_code int, error_type string, detail string, fetched_at timestamp"
REGISTRY = {
    "reg_root": "root_id string, slug string, url_main string",
    "reg_profile": "profile_id string, root_id string, name string, description_short string, type string, sector string, status string",
    "reg_product": "product_id string, root_id string, name string, description string, type string, status string, is_main boolean",
    "reg_asset": "asset_id string, root_id string, name string, ticker string, type string, status string",
    "reg_entity": "entity_id string, name string, trade_name string, type string, country string",
    "reg_support": "product_id string, asset_id string, asset_name string, asset_ticker string, support_slug string",
    "reg_social": "root_id string, social_type string, name string, url string",
}


def read_json(spark: SparkSession, path: str, schema: str, multiline: bool = True) -> DataFrame:
    """A JSON array of objects, or one object a line."""
    return spark.read.option("multiLine", multiline).schema(schema).json(path)


def chains(spark: SparkSession, path: str) -> DataFrame:
    """The chain dimension, one row a chain with its place in the file."""
    listed = f"chains array<{spark.createDataFrame([], CHAINS).schema.simpleString()}>"
    whole = read_json(spark, path, listed)
    return whole.select(F.posexplode("chains").alias("pos", "c")).select("pos", "c.*")


def chain_by_id(chains_: DataFrame, chain_id: str) -> dict:
    """One chain's row as a dict (empty if unknown): a point lookup in a small dimension."""
    row = chains_.where(F.col("id") == chain_id).first()
    return row.asDict(recursive=True) if row else {}


def registry(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The registry's snapshot tables by name, from Parquet folders under ``root``."""
    return {name: spark.read.schema(schema).parquet(f"{root}/{name}") for name, schema in REGISTRY.items()}


def on_chain(protocols: DataFrame, chain: str, lenient: bool = True) -> DataFrame:
    """Protocols of a chain.  Lenient: any case, and those without chains; else exact."""
    if lenient:
        low = chain.lower()
        return protocols.where(F.exists("chains", lambda c: F.lower(c) == low) | (F.coalesce(F.size("chains"), F.lit(0)) <= 0))
    return protocols.where(F.array_contains("chains", chain))


def deployed(coins: DataFrame) -> DataFrame:
    """Coins with a contract on some platform."""
    return coins.where(F.exists(F.map_values("platforms"), lambda v: F.coalesce(v, F.lit("")) != ""))
