"""Texts, links and records from stored HTML pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from rosterforge.functions import html as H
from rosterforge.functions.urls import app_store, hostname, resolved, with_scheme
from rosterforge.schema import ROW_ID, WEBSITE, trim

#: Paths that most sites have, in order of priority (fixed values).
SUBPATHS = ["/about", "/features", "/products", "/services", "/faq", "/docs", "/developers", "/about-us", "/how-it-works"]
#: Words of paths that are no records (fixed values).
NOT_RECORDS = ["about", "contact", "privacy", "terms", "login", "signup", "search", "blog", "docs", "faq", "tag", "category"]


def _path(url: Column) -> Column:
    return F.regexp_extract(url, "^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def same_domain_links(pages: DataFrame, limit: int = 20) -> DataFrame:
    """``page_id, place, link``: each page's first ``limit`` links to other pages of its host, one
    per path, in document order, without query and fragment."""
    hrefs = pages.select("page_id", "url", F.posexplode(H.hrefs("html")).alias("p", "href")).withColumn("href", trim("href"))
    hrefs = hrefs.where(~F.col("href").rlike("^(#|mailto:|tel:|javascript:)") & (F.col("href") != ""))
    links = hrefs.withColumn("abs", resolved(F.col("url"), F.col("href")))
    path = F.lower(_path(F.col("abs")))
    key, home = F.regexp_replace(path, "/+$", ""), F.regexp_replace(F.lower(_path(F.col("url"))), "/+$", "")
    links = links.withColumns({"path": path, "key": F.when(key == "", "/").otherwise(key), "home": F.when(home == "", "/").otherwise(home)})
    host = lambda c: F.regexp_extract(F.lower(c), "^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    ok = (host(F.col("abs")) == host(F.col("url"))) & (F.col("key") != F.col("home"))
    for ending in H.ASSETS:
        ok = ok & ~F.col("path").endswith(ending)
    first = links.where(ok).groupBy("page_id", "key").agg(F.min("p").alias("p"), F.min_by("abs", "p").alias("abs"))
    place = F.row_number().over(W.partitionBy("page_id").orderBy("p"))
    link = F.regexp_replace(F.regexp_replace(F.col("abs"), "[?#].*$", ""), "^([A-Za-z][A-Za-z0-9+.-]*://)(?:[^/@]*@)?([^/:]*)(?::[0-9]*)?", "$1$2")
    return first.withColumn("place", place).where(F.col("place") <= limit).select("page_id", "place", link.alias("link"))


def site_texts(rows: DataFrame, pages: DataFrame, mode: str = "both", subpages: int = 5, shortest: int = 50) -> DataFrame:
    """``row_id, text, pages_fetched``: the text of each row's site: its homepage, then the first
    ``subpages`` candidates (usual paths, then links; ``mode`` homepage, fixed, links
    or both).  Candidates are capped before they are looked up: a page that is not
    there uses up its place.  App pages give their description.  Rows without a
    stored homepage, or with an app page that has no description, are absent; short texts do not count."""
    sites = rows.select(ROW_ID, with_scheme(WEBSITE).alias("url")).where("url <> ''")
    got = pages.groupBy("url").agg(F.min_by(F.struct("page_id", "html"), "page_id").alias("page")).select("url", "page.page_id", "page.html")
    homes = sites.join(got, "url")
    store = app_store("url")
    home = homes.select(ROW_ID, F.lit(0).alias("place"), F.when(store.isNotNull(), F.lower(H.description("html"))).otherwise(H.page_text("html")).alias("t"))
    # an app page without a description is a page that could not be read
    home = home.join(homes.where(store.isNotNull() & (H.description("html") == "")).select(ROW_ID), ROW_ID, "left_anti")
    crawled = homes.where(store.isNull())
    origin = F.regexp_extract("url", "^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    found = []
    if mode in ("fixed", "both"):
        found.append(crawled.select(ROW_ID, F.posexplode(F.transform(F.array(*map(F.lit, SUBPATHS)), lambda p: F.concat(origin, p))).alias("p", "link")))
    if mode in ("links", "both"):
        # a site shared by several rows is searched for links once
        links = same_domain_links(crawled.select("page_id", "url", "html").dropDuplicates(["page_id"]))
        found.append(crawled.select(ROW_ID, "page_id").join(links, "page_id").select(ROW_ID, (F.col("place") + len(SUBPATHS)).alias("p"), "link"))
    texts = home
    if found and subpages > 0:
        candidates = found[0] if len(found) == 1 else found[0].unionByName(found[1])
        key = F.lower(F.regexp_replace(_path(F.col("link")), "/+$", ""))
        one = candidates.withColumn("k", key).where("k <> ''").groupBy(ROW_ID, "k").agg(F.min("p").alias("p"), F.min_by("link", "p").alias("link"))
        ranked = one.withColumn("place", F.row_number().over(W.partitionBy(ROW_ID).orderBy("p"))).where(F.col("place") <= subpages)
        subs = ranked.join(got, ranked["link"] == got["url"]).select(ROW_ID, "place", H.page_text("html").alias("t"))
        texts = texts.unionByName(subs)
    kept = F.filter(F.array_sort(F.collect_list(F.struct("place", "t"))), lambda x: F.length(x["t"]) >= shortest)
    return texts.groupBy(ROW_ID).agg(F.array_join(F.transform(kept, lambda x: x["t"]), " ").alias("text"), F.count("*").alias("pages_fetched"))


# -- records ----------------------------------------------------------------


def embedded_json(html: str | Column) -> Column:
    """The JSON text that a page carries for its scripts: a framework's data, else the first JSON block."""
    page = F.coalesce(F.col(html) if isinstance(html, str) else html, F.lit(""))
    next_data = F.regexp_extract(page, r"(?is)<script[^>]*id=[\"']__NEXT_DATA__[\"'][^>]*>(.*?)</script>", 1)
    other = F.regexp_extract(page, r"(?is)<script[^>]*type=[\"']application/json[\"'][^>]*>(.*?)</script>", 1)
    return F.when(next_data != "", next_data).otherwise(F.nullif(other, F.lit("")))


def json_records(pages: DataFrame, paths: list[str], least: int = 5) -> DataFrame:
    """``page_id, place, record`` (JSON text): of the arrays at ``paths`` in a page's embedded JSON
    the one with the most named records, if at least ``least`` have a name."""
    data = pages.select("page_id", F.try_parse_json(embedded_json("html")).alias("v"))
    arrays = F.array(*[F.try_variant_get("v", p, "array<variant>") for p in paths])
    named = lambda arr: F.filter(arr, lambda r: F.coalesce(F.try_variant_get(r, "$.name", "string"), F.try_variant_get(r, "$.title", "string"), F.try_variant_get(r, "$.profile.name", "string")).isNotNull())
    sized = data.select("page_id", F.posexplode(arrays).alias("a", "items")).where("items is not null").withColumn("n", F.size(named(F.col("items")))).where(F.col("n") >= least)
    best = sized.withColumn("best", F.row_number().over(W.partitionBy("page_id").orderBy(F.desc("n"), "a"))).where("best = 1")
    return best.select("page_id", F.posexplode("items").alias("place", "r")).select("page_id", "place", F.to_json("r").alias("record"))


def json_map_records(pages: DataFrame, path: str) -> DataFrame:
    """``page_id, _mapKey, record`` (JSON text) of a map of records in a page's embedded JSON."""
    data = pages.select("page_id", F.try_variant_get(F.try_parse_json(embedded_json("html")), path, "map<string, variant>").alias("m"))
    return data.select("page_id", F.explode("m").alias("_mapKey", "r")).select("page_id", "_mapKey", F.to_json("r").alias("record"))


def repeated_links(pages: DataFrame, least: int = 5) -> DataFrame:
    """``page_id, section, slug, place``: links of one form ``/section/slug`` of which a page has at
    least ``least``; one row per slug, in document order."""
    hrefs = pages.select("page_id", F.posexplode(H.hrefs("html")).alias("p", "href"))
    part = lambda i: F.regexp_extract("href", r"^(?:https?://[^/?#]*)?/([A-Za-z][\w-]*)/([\w.-]+)/?(?:[?#].*)?$", i)
    found = hrefs.select("page_id", "p", part(1).alias("section"), part(2).alias("slug")).where("slug <> ''").where(~F.lower("section").isin(NOT_RECORDS))
    one = found.groupBy("page_id", "section", "slug").agg(F.min("p").alias("place"))
    groups = one.groupBy("page_id", "section").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    return one.join(groups.select("page_id", "section"), ["page_id", "section"])


def table_rows(pages: DataFrame, least: int = 5) -> DataFrame:
    """``page_id, place, cells``: rows of HTML tables with data cells, of pages with at least ``least``."""
    rows = pages.select("page_id", F.posexplode(F.regexp_extract_all("html", F.lit(r"(?is)<tr\b[^>]*>(.*?)</tr>"), F.lit(1))).alias("place", "row"))
    cells = F.transform(F.regexp_extract_all("row", F.lit(r"(?is)<td\b[^>]*>(.*?)</td>"), F.lit(1)), lambda c: F.trim(F.regexp_replace(F.regexp_replace(c, "<[^>]+>", " "), r"\s+", " ")))
    rows = rows.select("page_id", "place", cells.alias("cells")).where(F.size("cells") > 0)
    enough = rows.groupBy("page_id").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    return rows.join(enough.select("page_id"), "page_id")


def page_records(pages: DataFrame, paths: list[str], enough: int = 20, most: int = 500) -> DataFrame:
    """``page_id, place, name``: embedded records where a page has ``enough`` of them, else with its
    repeated links and table rows; distinct names (any case), ``most`` per page."""
    v = F.try_parse_json(F.col("record"))
    name = F.coalesce(*[F.try_variant_get(v, p, "string") for p in ("$.profile.name", "$.name", "$.title")])
    a = json_records(pages, paths).select("page_id", F.lit(0).alias("by"), "place", name.alias("name"))
    full = a.groupBy("page_id").agg(F.count("*").alias("n")).where(F.col("n") >= enough).select("page_id")
    rest = pages.join(full, "page_id", "left_anti")
    b = repeated_links(rest).select("page_id", F.lit(1).alias("by"), "place", F.col("slug").alias("name"))
    c = table_rows(rest).select("page_id", F.lit(2).alias("by"), "place", F.element_at("cells", 1).alias("name"))
    rows = a.unionByName(b).unionByName(c).where(F.length("name") >= 2)
    one = rows.groupBy("page_id", F.lower(F.trim("name")).alias("k")).agg(F.min(F.struct("by", "place", F.trim("name").alias("name"))).alias("r"))
    place = F.row_number().over(W.partitionBy("page_id").orderBy("r.by", "r.place"))
    return one.withColumn("place", place).where(F.col("place") <= most).select("page_id", "place", "r.name")


def stream_json(html: str | Column) -> Column:
    """The JSON object that a page streams in escaped chunks, from its first brace on; null if none parses."""
    page = F.coalesce(F.col(html) if isinstance(html, str) else html, F.lit(""))
    chunks = F.regexp_extract_all(page, F.lit(r'(?s)self\.__next_f\.push\(\[1,\s*"((?:[^"\\]|\\.)*)"\]\)'), F.lit(1))
    # each chunk is the inside of a JSON string
    text = F.array_join(F.transform(chunks, lambda c: F.coalesce(F.get_json_object(F.concat(F.lit('{"x":"'), c, F.lit('"}')), "$.x"), F.lit(""))), "")
    from_brace = F.substring(text, F.instr(text, "{"), F.length(text))
    upto = F.regexp_extract(from_brace, r"(?s)^(\{.*\})", 1)
    return F.coalesce(F.try_parse_json(F.nullif(upto, F.lit(""))), F.try_parse_json(F.nullif(F.regexp_extract(from_brace, r"(?m)^(\{.*\})$", 1), F.lit(""))))


def sitemap_slugs(pages: DataFrame, pattern: str, deny: list[str]) -> DataFrame:
    """Distinct ``slug`` values of a sitemap's locations."""
    locs = pages.select(F.explode(F.regexp_extract_all("html", F.lit(r"(?i)<loc>\s*([^<]+?)\s*</loc>"), F.lit(1))).alias("loc"))
    return locs.select(F.regexp_extract("loc", pattern, 1).alias("slug")).where("slug <> ''").where(~F.col("slug").isin(deny) if deny else F.lit(True)).distinct()


def union_slugs(*tables: DataFrame) -> DataFrame:
    out = tables[0].select("slug")
    for t in tables[1:]:
        out = out.unionByName(t.select("slug"))
    return out.distinct()


def link_list(pages: DataFrame, pattern: str, fixed: dict[str, str] | None = None) -> DataFrame:
    """``page_id, place, slug, name`` and ``fixed`` fields: anchors whose target fits ``pattern`` (its first
    group is the slug); one per slug, the name being the anchor's text or the slug in words."""
    anchors = pages.select("page_id", F.posexplode(F.regexp_extract_all("html", F.lit(r"(?is)(<a\b[^>]*href=[\"'][^\"']+[\"'][^>]*>.*?</a>)"), F.lit(1))).alias("p", "a"))
    slug = F.regexp_extract(F.regexp_extract("a", r"(?i)href=[\"']([^\"']+)[\"']", 1), pattern, 1)
    text = F.trim(F.regexp_replace(F.regexp_replace("a", "<[^>]+>", " "), r"\s+", " "))
    rows = anchors.select("page_id", "p", slug.alias("slug"), text.alias("t")).where("slug <> ''")
    name = F.when(F.length("t") >= 2, F.col("t")).otherwise(F.initcap(F.translate("slug", "-_", "  ")))
    one = rows.groupBy("page_id", "slug").agg(F.min("p").alias("place"), F.min_by(name, "p").alias("name"))
    return one.select("page_id", "place", "slug", "name", *[F.lit(v).alias(k) for k, v in (fixed or {}).items()])


def distinct_names(df: DataFrame, name: str = "name", order: str = "place") -> DataFrame:
    """One row per name in any case: the first by ``order``."""
    row = F.struct(*[F.col(c) for c in df.columns])
    return df.groupBy(F.lower(F.trim(name)).alias("_k")).agg(F.min_by(row, order).alias("r")).select("r.*")


def detail_fields(pages: DataFrame, least: int = 2, most: int = 500) -> DataFrame:
    """``page_id, name, description, category, website, twitter, telegram, discord, github`` of detail pages."""
    page = F.coalesce(F.col("html"), F.lit(""))
    heading = F.trim(F.regexp_replace(F.regexp_replace(F.regexp_extract(page, r"(?is)<h1\b[^>]*>(.*?)</h1>", 1), "<[^>]+>", " "), r"\s+", " "))
    link = lambda p: F.regexp_extract(page, rf"(?i)href=[\"'](https?://(?:www\.)?(?:{p})/[^\"']+)[\"']", 1)
    bounded = lambda c: F.when(F.length(c) >= least, F.substring(c, 1, most)).otherwise("")
    outside = F.filter(H.hrefs("html"), lambda h: h.rlike("^https?://") & (hostname(h) != hostname(F.col("url"))) & ~h.rlike(r"(?i)//(www\.)?(twitter\.com|x\.com|t\.me|telegram\.me|discord\.(gg|com)|github\.com)"))
    return pages.select(
        "page_id",
        bounded(heading).alias("name"),
        bounded(H.description("html", 1)).alias("description"),
        bounded(F.regexp_extract(page, r"(?is)<meta[^>]*article:section[^>]*content=[\"']([^\"']*)", 1)).alias("category"),
        F.coalesce(F.get(outside, F.lit(0)), F.lit("")).alias("website"),
        link(r"twitter\.com|x\.com").alias("twitter"),
        link(r"t\.me|telegram\.me").alias("telegram"),
        link(r"discord\.gg|discord\.com").alias("discord"),
        link(r"github\.com").alias("github"),
    )
