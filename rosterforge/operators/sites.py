"""Site rules: which pages are lists or details of which site, and what is read from them.

Rules are rows.  A page is routed to its site by address, meets the site's rules
in a broadcast join and evaluates each by its own pattern, so any number of
sites share one plan and one scan.  Selectors are those of elements by tag and
attributes; they are turned into patterns once, on the driver.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterforge.functions.urls import glob_pattern
from rosterforge.operators.mapping import TRANSFORMS

#: Rule rows that may be broadcast; more are joined by shuffle.
BROADCAST_RULES = 10_000
#: Profile links that every detail page may have (fixed values).
SOCIAL = {"twitter": r"(?:twitter|x)\.com", "telegram": r"(?:t\.me|telegram\.me)", "discord": r"discord\.(?:gg|com)", "github": r"github\.com"}


@dataclass(frozen=True)
class Field:
    """How a detail page tells a field: ``read`` is text, href or url; ``every`` joins all
    elements' alternative text, title or text; shorter values than ``least`` do not count,
    longer ones than ``most`` are cut."""

    name: str
    selector: str
    read: str = "text"
    first_word: bool = False
    every: bool = False
    least: int = 0
    most: int = 0


@dataclass(frozen=True)
class Links:
    """How a list page tells its records: anchors whose target fits ``slug`` (first group), names
    of 2 to ``most`` characters after a transform, fixed fields, fields with ``{slug}``."""

    slug: str
    transform: str = ""
    most: int = 0
    distinct: bool = True
    fixed: dict[str, str] = field(default_factory=dict)
    more: dict[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class Site:
    """A site: its addresses as globs, kinds of page by a pattern of the path (first that fits,
    else ``default``), patterns of the path whose first group is the chain, and its rules."""

    name: str
    globs: tuple[str, ...]
    kinds: tuple[tuple[str, str], ...] = ()
    default: str = "detail"
    chain: tuple[str, ...] = ()
    fields: tuple[Field, ...] = ()
    links: Links | None = None
    social: bool = True


_ATTRIBUTE = re.compile(r"\[\s*([\w-]+)\s*(?:([*^$]?=)\s*[\"']?([^\"'\]]*)[\"']?)?\s*\]")
_PART = re.compile(r"^([A-Za-z][\w-]*|\*)?((?::not\()?\[[^\]]*\]\)?)*$")


def _condition(attribute: re.Match, negated: bool) -> str:
    name, sign, value = attribute.groups()
    said = re.escape(value or "")
    quoted = {None: r"", "=": rf"\s*=\s*[\"']{said}[\"']", "*=": rf"\s*=\s*[\"'][^\"'>]*{said}", "^=": rf"\s*=\s*[\"']{said}", "$=": rf"\s*=\s*[\"'][^\"'>]*{said}[\"']"}[sign]
    return f"(?{'!' if negated else '='}[^>]*?\\s{name}{quoted})"


def element_pattern(selector: str) -> str:
    """A pattern for elements by tag, ``[a=v]``, ``[a*=v]``, ``[a^=v]``, ``[a$=v]``, ``:not([...])`` and commas; its
    groups are tag, attributes and content.  Anything else in a selector is an error.
    An element ends at the first closing tag of its name, if it has one."""
    found = []
    for part in (p.strip() for p in selector.split(",")):
        if not part or not (whole := _PART.match(part)):
            raise ValueError(f"selector not supported: {part}")
        tag = whole[1] if whole[1] and whole[1] != "*" else r"[A-Za-z][\w-]*"
        conditions = "".join(_condition(a, part[: a.start()].endswith(":not(")) for a in _ATTRIBUTE.finditer(part))
        found.append(rf"{tag}(?=[\s/>]){conditions}")
    return rf"(?is)<({'|'.join(found)})([^>]*)>(?:(.*?)</\1\s*>)?"


def _rules(df: DataFrame, rows: list[tuple], schema: str) -> DataFrame:
    rules = df.sparkSession.createDataFrame(rows, schema)
    return F.broadcast(rules) if len(rows) <= BROADCAST_RULES else rules


def _path(url: Column) -> Column:
    return F.regexp_extract(url, "^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def routed(pages: DataFrame, sites: list[Site]) -> DataFrame:
    """``pages`` with ``site``, ``kind`` and ``chain`` (null for pages of no site; the first site that fits)."""
    path = _path(F.col("url"))
    site = F.coalesce(*[F.when(F.col("url").rlike(glob_pattern(g)), F.lit(s.name)) for s in sites for g in s.globs], F.lit(None).cast("string"))
    out = pages.withColumn("site", site)

    def of(s: Site, value: Column) -> Column:
        return F.when(F.col("site") == s.name, value)

    kind = [of(s, F.coalesce(*[F.when(path.rlike(p), F.lit(k)) for p, k in s.kinds], F.lit(s.default))) for s in sites]
    raw = [of(s, F.coalesce(*[F.nullif(F.regexp_extract(path, p, 1), F.lit("")) for p in s.chain], F.lit(""))) for s in sites]
    nothing = F.lit(None).cast("string")
    chain = F.coalesce(*raw, nothing)
    return out.withColumns({"kind": F.coalesce(*kind, nothing), "chain": F.coalesce(F.try_url_decode(chain), chain)})


def _plain(html: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(html, "<[^>]*>", " "), r"\s+", " "))


def _told(text: Column, pattern: Column, group: int) -> Column:
    """A group of a rule's own pattern."""
    return F.call_function("regexp_extract", text, pattern, F.lit(group))


def _attribute(attributes: Column, name: str) -> Column:
    return F.regexp_extract(attributes, rf"(?is)(?:^|\s){name}\s*=\s*[\"']([^\"']*)[\"']", 1)


def detail_fields(pages: DataFrame, sites: list[Site]) -> DataFrame:
    """``page_id, site, chain, fields`` (map): detail pages by their site's rules, those with a name.

    A rule takes the first element that its selector fits; absent and too short values
    are no fields.  ``social`` adds the page's first profile link of each kind.  A rule
    for ``chain`` stands before the address.  ``page_id`` must be unique; null pages
    have only what their address tells."""
    rows = [(s.name, f.name, f.read, f.selector if f.read == "url" else element_pattern(f.selector), f.first_word, f.every, f.least, f.most) for s in sites for f in s.fields]
    rows += [(s.name, k, "link", rf"(?i)href=[\"'](https?://(?:www\.)?{p}/[^\"']+)[\"']", False, False, 0, 0) for s in sites if s.social for k, p in SOCIAL.items()]
    rules = _rules(pages, rows, "site string, field string, read string, pattern string, first_word boolean, every boolean, least int, most int")
    html = F.coalesce("html", F.lit(""))
    at = F.col("pattern")
    met = routed(pages, sites).where("kind = 'detail'").join(rules, "site")
    first = _told(html, at, 3)
    texts = F.zip_with(F.regexp_extract_all(html, at, F.lit(2)), F.regexp_extract_all(html, at, F.lit(3)), lambda a, t: F.coalesce(F.nullif(_attribute(a, "alt"), F.lit("")), F.nullif(_attribute(a, "title"), F.lit("")), _plain(t)))
    value = (
        F.when(F.col("read") == "url", _told(_path(F.col("url")), at, 1))
        .when(F.col("read") == "link", _told(html, at, 1))
        .when(F.col("every"), F.array_join(F.filter(F.array_distinct(texts), lambda t: t != ""), ", "))
        .when(F.col("read") == "href", _attribute(_told(html, at, 2), "href"))
        .otherwise(F.when(F.col("first_word"), F.regexp_extract(_plain(first), r"^(\S*)", 1)).otherwise(_plain(first)))
    )
    told = met.select("page_id", "site", "chain", "field", value.alias("value"), "least", "most").where((F.col("value") != "") & (F.length("value") >= F.col("least")))
    told = told.withColumn("value", F.when(F.col("most") > 0, F.substring("value", F.lit(1), F.col("most"))).otherwise(F.col("value")))
    # one entry for each rule of a site
    out = told.groupBy("page_id", "site", "chain").agg(F.map_from_entries(F.array_sort(F.collect_set(F.struct("field", "value")))).alias("fields"))
    chain = F.coalesce(F.element_at("fields", "chain"), "chain")
    return out.where(F.map_contains_key("fields", "name")).select("page_id", "site", chain.alias("chain"), "fields")


def list_records(pages: DataFrame, sites: list[Site]) -> DataFrame:
    """``page_id, site, chain, place, slug, name, fields`` (map): list pages by their site's rules.

    One row per slug of a page (its first anchor), or per anchor; names are the anchors'
    text, and those under 2 characters or of ``most`` and more drop out.  An anchor that
    drops out still uses up its slug."""
    with_links = [s for s in sites if s.links]
    rows = [(s.name, s.links.slug, s.links.transform, s.links.most, s.links.distinct, s.links.fixed, s.links.more) for s in with_links]
    rules = _rules(pages, rows, "site string, pattern string, transform string, most int, once boolean, fixed map<string,string>, more map<string,string>")
    met = routed(pages, sites).where("kind = 'list'").join(rules, "site")
    anchors = F.regexp_extract_all("html", F.lit(r"(?is)(<a\b[^>]*\bhref\s*=\s*[\"'][^\"']*[\"'][^>]*>.*?</a>)"), F.lit(1))
    each = met.select("page_id", "site", "chain", "pattern", "transform", "most", "once", "fixed", "more", F.posexplode(anchors).alias("place", "a"))
    each = each.withColumns({"slug": _told(F.regexp_extract("a", r"(?is)^<a\b[^>]*\bhref\s*=\s*[\"']([^\"']*)[\"']", 1), F.col("pattern"), 1), "name": _plain(F.col("a"))}).where("slug <> ''")
    kinds = sorted({s.links.transform for s in with_links} - {""})
    name = F.coalesce(*[F.when(F.col("transform") == k, TRANSFORMS[k](F.col("name"))) for k in kinds], F.col("name"))
    key = F.when(F.col("once"), F.lit(-1)).otherwise(F.col("place"))
    rest = F.struct("place", name.alias("name"), "chain", "most", "fixed", "more")
    one = each.groupBy("page_id", "site", "slug", key.alias("k")).agg(F.min_by(rest, "place").alias("x")).select("page_id", "site", "slug", "x.*")
    one = one.where((F.length("name") >= 2) & ((F.col("most") <= 0) | (F.length("name") < F.col("most"))))
    told = F.transform_values("more", lambda _, v: F.replace(v, F.lit("{slug}"), F.col("slug")))
    fields = F.map_concat(F.map_filter("fixed", lambda k, _: ~F.map_contains_key("more", k)), told)
    return one.select("page_id", "site", "chain", "place", "slug", "name", fields.alias("fields"))
