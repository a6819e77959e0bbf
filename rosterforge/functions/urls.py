"""URLs, domains and handles: Column -> Column."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from rosterforge.schema import cell, trim

#: Prefixes that stand for a profile on the same network (fixed values).
HANDLE_PREFIXES = ["https://twitter.com/", "http://twitter.com/", "https://x.com/", "http://x.com/", "https://www.twitter.com/"]
ADMIN_HOST = "admin.thegrid.id"


def with_scheme(c: str | Column) -> Column:
    url = trim(c)
    return F.when((url == "") | url.rlike("^https?://"), url).otherwise(F.concat(F.lit("https://"), url))


def url_key(c: str | Column) -> Column:
    """Lower case without scheme, ``www.``, trailing slashes and then the query: a slash
    before a query stays."""
    url = F.regexp_replace(F.lower(trim(c)), "^https?://", "")
    url = F.regexp_replace(F.regexp_replace(url, r"^www\.", ""), "/+$", "")
    return F.regexp_replace(url, r"\?.*$", "")


def domain(c: str | Column) -> Column:
    """Host in lower case without a leading ``www.`` and the port; the scheme is optional."""
    host = F.regexp_extract(trim(c), "^(?:https?://)?([^/?#]*)", 1)
    return F.substring_index(F.regexp_replace(F.lower(host), r"^www\.", ""), ":", 1)


def registry_domain(c: str | Column) -> Column:
    """As ``domain``, but any scheme counts, every ``www.`` goes and the port stays."""
    host = F.regexp_extract(cell(c), "^(?:[^/]*?://)?([^/?#]*)", 1)
    return F.replace(F.lower(host), F.lit("www."), F.lit(""))


def hostname(c: str | Column) -> Column:
    """As ``domain`` without user and port."""
    return F.substring_index(domain(c), "@", -1)


def is_fetchable(c: str | Column) -> Column:
    """An http(s) URL with a host that is neither local nor a bare address."""
    url = trim(c)
    host = F.lower(F.regexp_extract(with_scheme(c), "^https?://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    local = host.isin("localhost", "127.0.0.1", "0.0.0.0") | host.rlike(r"^\d{1,3}(\.\d{1,3}){3}$")
    other_scheme = url.rlike("^[A-Za-z][A-Za-z0-9+.-]*://") & ~url.rlike("^https?://")
    return (url != "") & (host != "") & ~local & ~other_scheme


def handle(c: str | Column) -> Column:
    """``@name`` from a handle or a profile URL."""
    text = trim(c)
    prefix = "(?i)^(" + "|".join(re.escape(p) for p in HANDLE_PREFIXES) + ")"
    name = F.regexp_replace(F.regexp_replace(F.regexp_replace(text, prefix, ""), "/+$", ""), r"\?.*$", "")
    return F.when(name == "", F.lit("")).when(name.startswith("@"), name).otherwise(F.concat(F.lit("@"), name))


def handle_in_page(c: str | Column) -> Column:
    """The handle that a link in a page names; share and intent links name none."""
    name = F.regexp_extract(cell(c), r"(?i)(?:twitter\.com|x\.com)/@?([A-Za-z0-9_]+)", 1)
    return F.when((name == "") | F.lower(name).isin("share", "intent"), F.lit("")).otherwise(F.concat(F.lit("@"), name))


def profile_link(handle_: str | Column) -> Column:
    name = F.regexp_replace(trim(handle_), "^@+", "")
    return F.when(name == "", F.lit("")).otherwise(F.concat(F.lit("https://x.com/"), name))


def root_id(root: str | Column, url: str | Column) -> Column:
    """The root id, where empty the one in an admin URL's query."""
    query = F.regexp_extract(cell(url), r"[?&]rootId=([^&#]*)", 1)
    found = F.coalesce(F.try_url_decode(query), query)
    return F.when(trim(root) != "", trim(root)).when(cell(url).contains(ADMIN_HOST), found).otherwise("")


def app_store(c: str | Column) -> Column:
    """struct(type, id) of an app page, null elsewhere."""
    play = F.regexp_extract(cell(c), r"play\.google\.com/store/apps/details\?(?:[^#]*&)?id=([A-Za-z0-9._]+)", 1)
    apple = F.regexp_extract(cell(c), r"apps\.apple\.com/.*?/?id(\d+)", 1)
    made = lambda kind, i: F.struct(F.lit(kind).alias("type"), i.alias("id"))
    return F.when(play != "", made("google_play", play)).when(apple != "", made("apple", apple))


def glob_pattern(glob: str) -> str:
    """A URL glob as a regular expression: ``**`` is anything, ``*`` stays within a path part."""
    return "^" + ".*".join("[^/]*".join(re.escape(x) for x in part.split("*")) for part in glob.split("**")) + "$"


def route(c: Column, rules: list[tuple[str, str]], default: str) -> Column:
    """The value of the first (glob, value) rule that the URL fits."""
    found = [F.when(c.rlike(glob_pattern(g)), F.lit(v)) for g, v in rules]
    return F.coalesce(*found, F.lit(default))


def chain_from_path(c: Column, patterns: list[str]) -> Column:
    """The first pattern's first group that is not empty, URL-decoded."""
    found = F.coalesce(*[F.nullif(F.regexp_extract(c, p, 1), F.lit("")) for p in patterns], F.lit(""))
    return F.coalesce(F.try_url_decode(found), found)


def without_tracking(c: str | Column) -> Column:
    """Without ``utm_*`` parameters."""
    bare = F.regexp_replace(cell(c), r"([?&])utm_[^&#]*(?:&utm_[^&#]*)*(&?)", "$1")
    return F.regexp_replace(F.regexp_replace(bare, r"[?&]+(#|$)", "$1"), r"\?&+", "?")


def is_app_entry(c: str | Column) -> Column:
    return hostname(c).startswith("app.")


def resolved(base: Column, href: Column) -> Column:
    """An absolute URL for a link on the page ``base``."""
    scheme = F.regexp_extract(base, "^([A-Za-z][A-Za-z0-9+.-]*):", 1)
    origin = F.regexp_extract(base, "^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    bare = F.regexp_replace(base, "[?#].*$", "")
    path = F.substring(bare, F.length(origin) + 1, F.length(bare))
    folder = F.when(path.contains("/"), F.regexp_replace(path, "[^/]*$", "")).otherwise("/")
    joined = F.when(href.startswith("/"), href).when(href.startswith("?"), F.concat(path, href)).otherwise(F.concat(folder, href))
    tail = F.regexp_extract(joined, "([?#].*)$", 1)
    steps = F.split(F.regexp_replace(joined, "[?#].*$", ""), "/")
    # "." stays put, ".." goes up; a path that ends in either ends in a slash
    fold = lambda acc, s: (
        F.when(s == ".", acc).when((s == "..") & (F.size(acc) > 1), F.slice(acc, 1, F.size(acc) - 1)).when(s == "..", acc).otherwise(F.array_append(acc, s))
    )
    walked = F.array_join(F.aggregate(steps, F.array().cast("array<string>"), fold), "/")
    walked = F.concat(walked, F.when(F.element_at(steps, -1).isin(".", "..") & ~walked.endswith("/"), "/").otherwise(""))
    return (
        F.when(href.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(scheme, F.lit(":"), href))
        .otherwise(F.concat(origin, walked, tail))
    )
