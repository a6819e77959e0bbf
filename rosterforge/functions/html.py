"""Text, descriptions and links of HTML pages: Column -> Column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rosterforge.functions import kernels
from rosterforge.schema import cell

#: Link targets that are not pages (fixed values).
ASSETS = [".css", ".js", ".png", ".jpg", ".jpeg", ".gif", ".svg", ".ico", ".woff", ".woff2", ".ttf", ".eot", ".pdf", ".zip", ".mp4", ".webm", ".mp3", ".xml", ".json", ".rss"]
BLOCKS = r"(?is)<(script|style|noscript)\b[^>]*>.*?</\1>"


def without_tags(html: str | Column) -> Column:
    """Script, style and noscript blocks and all tags become spaces."""
    return F.regexp_replace(F.regexp_replace(cell(html), BLOCKS, " "), r"<[^>]+>", " ")


def page_text(html: str | Column, entities: bool = True, unclosed: bool = True) -> Column:
    """Visible text: entities decoded, white space collapsed, lower case.  Entities without
    their semicolon are decoded as browsers do, or left as they are (``unclosed`` false).
    Only texts that may hold an entity go through the decoder."""
    text = without_tags(html)
    if entities:
        may = text.contains("&") if unclosed else text.rlike(kernels.CLOSED)
        text = F.when(may, kernels.unescaped(text, unclosed)).otherwise(text)
    return F.lower(F.trim(F.regexp_replace(text, r"(?U)\s+", " ")))


def _meta(html: Column, key: str) -> Column:
    name = rf"(?:name|property)\s*=\s*[\"']{key}[\"']"
    value = r"content\s*=\s*[\"']([^\"']*)[\"']"
    found = F.coalesce(
        F.nullif(F.regexp_extract(html, rf"(?is)<meta[^>]*{name}[^>]*{value}", 1), F.lit("")),
        F.regexp_extract(html, rf"(?is)<meta[^>]*{value}[^>]*{name}", 1),
    )
    return F.trim(found)


def description(html: str | Column, least: int = 20) -> Column:
    """The page's own description: Open Graph, else meta, else JSON-LD; each of at least ``least`` characters."""
    page = cell(html)
    data = F.regexp_extract(page, r"(?is)<script[^>]*application/ld\+json[^>]*>(.*?)</script>", 1)
    told = [_meta(page, "og:description"), _meta(page, "description"), F.trim(F.get_json_object(data, "$.description"))]
    return F.coalesce(*[F.when(F.length(t) >= least, t) for t in told], F.lit(""))


def hrefs(html: str | Column) -> Column:
    return F.regexp_extract_all(cell(html), F.lit(r"(?i)href=[\"']([^\"']+)[\"']"), F.lit(1))
