"""The two computations that Spark has no expression for, as Arrow-batched UDFs."""

from __future__ import annotations

import re
from difflib import SequenceMatcher
from html import unescape
from html.entities import html5

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: An entity that its semicolon ends.
CLOSED = "&(?:#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);"


def ratios(a: list[str], b: list[str], least: float = 0.0) -> list[float]:
    """difflib's similarity of each pair, in this order (it is not symmetric); 0 where it is
    certainly not above ``least``.

    A pair's shared characters bound its matching blocks, so most unlike pairs need
    no blocks.  Pairs of one right string come together, as difflib's index of that
    string is most of a comparison's cost; each different pair is compared once."""
    known: dict[tuple[str, str], float] = {}
    m, right = SequenceMatcher(None), None
    for x, y in sorted(set(zip(a, b, strict=True)), key=lambda p: p[1]):
        if y != right:
            m.set_seq2(y)
            right = y
        m.set_seq1(x)
        far = least > 0 and (m.real_quick_ratio() <= least or m.quick_ratio() <= least)
        known[x, y] = 0.0 if far else m.ratio()
    return [known[p] for p in zip(a, b, strict=True)]


def ratio(a: Column, b: Column, least: float = 0.0) -> Column:
    """``ratios`` as a column; null is empty."""

    @F.pandas_udf("double")
    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series(ratios(x.fillna("").tolist(), y.fillna("").tolist(), least), dtype="float64")

    return run(a, b)


def _unescape_closed(text: str) -> str:
    return re.sub(CLOSED, lambda m: unescape(m[0]) if m[0][1] == "#" or m[0][1:] in html5 else m[0], text)


def unescaped(c: Column, unclosed: bool = True) -> Column:
    """All HTML entities decoded; those without their semicolon only if ``unclosed``."""
    decode = unescape if unclosed else _unescape_closed

    @F.pandas_udf("string")
    def run(x: pd.Series) -> pd.Series:
        return x.map(decode, na_action="ignore")

    return run(c)
