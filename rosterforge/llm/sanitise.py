"""Personal data by fixed patterns, and terms that reveal them by co-occurrence.

A protected entity is a value that a pattern finds.  The words around its
occurrences are terms that may reveal it.  Corpus counts give the information
a term has about an entity, PMI(t, e) = ln(N n(e,t) / n(e) n(t)), and the
entity's own information, IC(e) = ln(N / n(e)), n counting documents.  A term
whose PMI reaches a share of the entity's IC discloses it; its occurrences
beside the entity are spans as well, to be generalised or removed.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterforge.llm.common import cut, row_key

#: The patterns as the contract gives them (fixed values); possessive where that
#: changes no match but keeps long runs linear.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
KINDS = ("email", "ip", "card", "phone")
#: What replaces a span of each kind.
MARKS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", "term": "[TERM]"}

WORD = re.compile("[^\x20\x09-\x0d]+")
PUNCTUATION = ".,;:!?()[]{}\"'|"
#: White space to Python's split() that separates no words here.
OTHER_SPACE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
#: By default, words on either side of an entity, in its line, that may reveal it (None: all).
AROUND: int | None = None
#: By default, characters searched for them on either side (None: all of the line).
REACH: int | None = None
#: Letters that a term has at least.
LEAST = 3
#: Documents that hold a term and an entity before it can disclose it: one, as most entities stand in one.
SUPPORT = 1
#: Share of an entity's information at which a term discloses it.
DISCLOSURE = 0.8
#: Terms whose counts a worker keeps before it passes them on.
FLUSH = 400_000
#: Terms in question up to which they are broadcast to the counts of all terms (8 bytes each).
BROADCAST_TERMS = 1_000_000

Span = tuple[str, int, int]


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """Spans (code points, end exclusive) by kind as listed, then start."""
    found: list[Span] = []
    end, at = 0, text.find("@")
    while at >= 0:
        # each match holds one @: the run of local characters before it is leftmost
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            found.append(("email", start, end := m.end()))
        at = text.find("@", at + 1)
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in m[0].split(".")):
            found.append(("ip", m.start(), m.end()))
    for m in CARD.finditer(text):
        if 16 <= len(d := re.sub("[^0-9]", "", m[0])) <= 19 and _luhn(d):
            found.append(("card", m.start(), m.end()))
    for m in PHONE.finditer(text):
        if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            found.append(("phone", m.start(), m.end()))
    return found


def _hash(value: str) -> int:
    return xxhash.xxh64_intdigest(value) - (1 << 63)


def _terms(text: str) -> set[str]:
    low = text.lower()
    return {w.strip(PUNCTUATION) for w in set(WORD.findall(low) if OTHER_SPACE.search(low) else low.split())}


def _entity(kind: str, value: str) -> int:
    return _hash(kind + ":" + (value.lower() if kind in ("email", "ip") else re.sub("[^0-9]", "", value)))


def neighbours(text: str, spans: list[Span], around: int | None = AROUND, reach: int | None = REACH) -> list[tuple[list[int], list[tuple[int, int, int]]]]:
    """(entities, (term, start, end) of the words around them): one for each line that holds
    spans, with all its words; or, where ``around`` or ``reach`` bounds these, one for each span.

    Words that overlap a span or touch one are no terms."""
    covered: list[list[int]] = []  # the spans' union, in order
    for _, start, end in sorted(spans, key=lambda s: s[1:]):
        if covered and start <= covered[-1][1]:
            covered[-1][1] = max(end, covered[-1][1])
        else:
            covered.append([start, end])
    starts, ends = [c[0] for c in covered], [c[1] for c in covered]

    def terms(words: list[re.Match[str]]) -> list[tuple[int, int, int]]:
        out = []
        for m in words:
            term, i = m[0].strip(PUNCTUATION), bisect_left(ends, m.start())
            if len(term) >= LEAST and (i == len(starts) or starts[i] > m.end()):
                at = m.start() + m[0].index(term)
                out.append((_hash(term.lower()), at, at + len(term)))
        return out

    breaks = [m.start() for m in re.finditer("\n", text)] if spans else []
    lines: dict[tuple[int, int], list[Span]] = {}
    for span in spans:
        i = bisect_left(breaks, span[1])
        lines.setdefault((breaks[i - 1] + 1 if i else 0, breaks[i] if i < len(breaks) else len(text)), []).append(span)
    if around is None and reach is None:
        return [(list({_entity(k, text[a:b]) for k, a, b in held}), terms(list(WORD.finditer(text, *line)))) for line, held in lines.items()]
    out = []
    reach = len(text) if reach is None else reach
    around = len(text) if around is None else around
    for (first, last), held in lines.items():
        for kind, start, end in held:
            low, high = max(first, start - reach), min(last, end + reach)
            # a word that touches the span or the end of the reach may be part of a longer one
            before = [m for m in WORD.finditer(text, low, start) if m.end() < start and (m.start() > low or not low or text[low - 1].isspace())]
            after = [m for m in WORD.finditer(text, end, high) if m.start() > end and (m.end() < high or high == len(text) or text[high].isspace())]
            out.append(([_entity(kind, text[start:end])], terms([*before[max(0, len(before) - around) :], *after[:around]])))
    return out


def find(docs: DataFrame, key: str = "doc_id", text: str = "text", around: int | None = AROUND, reach: int | None = REACH) -> DataFrame:
    """One row per document: ``key, n_email, n_ip, n_card, n_phone`` (long),
    ``base_sha256`` and ``spans``: kind:start:end by kind, then start, comma-joined.

    Null text is empty.  Rows of one id are kept apart by their text; equal rows
    get equal spans.  All words of an entity's line are in question, unless ``around`` or
    ``reach`` bounds how far from it a term can be a span; counts are of whole documents
    always.  Texts are read whole; two passes read them and only numbers are shuffled.

    n(t) rules out most terms before they meet an entity: as n(e,t) is at most n(e), a term
    that discloses e has n(t) <= n(e)^D N^(1-D), D being ``DISCLOSURE``.  Entities of one
    document ask for nothing but that, hence need no pairs."""
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).cast("string").alias("k"), row_key(key, text).alias("row"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for k, row, t in zip(batch["k"], batch["row"], batch["text"], strict=True):
                spans = base_spans(t)
                n = Counter(s[0] for s in spans)
                near = neighbours(t, spans, around, reach)
                held = {_entity(kind, t[a:b]) for kind, a, b in spans}
                words = [_hash(w) for w in _terms(t)] if spans else []
                beside = [(i, e) for i, (entities, _) in enumerate(near) for e in entities]
                terms = [(i, *x) for i, (_, found) in enumerate(near) for x in found]
                base = ",".join(f"{a}:{b}:{c}" for a, b, c in spans)
                out.append((k, row, *(n[x] for x in KINDS), base, list(held), words, *([x[i] for x in beside] for i in range(2)), *([x[i] for x in terms] for i in range(4))))
            yield pd.DataFrame(out, columns=["k", "row", *KINDS, "base", "held", "words", "of", "entity", "line", "term", "start", "end"])

    schema = "k string, row long, email long, ip long, card long, phone long, base string, held array<long>, words array<long>, of array<int>, entity array<long>, line array<int>, term array<long>, start array<int>, end array<int>"
    found = cut(rows.mapInPandas(scan, schema))
    some = found.where(F.size("term") > 0)
    beside = some.select("row", F.explode(F.arrays_zip(F.col("of").alias("line"), "entity")).alias("x")).select("row", "x.*").distinct()
    near = some.select("row", F.explode(F.arrays_zip("line", "term", "start", "end")).alias("x")).select("row", "x.*").distinct()

    n_docs = found.count()
    # all counts are of documents: those that hold the entity, the term, or both, wherever they stand
    within = found.where(F.size("held") > 0).select(F.explode("held").alias("entity"), "words")
    held = cut(within.groupBy("entity").agg(F.count("*").alias("n_e")))
    often = held.where("n_e > 1").select("entity")
    asked = cut(near.select("term").distinct())
    few = asked.count() <= BROADCAST_TERMS

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def passed_on() -> pd.DataFrame:
            out = pd.DataFrame({"term": [_hash(w) for w in n], "n": list(n.values())}, dtype="int64")
            n.clear()
            return out

        n: Counter[str] = Counter()
        for batch in batches:
            for t in batch["text"]:
                n.update(_terms(t))
                if len(n) > FLUSH:
                    yield passed_on()
        yield passed_on()

    spread = rows.select("text").mapInPandas(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n_t"))
    spread = spread.join(F.broadcast(asked) if few else asked, "term", "left_semi")
    total = F.lit(float(n_docs))
    own = F.log(total / F.col("n_e"))
    pmi = F.log(total * F.col("n_et") / (F.col("n_e").cast("double") * F.col("n_t")))
    tells = (own > 0) & (pmi >= DISCLOSURE * own) & (F.col("n_et") >= SUPPORT)
    # of the terms in question, those rare enough for the most frequent entity of their line
    beside = beside.join(held, "entity")
    most = beside.groupBy("row", "line").agg(F.max("n_e").alias("n_e"), F.min("n_e").alias("least"))
    rare = F.log(F.col("n_t").cast("double")) <= DISCLOSURE * F.log(F.col("n_e").cast("double")) + (1 - DISCLOSURE) * F.log(total) + 1e-9
    near = cut(near.join(spread, "term").join(most, ["row", "line"]).where(rare).drop("n_e"))
    once = near.where("least = 1").withColumns({"n_e": F.lit(1), "n_et": F.lit(1)}).where(tells).select("row", "start", "end")
    met = near.join(beside.where("n_e > 1"), ["row", "line"]).where(rare)
    both = within.join(often, "entity").select("entity", F.explode("words").alias("term")).groupBy("entity", "term").agg(F.count("*").alias("n"))
    pairs = met.select("entity", "term", "n_e", "n_t").distinct().join(both, ["entity", "term"], "left")
    telling = pairs.withColumn("n_et", F.coalesce("n", F.lit(1))).where(tells).select("entity", "term")
    added = once.unionByName(met.join(telling, ["entity", "term"]).select("row", "start", "end"))
    added = added.groupBy("row").agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("more"))
    added = added.select("row", F.array_join(F.transform("more", lambda s: F.concat_ws(":", F.lit("term"), s["start"], s["end"])), ",").alias("more"))
    return found.join(added, "row", "left").select(
        F.col("k").cast(kind).alias(key),
        *[F.col(x).alias("n_" + x) for x in KINDS],
        F.sha2("base", 256).alias("base_sha256"),
        F.concat_ws(",", F.when(F.col("base") != "", F.col("base")), "more").alias("spans"),
    )


def _redact(text: str | None, listed: str | None) -> str | None:
    if not text or not listed:
        return text
    out, end = [], 0
    for start, stop, kind in sorted((int(a), -int(b), k) for k, a, b in (s.split(":") for s in listed.split(","))):
        if start >= end:
            out += [text[end:start], MARKS[kind]]
            end = -stop
    return "".join([*out, text[end:]])


def redacted(text: Column, spans: Column) -> Column:
    """Text with its spans (as ``find`` gives them) generalised to their kind; where
    spans overlap, the one that starts first, then the longer one."""

    @F.pandas_udf("string")
    def redact(texts: pd.Series, listed: pd.Series) -> pd.Series:
        return pd.Series([_redact(t, s) for t, s in zip(texts, listed, strict=True)], dtype="object")

    return redact(text, spans)
