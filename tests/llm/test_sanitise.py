import math
import re
from hashlib import sha256

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rosterforge.llm import sanitise

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def plain(text):
    out = []
    for kind, p in PATTERNS.items():
        for m in re.finditer(p, text):
            d = re.sub("[^0-9]", "", m[0])
            if {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")), "card": 16 <= len(d) <= 19 and luhn(d), "phone": 8 <= len(d) <= 15}[kind]:
                out.append((kind, m.start(), m.end()))
    return out


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(alphabet="a@.b-1 ", max_size=30), st.text(alphabet="0123.5+() -a", max_size=40), st.text(max_size=20)))
def test_base_spans_are_the_patterns(text):
    assert sanitise.base_spans(text) == plain(text)


def test_known_spans():
    text = "é x@y.co.uk 256.1.1.1 10.0.0.255, 4111 1111 1111 1111 +1 (626) 555-5759 a@b@c.de"
    assert sanitise.base_spans(text) == plain(text) and {k for k, *_ in plain(text)} == set(PATTERNS)
    assert sanitise.base_spans("1" * 50000 + "@" * 50000 + "a" * 50000) == []


def docs_with_a_tell():
    rows = [(i, f"filler words number{i} and the rest of it\nagent zorbix wrote from spy{i % 2}@corp.com about the matter of day {i}") for i in range(8)]
    rows += [(100 + i, f"agents and the matter of other things {i}") for i in range(40)]
    return [*rows, (200, "zorbix wrote nothing here")]


def test_terms_that_reveal_an_entity_are_added(spark, make):
    rows = docs_with_a_tell()
    got = {r.doc_id: r for r in sanitise.find(make(rows)).collect()}
    assert len(got) == len(rows)
    text = dict(rows)
    total = len(rows)
    for i in range(8):
        added = {text[i][int(a) : int(b)] for k, a, b in (s.split(":") for s in got[i].spans.split(",")) if k == "term"}
        # by definition, from counts of documents
        want = set()
        line, email = text[i].split("\n")[1], f"spy{i % 2}@corp.com"
        near = [w for w in line.split() if w != email and len(w) >= sanitise.LEAST]
        with_e = [t for _, t in rows if email in t]
        for w in near:
            both = sum(w in t.split("\n")[1].split() for t in with_e)
            alone = sum(w in t.split() for _, t in rows)
            pmi = math.log(total * both / (len(with_e) * alone))
            if both >= sanitise.SUPPORT and pmi >= sanitise.DISCLOSURE * math.log(total / len(with_e)):
                want.add(w)
        assert added == want
        assert got[i].spans.startswith("email:") and got[i].n_email == 1
    assert all(got[i].spans == "" for i in (*range(100, 140), 200))


def test_a_telling_term_is_found_and_replaced(spark, make):
    rows = [(i, f"call zorbix at spy@corp.com on day{i}") for i in range(5)] + [(10 + i, f"call me on day{i} please {i}") for i in range(30)]
    docs = make(rows)
    found = sanitise.find(docs).select("doc_id", "spans")
    out = {r.doc_id: r.safe for r in docs.join(found, "doc_id").select("doc_id", sanitise.redacted(F.col("text"), F.col("spans")).alias("safe")).collect()}
    assert out[0] == "call [TERM] at [EMAIL] on day0" and out[10] == rows[5][1]


def test_odd_rows_and_both_ways_of_counting(spark, make, odd, monkeypatch):
    rows = [*odd, *docs_with_a_tell(), *docs_with_a_tell()]
    a = sorted(map(str, sanitise.find(make(rows)).collect()))
    monkeypatch.setattr(sanitise, "BROADCAST_TERMS", 0)
    monkeypatch.setattr(sanitise, "FLUSH", 10)
    b = sorted(map(str, sanitise.find(make(rows)).collect()))
    assert a == b and len(a) == len(rows)
    by = {r.doc_id: r for r in sanitise.find(make(odd)).collect()}
    assert by[2].base_sha256 == sha256(b"").hexdigest() and by[2].spans == "" and by[2].n_card == 0
    assert sanitise.find(make([])).count() == 0


def test_terms_by_an_entity_of_one_document_are_found(spark, make):
    rows = [(i, f"write to ann{i}@corp.com about codename{i} and the matter") for i in range(3)]
    rows += [(10 + i, f"the matter and what to write about {i}") for i in range(40)]
    rows += [(60, "x@corp.com"), (61, "quolm\nx@corp.com"), (62, "quolm x@corp.com")]
    text, terms = dict(rows), {}
    for r in sanitise.find(make(rows)).collect():
        terms[r.doc_id] = [text[r.doc_id][int(a) : int(b)] for k, a, b in (s.split(":") for s in r.spans.split(",") if s) if k == "term"]
    assert [terms[i] for i in range(3)] == [["codename0"], ["codename1"], ["codename2"]]
    # quolm and x@corp.com share two documents of three: ln(46 * 2 / (3 * 2)) of ln(46 / 3)
    assert terms[62] == ["quolm"] and not terms[60] and not terms[61]


def test_terms_far_away_or_beside_odd_spaces(spark, make):
    far = "filler " * 60
    rows = [(1, f"codename {far} ann@corp.com and the matter"), (2, "bob@corp.com told zorb\u00a0ix the matter"), *((10 + i, f"filler and the matter told {i}") for i in range(40))]
    for around, want in ((8, []), (None, ["codename"])):
        got = {r.doc_id: r.spans for r in sanitise.find(make(rows), around=around, reach=None).collect()}
        terms = {i: [dict(rows)[i][int(a) : int(b)] for k, a, b in (s.split(":") for s in got[i].split(",")) if k == "term"] for i in (1, 2)}
        assert terms == {1: want, 2: ["zorb\u00a0ix"]}


def test_no_word_of_the_line_is_left_out_by_default(spark, make):
    far = "filler " * 60
    rows = [(1, f"codename {far} ann@corp.com {far} bob@corp.com {far} secret, and\nother"), *((10 + i, f"filler and the other told {i}") for i in range(40))]
    spans = {r.doc_id: r.spans for r in sanitise.find(make(rows)).collect()}[1].split(",")
    assert [rows[0][1][int(a) : int(b)] for k, a, b in (s.split(":") for s in spans) if k == "term"] == ["codename", "secret"]


def test_neighbours_are_listed_once_a_line():
    text = " ".join(f"word{i} a{i}@b.co" for i in range(300)) + "\nnext c@d.ef (c@d.ef) +12 345 678 90"
    found = sanitise.neighbours(text, sanitise.base_spans(text))
    assert [(len(set(e)), [text[a:b] for _, a, b in t]) for e, t in found] == [(300, [f"word{i}" for i in range(300)]), (2, ["next"])]
