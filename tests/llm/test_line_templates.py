import re
from collections import defaultdict

import corpus_pipeline as pipeline

from rosterforge.llm import line_templates as lt


def brute(rows, levels):
    """The texts that stay, by the rules told in the docstrings."""
    gone = set().union(*[dropped(rows, level) for level in levels])
    return ["\n".join(x for p, x in enumerate(text.split("\n")) if (row, p) not in gone) if text is not None else None for row, (_, text, *_) in enumerate(rows)]


def dropped(rows, level):
    texts = level.texts
    lines = []
    for row, (i, text, *_) in enumerate(rows):
        for pos, line in enumerate((text or "").split("\n") if text is not None else []):
            tokens = [lt.FIELD if re.search("[0-9]", w) else w for w in re.sub("[ \t\x0b-\r]+", " ", line).strip(" ").split(" ")]
            if line.strip(" \t\x0b\x0c\r") and level.least <= len(tokens) <= level.most:
                lines.append(((i is None, i or 0, row, pos), text, (len(tokens), *tokens[: lt.DEPTH]), tuple(tokens)))
    by_leaf, support = defaultdict(set), defaultdict(set)
    for _, text, leaf, tokens in lines:
        by_leaf[leaf].add(text)
        support[leaf, tokens].add(text)
    held = defaultdict(int)
    for (leaf, tokens), t in support.items():
        if len(by_leaf[leaf]) >= texts:
            for at, w in enumerate(tokens):
                held[leaf, at, w] += len(t)
    template, often = {}, defaultdict(int)
    for (leaf, tokens), t in support.items():
        if len(by_leaf[leaf]) >= texts:
            slots = tuple(w if w != lt.FIELD and held[leaf, at, w] >= texts else lt.FIELD for at, w in enumerate(tokens))
            constants = sum(held[leaf, at, w] >= texts and w != lt.FIELD for at, w in enumerate(tokens))
            if constants / len(tokens) >= lt.CONSTANT and constants >= level.fixed:
                template[leaf, tokens] = leaf, slots
                often[leaf, slots] += len(t)
    first, gone = {}, set()
    for place, _, leaf, tokens in sorted(lines):
        t = template.get((leaf, tokens))
        if t and often[t] >= texts:
            if first.setdefault(t, place) != place:
                gone.add(place[2:])
    return gone


def test_recurring_templates_go_but_for_the_first(spark, make, prose):
    rows = []
    for i, t in enumerate(prose(11, 40)):
        extra = [f"Page {i} of 40 printed on day {i * 3}", "All rights reserved by the owner.", f"Hello there {t.split()[0]}"][: 1 + i % 3]
        rows.append((i, "\n".join([t, *extra, "", "ok"]) if i % 4 else "\n".join([*extra, t])))
    levels = (lt.Level(20, 1, 2, 0), *lt.LEVELS[1:])
    got = {r.doc_id: r for r in lt.dedup(make(rows), levels=levels).collect()}
    want = brute(rows, levels)
    assert [got[i].text for i in range(40)] == want
    assert sum(r.n_dropped for r in got.values()) == sum((t or "").count("\n") - (w or "").count("\n") for (_, t), w in zip(rows, want, strict=True)) + sum(bool(t) and not w for (_, t), w in zip(rows, want, strict=True))
    assert "All rights reserved by the owner." in got[1].text and "All rights reserved" not in got[2].text + got[5].text


def test_copies_of_a_document_are_one_text(spark, make, prose):
    text = "\n".join(prose(12, 6, 8, 12))
    rows = [(i, text) for i in range(30)]
    assert {r.text for r in lt.dedup(make(rows)).collect()} == {text}


def test_odd_rows(spark, make, odd):
    for texts in (1, 2, 10):
        got = lt.dedup(make(odd), levels=(lt.Level(texts, 1, lt.MOST, 0),)).collect()
        assert len(got) == len(odd)
        assert {r.text for r in got if r.doc_id == 2} == {None}
    assert lt.dedup(make([])).count() == 0


def test_the_main_path_is_native(spark, make, prose):
    plan = lt.dedup(make([(i, t) for i, t in enumerate(prose(1, 5))]))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_the_pipeline_drops_a_long_passage_of_two_documents(spark, make, prose):
    passage, short = prose(13, 1, 55, 55)[0], "a short line in two documents"
    rows = [(i, "\n".join([t, passage, short]) if i in (2, 5) else t) for i, t in enumerate(prose(14, 12, 60, 60))]
    got = {r.doc_id: r.text for r in pipeline.lines(spark, make(rows), "").collect()}
    assert [i for i, t in got.items() if passage in t] == [2]
    assert all(short in got[i] for i in (2, 5)) and all(got[i].split("\n")[0] == t.split("\n")[0] for i, t in rows)


def test_short_lines_in_many_texts_go_but_for_the_first(spark, make, prose):
    rows = [(i, "\n".join([t, "Read more", "Share", "", f"Page {i}"])) for i, t in enumerate(prose(15, 60, 30, 40))]
    got = {r.doc_id: r.text for r in lt.dedup(make(rows)).collect()}
    assert [got[i] for i in range(60)] == brute(rows, lt.LEVELS)
    assert [i for i, t in got.items() if "Read more" in t] == [0] and [i for i, t in got.items() if "Share" in t] == [0]
    assert all("\n" in got[i] and got[i].split("\n")[0] == rows[i][1].split("\n")[0] for i in range(60))


def test_levels_share_their_joins(spark, make, prose):
    docs = make([(i, t) for i, t in enumerate(prose(16, 5))])
    joins = [lt.recurring(docs, levels=lt.LEVELS[:n])._jdf.queryExecution().optimizedPlan().toString().count("Join ") for n in (1, 3)]
    assert joins[0] == joins[1] > 0
