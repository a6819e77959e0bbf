from collections import Counter
from hashlib import sha256

from hypothesis import given
from hypothesis import strategies as st

from rosterforge.llm import merkle


@given(st.text(alphabet="ab.!\n é", max_size=80), st.text(alphabet="ab.!\n é", max_size=80))
def test_equal_prints_mean_equal_texts(a, b):
    assert (merkle.fingerprint(a) == merkle.fingerprint(b)) == (a == b)
    assert 0 <= merkle.likeness(merkle.fingerprint(a), merkle.fingerprint(b)) <= 1


def test_an_edit_is_local_and_located():
    lines = [f"Line number {i} says something of its own. And more." for i in range(60)]
    edited = lines.copy()
    edited[30] = "Another line altogether!"
    a, b = merkle.fingerprint("\n".join(lines)), merkle.fingerprint("\n".join(edited))
    assert merkle.likeness(a, b) > 0.9
    flat = [p for s in a.partition(":")[2].split("/") for p in s.split(".")]
    (place,) = merkle.differing(a, b)
    section, paragraph = place
    sizes = [len(s.split(".")) for s in a.partition(":")[2].split("/")]
    assert sum(sizes[:section]) + paragraph == 30 and len(flat) == 60
    assert merkle.differing(a, a) == []


def test_short_texts_keep_what_an_edit_leaves():
    a = "a short text of a few words"
    assert 0.5 <= merkle.likeness(merkle.fingerprint(a), merkle.fingerprint(a[:18] + "something")) < 1


def own_spans(line):
    """The rule for spans, character by character."""
    ends = lambda c: c in ".!?。！？" or 0x2E80 <= ord(c) < 0xD800 and ord(c) % 16 < 2
    out, i = [], 0
    while i < len(line):
        j = i
        if ends(line[i]):
            while j < len(line) and j - i < 8 and ends(line[j]):
                j += 1
        else:
            j += 1
            while j < len(line) and j - i < 8:
                if ends(line[j]) or line[j] == " " and line[j - 1] in "dhlptx":
                    j += not ends(line[j])
                    break
                j += 1
            k = j
            if j - i < 8 and j < len(line) and ends(line[j]) and not (line[j - 1] == " " and j - i > 1 and line[j - 2] in "dhlptx"):
                while k < len(line) and k - j < 8 and ends(line[k]):
                    k += 1
            j = k
        out.append(line[i:j])
        i = j
    return out


def own_tree(text):
    """(root, [[leaf digests of a paragraph] of a section]) by the docstring."""
    h = lambda mark, parts: sha256(mark + b"".join(parts)).digest()
    sections, open_ = [], []
    for line in text.split("\n") if text else []:
        leaves = [sha256(x.encode()).digest() for x in own_spans(line)]
        open_.append((h(b"\1", leaves), leaves))
        if line == "" or open_[-1][0][0] % 8 == 0:
            sections.append(open_)
            open_ = []
    sections += [open_] * bool(open_)
    return h(b"\3", [h(b"\2", [n for n, _ in s]) for s in sections]), [[leaves for _, leaves in s] for s in sections]


def own_likeness(a, b):
    (root, x), (other, y) = own_tree(a), own_tree(b)
    if root == other:
        return 1.0
    x, y = (Counter(d[:3] for s in t for p in s for d in p) for t in (x, y))
    return 2 * (x & y).total() / max(1, x.total() + y.total())


@given(st.text(alphabet="abdh.! \né八八九中。", max_size=90))
def test_a_fingerprint_is_the_trees(text):
    root, sections = own_tree(text)
    assert merkle.fingerprint(text) == root.hex() + ":" + "/".join(".".join("".join(d[:3].hex() for d in p) for p in s) for s in sections)
    assert "".join(x for line in text.split("\n") for x in own_spans(line)) == text.replace("\n", "")


def test_an_insertion_moves_few_spans():
    chinese = "".join(chr(0x4E00 + (i * i * 7 + i) % 3000) for i in range(360))
    words = " ".join(f"{'word' if i % 3 else 'more'}{chr(97 + i % 26)} sand" for i in range(80))
    for text in (chinese, words):
        assert own_likeness("x" + text, text) > 0.8
        assert merkle.likeness(merkle.fingerprint("x" + text), merkle.fingerprint(text)) == own_likeness("x" + text, text)


def brute(rows):
    """Rows in descending id, nulls last, each with the next one's text."""
    ids = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    return [(i, t or "", ids[(n + 1) % len(ids)][1] or "") for n, (i, t, *_) in enumerate(ids)]


def test_edited_texts(spark, make, prose, odd):
    for rows in ([(i * 7 % 101, t) for i, t in enumerate(prose(2, 90))], [odd[i] for i in (0, 1, 2, 3, 4, 7, 8, 9)], [(1, "only one row")]):
        got = {r.doc_id: r for r in merkle.compare_edited(make(rows)).collect()}
        assert len(got) == len(rows)
        for i, text, after in brute(rows):
            k = len(text) // 3
            edited = text[: len(text) - k] + after[:k]
            r = got[i]
            assert (r.n_chars, r.edited_sha256) == (len(text), sha256(edited.encode()).hexdigest())
            assert (r.fingerprint.split(":")[0], r.edited_fingerprint.split(":")[0]) == (own_tree(text)[0].hex(), own_tree(edited)[0].hex())
            assert (r.near_edited, r.near_next) == (own_likeness(text, edited), own_likeness(text, after))


def test_repeated_rows_and_no_rows(spark, make, odd):
    assert merkle.compare_edited(make(odd)).count() == len(odd)
    assert merkle.compare_edited(make([])).count() == 0


def test_many_rows_of_one_id_are_dealt_over_ranges(spark, make, prose):
    texts = prose(10, 60)
    rows = [(None if i % 3 == 0 else 5 if i % 3 == 1 else i, t) for i, t in enumerate(texts)]
    got = merkle.compare_edited(make(rows)).collect()
    hashes = {(r.doc_id, r.text): r.h for r in make(rows).selectExpr("doc_id", "text", "xxhash64(doc_id, text) h").collect()}
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), hashes[r]))
    want = []
    for n, (i, t) in enumerate(order):
        edited = t[: len(t) - len(t) // 3] + order[(n + 1) % len(order)][1][: len(t) // 3]
        want.append((str(i), sha256(edited.encode()).hexdigest()))
    assert sorted((str(r.doc_id), r.edited_sha256) for r in got) == sorted(want)


def test_texts_on_either_side_of_any_length_are_alike(prose):
    text = prose(9, 1, 80, 80)[0]
    for n in (64, 128, 256, 257, 300):
        assert merkle.likeness(merkle.fingerprint(text[:n]), merkle.fingerprint(text[: n - 1])) > 0.8
