import corpus_pipeline as pipeline
import pytest

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for _, stage in pipeline.STAGES:
        out.append(stage(spark, out[-1], SF).persist())
    return out


def test_stages_return_documents(steps):
    assert [n for n, _ in pipeline.STAGES] == ["quality", "lines", "near_duplicates", "mixture", "sequences"]
    for df in steps[1:-1]:
        assert df.columns == COLUMNS and [t for _, t in df.dtypes] == ["bigint", "string", "string", "string", "bigint"]


def test_each_stage_acts_on_what_came_before(spark, steps):
    raw, good, lines, single, mixed, packed = ([r.doc_id for r in df.select("doc_id").collect()] for df in steps)
    assert len(good) < len(raw) and set(good) < set(raw)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    clean = [i for i in raw if labels.get(i) == 1]
    junk = [i for i in raw if labels.get(i) == 0]
    assert len([i for i in clean if i in set(good)]) >= 0.99 * len(clean)
    assert len([i for i in junk if i in set(good)]) <= 0.2 * len(junk)
    assert sorted(lines) == sorted(good)
    assert len(single) == len(set(single)) <= len(lines)
    texts = [r.text for r in steps[3].collect()]
    assert len(texts) == len(set(texts))
    assert set(mixed) <= set(single) and max(mixed.count(i) for i in set(mixed)) <= 2
    assert set(packed) == set(mixed)


def test_run_applies_all_stages(spark, steps):
    key = lambda r: (r.doc_id, r.piece, r.start, r.length, r.ids_crc32)
    assert sorted(map(key, pipeline.run(spark, SF).collect())) == sorted(map(key, steps[-1].collect()))
