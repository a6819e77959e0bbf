import json

from pyspark.sql import functions as F

from rosterforge.operators import records as R


def script(data, attrs='type="application/json"'):
    return f"<script {attrs}>{data if isinstance(data, str) else json.dumps(data)}</script>"


NEXT = 'id="__NEXT_DATA__" type="application/json"'


def found(spark, pages):
    df = spark.createDataFrame(list(enumerate(pages)), "page_id long, html string")
    out = {}
    for r in R.found_records(df).orderBy("page_id", "place").collect():
        out.setdefault(r.page_id, []).append((r.path, r.score, r.map_key, json.loads(r.record)))
    return out


def named(n, **more):
    return [{"name": f"Item {i}", **more} for i in range(n)]


def test_best_array_at_any_path(spark):
    data = {"props": {"a": {"b": named(7, website="https://w", tags=[])}}, "z": named(9), "short": named(4, url="u", slug="s"), "numbers": list(range(30))}
    got = found(spark, [f"<p>x</p>{script(data, NEXT)}", script({"a": {"b": {"c": {"d": {"e": named(5)}}}}}, NEXT), script({"a": {"b": {"c": {"d": {"e": {"f": named(5)}}}}}}, NEXT)])
    assert [x[:2] for x in got[0]] == [("$.props.a.b", 28)] * 7 and got[0][3][3]["name"] == "Item 3"  # an empty list is given
    assert got[1][0][0] == "$.a.b.c.d.e" and 2 not in got  # six levels down is too deep
    unnamed = [{"name": "x"}, {"title": 5}, {"label": None}, {}, 3, "s", [1]]
    assert found(spark, [script({"a": unnamed}, NEXT)]) == {}


def test_several_blocks(spark):
    weak, good = {"w": [*named(4), {}]}, {"g": named(5, description="d")}
    got = found(spark, [script(weak) + script("no json") + script({"g": named(5)}) + script(good), script(weak), script(good) + script(weak, NEXT), script({"g": named(6)}, "type=text/x") + script(good, "type='application/json' id=q")])
    assert [len(v) for v in got.values()] == [5, 5, 5]
    assert got[0][0][1] == 10 and got[2][0][0] == "$.w" and got[3][0][0] == "$.g" and 1 not in got


def test_maps_of_records(spark):
    entries = {f"slug-{i}": {"profile": {"name": f"P{i}"}} for i in range(12)}
    got = found(spark, [script({"props": {"all": entries, "few": dict(list(entries.items())[:4])}}, NEXT), script({"m": entries}), script({"m": {f"k{i}": i for i in range(9)}}, NEXT)])
    assert list(got) == [0] and len(got[0]) == 12
    assert {x[:2] for x in got[0]} == {("$.props.all", 120)} and {x[2] for x in got[0]} == set(entries)


def test_odd_pages(spark):
    assert found(spark, [None, "", "<script>", script("[1,2"), script("null", NEXT), script("5"), script("[]", NEXT)]) == {}
    assert R.found_records(spark.createDataFrame([], "page_id long, html string")).count() == 0


def test_normalized_records(spark):
    rows = [
        {"name": "Alpha", "twitter": "https://x.com/alpha?s=1", "url": "https://a", "tags": ["dex", "amm"], "id": 7, "tagline": "t" * 600},
        {"name": "top", "profile": {"name": "Inner", "linktree": {"twitter": "inner", "telegram": "t.me/i"}, "tags": {"a": "x", "b": ["y", "z"]}}},
        {"profile": {"description": ""}, "description": "hidden"},
        {"title": "T", "label": "Long enough"},
        {"label": 12},
        {"title": "", "projectName": "By project", "twitterHandle": "bare", "network": "N, M", "category": "c"},
        [1],
        "text",
    ]
    df = spark.createDataFrame([(i, json.dumps(r), "key-of" if i == 2 else None) for i, r in enumerate(rows)] + [(99, "no json", "k"), (100, None, None)], "i int, record string, k string")
    got = {r.i: r for r in R.normalized(df, "record", "k").collect()}
    assert set(got) == {0, 1, 2, 5}
    assert (got[0].name, got[0].slug, got[0].website, got[0].twitter, got[0].category, len(got[0].description)) == ("Alpha", "7", "https://a", "@alpha", "dex; amm", 500)
    assert (got[1].name, got[1].slug, got[1].twitter, got[1].telegram, got[1].category) == ("Inner", "inner", "@inner", "t.me/i", "x; y; z")
    assert (got[2].name, got[2].slug, got[2].description) == ("key-of", "key-of", "")
    assert (got[5].name, got[5].slug, got[5].twitter, got[5].chain, got[5].category) == ("By project", "by-project", "@bare", "N; M", "c")


def test_first_object_knows_strings(spark):
    texts = ['0:x {"a":{"b":"}{\\" }"}} after } {"c":1}', "{ no field } {}", '{"open":{"x":1}', "", None, 'x{"a":"' + "y{" * 200_000 + '"}}}']
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", R.first_object(F.col("t")).alias("o"))
    got = {r.i: r.o for r in df.collect()}
    assert got[0] == '{"a":{"b":"}{\\" }"}}' and got[5] == texts[5][1:-2]
    assert [got[i] for i in (1, 2, 3, 4)] == [None] * 4


def test_streamed_objects(spark):
    data = {f"s{i}": {"profile": {"name": f"Na}}me {i}", "tagline": 'say "hi" {'}} for i in range(8)}
    raw = "1:T {x} " + json.dumps(data) + ' and {"more": "text}"}'
    cut = [raw[i : i + 50] for i in range(0, len(raw), 50)]
    push = lambda s: f"<script>self.__next_f.push([1, {json.dumps(s)}])</script>"
    pages = ["".join(map(push, cut)), push('{"a": 1}'), push("bad \\u12") + "x", None, push("y" * 300_000 + json.dumps(data))]
    df = spark.createDataFrame(list(enumerate(pages)), "page_id long, html string")
    got = R.streamed_records(df).collect()
    assert {(r.page_id, r.map_key): json.loads(r.record) for r in got} == {(p, k): v for p in (0, 4) for k, v in data.items()}
    assert df.select(R.streamed_object("html", 0).alias("v")).where("v is not null").count() == 3
