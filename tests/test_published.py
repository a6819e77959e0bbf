import threading

import pytest
from helpers import catalog
from pyspark.sql import functions as F

from rosterforge import schema as S
from rosterforge.sources import sheets, versions


def names(df):
    return sorted(r[0] for r in df.select(S.NAME).collect())


def test_readers_see_whole_versions(spark, tmp_path):
    root = str(tmp_path / "table")
    with pytest.raises(FileNotFoundError):
        versions.read(spark, root)
    one = catalog(spark, [{"name": "A &amp; B, C"}, {"name": "D"}])
    assert versions.publish(one, root) == 1 and names(versions.read(spark, root)) == ["A & B; C", "D"]
    opened = versions.read(spark, root)
    bad = one.withColumn(S.NAME, F.when(F.col("row_id") == 1, F.raise_error("broken")).otherwise(F.col(S.NAME)))
    with pytest.raises(Exception, match="broken"):
        versions.publish(bad, root)
    assert versions.latest(spark, root) == 1 and names(versions.read(spark, root)) == ["A & B; C", "D"]
    assert versions.publish(catalog(spark, [{"name": "New"}]), root, kind="csv", seen=1) == 2
    assert names(versions.read(spark, root)) == ["New"] and names(opened) == ["A & B; C", "D"] == names(versions.read(spark, root, 1))
    assert versions.read(spark, root).columns == list(S.CATALOG)
    with pytest.raises(versions.Conflict):
        versions.publish(one, root, seen=1)
    assert versions.restore(spark, root, 1) == 3 and names(versions.read(spark, root)) == ["A & B; C", "D"]
    assert versions.vacuum(spark, root, keep=1) == 2  # the other version and the failed write
    assert names(versions.read(spark, root)) == ["A & B; C", "D"]
    assert [r.version for r in versions.history(spark, root).orderBy("version").collect()] == [1, 2, 3]
    with pytest.raises(FileNotFoundError):
        versions.restore(spark, root, 9)


def test_one_of_two_writers_wins(spark, tmp_path):
    root, out = str(tmp_path / "table"), []
    frames = [catalog(spark, [{"name": n}]) for n in ("x", "y")]
    versions.publish(frames[0], root)

    def write(df):
        try:
            out.append(versions.publish(df, root, seen=1))
        except versions.Conflict:
            out.append("conflict")

    both = [threading.Thread(target=write, args=(df,)) for df in frames]
    for t in both:
        t.start()
    for t in both:
        t.join()
    assert sorted(map(str, out)) == ["2", "conflict"] and len(versions.read(spark, root).collect()) == 1


def test_an_empty_table(spark, tmp_path):
    root = str(tmp_path / "table")
    versions.publish(catalog(spark, [{"name": "x"}]).limit(0), root)
    assert versions.read(spark, root).count() == 0 and set(S.CATALOG) <= set(versions.read(spark, root).columns)


def test_each_sheet_by_its_own_kind(spark, tmp_path):
    folder = tmp_path / "in"
    (folder / "deeper").mkdir(parents=True)
    text = {
        "a.csv": ("Name,Web\nÜber,u.example\n\"two\nlines\",x\n", "utf-8"),
        "b.tsv": ("Name\tWeb\nCafé, bar\tc.example\n", "latin-1"),
        "c.csv": ("Name,Web\n" + "x,y\n" * 3000 + "niño,n\n", "latin-1"),
        "d.csv": ("Other,Name\n1,Dé\n", "utf-8"),
        "e.csv": ("", "utf-8"),
        "f.csv": ("  \n1,2\n", "utf-8"),
        "deeper/g h+[1]*.csv": ("Name,Web,,name\nlast,é,1,2\n", "utf-8-sig"),
    }
    for name, (body, code) in text.items():
        (folder / name).write_bytes(body.encode(code))
    kinds = {r.file.rpartition("/")[2]: (r.sep, r.encoding) for r in sheets.file_kinds(spark, str(folder)).collect()}
    assert kinds == {"a.csv": (",", "UTF-8"), "b.tsv": ("\t", "ISO-8859-1"), "c.csv": (",", "ISO-8859-1"), "d.csv": (",", "UTF-8"), "g%20h+%5B1%5D*.csv": (",", "UTF-8")}
    df = sheets.read_sheets(spark, str(folder))
    rows = df.orderBy("row_id").collect()
    assert [(r.Name or r.Name0, r.Web, r.Other) for r in rows if (r.Name, r.Web) != ("x", "y")] == [
        ("Über", "u.example", None), ("two\nlines", "x", None), ("Café, bar", "c.example", None), ("niño", "n", None), ("Dé", None, "1"), ("last", "é", None),
    ]
    assert len(rows) == 3006 == len({r.row_id for r in rows}) and [r.source_file for r in rows] == sorted(r.source_file for r in rows)


def test_blank_sheets_have_no_rows(spark, tmp_path):
    (tmp_path / "e.csv").write_text("")
    assert sheets.read_sheets(spark, str(tmp_path)).count() == 0
