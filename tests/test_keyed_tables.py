"""Tables by key: what a write touches, lost writers, two writers at once, old versions."""

import os

import pytest
from pyspark.sql import functions as F

from medloom.sinks import keyed
from medloom.sinks.keyed import Conflict, KeyedTable

KIND = "k int, g int, v string"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def frame(spark, data, kind=KIND):
    return spark.createDataFrame(data, kind)


def many(spark, n=200):
    return spark.range(n).select(F.col("id").cast("int").alias("k"), (F.col("id") % 7).cast("int").alias("g"), F.lit("a").alias("v"))


def files_of(path, folder):
    return sorted(d for d in os.listdir(f"{path}/{folder}") if d.startswith("__bucket="))


def test_an_upsert_of_one_key_reads_and_writes_one_bucket(spark, tmp_path, monkeypatch):
    t = KeyedTable(spark, f"file://{tmp_path}/t", ["k"], buckets=16)
    first = t.upsert(many(spark))
    assert len(first.folders) == 16
    read = []

    def seen(self, version=None, only=None, real=KeyedTable.read):
        read.append(only)
        return real(self, version, only)

    monkeypatch.setattr(KeyedTable, "read", seen)
    second = t.upsert(frame(spark, [(17, 0, "new")]))
    monkeypatch.undo()
    assert [len(x) for x in read] == [1]
    changed = [b for b in range(16) if first.folders[b] != second.folders[b]]
    assert changed == read[0]
    (folder,) = second.folders[changed[0]]
    assert files_of(tmp_path / "t" / "data", folder.split("/")[1]) == [f"__bucket={changed[0]}"]
    want = {k: ("new" if k == 17 else "a") for k in range(200)}
    assert {r["k"]: r["v"] for r in t.read().collect()} == want
    assert rows(t.lookup(k=17)) == [(17, 0, "new")] and rows(t.lookup(k=1000)) == []
    files = {os.path.basename(os.path.dirname(f)) for f in t.lookup(k=17).inputFiles()}
    assert files == {f"__bucket={changed[0]}"}
    assert {r["v"] for r in t.read(first).collect()} == {"a"}


@pytest.mark.parametrize("same", [False, True])
def test_two_writers_at_once_lose_nothing(spark, tmp_path, monkeypatch, same):
    path = f"file://{tmp_path}/t"
    a, b = (KeyedTable(spark, path, ["k"], buckets=64) for _ in range(2))
    a.upsert(many(spark))
    computed, raced = [], []

    def publish(self, v, real=KeyedTable._publish):
        if self is a and not raced:  # the other writer is faster
            raced.append(b.upsert(frame(spark, [(3, 9, "b")] if same else [(4, 9, "b")])).number)
        return real(self, v)

    def merged(old, new):
        computed.append(1)
        return keyed.upsert(old, new, ["k"])

    monkeypatch.setattr(KeyedTable, "_publish", publish)
    last = a.write(frame(spark, [(3, 1, "a2")]), merged)
    monkeypatch.undo()
    assert raced == [2] and last.number == 3
    # a writer whose buckets are as it read them does not begin anew
    assert len(computed) == (2 if same else 1)
    got = {r["k"]: r["v"] for r in a.read().collect()}
    assert got == {**dict.fromkeys(range(200), "a"), 3: "a2"} | ({} if same else {4: "b"})


def test_a_writer_that_always_loses_says_so(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(keyed, "TRIES", 2)
    path = f"file://{tmp_path}/t"
    a, b = (KeyedTable(spark, path, ["k"], buckets=2) for _ in range(2))
    a.upsert(many(spark, 10))

    def publish(self, v, real=KeyedTable._publish):
        if self is a:
            b.upsert(many(spark, 10).withColumn("v", F.lit(str(v.number))))
        return real(self, v)

    monkeypatch.setattr(KeyedTable, "_publish", publish)
    with pytest.raises(Conflict):
        a.upsert(frame(spark, [(3, 1, "z")]))


@pytest.mark.parametrize("step", ["data", "version"])
def test_a_lost_writer_leaves_the_old_rows(spark, tmp_path, monkeypatch, step):
    t = KeyedTable(spark, f"file://{tmp_path}/t", ["k"], buckets=4)
    t.upsert(frame(spark, [(1, 1, "a"), (2, 1, "b")]))
    if step == "version":

        def lost(self, v):
            raise OSError("lost")

        monkeypatch.setattr(KeyedTable, "_publish", lost)
        new = frame(spark, [(1, 1, "z")])
    else:
        new = frame(spark, [(1, 1, "z")]).withColumn("v", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        t.upsert(new)
    monkeypatch.undo()
    assert rows(t.read()) == [(1, 1, "a"), (2, 1, "b")] and t.version().number == 1
    t.upsert(frame(spark, [(1, 1, "y")]))
    assert rows(t.read()) == [(1, 1, "y"), (2, 1, "b")]
    assert t.clear(age=3600) == [] and t.clear(age=0) != [] and t.clear(age=0) == []
    assert rows(t.read()) == [(1, 1, "y"), (2, 1, "b")] and t._numbers() == [2]


def test_replace_delete_and_insert(spark, tmp_path):
    t = KeyedTable(spark, f"file://{tmp_path}/t", ["g"], buckets=4)
    t.replace(frame(spark, [(1, 1, "a"), (2, 1, "b"), (3, 2, "c"), (4, None, "d")]))
    t.replace(frame(spark, [(5, 1, "e"), (6, 1, "f"), (7, None, "g"), (7, None, "g")]))
    assert rows(t.read()) == [(3, 2, "c"), (5, 1, "e"), (6, 1, "f"), (7, None, "g"), (7, None, "g")]
    t.delete(frame(spark, [(1,), (9,)], "g int"))
    assert rows(t.read()) == [(3, 2, "c"), (7, None, "g"), (7, None, "g")]
    u = KeyedTable(spark, f"file://{tmp_path}/u", ["k"])
    u.insert_missing(frame(spark, [(1, 1, "b"), (1, 1, "a")]))
    u.insert_missing(frame(spark, [(1, 9, "z"), (2, 9, "y")]))
    assert rows(u.read()) == [(1, 1, "a"), (2, 9, "y")]
    assert u.upsert(frame(spark, [])).number == 2 and rows(u.read().select("v", "k")) == [("a", 1), ("y", 2)]


def test_stamps_and_late_rows(spark, tmp_path):
    t = KeyedTable(spark, f"file://{tmp_path}/t", ["k"])
    kind = "k int, v string, at string"
    t.upsert(frame(spark, [(1, "a", "old"), (2, None, "old"), (3, "c", "old")], kind))
    t.upsert_stamped(frame(spark, [(1, "a", ""), (2, None, ""), (3, "d", ""), (4, "e", "")], kind), "at", F.lit("now"))
    assert rows(t.read()) == [(1, "a", "old"), (2, None, "old"), (3, "d", "now"), (4, "e", "now")]
    u = KeyedTable(spark, f"file://{tmp_path}/u", ["k"])
    u.keep_greatest(frame(spark, [(1, 5, "x"), (2, 1, "x")]), ["g"])
    u.keep_greatest(frame(spark, [(1, 4, "late"), (2, 2, "y")]), ["g"])
    assert rows(u.read()) == [(1, 5, "x"), (2, 2, "y")]


def test_empty_and_other_keys(spark, tmp_path):
    t = KeyedTable(spark, f"file://{tmp_path}/t", ["k"])
    with pytest.raises(FileNotFoundError):
        t.read()
    t.upsert(frame(spark, []))
    assert rows(t.read()) == [] and t.read().columns == ["k", "g", "v"]
    with pytest.raises(ValueError, match="keys"):
        KeyedTable(spark, t.path, ["g"]).upsert(many(spark, 3))
    t.upsert(many(spark, 3))
    assert t.read().count() == 3
