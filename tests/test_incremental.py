import pytest
from pyspark.sql import functions as F

from millrace.operators import incremental as inc

SCHEMA = "topic string, source_sha string"


def target(spark, tmp_path, **kw):
    return inc.VersionedTarget(spark, f"file://{tmp_path}/t", ["topic"], "source_sha", **kw)


def rows(df):
    return sorted((r["topic"] or "", r["source_sha"]) for r in df.collect())


def test_runs_neither_skip_nor_repeat(spark, tmp_path):
    t = target(spark, tmp_path)
    one = spark.createDataFrame([("a", "1"), ("b", "1"), (None, "1"), ("c", None)], SCHEMA)
    work, base = t.pending(one)
    assert base == 0 and rows(work) == [("", "1"), ("a", "1"), ("b", "1")]
    assert t.publish(work, base) == 1
    work, base = t.pending(spark.createDataFrame([("a", "1"), ("b", "2"), (None, "1")], SCHEMA))
    assert rows(work) == [("b", "2")]
    t.publish(work, base)
    assert rows(t.read()) == [("", "1"), ("a", "1"), ("b", "2")]


def test_interleaved_runs_are_refused(spark, tmp_path):
    t = target(spark, tmp_path)
    t.publish(*t.pending(spark.createDataFrame([("a", "1")], SCHEMA)))
    slow, base = t.pending(spark.createDataFrame([("a", "2"), ("b", "1")], SCHEMA))
    t.publish(*t.pending(spark.createDataFrame([("a", "3"), ("b", "1")], SCHEMA)))
    with pytest.raises(inc.Conflict):
        t.publish(slow, base)
    assert rows(t.read()) == [("a", "3"), ("b", "1")]


def test_two_commits_of_one_version(spark, tmp_path):
    t = target(spark, tmp_path)
    t.publish(*t.pending(spark.createDataFrame([("a", "1")], SCHEMA)))
    with pytest.raises(inc.Conflict):
        t._commit(1, ["other"])
    assert rows(t.read()) == [("a", "1")]


def test_a_crash_before_the_commit_leaves_no_trace(spark, tmp_path, monkeypatch):
    t = target(spark, tmp_path)
    t.publish(*t.pending(spark.createDataFrame([("a", "1")], SCHEMA)))
    source = spark.createDataFrame([("a", "2"), ("b", "1")], SCHEMA)
    with monkeypatch.context() as m:
        m.setattr(t, "_commit", lambda *a: (_ for _ in ()).throw(OSError("died")))
        with pytest.raises(OSError):
            t.publish(*t.pending(source))
    assert rows(t.read()) == [("a", "1")]
    work, base = t.pending(source)
    assert rows(work) == [("a", "2"), ("b", "1")]
    t.publish(work, base)
    assert rows(t.pending(source)[0]) == []


def test_compacts_past_its_folders(spark, tmp_path):
    t = target(spark, tmp_path, most_folders=2)
    for v in "1234":
        t.publish(*t.pending(spark.createDataFrame([("a", v), ("b", "1")], SCHEMA)))
    assert len(t.current()[1]) <= 2 and rows(t.read()) == [("a", "4"), ("b", "1")]


def test_empty_repeated_and_clashing(spark):
    source = spark.createDataFrame([("a", "1", 5), ("a", "1", 5), ("b", None, 6)], SCHEMA + ", settled int")
    none = spark.createDataFrame([], SCHEMA + ", settled boolean")
    assert inc.pending(source, none, ["topic"], "source_sha", "settled").count() == 2
    held = spark.createDataFrame([("a", "0", True)], SCHEMA + ", settled boolean")
    assert inc.pending(source, held, ["topic"], "source_sha", "settled").count() == 0
    assert inc.pending(source, held.withColumn("settled", F.lit(None).cast("boolean")), ["topic"], "source_sha", "settled").count() == 2
    assert inc.newest(source.limit(0), ["topic"], ["source_sha"]).count() == 0
