"""Process only new or changed records: the target is the state.

Every output row keeps the key and the version of the source row it was made from. What is still to
do is the source, anti-joined against those columns; there is no second book-keeping that could
disagree with the data. A run writes its rows into a folder of its own and then publishes a new
target version by an atomic rename of one small manifest, so a run that dies leaves no trace.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.session import shared_dir, table


def newest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row for each key: the one with the greatest ``order`` columns, nulls being the least.

    A sorted aggregate with map-side combine, so a key that holds a third of the rows shuffles one row
    for each input split. Rows delivered twice are equal and collapse. Null keys form a group.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    best = F.max(F.struct(*order, *_tie_broken(df, rest))).alias("_best")
    out = df.groupBy(*keys).agg(best)
    return out.select(*keys, *[F.col(f"_best.{c}").alias(c) for c in df.columns if c not in keys])


def _tie_broken(df: DataFrame, rest: Sequence[str]) -> list[str]:
    kinds = dict(df.dtypes)
    bad = [c for c in rest if kinds[c].startswith("map")]
    if bad:
        raise ValueError(f"map columns can't be ordered: {bad}")
    return list(rest)


def as_of(points: DataFrame, states: DataFrame, keys: Sequence[str], at: str, order: Sequence[str]) -> DataFrame:
    """For each row of ``points`` the newest row of ``states`` with the same key and a smaller ``at``.

    Adds the column ``state`` (a struct, null where there is none). States are reduced to one row per
    key and ``at`` before the window, so a window holds at most two rows for each value of ``at``.
    ``points`` must be unique by key and ``at``. Null keys match null keys.
    """
    payload = [c for c in states.columns if c not in keys and c != at]
    state = F.struct(*order, *[c for c in payload if c not in order])
    reduced = newest(states, [*keys, at], order).select(*keys, at, state.alias("_state"))
    carried = [c for c in points.columns if c not in keys and c != at]
    both = reduced.select(*keys, at, "_state", F.lit(None).cast(points.select(F.struct(*carried)).schema[0].dataType).alias("_point")).unionByName(
        points.select(*keys, at, F.lit(None).cast(reduced.schema["_state"].dataType).alias("_state"), F.struct(*carried).alias("_point"))
    )
    before = Window.partitionBy(*keys).orderBy(at).rangeBetween(Window.unboundedPreceding, -1)
    seen = both.withColumn("state", F.max("_state").over(before)).where(F.col("_point").isNotNull())
    return seen.select(*keys, at, *[F.col(f"_point.{c}").alias(c) for c in carried], "state")


def pending(source: DataFrame, target: DataFrame, keys: Sequence[str], version: str, settled: str | None = None) -> DataFrame:
    """The rows of ``source`` whose key and version no row of ``target`` holds.

    A row without a version (null) can't be processed and is left out. ``settled`` names a boolean
    column of ``target``; where it is true the row settles its key for every version (a pinned
    result). Keys match null to null, columns of the two sides may have the same names. An empty
    target leaves the whole source; the source keeps repeated rows, as an anti-join does.
    """
    right = target.select(*[F.col(k).alias(f"_t_{k}") for k in keys], F.col(version).alias("_t_version"), (F.coalesce(F.col(settled), F.lit(False)) if settled else F.lit(False)).alias("_t_settled"))
    on = [F.col(k).eqNullSafe(F.col(f"_t_{k}")) for k in keys]
    same = F.col("_t_settled") | (F.col("_t_version") == F.col(version))
    cond = same
    for c in on:
        cond = c & cond
    return source.where(F.col(version).isNotNull()).join(right, cond, "left_anti")


class Conflict(RuntimeError):
    """Another run has published since the work was planned."""


class VersionedTarget:
    """A table whose committed versions are manifests of immutable folders.

    ``pending`` gives the work and the version it was planned on; ``publish`` writes its rows into a new folder and commits a
    manifest ``manifest-N.json`` of all folders as the version after that one, and is refused if another run was faster:
    its work must be planned again, so nothing is done twice and no newer row is overwritten. A run that dies
    before the commit leaves a folder that no manifest names. Readers see whole versions.

    The commit takes the manifest's name by a hard link on a local disk, else by the rename of Hadoop's file system, which is
    atomic and refuses an existing name on HDFS. Object stores without such a rename can't hold a target.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], version: str, most_folders: int = 16):
        self.spark, self.path, self.keys, self.version, self.most_folders = spark, path.rstrip("/"), list(keys), version, most_folders
        self._fs = spark._jvm.org.apache.hadoop.fs.Path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _p(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def current(self) -> tuple[int, list[str]]:
        """Number and folders of the newest committed version; (0, []) before the first."""
        root = self._p("")
        if not self._fs.exists(root):
            return 0, []
        names = [s.getPath().getName() for s in self._fs.listStatus(root)]
        numbers = [int(n[9:-5]) for n in names if n.startswith("manifest-") and n.endswith(".json")]
        if not numbers:
            return 0, []
        n = max(numbers)
        stream = self._fs.open(self._p(f"manifest-{n:09d}.json"))
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return n, json.loads(text)["folders"]

    def read(self) -> DataFrame | None:
        """The newest row of every key (that of the latest publication), or None before the first version."""
        return self._read(self.current()[1])

    def _read(self, folders: Sequence[str]) -> DataFrame | None:
        if not folders:
            return None
        rows = self.spark.read.option("mergeSchema", "true").parquet(*[f"{self.path}/{f}" for f in folders])
        return newest(rows, self.keys, ["_published"])

    def pending(self, source: DataFrame, settled: str | None = None) -> tuple[DataFrame, int]:
        """The rows of ``source`` that the newest version doesn't hold, and that version's number."""
        base, folders = self.current()
        target = self._read(folders)
        return (source.where(F.col(self.version).isNotNull()) if target is None else pending(source, target, self.keys, self.version, settled)), base

    def publish(self, rows: DataFrame, base: int) -> int:
        """Commit ``rows`` as the version after ``base``; returns its number, or raises Conflict and changes nothing."""
        n, folders = self.current()
        if n != base:
            raise Conflict(f"version {n} was published since {base}")
        folder = f"data-{uuid.uuid4().hex}"
        rows.drop("_published").withColumn("_published", F.lit(base + 1)).write.parquet(f"{self.path}/{folder}")
        done = self._commit(base + 1, [*folders, folder])
        if len(folders) + 1 > self.most_folders:
            try:
                done = self.compact()
            except Conflict:
                pass  # the faster run will compact
        return done

    def compact(self) -> int:
        """Rewrite the newest rows into one folder, as a new version; older folders stay readable."""
        n, folders = self.current()
        if len(folders) < 2:
            return n
        folder = f"data-{uuid.uuid4().hex}"
        self._read(folders).write.parquet(f"{self.path}/{folder}")
        return self._commit(n + 1, [folder])

    def _commit(self, n: int, folders: list[str]) -> int:
        temp, final = self._p(f"_pending-{uuid.uuid4().hex}"), self._p(f"manifest-{n:09d}.json")
        out = self._fs.create(temp, False)
        out.write(bytearray(json.dumps({"version": n, "folders": folders}).encode()))
        out.close()
        try:
            if self._fs.getUri().getScheme() == "file":
                os.link(temp.toUri().getPath(), final.toUri().getPath())
            elif self._fs.exists(final) or not self._fs.rename(temp, final):
                raise FileExistsError
        except FileExistsError:
            raise Conflict(f"version {n} was published by another run") from None
        finally:
            self._fs.delete(temp, False)
        return n


def runs_to_do(scans: DataFrame, states: DataFrame) -> DataFrame:
    """run_no, topic, source_sha of every topic a run still has to work on.

    The newest observation of a scan counts (equal times: the greatest scan_id); the target as of a run is
    each topic's newest state of an earlier run (equal times: the greatest state_seq). A state holds its
    key and version if it is ``done``, and settles the topic if it is pinned. Null pinned is not pinned.
    """
    seen = newest(scans.select("run_no", "topic", "observed_at", "scan_id", "source_sha"), ["run_no", "topic"], ["observed_at", "scan_id"])
    source = seen.select("run_no", "topic", "source_sha")
    known = as_of(source, states.select("run_no", "topic", "updated_at", "state_seq", "status", "pinned", "source_sha"), ["topic"], "run_no", ["updated_at", "state_seq"])
    held = known.where(F.col("state").isNotNull()).select(
        "run_no", "topic", F.when(F.col("state.status") == "done", F.col("state.source_sha")).alias("source_sha"), F.col("state.pinned").alias("settled")
    )
    return pending(source, held, ["run_no", "topic"], "source_sha", "settled").select("run_no", "topic", "source_sha")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs_to_do(table(spark, sf_dir, "source_scans"), table(spark, sf_dir, "doc_states"))


def p6_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """topic, source_sha, run_no as the target holds them after every run of pipeline_runs worked off what it found pending."""
    scans = table(spark, sf_dir, "source_scans").select("run_no", "topic", "observed_at", "scan_id", "source_sha")
    seen = newest(scans, ["run_no", "topic"], ["observed_at", "scan_id"]).select("run_no", "topic", "source_sha")
    target = VersionedTarget(spark, f"{shared_dir(spark)}/target-{uuid.uuid4().hex}", ["topic"], "source_sha")
    for run in sorted(r[0] for r in table(spark, sf_dir, "pipeline_runs").select("run_no").collect()):  # a fixed table
        work, base = target.pending(seen.where(F.col("run_no") == run))
        target.publish(work, base)
    return target.read().select("topic", "source_sha", "run_no")


P6_TARGET_SQL = """
WITH obs AS (
  SELECT run_no, topic, source_sha FROM (
    SELECT *, row_number() OVER (PARTITION BY run_no, topic ORDER BY observed_at DESC NULLS LAST, scan_id DESC NULLS LAST) AS rn
    FROM source_scans) WHERE rn = 1 AND source_sha IS NOT NULL AND run_no IN (SELECT run_no FROM pipeline_runs)),
chg AS (SELECT *, lag(source_sha) OVER (PARTITION BY topic ORDER BY run_no) AS before FROM obs)
SELECT topic, source_sha, run_no FROM chg WHERE before IS DISTINCT FROM source_sha
QUALIFY row_number() OVER (PARTITION BY topic ORDER BY run_no DESC) = 1
"""

P6_SQL = """
WITH obs AS (
  SELECT run_no, topic, source_sha FROM (
    SELECT *, row_number() OVER (PARTITION BY run_no, topic ORDER BY observed_at DESC NULLS LAST, scan_id DESC NULLS LAST) AS rn
    FROM source_scans) WHERE rn = 1 AND source_sha IS NOT NULL),
st AS (
  SELECT o.run_no, o.topic, s.status, s.pinned, s.source_sha AS held,
    row_number() OVER (PARTITION BY o.run_no, o.topic ORDER BY s.updated_at DESC NULLS LAST, s.state_seq DESC NULLS LAST) AS rn
  FROM obs o JOIN doc_states s ON s.topic = o.topic AND s.run_no < o.run_no)
SELECT o.run_no, o.topic, o.source_sha FROM obs o
LEFT JOIN (SELECT * FROM st WHERE rn = 1) t ON t.run_no = o.run_no AND t.topic = o.topic
WHERE t.topic IS NULL OR NOT (coalesce(t.pinned, false) OR coalesce(t.status = 'done' AND t.held = o.source_sha, false))
"""
