"""The event journal: lines of JSON that processes append to a file, as a batch and as a stream that resumes by byte offset."""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

SCHEMA = "seq long, ts double, kind string, topic string, stage string, status string, payload string"
HEARTBEAT = "concurrency"
#: Bytes that a batch reads at most, unless one line is longer.
AT_ONCE = 16 << 20


def read_from(path: str, offset: int, most: int | None = None) -> tuple[list[tuple], int]:
    """Events of the complete lines behind ``offset``, and where the next read begins.

    A line that is still being written waits; a file that became shorter is read anew; lines that aren't JSON objects are
    skipped. ``seq`` is the byte at which a line begins, from 1. A missing file has no events.
    """
    try:
        size = os.path.getsize(path)
        with open(path, "rb") as f:
            offset = 0 if offset > size else offset
            f.seek(offset)
            data = f.read() if most is None else f.read(most)
            while most is not None and b"\n" not in data and (more := f.read(most)):
                data += more
    except OSError:
        return [], offset
    rows, at = [], offset
    for line in data[: data.rfind(b"\n") + 1].splitlines(keepends=True):
        try:
            e = json.loads(line)
        except ValueError:
            e = None
        if isinstance(e, dict):
            text = {k: None if e.get(k) is None else str(e[k]) for k in ("kind", "topic", "stage", "status")}
            ts = e.get("ts")
            rows.append((at + 1, float(ts) if isinstance(ts, (int, float)) else None, *text.values(), json.dumps(e, ensure_ascii=False)))
        at += len(line)
    return rows, at


class _Reader(SimpleDataSourceStreamReader):
    def __init__(self, path: str, start: int):
        self.path, self.start = path, start

    def initialOffset(self) -> dict:
        return {"bytes": self.start}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        rows, end = read_from(self.path, start["bytes"], AT_ONCE)
        return iter(rows), {"bytes": end}

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        return iter([r for r in read_from(self.path, start["bytes"], max(1, end["bytes"] - start["bytes"]))[0] if r[0] <= end["bytes"]])


class Journal(DataSource):
    """``spark.readStream.format("journal").option("path", …)``; ``start`` is the first byte, ``end`` begins behind all there is."""

    @classmethod
    def name(cls) -> str:
        return "journal"

    def schema(self) -> str:
        return SCHEMA

    def simpleStreamReader(self, schema: StructType) -> SimpleDataSourceStreamReader:
        path, start = self.options["path"], self.options.get("start", "0")
        return _Reader(path, (os.path.getsize(path) if os.path.exists(path) else 0) if start == "end" else int(start))


def follow(spark: SparkSession, path: str, start: str = "0") -> DataFrame:
    spark.dataSource.register(Journal)
    return spark.readStream.format("journal").option("path", path).option("start", start).load()


def append(path: str, event: dict) -> bool:
    """Write an event as one line, in one call, so lines of several processes don't mix; errors are told, not raised."""
    try:
        with open(path, "ab", buffering=0) as f:
            f.write((json.dumps(event, ensure_ascii=False) + "\n").encode())
        return True
    except OSError:
        return False


def heartbeat(kind: Column) -> Column:
    return F.coalesce(kind == HEARTBEAT, F.lit(False))


def latest_stages(events: DataFrame) -> DataFrame:
    """topic, stage, status, seq: the newest event of each, heartbeats left out. For a batch and, in update mode, a stream."""
    known = events.where(~heartbeat(F.col("kind")) & F.col("topic").isNotNull() & F.col("stage").isNotNull())
    return known.groupBy("topic", "stage").agg(F.max_by("status", "seq").alias("status"), F.max("seq").alias("seq"))


def backlog(events: DataFrame, n: int = 300) -> DataFrame:
    """The last ``n`` events and the last heartbeat, in order: what a new viewer gets before it follows."""
    last = events.where(~heartbeat(F.col("kind"))).orderBy(F.desc("seq")).limit(n)
    return last.unionByName(events.where(heartbeat(F.col("kind"))).orderBy(F.desc("seq")).limit(1)).orderBy("seq")


def keep_view(stream: DataFrame, name: str, checkpoint: str) -> StreamingQuery:
    """The view of ``latest_stages`` kept in memory under a name; it resumes from its checkpoint."""
    return latest_stages(stream).writeStream.outputMode("complete").format("memory").queryName(name).option("checkpointLocation", checkpoint).start()


def windows(events: DataFrame, time: str, length: str, late: str, keys: list[str]) -> DataFrame:
    """Events counted by window and keys; of a stream, those later than ``late`` are left out."""
    timed = events.withWatermark(time, late) if events.isStreaming else events
    return timed.groupBy(F.window(time, length), *keys).agg(F.count("*").alias("events"))
