"""Fill containers of a fixed capacity by the sum-of-squares rule.

Each item goes to the fill level whose choice leaves the smallest sum of squared counts of partially filled
containers. The counts are an array indexed by fill level, so placing an item costs one vector operation over
the levels, however many containers are open. Shards of the items are packed independently, then what is left
at most half full is packed once more.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.splitting import budget
from millrace.session import cut, table

#: Items that are packed in one task, and tasks whose low containers are packed together. Both bound a task, neither drops an
#: item; a smaller number costs fill, as each task ends with some containers that are partially filled.
SHARD_ITEMS, MERGED_SHARDS = 10_000, 512


def sum_of_squares(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """The container of each item, in the order given; containers are numbered from 0.

    Every size must lie in 1..capacity. Of equally good levels the fullest is taken, an empty container last.
    """
    count = np.zeros(capacity + 1, np.int64)
    open_at: list[list[int]] = [[] for _ in range(capacity + 1)]
    placed, made = np.empty(len(sizes), np.int64), 0
    big = np.iinfo(np.int64).max
    for i, s in enumerate(map(int, sizes)):
        top = capacity - s
        # moving one container from level h to h + s changes the sum of squares by 2 (N[h+s] - N[h]) + 2
        here = count[1 : top + 1]
        change = 2 * (count[1 + s : capacity + 1] - here) + 2
        if top >= 1:
            change[top - 1] = 1 - 2 * here[top - 1]  # a full container is no longer counted
            change = np.where(here > 0, change, big)
            best = top - int(np.argmin(change[::-1]))  # the last of equal ones
            cost = change[best - 1]
        else:
            best, cost = 0, big
        fresh = 2 * count[s] + 1 if s < capacity else 0
        if fresh < cost:
            best = 0
        if best:
            k = open_at[best].pop()
            count[best] -= 1
        else:
            k, made = made, made + 1
        if best + s < capacity:
            count[best + s] += 1
            open_at[best + s].append(k)
        placed[i] = k
    return placed


def pack(df: DataFrame, key: str, size: str, capacity: int, shard_items: int = SHARD_ITEMS, merged_shards: int = MERGED_SHARDS) -> DataFrame:
    """``key``, part_no, chars, batch_id: the batch of every item of at least one unit of size.

    An item larger than ``capacity`` is divided into full parts, which fill batches of their own, and a rest; no other
    item is divided. Sizes of null or below 1 need no place and give no row, an empty table none. Keys should be unique: a
    repeated row is an item of its own, in the same shard as its equals, and a null key is a key; other columns of ``df`` are
    ignored. Only keys and sizes are moved, never texts. Jobs run when this is called: items and first containers are written.

    Containers at most half full are packed once more, those of ``merged_shards`` shards in one task, until they are few
    enough for one task or no round merges any more.
    """
    items = cut(df.select(F.col(key).alias("k"), F.col(size).cast("long").alias("n")).where(F.col("n") >= 1), "items")
    shards = max(1, -(-items.count() // shard_items))
    parts = items.select("k", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / capacity).cast("int"))).alias("part"), "n").select(
        "k", "part", F.least(F.lit(capacity), F.col("n") - F.col("part") * F.lit(capacity).cast("long")).cast("int").alias("chars")
    )
    parts = parts.withColumn("shard", F.pmod(F.xxhash64("k", "chars"), F.lit(shards)).cast("int"))
    kind = dict(items.dtypes)["k"]

    def first(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["k", "part"], kind="stable", na_position="first")
        pdf["bin"] = sum_of_squares(pdf["chars"].to_numpy(), capacity) + (np.int64(pdf["shard"].iloc[0]) << 32)
        pdf["fill"] = pdf.groupby("bin")["chars"].transform("sum")
        return pdf

    def again(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("bin", kind="stable")
        into = sum_of_squares(pdf["fill"].to_numpy(), capacity)
        by = pd.Series(into)
        return pd.DataFrame({"bin": pdf["bin"].to_numpy(), "to": pd.Series(pdf["bin"].to_numpy()).groupby(by).transform("min"), "sum": pd.Series(pdf["fill"].to_numpy()).groupby(by).transform("sum")})

    # a given number of partitions, so that small shards aren't gathered in one task; twice as many, as their hashes may meet
    placed = parts.repartition(2 * shards, "shard").groupBy("shard").applyInPandas(first, f"k {kind}, part int, chars int, shard int, bin long, fill long")
    packed = cut(placed, "packed")
    low = packed.where(F.col("fill") * 2 <= capacity).groupBy("bin").agg(F.first("fill").alias("fill"), F.first("shard").alias("shard"))
    moves = None
    while True:
        groups = max(1, -(-shards // merged_shards))
        ways = low.withColumn("g", (F.col("shard") / merged_shards).cast("int")).repartition(2 * groups, "g").groupBy("g").applyInPandas(again, "bin long, to long, sum long")
        ways = cut(ways, "merged")
        moves = ways.select("bin", "to") if moves is None else moves.join(ways.select(F.col("bin").alias("to"), F.col("to").alias("next")), "to", "left").select("bin", F.coalesce("next", "to").alias("to"))
        if groups == 1:
            break
        low = ways.where((F.col("bin") == F.col("to")) & (F.col("sum") * 2 <= capacity)).select("bin", F.col("sum").alias("fill"), (F.shiftright("bin", 32) / merged_shards).cast("int").alias("shard"))
        shards = groups
        if low.isEmpty():
            break
    out = packed.join(moves.where("bin <> to"), "bin", "left")
    return out.select(F.col("k").alias(key), F.col("part").alias("part_no"), "chars", F.coalesce("to", "bin").alias("batch_id"))


def _sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = F.col("body")
    return table(spark, sf_dir, "sections").where(body.rlike(r"(?U)\S")).select("section_id", F.char_length(body).alias("chars"))


def p4_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch for every section with a non-blank body."""
    return pack(_sections(spark, sf_dir), "section_id", "chars", budget(spark, sf_dir, "extract_batch")[0])


def p4_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """section_id, parts, chars and fits (no batch of the section is over its capacity): what the batches hold of each section."""
    capacity = budget(spark, sf_dir, "extract_batch")[0]
    batches = cut(p4_batches(spark, sf_dir), "batches")
    fill = batches.groupBy("batch_id").agg(F.sum("chars").alias("fill"))
    told = batches.join(fill, "batch_id").groupBy("section_id")
    return told.agg(F.count("*").alias("parts"), F.sum("chars").alias("chars"), (F.max("fill") <= capacity).alias("fits"))


P4_SECTIONS_SQL = """
SELECT section_id, CAST(ceil(length(body) / CAST((SELECT max_chars FROM size_budgets WHERE budget_name = 'extract_batch') AS DOUBLE)) AS BIGINT) AS parts,
  CAST(length(body) AS BIGINT) AS chars, true AS fits
FROM sections WHERE regexp_matches(body, '[^\\s\\p{Z}\\x{85}\\x{1c}-\\x{1f}]')
"""
