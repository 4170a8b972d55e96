"""Pairs of like texts within a module: every pair that sizes and sketches leave, checked exactly.

Two texts of n and m characters are similar by t (0 to 1) if their longest common subsequence has ``t / 2 * (n + m)`` characters, so
at most ``(1 - t) * (n + m)`` characters stand in only one of them, and neither is longer than ``(2 - t) / t`` times the other.
As often as the counts of a character differ, one stands in only one text. A sketch keeps the counts of PLACES classes of characters
modulo 6, as three bits of which neighbouring counts differ by one: the Hamming distance of two sketches is never more than the
characters that only one text has. No pair at or above the threshold is lost; all of a module are compared, by words of 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.text import similarity

# Classes of characters, those of a word, and words; the shards of small modules; a module of more than SMALL norms is
# cut into blocks of LEAST to MOST, PARTS where these allow it; rows and columns that are compared at once, texts sketched at once.
PLACES, OF_WORD, WORDS = 84, 21, 4
SHARDS, SMALL, LEAST, MOST, PARTS = 1024, 8192, 4096, 65536, 16
ROWS, COLUMNS, AT_ONCE = 64, 2048, 4096
_U = np.uint64
#: Counts modulo 6, one bit flipped from each to the next.
_CODES = np.array([0, 1, 3, 7, 6, 4], _U)
_SLACK = 1e-6


def _places() -> np.ndarray:
    """The class of each code point: digits and small letters have their own, others share the rest by hash."""
    out = (36 + (np.arange(0x110000, dtype=np.int64) * 2654435761 % (1 << 32) >> 16) % (PLACES - 36)).astype(np.uint8)
    out[ord("0") : ord("9") + 1] = np.arange(10)
    out[ord("a") : ord("z") + 1] = np.arange(10, 36)
    return out


_PLACE = _places()


def sketches(texts: list[str]) -> list[np.ndarray]:
    """The words of the texts' sketches."""
    out = [np.zeros(len(texts), _U) for _ in range(WORDS)]
    for begin in range(0, len(texts), AT_ONCE):
        some = texts[begin : begin + AT_ONCE]
        points = np.frombuffer("".join(some).encode("utf-32-le", "surrogatepass"), np.uint32)
        at = np.repeat(np.arange(len(some)) * PLACES, [len(x) for x in some]) + _PLACE[points]
        codes = _CODES[np.bincount(at, minlength=len(some) * PLACES).reshape(-1, PLACES) % 6]
        for w in range(WORDS):
            for k in range(OF_WORD):
                out[w][begin : begin + AT_ONCE] |= codes[:, w * OF_WORD + k] << _U(3 * k)
    return out


def _left(n: np.ndarray, words: list[np.ndarray], first: np.ndarray, last: np.ndarray, rows: int, t: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (i, j) of the first ``rows`` texts with ``first[i] <= j < last[i]`` that their sketches leave; first and last don't fall."""
    for r in range(0, rows, ROWS):
        upto = min(r + ROWS, rows)
        for c in range(int(first[r]), int(last[upto - 1]), COLUMNS):
            end = min(c + COLUMNS, int(last[upto - 1]))
            most = int((1 - t) * (int(n[r:upto].max()) + int(n[c:end].max())) + _SLACK)
            apart = np.bitwise_count(words[0][r:upto, None] ^ words[0][c:end])
            apart += np.bitwise_count(words[1][r:upto, None] ^ words[1][c:end])
            i, j = np.divmod(np.flatnonzero(apart <= min(most, 255)), end - c)
            apart = apart[i, j].astype(np.int64)
            i, j = i + r, j + c
            for w in words[2:]:
                apart += np.bitwise_count(w[i] ^ w[j])
            ok = (first[i] <= j) & (j < last[i]) & (apart <= (1 - t) * (n[i] + n[j]) + _SLACK)
            yield i[ok], j[ok]


def pairs_of(module: np.ndarray, upper: np.ndarray | None, texts: list[str], least: float) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the pairs within a module, each once, that are similar by ``least`` (0 to 100) or more.

    With ``upper`` the texts are two blocks of one module, and only pairs across are told; no text of the lower block is longer
    than one of the upper.
    """
    t = least / 100
    n = np.array([len(x) for x in texts], np.int64)
    order = np.lexsort((n, module) if upper is None else (n, upper))
    module, n = module[order].astype(np.int64), n[order]
    texts = [texts[k] for k in order]
    wide = int(n.max()) + 1
    longest = np.minimum(np.floor(n * (2 - t) / t + _SLACK).astype(np.int64), wide - 1)
    last = np.searchsorted(module * wide + n, module * wide + longest, "right")
    rows, first = len(n), np.arange(1, len(n) + 1)
    if upper is not None:
        rows = len(n) - int(upper.sum())
        first = np.full(len(n), rows)
    left, right = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for i, j in _left(n, sketches(texts), first, last, rows, t):
        ok = np.fromiter((similarity(texts[x], texts[y]) >= least for x, y in zip(i, j)), bool, len(i))
        left.append(i[ok])
        right.append(j[ok])
    return order[np.concatenate(left)], order[np.concatenate(right)]


def placed(norms: DataFrame, least: float) -> DataFrame:
    """``norms`` with shard, low, high and block: a row for each task that compares it.

    Small modules lie whole in a shard. A larger one is cut into blocks by size, from its counts by size, and a norm goes
    to a task for each block that holds a size it may be similar to.
    """
    t = least / 100
    sized = norms.withColumn("size", F.length("norm"))
    of_module = Window.partitionBy("module")
    counts = sized.groupBy("module", "size").agg(F.count("*").alias("n")).withColumn("all", F.sum("n").over(of_module)).where(F.col("all") > SMALL)
    each = F.greatest(F.lit(LEAST), F.least(F.lit(MOST), F.ceil(F.col("all") / PARTS)))
    before = F.sum("n").over(of_module.orderBy("size")) - F.col("n")
    blocks = counts.withColumn("before", before).withColumn("each", each).withColumn("from", F.floor(F.col("before") / F.col("each"))).withColumn("to", F.floor((F.col("before") + F.col("n") - 1) / F.col("each")))
    reach = int(np.ceil(np.log((2 - t) / t) * 1e6)) + 2  # sizes by their logarithm, as a frame's bounds are whole numbers
    fit = of_module.orderBy((F.log("size") * 1e6).cast("long")).rangeBetween(-reach, reach)
    hot = blocks.select("module", "size", "n", "before", "each", F.min("from").over(fit).alias("from"), F.max("to").over(fit).alias("to"))
    told = sized.join(F.broadcast(hot), ["module", "size"], "left")
    block = F.floor((F.col("before") + F.pmod(F.xxhash64("ord"), F.col("n"))) / F.col("each"))
    other = F.explode(F.when(F.col("n").isNull(), F.array(F.lit(-1).cast("long"))).otherwise(F.sequence("from", "to"))).alias("other")
    each_task = told.select("module", "ord", "norm", F.coalesce(block, F.lit(-1)).alias("block"), other)
    shard = F.when(F.col("block") < 0, F.pmod(F.xxhash64("module"), F.lit(SHARDS)).cast("string")).otherwise(F.col("module"))
    return each_task.select(shard.alias("shard"), F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "module", "block", "ord", "norm")


def led_by(ord_: np.ndarray, module: np.ndarray, texts: list[str], least: float) -> np.ndarray:
    """Positions of the leaders that greedy clustering in order gives the texts of whole modules; a leader's own is its own.

    Only leaders are compared with later texts, and exactly only until one is similar, so a module of one wording is no more work.
    """
    t = least / 100
    order = np.lexsort((ord_, module))
    texts = [texts[k] for k in order]
    n, words, module = np.array([len(x) for x in texts], np.int64), sketches(texts), module[order]
    to = np.arange(len(texts))
    ends = [*(np.flatnonzero(module[1:] != module[:-1]) + 1).tolist(), len(texts)]
    for begin, end in zip([0, *ends], ends):
        lead = np.empty(0, np.int64)
        for r in range(begin, end, ROWS):
            rows = np.arange(r, min(r + ROWS, end))
            against = np.concatenate([lead, rows])
            left, right = [], []
            for c in range(0, len(against), COLUMNS):
                cols = against[c : c + COLUMNS]
                most = int((1 - t) * (int(n[rows].max()) + int(n[cols].max())) + _SLACK)
                apart = np.bitwise_count(words[0][rows, None] ^ words[0][cols])
                apart += np.bitwise_count(words[1][rows, None] ^ words[1][cols])
                i, j = np.divmod(np.flatnonzero(apart <= min(most, 255)), len(cols))
                apart = apart[i, j].astype(np.int64)
                i, j = i + r, cols[j]
                for w in words[2:]:
                    apart += np.bitwise_count(w[i] ^ w[j])
                ok = (j < i) & (np.maximum(apart, np.abs(n[i] - n[j])) <= (1 - t) * (n[i] + n[j]) + _SLACK)
                left.append(i[ok])
                right.append(j[ok])
            i, j = np.concatenate(left), np.concatenate(right)
            sorted_ = np.lexsort((j, i))
            done = -1
            for x, y in zip(i[sorted_].tolist(), j[sorted_].tolist()):
                if x != done and to[y] == y and similarity(texts[x], texts[y]) >= least:
                    to[x], done = y, x
            lead = np.concatenate([lead, rows[to[rows] == rows]])
    out = np.empty(len(texts), np.int64)
    out[order] = order[to]
    return out


def _edges(norms: DataFrame, least: float, leading: bool) -> DataFrame:
    def near(rows: pa.Table) -> pa.Table:
        module, ord_ = rows["module"].combine_chunks(), rows["ord"].combine_chunks()
        low, high = rows["low"][0].as_py(), rows["high"][0].as_py()
        codes, texts = module.dictionary_encode().indices.to_numpy(zero_copy_only=False), rows["norm"].to_pylist()
        whole = leading and low < 0
        if whole:
            to = led_by(ranks(ord_), codes, texts, least)
            j = np.flatnonzero(to != np.arange(len(to)))
            i = to[j]
        else:
            i, j = pairs_of(codes, rows["block"].to_numpy() == high if low < high else None, texts, least)
        return pa.table({"module": module.take(pa.array(i)), "x": ord_.take(pa.array(i)), "y": ord_.take(pa.array(j)), "whole": pa.array(np.full(len(i), whole))})

    spark = norms.sparkSession
    kind = norms.schema["ord"].dataType.simpleString()
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 3 * spark.sparkContext.defaultParallelism)
    keys = ["shard", "low", "high"]
    # by number, as little text can be much work, and tasks joined by their bytes would leave it to one
    pairs = placed(norms, least).repartition(tasks, *keys).groupBy(*keys).applyInArrow(near, f"module string, x {kind}, y {kind}, whole boolean")
    return pairs.select("module", F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "whole")


def ranks(values: pa.Array) -> np.ndarray:
    """The rank of each value among the distinct ones, in Spark's order."""
    return np.unique(values.to_numpy(zero_copy_only=False), return_inverse=True)[1]


def near_edges(norms: DataFrame, least: float) -> DataFrame:
    """module, a, b (a < b): the pairs of a module whose norms are similar by ``least`` (0 to 100) or more.

    ``norms`` has module, ord and a distinct, non-empty norm. ``least`` is above 0.
    """
    return _edges(norms, least, leading=False).drop("whole")


def leading_edges(norms: DataFrame, least: float) -> DataFrame:
    """As ``near_edges``, with whole; a module that lies whole in a task gives only each text's pair with its leader (whole is true)."""
    return _edges(norms, least, leading=True)


def settled_by(edges: DataFrame) -> DataFrame:
    """module, b, leader of every b of ``edges`` (module, a, b), all pairs of their modules; each module is one task's."""
    kind = edges.schema["b"].dataType.simpleString()

    def greedy(rows: pa.Table) -> pa.Table:
        names = pa.chunked_array([*rows["a"].chunks, *rows["b"].chunks]).combine_chunks()
        codes = ranks(names)
        a, b = codes[: len(rows)], codes[len(rows) :]
        order = np.lexsort((a, b))
        to = np.arange(int(codes.max()) + 1)
        for begin in range(0, len(order), AT_ONCE):
            some = order[begin : begin + AT_ONCE]
            for x, y in zip(a[some].tolist(), b[some].tolist()):
                if to[y] == y and to[x] == x:  # the earliest leader first, as its pairs are sorted
                    to[y] = x
        told = np.unique(b)
        at = np.empty(len(to), np.int64)
        at[codes] = np.arange(len(codes))
        return pa.table({"module": pa.repeat(rows["module"][0], len(told)), "b": names.take(pa.array(at[told])), "leader": names.take(pa.array(at[to[told]]))})

    return edges.select("module", "a", "b").groupBy("module").applyInArrow(greedy, f"module string, b {kind}, leader {kind}")
