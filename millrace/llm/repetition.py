"""Repeated text within a document, by gradient-boosted trees over its statistics.

A statistic is the share of characters in stretches of WINDOW characters that also start earlier in the document; others
are repeated lines, few distinct substrings, how well the text compresses, and its length. Trees with logistic loss are
fitted on a bounded sample of documents and flattened into arrays of nodes, which score a whole batch at once. All
statistics but the length are constrained to be monotonic: more repetition never lowers a score.

The trees decide which documents are repetitive: score at or above a cut. The cut is not tuned but proven: by the constraints
the least score of a document with a repeated share of LEAST or more is one with no other repetition, of some length; all
lengths that the trees tell apart are tried. So none is lost, whatever the sample was. Those at or above the cut are then
checked exactly.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import cut, spread, table, text_batches

WINDOW, LEAST = 30, 0.40
_FACTORS = np.random.default_rng(10).integers(1, 2**63, WINDOW, np.uint64) | np.uint64(1)


def later_starts(c: np.ndarray) -> np.ndarray:
    """Positions whose window of code points starts earlier too; exact, as equal hashes are compared on their text."""
    n = len(c) - WINDOW + 1
    if n < 2:
        return np.empty(0, np.int64)
    wide, h = c.astype(np.uint64), np.zeros(n, np.uint64)
    for k in range(WINDOW):
        h += wide[k : k + n] * _FACTORS[k]
    order = np.argsort(h, kind="stable")
    same = np.nonzero(h[order[1:]] == h[order[:-1]])[0]
    if not len(same):
        return np.empty(0, np.int64)
    windows = np.lib.stride_tricks.sliding_window_view(c, WINDOW)
    if all((windows[order[s + 1]] == windows[order[s]]).all() for s in np.array_split(same, -(-len(same) // 4096))):
        return order[same + 1]
    seen: set[bytes] = set()
    later = []
    for i in range(n):
        w = windows[i].tobytes()
        later.append(i) if w in seen else seen.add(w)
    return np.array(later, np.int64)


def repeated(text: str | None) -> tuple[int, int]:
    """Repeated characters and all characters of the text, in lower case and with its whitespace made single blanks."""
    s = " ".join((text or "").lower().split())
    c = np.frombuffer(s.encode("utf-32-le", "surrogatepass"), np.uint32)
    at = later_starts(c)
    if not len(at):
        return 0, len(c)
    edges = np.bincount(at, minlength=len(c) + 1) - np.bincount(at + WINDOW, minlength=len(c) + 1)
    return int((np.cumsum(edges)[: len(c)] > 0).sum()), len(c)


STATISTICS = ("repeated_share", "line_share", "few_substrings", "compressed", "log_chars")
#: Direction of each statistic: more of the first four never lowers a score; the length may do either.
MONOTONIC = (1, 1, 1, 1, 0)
#: Documents of the sample that the trees are fitted on, least by a hash of their ids; trees, their depth, shrinkage and bins.
SAMPLE, TREES, LEVELS, RATE, BINS = 4000, 24, 3, 0.3, 32


def statistics(text: str | None) -> tuple[int, int, float, float, float, float, float]:
    """Repeated and all characters (whitespace made single blanks), then the STATISTICS; all are 0 for a text without characters."""
    again, chars = repeated(text)
    if not chars:
        return 0, 0, 0.0, 0.0, 0.0, 0.0, 0.0
    lines = Counter(x for x in (" ".join(line.lower().split()) for line in text.splitlines()) if x)
    all_lines = sum(len(x) * n for x, n in lines.items())
    same = sum(len(x) * (n - 1) for x, n in lines.items())
    s = " ".join(text.lower().split())
    c = np.frombuffer(s.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    few = 0.0
    if len(c) >= 8:
        h = c[:-7].copy()
        for k in range(1, 8):
            h = h * np.uint64(0x9E3779B97F4A7C15) + c[k : len(c) - 7 + k]
        few = 1.0 - len(np.unique(h)) / len(h)
    raw = s.encode("utf-8", "surrogatepass")
    packed = max(0.0, 1.0 - len(zlib.compress(raw, 1)) / len(raw))
    return again, chars, again / chars, same / max(all_lines, 1), few, packed, float(np.log1p(chars))


@dataclass(frozen=True)
class Trees:
    """Trees in arrays: a node sends a row left if its feature is below the threshold; leaves are their own children."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """The log-odds of every row of ``x``."""
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for root in self.roots:
            at = np.full(len(x), root)
            for _ in range(LEVELS):
                at = np.where(x[rows, self.feature[at]] < self.threshold[at], self.left[at], self.right[at])
            total += self.value[at]
        return total

    def least_score(self, feature: int, at_least: float, monotonic: tuple[int, ...] = MONOTONIC) -> float:
        """The least score of any row whose ``feature`` is ``at_least`` or more, all features being 0 or more.

        Raising a constrained feature lowers no tree, so the least score has all of them at their least values; the one that
        isn't constrained is tried in every interval between its thresholds. This is exact, whatever the trees are.
        """
        free = monotonic.index(0)
        inner = self.left != np.arange(len(self.left))
        tried = np.unique(np.concatenate([[0.0], self.threshold[inner & (self.feature == free)]]))
        x = np.zeros((len(tried), len(monotonic)))
        x[:, feature], x[:, free] = at_least, tried
        return float(self.score(x).min())


def fit(x: np.ndarray, y: np.ndarray, monotonic: tuple[int, ...] = MONOTONIC, trees: int = TREES) -> Trees:
    """Boosted trees for the labels ``y`` (0 or 1); with none or all of them 1 no split gains anything and every score is equal."""
    share = (y.sum() + 1.0) / (len(y) + 2.0)
    base = float(np.log(share / (1 - share)))
    nodes: list[list[float]] = []
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) if len(x) else np.empty(0) for f in range(len(monotonic))]
    odds = np.full(len(y), base)
    roots = []

    def weight(g: float, h: float, lo: float, hi: float) -> float:
        return float(min(max(-g / (h + 1.0), lo), hi))

    def grow(rows: np.ndarray, level: int, lo: float, hi: float) -> int:
        g, h = grad[rows].sum(), hess[rows].sum()
        w = weight(g, h, lo, hi)
        me = len(nodes)
        nodes.append([0, 0.0, me, me, w * RATE])
        best = None
        if level < LEVELS and len(rows) >= 2:
            for f, sign in enumerate(monotonic):
                which = np.searchsorted(edges[f], x[rows, f], "right")
                gs = np.cumsum(np.bincount(which, grad[rows], len(edges[f]) + 1))[:-1]
                hs = np.cumsum(np.bincount(which, hess[rows], len(edges[f]) + 1))[:-1]
                for k, (gl, hl) in enumerate(zip(gs, hs)):
                    if hl < 1e-3 or h - hl < 1e-3:
                        continue
                    wl, wr = weight(gl, hl, lo, hi), weight(g - gl, h - hl, lo, hi)
                    if sign * (wr - wl) < 0:
                        continue
                    # the loss that two weights save, against one for all
                    gain = -(gl * wl + 0.5 * (hl + 1) * wl * wl) - ((g - gl) * wr + 0.5 * (h - hl + 1) * wr * wr) + (g * w + 0.5 * (h + 1) * w * w)
                    if gain > 1e-6 and (best is None or gain > best[0]):
                        best = (gain, f, float(edges[f][k]), wl, wr)
        if best is None:
            return me
        _, f, at, wl, wr = best
        below = x[rows, f] < at
        middle = (wl + wr) / 2
        bounds = {1: ((lo, middle), (middle, hi)), -1: ((middle, hi), (lo, middle)), 0: ((lo, hi), (lo, hi))}[monotonic[f]]
        left = grow(rows[below], level + 1, *bounds[0])
        right = grow(rows[~below], level + 1, *bounds[1])
        nodes[me] = [f, at, left, right, 0.0]
        return me

    for _ in range(trees):
        p = 1 / (1 + np.exp(-odds))
        grad, hess = p - y, p * (1 - p)
        start = len(nodes)
        roots.append(grow(np.arange(len(y)), 0, -np.inf, np.inf))
        one = _arrays(nodes, [start], 0.0)
        odds = odds + one.score(x)
    return _arrays(nodes, roots, base)


def _arrays(nodes: list[list[float]], roots: list[int], base: float) -> Trees:
    n = np.array(nodes, float).reshape(-1, 5)
    return Trees(np.array(roots, np.int64), n[:, 0].astype(np.int64), n[:, 1], n[:, 2].astype(np.int64), n[:, 3].astype(np.int64), n[:, 4], base)


# --- Spark ---


def repetition(df: DataFrame, key: str, text: str) -> DataFrame:
    """``key``, chars, repeated_chars, the STATISTICS, score (log-odds) and repetitive (score at or above the proven cut) of each row.

    Null, empty and blank texts have no characters, shares of 0 and are never repetitive by the exact check. Repeated rows stay, a null
    key is a key, other columns of ``df`` are ignored. The texts are read once, without a shuffle; the statistics are
    written to the shared folder. The driver gets the statistics of at most SAMPLE documents.
    """
    text_batches(df.sparkSession)
    kind = df.schema[key].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = list(zip(*(statistics(t) for t in b.column("_text").to_pylist()))) or [()] * 7
            yield pa.RecordBatch.from_arrays([b.column("_key"), *(pa.array(c, pa.int64()) for c in made[:2]), *(pa.array(c, pa.float64()) for c in made[2:])], names=["_key", "repeated_chars", "chars", *STATISTICS])

    schema = f"_key {kind}, repeated_chars long, chars long, " + ", ".join(f"{s} double" for s in STATISTICS)
    known = cut(spread(df.select(F.col(key).alias("_key"), F.col(text).cast("string").alias("_text"))).mapInArrow(count, schema), "statistics")
    sample = known.select(*STATISTICS, F.xxhash64("_key").alias("h"), "_key").orderBy("h", "_key").limit(SAMPLE).toPandas()
    x = sample[list(STATISTICS)].to_numpy(float)
    trees = fit(x, (x[:, 0] >= LEAST).astype(float))
    least = trees.least_score(0, LEAST)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = trees.score(np.stack([b.column(c).to_numpy() for c in STATISTICS], 1)) if b.num_rows else np.empty(0)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(s), pa.array(s >= least)], names=[*b.schema.names, "score", "repetitive"])

    return known.mapInArrow(score, f"{schema}, score double, repetitive boolean").withColumnRenamed("_key", key)


def p10_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, chars, repeated_chars, the statistics and the score of every document."""
    return repetition(table(spark, sf_dir, "documents"), "doc_id", "text")


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that the trees find repetitive, less those that the exact share excludes."""
    return p10_shares(spark, sf_dir).where("repetitive").where((F.col("chars") > 0) & (F.col("repeated_share") >= LEAST)).select("doc_id")
