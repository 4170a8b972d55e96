"""Near-duplicate records: a prefix filter that loses no pair, sketches, then an exact check.

The similarity of two texts is that of their sets of distinct 3-character substrings. With one order of all
substrings, rare ones first, two sets of similarity t share one of the first ``n - ceil(t * n) + 1`` of either; records
are sharded by those of the first field, so every pair that is similar enough meets in the shard of its first shared one.
Counts for the order are kept by hash in a table of fixed size: any order is right, a good one only makes the shards small.

In a shard, sizes and positions bound what a pair can share: sets of n and m that are similar enough share
``t / (1 + t) * (n + m)``, and if their first shared substring stands at position i of one of them, at most ``n - i``. Sorted by
size, the partners of a record are one range. Those left are compared by 256-bit parity sketches of the first field: bit
``hash(gram) % 256`` is flipped once for every gram, so the Hamming distance of two sketches is at most the number of grams
that only one of the records has, which a threshold bounds by the sizes. Pairs that pass are checked on their texts.

Shards are counted exactly: one of more than BLOCK records is cut into blocks, and each pair of blocks is a cell for a
task of its own. BK-trees over the sketches were tried for the search of a shard and given up: the README has the figures.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import cut, spread, table, text_batches

WORDS = 4  # of 64 bits in a sketch
#: Entries of the table of counts that orders the 3-character substrings.
COUNTS = 1 << 16
#: Records of a block of a hot shard, and pairs that are compared at once.
BLOCK, AT_ONCE = 4096, 1_000_000
_U = np.uint64
_NOT_TEXT = re.compile(r"[\W_]+")


@dataclass(frozen=True)
class Field:
    """A text column and the least similarity."""

    name: str
    least: float


def normal(text: str | None) -> str:
    """NFKC, lower case, letters and digits only."""
    return _NOT_TEXT.sub("", unicodedata.normalize("NFKC", text).lower()) if text else ""


def grams(normal_text: str) -> np.ndarray:
    """The distinct 3-character substrings, each as one integer of its three code points; sorted."""
    c = np.frombuffer(normal_text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(_U)
    return np.unique(c[:-2] | (c[1:-1] << _U(21)) | (c[2:] << _U(42))) if len(c) > 2 else np.empty(0, _U)


def mixed(x: np.ndarray) -> np.ndarray:
    x = x * _U(0x9E3779B97F4A7C15)
    x ^= x >> _U(29)
    x *= _U(0xBF58476D1CE4E5B9)
    return x ^ (x >> _U(32))


def features(frame: dict[str, list], fields: Sequence[Field], counts: np.ndarray) -> tuple[np.ndarray, list[bytes], np.ndarray, np.ndarray, list[np.ndarray]]:
    """Of the records whose fields all have grams: their positions, class digests, sizes, sketches (of the first field) and prefixes."""
    texts = [[normal(t) for t in frame[f.name]] for f in fields]
    sets = [[grams(t) for t in col] for col in texts]
    kept = np.array([i for i in range(len(texts[0])) if all(len(col[i]) for col in sets)], np.int64)
    if not len(kept):
        return kept, [], np.empty((0, len(fields)), np.int64), np.empty((0, WORDS), _U), []
    digests = [hashlib.blake2b("\0".join(col[i] for col in texts).encode("utf-8", "surrogatepass"), digest_size=16).digest() for i in kept]
    sizes = np.array([[len(col[i]) for col in sets] for i in kept], np.int64)
    hashed = mixed(np.concatenate([sets[0][i] for i in kept]) + _U(1))
    at = np.repeat(np.arange(len(kept)) * WORDS * 64, sizes[:, 0]) + (hashed % _U(WORDS * 64)).astype(np.int64)
    flips = (np.bincount(at, minlength=len(kept) * WORDS * 64) & 1).astype(bool).reshape(len(kept), -1)
    keys = [(prefix(h, fields[0].least, counts) >> _U(32)).astype(np.uint32).view(np.int32) for h in np.split(hashed, np.cumsum(sizes[:, 0])[:-1])]
    return kept, digests, sizes, np.packbits(flips, axis=1).view(_U), keys


def prefix(hashed: np.ndarray, least: float, counts: np.ndarray) -> np.ndarray:
    """The hashed grams of a set, in the order of all grams, of which it must share one with a set at least so similar."""
    n = len(hashed) - int(np.ceil(least * len(hashed) - 1e-9)) + 1
    return hashed[np.lexsort((hashed, counts[(hashed % _U(COUNTS)).astype(np.int64)]))[:n]]


def shard_pairs(shard: np.ndarray, side: np.ndarray, ids: np.ndarray, sizes: np.ndarray, at: np.ndarray, sketch: np.ndarray, least: Sequence[float]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of ids within a shard that neither sizes nor positions nor sketches exclude.

    ``shard`` numbers the shards from 0, ``at`` is the position of a record's substring in its order. ``side`` is 0, or tells
    the two blocks of a cell of a hot shard apart (1 and 2), of which only pairs across are asked for.
    """
    order = np.lexsort((sizes[:, 0], shard))
    shard, side, ids, sizes, at = shard[order], side[order], ids[order], sizes[order], at[order]
    n, t = sizes[:, 0], least[0]
    words = [np.ascontiguousarray(sketch[order, w]) for w in range(sketch.shape[1])]
    bound = (1 - t) / (1 + t) * n
    most = np.floor((n - at) * (1 + t) / t - n + 1e-6).astype(np.int64)  # the size of the largest partner
    top = np.minimum(most, np.floor(n / t + 1e-6).astype(np.int64))
    wide = int(n.max()) + 1 if len(n) else 1
    last = np.searchsorted(shard * wide + n, shard * wide + np.minimum(top, wide - 1), "right")
    partners = np.maximum(last - np.arange(len(n)) - 1, 0)  # those behind a record, which are no smaller
    upto = np.cumsum(partners)
    left, right = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    begin = 0
    while begin < len(n):
        before = int(upto[begin - 1]) if begin else 0
        end = max(begin + 1, int(np.searchsorted(upto, before + AT_ONCE, "right")))
        many = partners[begin:end]
        a = np.repeat(np.arange(begin, end), many)
        b = a + 1 + np.arange(len(a)) - np.repeat(upto[begin:end] - many - before, many)
        ok = most[b] >= n[a]
        if side.any():
            ok &= (side[a] == 0) | (side[a] != side[b])
        for f, s in list(enumerate(least))[1:]:
            x, y = sizes[a, f], sizes[b, f]
            ok &= np.minimum(x, y) + 1e-9 >= s * np.maximum(x, y)
        a, b = a[ok], b[ok]
        for k in range(2):  # half of the bits exclude most pairs, then all of them
            d = np.zeros(len(a), np.uint16)
            for w in words[: len(words) // 2] if k == 0 else words:
                d += np.bitwise_count(w[a] ^ w[b])
            ok = d <= bound[a] + bound[b] + 1e-9
            a, b = a[ok], b[ok]
        left.append(np.minimum(ids[a], ids[b])), right.append(np.maximum(ids[a], ids[b]))
        begin = end
    return np.concatenate(left), np.concatenate(right)


# --- Spark ---


@dataclass(frozen=True)
class Near:
    """``members``: id, cls of every record that has grams. ``pairs``: a, b (a < b), representatives of similar classes."""

    members: DataFrame
    pairs: DataFrame

    def expanded(self) -> DataFrame:
        """key_a, key_b (key_a < key_b) of all records, the members of a class being similar to each other."""
        left = self.members.select(F.col("id").alias("a"), F.col("cls").alias("ca"))
        right = self.members.select(F.col("id").alias("b"), F.col("cls").alias("cb"))
        by_class = self.pairs.join(left, "a").join(right, "b").select("ca", "cb")
        across = by_class.join(left, "ca").join(right, "cb").select("a", "b")
        within = left.join(right, (left["ca"] == right["cb"]) & (left["a"] < right["b"])).select("a", "b")
        return across.unionByName(within).select(F.least("a", "b").alias("key_a"), F.greatest("a", "b").alias("key_b"))

    def classes(self) -> DataFrame:
        """key, class_id (the least key of its class of equal texts), copies (records of the class) and links (other classes that are similar)."""
        size = self.members.groupBy("cls").agg(F.min("id").alias("class_id"), F.count("*").alias("copies"))
        links = self.pairs.select(F.explode(F.array("a", "b")).alias("class_id")).groupBy("class_id").agg(F.count("*").alias("links"))
        told = size.join(links, "class_id", "left").select("cls", "class_id", "copies", F.coalesce("links", F.lit(0)).alias("links"))
        return self.members.join(told, "cls").select(F.col("id").alias("key"), "class_id", "copies", "links")


def near(df: DataFrame, key: str, fields: Sequence[Field]) -> Near:
    """The classes of equal records and the pairs of classes that are similar enough in every field.

    Fields that have no 3-character substring after normalisation are like no other: such a record is in no class, as
    is one with a null. ``key`` must be a unique long that isn't null; other columns of ``df`` are ignored. Records with equal
    normalised texts form a class, of which the one of least key is sharded and searched, so a group of copies costs no
    more than one record. Jobs run when this is called: the counts of substrings, features and candidates are written.
    """
    spark = df.sparkSession
    text_batches(spark)
    names, least = [f.name for f in fields], [f.least for f in fields]
    source = df.select(F.col(key).cast("long").alias("_k"), *names)

    counts = _counts(source, names[0])

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kept, digests, sizes, sketch, keys = features({n: b.column(n).to_pylist() for n in names}, fields, counts)
            if len(kept):
                ids = b.column("_k").to_numpy(zero_copy_only=False)[kept]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids), pa.array(digests, pa.binary()), pa.array(_packed(sizes)), pa.array([r.tobytes() for r in sketch], pa.binary()), pa.array(keys, pa.list_(pa.int32()))],
                    names=["id", "cls", "sizes", "sketch", "shards"],
                )

    rows = cut(spread(source).mapInArrow(featured, "id long, cls binary, sizes long, sketch binary, shards array<int>"), "features")
    members = rows.select("id", "cls")
    repeated = members.groupBy("cls").agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1")
    copies = cut(members.join(repeated, "cls").where("id <> first").select("id"), "copies")
    one = rows.join(copies, "id", "left_anti")
    hot = cut(one.select(F.explode("shards").alias("shard")).groupBy("shard").agg(F.count("*").alias("n")).where(F.col("n") > BLOCK), "hot")
    met = one.select("id", "sizes", "sketch", F.posexplode("shards").alias("at", "shard")).join(hot, "shard", "left")
    found = _cells(met).mapInArrow(_searcher(len(fields), least), "a long, b long").distinct()
    return Near(members, cut(_verified(found, source, fields), "near"))


def near_pairs(df: DataFrame, key: str, fields: Sequence[Field]) -> DataFrame:
    """key_a, key_b (key_a < key_b) of all records that are similar enough in every field."""
    return near(df, key, fields).expanded()


def _counts(source: DataFrame, name: str) -> np.ndarray:
    """How many records have a gram of each of COUNTS hash values."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTS, np.int64)
        for b in batches:
            parts = [grams(normal(t)) for t in b.column(name).to_pylist()]
            if parts:
                total += np.bincount((mixed(np.concatenate(parts) + _U(1)) % _U(COUNTS)).astype(np.int64), minlength=COUNTS)
        at = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["at", "n"])

    found = spread(source.select(name)).mapInArrow(count, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toPandas()  # at most COUNTS rows
    counts = np.zeros(COUNTS, np.int64)
    counts[found["at"].to_numpy(np.int64)] = found["n"].to_numpy(np.int64)
    return counts


def _packed(sizes: np.ndarray) -> np.ndarray:
    """The sizes of one or two fields in one integer."""
    return sizes[:, 0] if sizes.shape[1] == 1 else sizes[:, 0] | sizes[:, 1] << 31


def _cells(met: DataFrame) -> DataFrame:
    """Rows by cell, sorted. A usual shard is one cell; a hot one, which has ``n``, is a triangle of cells for pairs of its blocks, over many tasks."""
    blocks = F.coalesce(F.ceil(F.col("n") / BLOCK), F.lit(1)).cast("int")
    own = F.pmod(F.xxhash64("id"), blocks).cast("int")
    rows = met.select("shard", "id", "sizes", "sketch", "at", own.alias("own"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    side = F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1).otherwise(2)
    cell = F.xxhash64("shard", F.least("own", "other"), F.greatest("own", "other"))
    return rows.select(cell.alias("cell"), (F.col("at") * 4 + side).cast("int").alias("at"), "id", "sizes", "sketch").repartition("cell").sortWithinPartitions("cell")


def _searcher(width: int, least: Sequence[float]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        held = 0
        for b in batches:
            waiting.append(b)
            held += b.num_rows
            cells = b.column("cell").to_numpy()
            if held < 50_000 or cells[0] == cells[-1] and waiting[0].column("cell")[0].as_py() == cells[-1]:
                continue  # a cell is searched when the whole of it is here
            last = int(np.searchsorted(cells, cells[-1], "left")) if cells[0] <= cells[-1] else 0
            whole = [*waiting[:-1], b.slice(0, last)]
            waiting, held = [b.slice(last)], b.num_rows - last
            yield from found(whole, waiting)
        if waiting:
            yield from found(waiting, None)

    def found(parts: list[pa.RecordBatch], rest: list[pa.RecordBatch] | None) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(parts).combine_chunks()
        if not t.num_rows:
            return
        cell = t.column("cell").to_numpy()
        if rest is not None and rest[0].num_rows:  # the cell that goes on in the next batch waits as a whole
            going_on = int(np.searchsorted(cell, rest[0].column("cell")[0].as_py(), "left"))
            if going_on < len(cell):
                rest.insert(0, t.slice(going_on).to_batches()[0])
                t, cell = t.slice(0, going_on), cell[:going_on]
        _, number, size = np.unique(cell, return_inverse=True, return_counts=True)
        keep = size[number] > 1
        if not keep.any():
            return
        t = t.filter(pa.array(keep))
        _, number = np.unique(number[keep], return_inverse=True)
        packed = t.column("sizes").to_numpy()
        sizes = np.stack([packed >> 31 * f & (1 << 31) - 1 for f in range(width)], 1)
        sketch = np.frombuffer(b"".join(t.column("sketch").to_pylist()), _U).reshape(-1, WORDS)
        at = t.column("at").to_numpy()
        a, b = shard_pairs(number, at & 3, t.column("id").to_numpy(), sizes, at >> 2, sketch, least)
        if len(a):
            yield pa.RecordBatch.from_pandas(pd.DataFrame({"a": a, "b": b}).drop_duplicates(), preserve_index=False)

    return run


def _verified(candidates: DataFrame, source: DataFrame, fields: Sequence[Field]) -> DataFrame:
    """The candidates (a, b) whose texts are similar enough."""
    names = [f.name for f in fields]
    texts = source.select(F.col("_k").alias("id"), F.struct(*names).alias("t"))
    left = candidates.join(texts, candidates["a"] == texts["id"]).select("a", "b", F.col("t").alias("ta"))
    both = left.join(texts, left["b"] == texts["id"]).select("a", "b", "ta", F.col("t").alias("tb"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ta, tb = batch.column("ta"), batch.column("tb")
            ok = np.ones(batch.num_rows, bool)
            for f in fields:
                xs, ys = ta.field(f.name).to_pylist(), tb.field(f.name).to_pylist()
                sets = {t: set(grams(normal(t)).tolist()) for t in {*xs, *ys}}  # each text of a batch once
                for i, (x, y) in enumerate(zip(xs, ys)):
                    if ok[i]:
                        x, y = sets[x], sets[y]
                        both = len(x & y)
                        ok[i] = both >= f.least * (len(x) + len(y) - both) and both > 0
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(ok))

    return both.mapInArrow(check, "a long, b long")


def similarity(x: str | None, y: str | None) -> float:
    """Shared distinct 3-character substrings over all of either; 0 if neither has any."""
    a, b = grams(normal(x)), grams(normal(y))
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared / (len(a) + len(b) - shared) if len(a) + len(b) else 0.0


QA = (Field("query", 0.60), Field("answer", 0.60))
SOP = (Field("title", 0.70),)


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    qa = near_pairs(table(spark, sf_dir, "qa_units"), "qa_id", QA).select(F.lit("qa").alias("src"), "key_a", "key_b")
    sop = near_pairs(table(spark, sf_dir, "sop_units"), "sop_id", SOP).select(F.lit("sop").alias("src"), "key_a", "key_b")
    return qa.unionByName(sop)


def p5_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """src, key, class_id, copies, links of every record: its class of equal texts and the other classes it is similar to."""
    qa = near(table(spark, sf_dir, "qa_units"), "qa_id", QA).classes().select(F.lit("qa").alias("src"), "*")
    sop = near(table(spark, sf_dir, "sop_units"), "sop_id", SOP).classes().select(F.lit("sop").alias("src"), "*")
    return qa.unionByName(sop)
