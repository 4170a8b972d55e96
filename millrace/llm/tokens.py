"""Encode a corpus with a public byte-level BPE vocabulary, and decode it again.

The encoder finds the exact merges of BPE without merging. An Aho-Corasick automaton gives the longest token that
starts at each byte; the encoder takes it if it is compatible with the token before, else the next shorter token, else it
steps back and marks the position as dead. Each position is tried at most once per token, so time is linear in the text.
Two tokens are compatible if BPE over their joined bytes ends with just these two, which is decided by
undoing merges on either side of the border and is kept in a table.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from millrace.session import spread, table, text_batches

#: Fixed value: the public pre-tokenisation pattern of byte-level BPE vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Words and pairs a worker remembers; both tables are emptied when full, which costs time and changes nothing.
MOST_WORDS, MOST_PAIRS = 300_000, 1_000_000


def byte_letters() -> dict[str, int]:
    """The letter that a byte-level vocabulary writes for each byte: printable Latin-1 as is, the rest from U+0100 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    others = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}


def default_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


class Encoder:
    """Exact BPE by backtracking. ``vocabulary`` is the text of a tokenizer file with vocab and merges."""

    def __init__(self, vocabulary: str):
        model = json.loads(vocabulary)["model"]
        letters = byte_letters()
        raw = {t: bytes(letters[c] for c in t).decode("latin-1") for t in model["vocab"] if all(c in letters for c in t)}
        #: Token text (bytes as Latin-1 letters) to id; special tokens are not ordinary text.
        singles = {raw[t]: i for t, i in model["vocab"].items() if t in raw and len(raw[t]) == 1}
        self.ids, self.merged, self.halves = dict(singles), {}, {}
        for m in model["merges"]:
            x, y = m.split(" ") if isinstance(m, str) else m
            a, b, i = raw[x], raw[y], model["vocab"][x + y]
            self.ids[a + b] = i
            self.merged[self.ids[a], self.ids[b]] = i
            self.halves[i] = (self.ids[a], self.ids[b])
        self.text = {i: t for t, i in self.ids.items()}
        self.rank = {pair: k for k, pair in enumerate(self.merged)}
        self.made = {i: self.rank[p] for i, p in self.halves.items()}
        self.automaton = ahocorasick.Automaton()
        for t, i in self.ids.items():
            self.automaton.add_word(t, (i, len(t)))
        self.automaton.make_automaton()
        #: The longest proper prefix of each token that is a token, -1 if none.
        self.shorter = {i: next((self.ids[t[:k]] for k in range(len(t) - 1, 0, -1) if t[:k] in self.ids), -1) for i, t in self.text.items()}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.words: dict[str, tuple[int, ...]] = {}
        self.split = regex.compile(PATTERN).findall

    def compatible(self, a: int, b: int) -> bool:
        """Whether BPE over the bytes of both ends with these two tokens: no merge across the border comes first."""
        known = self.pairs.get((a, b))
        if known is None:
            if len(self.pairs) >= MOST_PAIRS:
                self.pairs.clear()
            known = self.pairs[a, b] = self._compatible(a, b)
        return known

    def _compatible(self, a: int, b: int) -> bool:
        # Undo the later of the two last merges, again and again, down to the bytes at the border. Each state must last
        # until the merge that was undone to get there: a merge across the border that comes before that one would have
        # happened. Merges of equal rank happen from left to right, so one across the border precedes one to its right.
        none = until = len(self.rank)
        while True:
            across = self.rank.get((a, b), none)
            if across < until:
                return False
            left, right = self.made.get(a, -1), self.made.get(b, -1)
            if left > right:
                a, until = self.halves[a][1], left
            elif right >= 0:
                b, until = self.halves[b][0], right + 1
            else:
                return True

    def word(self, word: str) -> tuple[int, ...]:
        """Ids of one pre-token."""
        s = word.encode("utf-8", "surrogatepass").decode("latin-1")
        known = self.ids.get(s)
        if known is not None:
            return (known,)
        n = len(s)
        longest = [0] * n
        for end, (i, size) in self.automaton.iter(s):
            longest[end - size + 1] = i  # ends ascend, so the last one is the longest
        alive, out, at = bytearray(b"\1") * (n + 1), [], 0
        token, text, shorter, fits = longest[0], self.text, self.shorter, self.compatible
        while True:
            end = at + len(text[token])
            if alive[end] and (not out or fits(out[-1], token)):
                out.append(token)
                at = end
                if at == n:
                    return tuple(out)
                token = longest[at]
                continue
            token = shorter[token]
            while token < 0:
                alive[at] = 0
                token = out.pop()
                at -= len(text[token])
                token = shorter[token]

    def encode(self, text: str | None) -> Sequence[int]:
        """Ids of a text without special tokens; the empty list for null and for the empty text."""
        if not text:
            return []
        words, get = self.split(text), self.words
        for w in set(words).difference(get):
            if len(get) >= MOST_WORDS:
                get = self.words = {}
                return list(chain.from_iterable(map(self._remembered, words)))
            get[w] = self.word(w)
        return list(chain.from_iterable(map(get.__getitem__, words)))

    def _remembered(self, w: str) -> tuple[int, ...]:
        known = self.words.get(w)
        if known is None:
            known = self.word(w)
            if len(self.words) < MOST_WORDS:
                self.words[w] = known
        return known


class Decoder:
    """Ids back to bytes by an offset table: all tokens' bytes in one array, and where each begins."""

    def __init__(self, encoder: Encoder):
        size = max(encoder.text) + 1
        parts = [encoder.text.get(i, "").encode("latin-1") for i in range(size)]
        self.offset = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        self.blob = np.frombuffer(b"".join(parts), np.uint8)

    def decode(self, ids: Sequence[int]) -> str:
        if not len(ids):
            return ""
        start, size = self.offset[ids], self.offset[np.asarray(ids) + 1] - self.offset[ids]
        where = np.arange(size.sum()) + np.repeat(start - np.concatenate([[0], np.cumsum(size)[:-1]]), size)
        return self.blob[where].tobytes().decode("utf-8", "replace")


_made: dict[int, Encoder] = {}


def encoder(vocabulary: str) -> Encoder:
    """The worker's encoder of a vocabulary, built once."""
    key = hash(vocabulary)
    if key not in _made:
        _made.clear()
        _made[key] = Encoder(vocabulary)
    return _made[key]


def with_ids(df: DataFrame, text: str, ids: str = "ids", path: str | None = None, count_only: bool = False) -> DataFrame:
    """``df`` without ``text``, with the token ids (or with their number) in the column ``ids``.

    Null and empty texts give the empty list (or 0), never null. Rows stay where they are: no shuffle. The vocabulary,
    whose size is fixed, is read by the driver from ``path`` and broadcast. An existing column ``ids`` is replaced.
    """
    spark = df.sparkSession
    with open(path or default_path(), encoding="utf-8") as f:
        shared = spark.sparkContext.broadcast(f.read())
    text_batches(spark)
    keep = [c for c in df.columns if c not in (text, ids)]
    kind = T.LongType() if count_only else T.ArrayType(T.IntegerType())
    schema = T.StructType([*[df.schema[c] for c in keep], T.StructField(ids, kind)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(shared.value)
        for b in batches:
            lists = [e.encode(t) for t in b.column("_text").to_pylist()]
            sizes = np.fromiter(map(len, lists), np.int64, len(lists))
            if count_only:
                made: pa.Array = pa.array(sizes)
            else:
                flat = np.fromiter(chain.from_iterable(lists), np.int32, int(sizes.sum()))
                made = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(flat))
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in keep], made], names=[*keep, ids])

    return spread(df.select(*keep, df[text].alias("_text"))).mapInArrow(run, schema)


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_ids(table(spark, sf_dir, "documents").select("doc_id", "text"), "text")
