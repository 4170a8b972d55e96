import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import packing, splitting, tokens


def test_packing_bounds_and_fill(spark):
    rng = random.Random(3)
    sizes = [rng.randint(1, 80) for _ in range(3000)] + [250, 100, None, 0, -3]
    df = spark.createDataFrame([(i, n, 1) for i, n in enumerate(sizes)], "id long, n long, batch_id int")
    for shard_items, merged, loss in ((10_000, 512, 1.03), (200, 4, 1.12)):
        rows = packing.pack(df, "id", "n", 100, shard_items, merged).collect()
        fill, parts = {}, {}
        for r in rows:
            fill[r["batch_id"]] = fill.get(r["batch_id"], 0) + r["chars"]
            parts.setdefault(r["id"], []).append(r["chars"])
        assert max(fill.values()) <= 100 and {i: sum(p) for i, p in parts.items()} == {i: n for i, n in enumerate(sizes) if n and n > 0}
        assert all(len(p) == 1 for i, p in parts.items() if sizes[i] <= 100) and sorted(parts[3000]) == [50, 100, 100]
        assert len(fill) <= loss * sum(n for n in sizes if n and n > 0) / 100 + 2
    assert packing.pack(df.limit(0), "id", "n", 100).count() == 0


def test_sum_of_squares_takes_the_best_level():
    assert packing.sum_of_squares(np.array([6, 4, 10, 3, 7]), 10).tolist() == [0, 0, 1, 2, 2]


@pytest.mark.parametrize("wide", ["", "\U0001f6f0"])
def test_pieces(spark, wide):
    rng = random.Random(5)
    text = "".join(rng.choice(["word ", "Satz. ", "行。", "\n", "\n\n", f"## H{wide}\n", "x" * 30, wide]) for _ in range(400))
    df = spark.createDataFrame([(1, text, 9), (2, "short", 9), (3, None, 9), (4, "", 9)], "id long, body string, piece int")
    rows = splitting.split_text(df, "body", 120, 20).collect()
    mine = sorted((r for r in rows if r["id"] == 1), key=lambda r: r["piece_no"])
    assert max(len(r["piece"]) for r in mine) <= 120 and mine[0]["piece"] + "".join(r["piece"][20:] for r in mine[1:]) == text
    assert all(r["piece"][:20] == before["piece"][-20:] for before, r in zip(mine, mine[1:]) if len(before["piece"]) >= 20)
    assert [r["piece"] for r in rows if r["id"] == 2] == ["short"] and [r["piece"] for r in rows if r["id"] == 4] == [""] and not [r for r in rows if r["id"] == 3]


def cores(spark, text, limit, overlap):
    return [r["core"] for r in spark.createDataFrame([(text,)], "t string").select(splitting.cores(F.col("t"), limit, overlap).alias("c")).first()["c"]]


def test_early_boundary_before_a_long_run(spark):
    text = "word. " * 5 + "x" * 300
    got = cores(spark, text, 120, 20)
    assert got[0] == "word. " * 5 and "".join(got) == text and max(map(len, got)) <= 100


def test_code_is_not_cut_while_there_is_a_boundary_outside(spark):
    text = "Some prose here.\n\n" + "```\n" + "code line\n\n" * 6 + "```\n" + "More prose there. " * 4
    got = cores(spark, text, 110, 10)
    assert "".join(got) == text and all(c.count("```") % 2 == 0 for c in got)
    long = "```\n" + "code line\n" * 40 + "```\n"
    got = cores(spark, long, 110, 10)
    assert "".join(got) == long and all(c.endswith("\n") for c in got)


def merge_loop(e, word):
    ids = [e.ids[c] for c in word.encode().decode("latin-1")]
    while True:
        at = min(range(len(ids) - 1), key=lambda i: e.rank.get((ids[i], ids[i + 1]), 1 << 60), default=None)
        if at is None or (ids[at], ids[at + 1]) not in e.rank:
            return ids
        ids[at : at + 2] = [e.merged[ids[at], ids[at + 1]]]


@pytest.fixture(scope="module")
def encoder():
    try:
        path = tokens.default_path()
    except ImportError:
        pytest.skip("no vocabulary files here")
    with open(path, encoding="utf-8") as f:
        return tokens.encoder(f.read())


def test_encoder_is_exact_and_decodes(encoder):
    rng = random.Random(8)
    texts = ["", "Hello, world!  \n\n x", "网关重启 café 🛰🛰", "a" * 500, " " * 50, "\ufeff\u200b"]
    texts += ["".join(chr(rng.choice([rng.randint(32, 126), rng.randint(0x4E00, 0x9FFF), rng.randint(0xC0, 0x17F)])) for _ in range(rng.randint(1, 60))) for _ in range(200)]
    decoder = tokens.Decoder(encoder)
    for t in texts:
        ids = encoder.encode(t)
        assert list(ids) == [i for w in encoder.split(t) for i in merge_loop(encoder, w)] and decoder.decode(np.array(ids, np.int64)) == t
    assert list(encoder.encode(None)) == []


def test_ids_of_rows(spark, encoder):
    df = spark.createDataFrame([(1, "Hello", [7]), (2, None, None), (3, "", None), (3, "Hello", None)], "id long, text string, ids array<int>")
    rows = sorted((r["id"], r["ids"]) for r in tokens.with_ids(df, "text").collect())
    assert rows == [(1, list(encoder.encode("Hello"))), (2, []), (3, []), (3, list(encoder.encode("Hello")))]
    assert tokens.with_ids(df.limit(0), "text").count() == 0
