import random

import numpy as np

from millrace.llm import neardup


def planted(rng: random.Random, least: float, n: int) -> list[tuple[str, str]]:
    """Pairs of texts whose similarity is just at or above the threshold."""
    letters = [chr(c) for c in range(0x4E00, 0x4E00 + 3000)]
    pairs = []
    while len(pairs) < n:
        x = rng.choices(letters, k=60)
        y, last = list(x), "".join(x)
        for at in rng.sample(range(60), 60):
            y[at] = rng.choice(letters)
            if neardup.similarity("".join(x), "".join(y)) < least:
                break
            last = "".join(y)
        if neardup.similarity("".join(x), last) < least + 0.03:
            pairs.append(("".join(x), last))
    return pairs


def test_no_pair_at_the_threshold_is_lost(spark):
    rng = random.Random(5)
    q, a = planted(rng, 0.60, 150), planted(rng, 0.60, 150)
    rows = [(2 * i + s, q[i][s], a[i][s]) for i in range(150) for s in (0, 1)]
    df = spark.createDataFrame(rows, "qa_id long, query string, answer string")
    assert {tuple(r) for r in neardup.near_pairs(df, "qa_id", neardup.QA).collect()} == {(2 * i, 2 * i + 1) for i in range(150)}
    t = planted(rng, 0.70, 150)
    df = spark.createDataFrame([(2 * i + s, t[i][s]) for i in range(150) for s in (0, 1)], "sop_id long, title string")
    assert {tuple(r) for r in neardup.near_pairs(df, "sop_id", neardup.SOP).collect()} == {(2 * i, 2 * i + 1) for i in range(150)}


def test_sizes_positions_and_blocks_lose_none(monkeypatch):
    monkeypatch.setattr(neardup, "AT_ONCE", 1000)
    rng = random.Random(6)
    texts = ["".join(rng.choices("abcde", k=rng.randint(5, 14))) for _ in range(400)]
    field = (neardup.Field("t", 0.60),)
    kept, _, sizes, sketch, shards = neardup.features({"t": texts}, field, np.zeros(neardup.COUNTS, np.int64))
    rows = [(s, i, at) for i, keys in enumerate(shards) for at, s in enumerate(keys.tolist())]
    _, number = np.unique([r[0] for r in rows], return_inverse=True)
    i, at = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
    true = {(a, b) for a in range(400) for b in range(a + 1, 400) if neardup.similarity(texts[a], texts[b]) >= 0.60}
    a, b = neardup.shard_pairs(number, np.zeros(len(i), np.int64), kept[i], sizes[i], at, sketch[i], [0.60])
    assert true and true <= set(zip(a.tolist(), b.tolist()))
    a, b = neardup.shard_pairs(number, 1 + i % 2, kept[i], sizes[i], at, sketch[i], [0.60])
    got = set(zip(a.tolist(), b.tolist()))
    assert {(x, y) for x, y in true if (x - y) % 2} <= got and all((x - y) % 2 for x, y in got)


def test_hot_shards_copies_nulls_and_extra_columns(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 8)
    rng = random.Random(7)
    words = ["restart", "gateway", "cluster", "replica", "session", "timeout", "storage", "network"]
    titles = [" ".join(rng.choices(words, k=4)) for _ in range(80)] + ["same text here"] * 5 + [None, "", "ab", "!!"]
    df = spark.createDataFrame([(i, t, "x", i) for i, t in enumerate(titles)], "sop_id long, title string, cls string, id long")
    true = {(i, j) for i in range(len(titles)) for j in range(i + 1, len(titles)) if neardup.similarity(titles[i], titles[j]) >= 0.70}
    near = neardup.near(df, "sop_id", neardup.SOP)
    assert {tuple(r) for r in near.expanded().collect()} == true
    told = {r["key"]: r for r in near.classes().collect()}
    assert len(told) == 85 and told[82]["class_id"] == 80 and told[82]["copies"] == 5 and told[82]["links"] == 0
    assert neardup.near_pairs(df.limit(0), "sop_id", neardup.SOP).count() == 0
