import random
import time

from millrace.functions.text import similarity
from millrace.operators import units as U

SYLLABLES = [a + b + c for a in "bdfgklmnprstvz" for b in "aeiou" for c in "lmnrsx"]
COLUMNS = "ord long, query string, answer string, paraphrases array<string>, sources array<struct<topic:string,heading_path:string,section_sid:string>>, needs_review boolean, semantic_ok boolean"


def hot_module(n):
    """Questions of one wording about other things; each tenth is told once more, a sign apart, ``n`` ids further."""
    rng = random.Random(7)
    name = lambda: "".join(rng.choices(SYLLABLES, k=4))
    out = []
    for i in range(n):
        q = f"为什么{name()}升级后检查点写入变慢，{name()}的错误码E{rng.randint(10000, 99999)}是什么意思？（环境：{name()}，编号CHG-{rng.randint(10**8, 10**9 - 1)}）"
        out.append((i, q))
        if i % 10 == 0:
            out.append((n + i, q.replace("变慢", "很慢")))
    return out


def test_a_large_module_is_folded_in_time(spark):
    n = 9000
    rows = [(i, q, "a", [], [("hot", "", "1")], False, None) for i, q in hot_module(n)]
    began = time.time()
    got = {r["ord"]: len(r["paraphrases"]) for r in U.dedup_questions(spark.createDataFrame(rows, COLUMNS)).collect()}
    assert time.time() - began < 90
    assert got == {i: int(i % 10 == 0) for i in range(n)}


def test_blocks_of_a_module_lose_no_group(spark, monkeypatch):
    from millrace.operators import alike

    monkeypatch.setattr(alike, "SMALL", 100)
    monkeypatch.setattr(alike, "LEAST", 40)
    rng = random.Random(5)
    base = ["".join(rng.choices("abcde01问题", k=rng.randint(5, 60))) for _ in range(40)]
    texts = {}
    for i in range(500):
        t = list(rng.choice(base))
        for _ in range(rng.randint(0, 4)):
            at = rng.randrange(len(t) + 1)
            t[at : at + rng.randint(0, 1)] = rng.choice(["", "x", "9", "解"])
        texts.setdefault("".join(t), i)
    rows = [(m, i, t) for m in ("hot", "like hot") for t, i in texts.items()] + [(f"small {i % 7}", i, t) for t, i in texts.items()]
    df = spark.createDataFrame(rows, "module string, ord long, norm string")
    assert alike.placed(df, 90.0).where("low >= 0").select("low", "high").distinct().count() > 10
    by = {}
    for m, i, t in rows:
        by.setdefault(m, []).append((i, t))
    want = {(m, i, j) for m, own in by.items() for i, a in own for j, b in own if i < j and similarity(a, b) >= 90.0}
    got = [(r["module"], r["a"], r["b"]) for r in U.near_edges(df, 90.0).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_groups_of_a_large_module_in_time(spark):
    n = 9000
    rows = [(i, q, [("hot", "", "1")]) for i, q in hot_module(n)]
    began = time.time()
    got = {r["ord"]: r["leader"] for r in U.query_groups(spark.createDataFrame(rows, "ord long, query string, sources array<struct<topic:string,heading_path:string,section_sid:string>>")).collect()}
    assert time.time() - began < 90
    assert got == {i: i % n for i, _, _ in rows}


def greedy(texts):
    """Leaders by greedy clustering over the texts in order."""
    out = []
    for i, t in enumerate(texts):
        out.append(next((j for j in range(i) if out[j] == j and similarity(t, texts[j]) >= 90.0), i))
    return out


def grouped(spark, texts):
    rows = [("m", i, t) for i, t in enumerate(texts)]
    got = {r["ord"]: r["leader"] for r in U.leaders(spark.createDataFrame(rows, "module string, ord long, norm string"), 90.0).collect()}
    return [got[i] for i in range(len(texts))]


def test_a_module_of_one_wording_in_time(spark):
    began = time.time()
    got = grouped(spark, [f"节点{i:04d}的检查点写入在升级之后变慢时应该先看哪一个指标再看哪一段日志并且按什么次序重启相关的服务" for i in range(8000)])
    assert time.time() - began < 60
    assert got == [0] * 8000


def test_a_long_chain_in_time(spark, monkeypatch):
    from millrace.operators import alike

    rng = random.Random(8)
    long = "".join(rng.choices(SYLLABLES, k=600))
    chain = [long[2 * i : 2 * i + 40] for i in range(800)]
    want = greedy(chain)
    assert sum(i == j for i, j in enumerate(want)) > 200
    began = time.time()
    assert grouped(spark, chain) == want  # whole in a task
    monkeypatch.setattr(alike, "SMALL", 100)
    monkeypatch.setattr(alike, "LEAST", 200)
    assert grouped(spark, chain) == want  # in blocks, settled from the pairs
    assert time.time() - began < 60
    monkeypatch.setattr(U, "HELD", 0)
    assert grouped(spark, chain[:12]) == want[:12]
    monkeypatch.setattr(alike, "SMALL", 5)
    assert grouped(spark, chain[:12]) == want[:12]  # in rounds
