import random

from pyspark.sql import functions as F

from millrace.functions.text import similarity
from millrace.operators import sections as S
from millrace.operators import units as U

SOURCES = "array<struct<topic:string,heading_path:string,section_sid:string>>"


def greedy(norms, least):
    """Units in order, each to an equal leader, else to the first that is similar."""
    out, leaders = {}, []
    for ord_, n in norms:
        hit = next((o for o, m in leaders if n and m == n), None)
        if hit is None:
            hit = next((o for o, m in leaders if n and m and similarity(n, m) >= least), None)
        if hit is None:
            leaders.append((ord_, n))
            hit = ord_
        out[ord_] = hit
    return out


def test_groups_are_those_of_greedy_clustering(spark):
    rng = random.Random(4)
    norms = []
    base = ["".join(rng.choices("abcdefghij", k=rng.randint(1, 30))) for _ in range(12)]
    for i in range(160):
        t = list(rng.choice(base))
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(t) + 1)
            t[at : at + rng.randint(0, 1)] = rng.choice(["", "x", "y"])
        norms.append((i, "".join(t)))
    for least in (90.0, 88.0):
        df = spark.createDataFrame([("m", i, n) for i, n in norms] + [("other", 0, norms[0][1])], "module string, ord long, norm string")
        got = {r["ord"]: r["leader"] for r in U.leaders(df, least).where("module = 'm'").collect()}
        assert got == greedy(norms, least)
    assert U.leaders(df.limit(0), 90.0).count() == 0


def test_folds_lose_nothing(spark):
    s = lambda t: [{"topic": t, "heading_path": "", "section_sid": "1"}]
    rows = [
        (1, "如何重启网关？", "short", ["怎样重启"], s("m"), False, True),
        (2, "如何重启网关", "a longer answer", [], s("m"), True, False),
        (3, "如何重启网关", "x", None, s("n"), None, True),
        (4, "", "empty query", [], s("m"), False, None),
        (5, None, "", [], None, None, None),
    ]
    df = spark.createDataFrame(rows, f"ord long, query string, answer string, paraphrases array<string>, sources {SOURCES}, needs_review boolean, semantic_ok boolean")
    got = {(r["module"], r["ord"]): r for r in U.dedup_questions(df).collect()}
    assert set(got) == {("m", 1), ("n", 3), ("m", 4), ("", 5)}
    first = got["m", 1]
    assert first["answer"] == "a longer answer" and first["paraphrases"] == ["怎样重启", "如何重启网关"] and first["needs_review"] and len(first["sources"]) == 2
    same = df.where("ord < 3").withColumn("answer", F.lit("the same answer")).withColumn("semantic_ok", F.when(F.col("ord") == 1, True))
    assert [r["semantic_ok"] for r in U.aggregate_answers(same).collect()] == [None]


def test_packing_in_order(spark):
    rows = [("d", i, n) for i, n in enumerate([2, 2, 4, 9, 1, 1, 1, 1])]
    df = spark.createDataFrame(rows, "doc string, pos long, n long")
    got = [r["batch"] for r in U.batches(df, "doc", ["pos"], F.col("n"), 3, 5).orderBy("pos").collect()]
    assert got == [0, 0, 1, 2, 3, 3, 3, 4]


TEXT = """intro ![a](images/a.png)
# One
body
```
# no heading
~~~
```
## Sub
<!-- ocr-source: b.png -->
![b](img/b.png)
<!-- ocr-source: img/b.png -->
<details>
<pre>x &lt; y
z</pre>
</details>tail
# Two
"""


def test_parser():
    rows = {r[0]: r for r in S.parse(TEXT, "stem")}
    assert list(rows) == ["0", "1", "1.1", "2"]
    assert rows["0"][4] == "stem（前言）" and rows["1"][7].count("```") == 2 and rows["1.1"][5] == ["One"] and rows["1.1"][6] == "One / Sub"
    assert [r[4] for r in S.parse("just text", "stem")] == ["stem"] and S.parse(None, "s") == [] and S.parse("", "s") == []


def test_ocr_goes_to_its_image():
    text = "# A\n![b](img/b.png)\n![c](img/c.png)\n<!-- ocr-source: img/b.png -->\n<details>\n<pre>x &lt; y\nz</pre>\n</details>tail"
    row = S.parse(text, "s")[0]
    assert row[8] == [{"rel_path": "img/b.png", "inline_ocr": "x < y\nz"}, {"rel_path": "img/c.png", "inline_ocr": ""}] and row[7].endswith("tail") and "ocr" not in row[7]


def test_oversize(spark):
    body = "\n\n".join(f"para {i} " + "x" * 40 for i in range(10)) + "\n\n```\n" + "y\n\n" * 30 + "```"
    df = spark.createDataFrame([("1", "T", body), ("2", "U", "short"), ("3", "V", None)], "sid string, title string, body string")
    rows = {r["sid"]: r for r in S.split_oversize(df, 120).collect()}
    parts = [r for sid, r in rows.items() if sid.startswith("1.")]
    assert rows["2"]["body"] == "short" and rows["3"]["body"] is None and len(parts) > 3
    assert all(r["body"].count("```") % 2 == 0 for r in parts) and rows["1.part1"]["title"] == f"T（1/{len(parts)}）"


def test_coverage(spark):
    sections = spark.createDataFrame([("t", "1", "x"), ("t", "2", "x"), ("t", "3", " "), ("t", "4", None)], "topic string, sid string, body string")
    units = spark.createDataFrame([(True, [("t", "1")]), (False, [("t", "2")]), (None, None)], "struct_ok boolean, sources array<struct<topic:string,section_sid:string>>")
    assert [tuple(r) for r in S.coverage_gaps(sections, units).collect()] == [("t", "2")]


def test_merge_plan(spark):
    s = lambda p: [{"topic": "m", "heading_path": p, "section_sid": "1"}]
    df = spark.createDataFrame([(i, f"t{i}", s(f"m / {'A' if i < 4 else i}")) for i in range(7)] + [(9, "x", None)], f"sop_id long, title string, sources {SOURCES}")
    got = {r["sop_id"]: r["group_key"] for r in U.merge_plan(df).collect()}
    assert got[0] == "m::A" and got[6] == "m::6" and got[9] == "_unknown"
