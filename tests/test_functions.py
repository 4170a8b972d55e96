import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.functions import gates as G
from millrace.functions import text as X


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'array<string>' if isinstance(v, list) else 'boolean' if isinstance(v, bool) else 'string'}" for k, v in values.items()))
    return df.select(column.alias("x")).first()["x"]


def slow_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


@settings(max_examples=200, deadline=None)
@given(st.text("abcd", max_size=80), st.text("abcd", max_size=80))
def test_lcs(a, b):
    assert X.lcs_length(a, b) == slow_lcs(a, b)


@pytest.mark.parametrize(
    "text,kind,value",
    [
        ('Here: ```json\n[{"a": 1,},]\n``` done', list, [{"a": 1}]),
        ('{"a": "x ] } y", "b": "line\nend"}', dict, {"a": "x ] } y", "b": "line\nend"}),
        ("no [json here", list, None),
        ('{"a": 1}', list, None),
        (None, list, None),
        ("[bad] then [1, 2]", list, [1, 2]),
    ],
)
def test_tolerant_json(text, kind, value):
    assert X.loads_tolerant(text, kind) == value


def test_mask_and_restore(spark):
    text = "login pwd=hunter22 from 10.1.2.3 or 8.8.8.8, mac 00:1a:2b:3c:4d:5e, call 13812345678, mail a.b@c.example, again 10.1.2.3"
    df = spark.createDataFrame([(text,), (None,), ("",)], "t string").withColumn("m", X.mask("t"))
    known = df.select(F.explode(X.masked_values("t")).alias("p")).select("p.*").distinct()
    pairs = {r["token"]: r["value"] for r in known.collect()}
    masked = df.where(F.length("t") > 0).first()["m"]
    assert "8.8.8.8" in masked and not any(v in masked for v in ("hunter22", "10.1.2.3", "00:1a", "13812345678", "a.b@c"))
    assert masked.count("〔IP:") == 2 and len({t for t in pairs if t.startswith("〔IP:")}) == 1
    mapping = F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])
    assert df.where(F.length("t") > 0).select(X.restore(F.col("m"), mapping).alias("r")).first()["r"] == text
    gone = df.select(X.unresolved("m", F.array(*[F.lit(t) for t in list(pairs)[1:]])).alias("u")).first()["u"]
    assert gone == [list(pairs)[0]]


def test_questions_go_behind_the_first_heading(spark):
    line = X.QUESTIONS_LABEL + "a？｜b？"
    assert one(spark, X.inject_questions(F.col("m"), F.col("q")), m="# T\n\nbody\n## H", q=["a？", "b？"]) == f"# T\n\n{line}\n\nbody\n## H"
    assert one(spark, X.inject_questions(F.col("m"), F.col("q")), m="no heading", q=["a？", "b？"]) == f"{line}\n\nno heading"
    assert one(spark, X.inject_questions(F.col("m"), F.col("q")), m="# T", q=["a？", "b？"]) == f"# T\n\n{line}\n"
    assert one(spark, X.inject_questions(F.col("m"), F.col("q")), m="# T", q=[]) == "# T"


@pytest.mark.parametrize("title,key", [("7.4.7 重启", "7.4.7"), ("常见 faq 页", "FAQ"), ("重启 网关/步骤说明书再长", "重启_网关_步骤"), ("??", "untitled")])
def test_section_key(spark, title, key):
    assert one(spark, X.section_key("t"), t=title) == key


def test_names_and_chapters(spark):
    assert one(spark, X.safe_name("t"), t="a b/é—c.md") == "a_b_é_c.md"
    assert one(spark, X.top_chapter("p", F.lit("T")), p="M / 1. A / x") == "1. A" and one(spark, X.top_chapter("p", F.lit("T")), p="M") == "T"
    assert one(spark, X.demoted("t"), t="# a\n#\n###### f\nx # y") == "## a\n#\n###### f\nx # y"
    assert one(spark, X.vision_parts(F.col("t")), t="[TRANSCRIPT] a\n[MEANING] b") == ("a", "b")
    assert one(spark, X.query_norm("t"), t="Ａ b？C：") == "abc"
    assert one(spark, X.unescaped(F.col("t")), t="&amp;lt; &#39;") == "&lt; '"


def fence_ok(text):
    opened = None
    for line in (text or "").splitlines():
        s = line.lstrip()
        if s[:3] in ("```", "~~~"):
            n = len(s) - len(s.lstrip(s[0]))
            if opened is None:
                opened = (s[0], n)
            elif s[0] == opened[0] and n >= opened[1]:
                opened = None
    return opened is None


def test_fences(spark):
    rng = random.Random(1)
    texts = ["\n".join(rng.choices(["```", "````", "~~~", "  ```py", "x", ""], k=rng.randint(0, 7))) for _ in range(300)] + [None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", G.fence_balanced("t").alias("ok"))
    assert [r["ok"] for r in df.orderBy("i").collect()] == [fence_ok(t) for t in texts]


def test_gates(spark):
    reasons = lambda **v: one(spark, G.qa_reasons(F.col("q"), F.col("a"), F.col("t")), **v)
    assert reasons(q="x", a="y", t=False) == "" and reasons(q=" x ", a="x", t=True) == "truncated(finish_reason=length);query_equals_answer"
    assert reasons(q=" ", a="```\n", t=False) == "empty_query;unbalanced_code_fence"
    assert one(spark, G.sop_reasons(F.col("m"), F.col("q"), F.lit(None).cast("boolean")), m="text", q=[]) == "no_entry_questions;no_markdown_heading"
    label = lambda t, b="some longer body": one(spark, G.prefilter(F.col("t"), F.col("b")), t=t, b=b)
    assert [label("3.1 如何重启"), label("操作步骤"), label("附录"), label("V2.5.0"), label("其他"), label("任何", " ")] == ["qa", "sop", "skip", "sop", None, "skip"]


def test_preflight_reads_marks_only(spark):
    flags = lambda p, t: one(spark, G.preflight(F.col("p"), F.col("t")), p=p, t=t)["flags"]
    assert flags("kb/文档【已私密】.md", "x") == ["private"]
    assert flags("kb/a.md", "状态：已废弃\nbody") == ["deprecated"] and flags("kb/a.md", "visibility: private") == ["private"]
    assert flags("kb/a.md", "某 API 已废弃，请用新版") == []


def test_failures(spark):
    code = lambda e: one(spark, G.failure_code(F.col("e")), e=e)
    assert [code("Content blocked"), code("HTTP 429"), code("request timed out"), code("coverage gap: 1:qa"), code("x"), code(None)] == ["content_blocked", "rate_limited", "gateway_unavailable", "completeness_gap", "pipeline_error", "pipeline_error"]
    assert one(spark, G.sanitised(F.col("e")), e="content blocked: 邮箱 a@b.example, password x") == "gateway content safety blocked the request; categories=email,password"
    assert one(spark, G.whitelisted(F.col("c"), F.col("e")), c=["a", "b", "a"], e=["a"]) == ["a", "a"]
