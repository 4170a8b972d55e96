"""Rules on units, documents and errors, as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.text import stripped

# Cues of titles, marks of private and withdrawn documents, and reasons of the gates.
QA_CUES = r"(?iu)(如何|怎么|怎样|为什么|为何|是什么|报错|失败|错误|异常|问题|排查|定位|超时|不了|无法|起不来|hang|oom|error|\?|？)"
SOP_CUES = r"(流程|步骤|规则|说明|板斧|规范|介绍|概述|原理|机制|准备|配置方法|操作步骤)"
SKIP_CUES = r"(?i)^(目录|附录|提问之前|概览|index|toc|-+|=+)\s*$"
RELEASE_CUES = r"(?i)(^\s*v?\d+\.\d+(\.\d+)*|\d{4}[.\-/年]\s*\d{1,2}|版本|发版|发布|更新日志|产品动态|上线)"
PATH_MARKS = r"(?i)(?:^|[/_\-（(【\[])(已私密|私密文档|机密文档|仅协作人访问|协作人可见|内部受限|已废弃|废弃文档|已下线|停止维护)(?=$|[/_\-）)】\]])"
HEADER_MARKS = (
    r"(?i)^\s*#{0,3}\s*[【\[]\s*(已私密|私密|机密|仅协作人访问|协作人可见|内部受限|已废弃|废弃|已下线)\s*[】\]]",
    r"(?i)^\s*(?:status|状态|文档状态)\s*[:：]\s*(已废弃|废弃|已下线|停止维护)\s*$",
    r"(?i)^\s*(?:visibility|可见性)\s*[:：]\s*(private|私密|机密)\s*$",
    r"(?i)^\s*(?:deprecated|废弃)\s*[:：]\s*(?:true|yes|是)\s*$",
)
PRIVATE = r"(?i)private|私密|机密|协作人|受限"
TRUNCATED, EMPTY_QUERY, EMPTY_ANSWER, SAME = "truncated(finish_reason=length)", "empty_query", "empty_answer", "query_equals_answer"
FENCE, EMPTY_MARKDOWN, NO_QUESTIONS, NO_HEADING = "unbalanced_code_fence", "empty_markdown", "no_entry_questions", "no_markdown_heading"
#: Codes of failures, what their text holds, and whether a retry may help; the first that fits counts.
FAILURES = (
    ("content_blocked", ("content blocked",), False),
    ("invalid_model_output", ("invalid json",), True),
    ("quota_exhausted", ("quota", "配额"), True),
    ("rate_limited", ("429", "rate limit", "限流"), True),
    ("gateway_unavailable", ("503", "502", "upstream", "timeout", "timed out"), True),
    ("completeness_gap", ("coverage gap",), False),
    ("truncated_output", ("truncated",), True),
    ("vision_failed", ("vision", "image", "图片"), True),
)
STAGES = (("vision", ("vision", "image")), ("classify", ("classif",)), ("extract", ("extract", "json")), ("validate", ("coverage", "truncat")), ("review", ("review", "regenerat")))
SENSITIVE = (("email", ("邮箱", "email")), ("password", ("密码", "password", "passwd")), ("network_address", ("mac地址", "ip地址")), ("credential", ("密钥", "token", "secret")))


def _any(text: Column, cues: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for c in cues:
        out = out | text.contains(c)
    return out


def fence_balanced(text: Column | str) -> Column:
    """Whether every fence is closed by one of the same sign that is no shorter; true for null."""
    lines = F.transform(F.split(F.coalesce(text, F.lit("")), r"\R", -1), lambda x: F.regexp_extract(x, r"^\s*(`{3,}|~{3,})", 1))
    marks = F.filter(lines, lambda m: m != "")
    closes = lambda opened, m: (F.substring(m, 1, 1) == F.substring(opened, 1, 1)) & (F.length(m) >= F.length(opened))
    return F.aggregate(marks, F.lit(""), lambda opened, m: F.when(opened == "", m).when(closes(opened, m), "").otherwise(opened)) == ""


def _reasons(*told: tuple[Column, str]) -> Column:
    return F.array_join(F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(r)) for c, r in told])), ";")


def qa_reasons(query: Column, answer: Column, truncated: Column) -> Column:
    """Why a pair is malformed, joined by ``;``; empty for a sound one. Nulls count as empty texts."""
    q, a = stripped(F.coalesce(query, F.lit(""))), stripped(F.coalesce(answer, F.lit("")))
    return _reasons((truncated, TRUNCATED), (q == "", EMPTY_QUERY), (a == "", EMPTY_ANSWER), ((q != "") & (q == a), SAME), (~fence_balanced(answer), FENCE))


def sop_reasons(markdown: Column, questions: Column, truncated: Column) -> Column:
    m = stripped(F.coalesce(markdown, F.lit("")))
    return _reasons(
        (truncated, TRUNCATED),
        (m == "", EMPTY_MARKDOWN),
        (~fence_balanced(markdown), FENCE),
        (F.coalesce(F.size(questions), F.lit(0)) <= 0, NO_QUESTIONS),
        ((m != "") & ~markdown.rlike(r"(?mU)^#{1,6}\s+\S"), NO_HEADING),
    )


def prefilter(title: Column, body: Column) -> Column:
    """skip, qa or sop where title and body tell it, else null."""
    t, b = stripped(F.coalesce(title, F.lit(""))), F.coalesce(body, F.lit(""))
    bare = stripped(F.regexp_replace(t, r"(?U)^[\d.、]+\s*", ""))
    qa, sop = bare.rlike(QA_CUES), bare.rlike(SOP_CUES)
    skip = bare.rlike(SKIP_CUES) | ((F.length(bare) <= 1) & (F.length(b) < 20)) | (stripped(b) == "")
    return F.when(skip, "skip").when(qa & ~sop, "qa").when(sop & ~qa, "sop").when(~qa & t.rlike(RELEASE_CUES), "sop")


def preflight(path: Column, text: Column) -> Column:
    """flags (private, deprecated) and evidence of a document, from its path and its first 80 lines."""
    flag = lambda v: F.when(v.rlike(PRIVATE), "private").otherwise("deprecated")
    by_path = F.transform(F.regexp_extract_all(F.coalesce(path, F.lit("")), F.lit(PATH_MARKS), 1), lambda v: F.struct(flag(v).alias("flag"), F.concat(F.lit("路径标记："), v).alias("told")))
    lines = F.slice(F.split(F.substring(F.coalesce(text, F.lit("")), 1, 12000), r"\R", -1), 1, 80)

    def of_line(line: Column) -> Column:
        # the last pattern has no value of its own: it marks withdrawn documents
        values = [F.when(line.rlike(p), F.regexp_extract(line, p, 1) if i < 3 else F.lit("deprecated")) for i, p in enumerate(HEADER_MARKS)]
        value = F.coalesce(*values)
        return F.when(value.isNotNull(), F.struct(flag(value).alias("flag"), F.concat(F.lit("文档标记："), F.substring(stripped(line), 1, 240)).alias("told")))

    every = F.concat(by_path, F.array_compact(F.transform(lines, of_line)))
    return F.struct(F.array_distinct(every["flag"]).alias("flags"), F.array_distinct(every["told"]).alias("evidence"))


def publishable(status: Column, semantic_ok: Column) -> Column:
    """Neither failed in review nor found wrong; unknown is allowed."""
    return F.coalesce(status != "failed_review", F.lit(True)) & F.coalesce(semantic_ok, F.lit(True))


def verdict(status: Column, semantic_ok: Column, struct_ok: Column | None = None) -> Column:
    """active (approved and right), invalid (malformed) or quarantine."""
    active = F.coalesce((status == "approved") & semantic_ok, F.lit(False))
    return F.when(~F.coalesce(struct_ok, F.lit(False)) if struct_ok is not None else F.lit(False), "invalid").when(active, "active").otherwise("quarantine")


def failure_code(message: Column) -> Column:
    text = F.lower(F.coalesce(message, F.lit("")))
    out = F
    for code, cues, _ in FAILURES:
        out = out.when(_any(text, cues), code)
    return out.otherwise("pipeline_error")


def retryable(code: Column) -> Column:
    return ~code.isin([c for c, _, again in FAILURES if not again])


def failure_stage(message: Column) -> Column:
    text = F.lower(F.coalesce(message, F.lit("")))
    out = F
    for stage, cues in STAGES:
        out = out.when(_any(text, cues), stage)
    return out.otherwise("unknown")


def sanitised(message: Column) -> Column:
    """Blocked messages reduced to the categories of what they echo; others as they are, null as empty."""
    text = F.coalesce(message, F.lit(""))
    low = F.lower(text)
    told = F.array_join(F.array_compact(F.array(*[F.when(_any(low, cues), F.lit(label)) for label, cues in SENSITIVE])), ",")
    blocked = low.contains("content blocked") | text.contains("sensitive contain")
    return F.when(blocked, F.concat(F.lit("gateway content safety blocked the request; categories="), F.when(told == "", "sensitive_content").otherwise(told))).otherwise(text)


def without_excerpts(sources: Column) -> Column:
    return F.transform(sources, lambda s: s.dropFields("source_excerpt"))


def whitelisted(candidates: Column, echoed: Column) -> Column:
    """The candidates that a reviewer echoed, in order and as often as given; none without an answer."""
    allowed = F.coalesce(echoed, F.array().cast("array<string>"))
    return F.filter(candidates, lambda p: F.array_contains(allowed, p))
