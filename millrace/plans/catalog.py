"""All queries of the core and their SQL: a query for each operator that the tables can show."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import gates as G
from millrace.functions import text as X
from millrace.operators import control as C
from millrace.operators import incremental
from millrace.operators import sections as S
from millrace.operators import units as U
from millrace.session import table
from millrace.sinks import exports as E
from millrace.sources import files
from millrace.streaming import journal

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {"p6_found": incremental.p6_found, "p6_target": incremental.p6_target}
SQL: dict[str, str] = {"p6_found": incremental.P6_SQL, "p6_target": incremental.P6_TARGET_SQL}

_BLANK = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"
_SPACE = r"[\t-\r\x{85}\p{Z}]"


def _strip(x: str) -> str:
    return rf"regexp_replace(regexp_replace({x}, '^{_BLANK}+', ''), '{_BLANK}+$', '')"


def _balanced(x: str) -> str:
    marks = rf"list_transform(regexp_split_to_array(coalesce({x}, ''), '\r\n|[\n\x0b\f\r\x{{85}}\x{{2028}}\x{{2029}}]'), lambda l: regexp_extract(l, '^\s*(`{{3,}}|~{{3,}})', 1))"
    step = "CASE WHEN m = '' THEN o WHEN o = '' THEN m WHEN m[1] = o[1] AND length(m) >= length(o) THEN '' ELSE o END"
    return f"(list_reduce(list_prepend('', {marks}), lambda o, m: {step}) = '')"


_MODULE = "coalesce(sources[1].topic, '')"
_GOOD = "coalesce(publication_status <> 'failed_review', true) AND coalesce(semantic_ok, true)"
_LATEST = "(SELECT * FROM doc_states WHERE topic IS NOT NULL QUALIFY row_number() OVER (PARTITION BY topic ORDER BY updated_at DESC NULLS LAST, state_seq DESC NULLS LAST) = 1)"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its name, with its SQL where SQL can state it."""

    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return register


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES["p6_found"](spark, sf_dir)


# --- Gates ---


@query(f"SELECT section_id, {_balanced('body')} AS balanced FROM sections")
def op_fence_balance(spark, sf):
    return table(spark, sf, "sections").select("section_id", G.fence_balanced("body").alias("balanced"))


@query(f"""SELECT qa_id, array_to_string(list_filter([
  CASE WHEN truncated THEN 'truncated(finish_reason=length)' END, CASE WHEN q = '' THEN 'empty_query' END, CASE WHEN a = '' THEN 'empty_answer' END,
  CASE WHEN q <> '' AND q = a THEN 'query_equals_answer' END, CASE WHEN NOT ok THEN 'unbalanced_code_fence' END], lambda r: r IS NOT NULL), ';') AS struct_reason
FROM (SELECT qa_id, truncated, {_strip("coalesce(query, '')")} AS q, {_strip("coalesce(answer, '')")} AS a, {_balanced('answer')} AS ok FROM qa_units)""")
def op_qa_gate(spark, sf):
    return table(spark, sf, "qa_units").select("qa_id", G.qa_reasons(F.col("query"), F.col("answer"), F.col("truncated")).alias("struct_reason"))


@query(f"""SELECT sop_id, array_to_string(list_filter([
  CASE WHEN truncated THEN 'truncated(finish_reason=length)' END, CASE WHEN m = '' THEN 'empty_markdown' END, CASE WHEN NOT ok THEN 'unbalanced_code_fence' END,
  CASE WHEN coalesce(len(entry_questions), 0) = 0 THEN 'no_entry_questions' END,
  CASE WHEN m <> '' AND NOT regexp_matches(markdown, '(?m)^#{{1,6}}{_SPACE}+[^\\t-\\r\\x{{85}}\\p{{Z}}]') THEN 'no_markdown_heading' END], lambda r: r IS NOT NULL), ';') AS struct_reason
FROM (SELECT *, {_strip("coalesce(markdown, '')")} AS m, {_balanced('markdown')} AS ok FROM sop_units)""")
def op_sop_gate(spark, sf):
    return table(spark, sf, "sop_units").select("sop_id", G.sop_reasons(F.col("markdown"), F.col("entry_questions"), F.col("truncated")).alias("struct_reason"))


@query(rf"""SELECT section_id, CASE
  WHEN regexp_matches(b, '(?i)^(目录|附录|提问之前|概览|index|toc|-+|=+)\s*$') OR (length(b) <= 1 AND length(coalesce(body, '')) < 20) OR {_strip("coalesce(body, '')")} = '' THEN 'skip'
  WHEN q AND NOT s THEN 'qa' WHEN s AND NOT q THEN 'sop'
  WHEN NOT q AND regexp_matches(t, '(?i)(^\s*v?\d+\.\d+(\.\d+)*|\d{{4}}[.\-/年]\s*\d{{1,2}}|版本|发版|发布|更新日志|产品动态|上线)') THEN 'sop' END AS label
FROM (SELECT *, regexp_matches(b, '(?i)(如何|怎么|怎样|为什么|为何|是什么|报错|失败|错误|异常|问题|排查|定位|超时|不了|无法|起不来|hang|oom|error|\?|？)') AS q,
  regexp_matches(b, '(流程|步骤|规则|说明|板斧|规范|介绍|概述|原理|机制|准备|配置方法|操作步骤)') AS s
  FROM (SELECT section_id, body, t, {_strip("regexp_replace(t, '^[\\p{Nd}.、]+[\\t-\\r\\x{85}\\p{Z}]*', '')")} AS b FROM (SELECT section_id, body, {_strip("coalesce(title, '')")} AS t FROM sections)))""")
def op_section_labels(spark, sf):
    return table(spark, sf, "sections").select("section_id", G.prefilter(F.col("title"), F.col("body")).alias("label"))


@query(f"SELECT coalesce(label, 'model') AS label, count(*) AS sections FROM ({SQL['op_section_labels']}) GROUP BY 1")
def op_label_histogram(spark, sf):
    return op_section_labels(spark, sf).groupBy(F.coalesce("label", F.lit("model")).alias("label")).agg(F.count("*").alias("sections"))


@query(f"SELECT qa_id FROM qa_units WHERE {_GOOD}")
def op_publishable(spark, sf):
    return table(spark, sf, "qa_units").where(G.publishable(F.col("publication_status"), F.col("semantic_ok"))).select("qa_id")


@query("""WITH v AS (SELECT 'qa' AS kind, CASE WHEN coalesce(publication_status = 'approved' AND semantic_ok, false) THEN 'active' ELSE 'quarantine' END AS verdict FROM qa_units
UNION ALL SELECT 'sop', CASE WHEN NOT coalesce(struct_ok, false) THEN 'invalid' WHEN coalesce(publication_status = 'approved' AND semantic_ok, false) THEN 'active' ELSE 'quarantine' END FROM sop_units)
SELECT kind, verdict, count(*) AS units FROM v GROUP BY 1, 2""")
def op_result_split(spark, sf):
    status, ok = F.col("publication_status"), F.col("semantic_ok")
    qa = table(spark, sf, "qa_units").select(F.lit("qa").alias("kind"), G.verdict(status, ok).alias("verdict"))
    sop = table(spark, sf, "sop_units").select(F.lit("sop").alias("kind"), G.verdict(status, ok, F.col("struct_ok")).alias("verdict"))
    return qa.unionByName(sop).groupBy("kind", "verdict").agg(F.count("*").alias("units"))


def _when(column: str, rules, otherwise: str) -> str:
    cases = " ".join(f"WHEN {' OR '.join(f'contains({column}, {c!r})' for c in cues)} THEN '{name}'" for name, cues in rules)
    return f"CASE {cases} ELSE '{otherwise}' END"


_CODE = _when("e", [(c, cues) for c, cues, _ in G.FAILURES], "pipeline_error")


@query(f"""SELECT DISTINCT state_seq, {_CODE} AS code, {_CODE} NOT IN ('content_blocked', 'completeness_gap') AS again, {_when("e", G.STAGES, "unknown")} AS stage
FROM (SELECT state_seq, lower(error) AS e FROM doc_states WHERE error IS NOT NULL)""")
def op_failure_codes(spark, sf):
    code = G.failure_code(F.col("error"))
    states = table(spark, sf, "doc_states").where(F.col("error").isNotNull())
    return states.select("state_seq", code.alias("code"), G.retryable(code).alias("again"), G.failure_stage(F.col("error")).alias("stage")).distinct()


_LABELS = ", ".join(f"CASE WHEN {' OR '.join(f'contains(lower(e), {c!r})' for c in cues)} THEN '{name}' END" for name, cues in G.SENSITIVE)


@query(f"""SELECT DISTINCT state_seq, CASE WHEN contains(lower(e), 'content blocked') OR contains(e, 'sensitive contain')
  THEN 'gateway content safety blocked the request; categories=' || coalesce(nullif(array_to_string(list_filter([{_LABELS}], lambda r: r IS NOT NULL), ','), ''), 'sensitive_content') ELSE e END AS message
FROM (SELECT state_seq, coalesce(error, '') AS e FROM doc_states)""")
def op_safe_messages(spark, sf):
    return table(spark, sf, "doc_states").select("state_seq", G.sanitised(F.col("error")).alias("message")).distinct()


@query("SELECT qa_id, list_filter(paraphrases, lambda p: list_contains(list_filter(paraphrases, lambda x: length(x) > 20), p)) AS kept FROM qa_units")
def op_whitelist(spark, sf):
    echoed = F.filter("paraphrases", lambda x: F.char_length(x) > 20)
    return table(spark, sf, "qa_units").select("qa_id", G.whitelisted(F.col("paraphrases"), echoed).alias("kept"))


@query("SELECT qa_id, s.topic AS topic, s.doc_title AS doc_title, s.heading_path AS heading_path, s.section_sid AS section_sid, s.source_sha AS source_sha, len(s.image_refs) AS images FROM (SELECT qa_id, unnest(sources) AS s FROM qa_units)")
def op_public_sources(spark, sf):
    public = table(spark, sf, "qa_units").select("qa_id", F.explode(G.without_excerpts(F.col("sources"))).alias("s"))
    images = F.when(F.col("s.image_refs").isNotNull(), F.size("s.image_refs")).cast("long").alias("images")
    return public.select("qa_id", *[F.col(f"s.{c}").alias(c) for c in ("topic", "doc_title", "heading_path", "section_sid", "source_sha")], images)


# --- Sections and images ---


@query(f"""WITH c AS (SELECT DISTINCT s.topic AS topic, s.section_sid AS sid FROM (SELECT unnest(sources) AS s FROM (SELECT sources FROM qa_units WHERE struct_ok UNION ALL SELECT sources FROM sop_units WHERE struct_ok)))
SELECT DISTINCT x.topic, x.sid FROM sections x LEFT JOIN c ON c.topic = x.topic AND c.sid = x.sid WHERE coalesce({_strip('x.body')} <> '', false) AND c.sid IS NULL""")
def op_coverage_gaps(spark, sf):
    units = [table(spark, sf, t).select("struct_ok", F.transform("sources", lambda s: F.struct(s["topic"].alias("topic"), s["section_sid"].alias("section_sid"))).alias("sources")) for t in ("qa_units", "sop_units")]
    return S.coverage_gaps(table(spark, sf, "sections").select("topic", "sid", "body"), units[0].unionByName(units[1]))


@query(f"SELECT section_id FROM sections WHERE coalesce({_strip('body')} <> '', false)")
def op_sections_with_text(spark, sf):
    return table(spark, sf, "sections").where(S.worth_reading(F.col("body"))).select("section_id")


@query("SELECT section_id, array_to_string(list_append(coalesce(heading_path, []), title), ' / ') AS full_title FROM sections WHERE title IS NOT NULL")
def op_full_titles(spark, sf):
    path = F.coalesce("heading_path", F.array().cast("array<string>"))
    return table(spark, sf, "sections").where(F.col("title").isNotNull()).select("section_id", F.array_join(F.concat(path, F.array("title")), " / ").alias("full_title"))


@query(f"SELECT image_id, coalesce(nullif({_strip('vision_text')}, ''), {_strip('inline_ocr')}, '') AS best FROM images")
def op_image_text(spark, sf):
    return table(spark, sf, "images").select("image_id", X.best_text("vision_text", "inline_ocr").alias("best"))


@query(f"""WITH t AS (SELECT topic, section_sid, string_agg('[图片 ' || coalesce(rel_path, '') || ']' || chr(10) || best, chr(10) || chr(10) ORDER BY image_id) AS texts
FROM (SELECT *, coalesce(nullif({_strip('vision_text')}, ''), {_strip('inline_ocr')}, '') AS best FROM images) WHERE best <> '' GROUP BY 1, 2)
SELECT section_id, md5(concat_ws(chr(10) || chr(10), nullif(body, ''), texts)) AS digest FROM sections s LEFT JOIN t ON t.topic = s.topic AND t.section_sid = s.sid""")
def op_section_content(spark, sf):
    told = S.section_content(table(spark, sf, "sections").select("section_id", "topic", "sid", "body"), table(spark, sf, "images"))
    return told.select("section_id", F.md5(F.encode("content", "UTF-8")).alias("digest"))


@query(f"""SELECT image_id, CASE WHEN i = 0 THEN '' ELSE {_strip("replace(left(vision_text, i - 1), '[TRANSCRIPT]', '')")} END AS transcript,
  CASE WHEN i = 0 THEN {_strip('vision_text')} ELSE {_strip("substr(vision_text, i + 9)")} END AS meaning FROM (SELECT *, strpos(vision_text, '[MEANING]') AS i FROM images) WHERE vision_text IS NOT NULL""")
def op_vision_parts(spark, sf):
    return table(spark, sf, "images").where(F.col("vision_text").isNotNull()).select("image_id", X.vision_parts(F.col("vision_text")).alias("p")).select("image_id", "p.transcript", "p.meaning")


@query("SELECT image_id, CASE lower(regexp_extract(rel_path, '\\.([^./]+)$', 1)) WHEN 'jpg' THEN 'image/jpeg' WHEN 'jpeg' THEN 'image/jpeg' WHEN 'gif' THEN 'image/gif' WHEN 'webp' THEN 'image/webp' ELSE 'image/png' END AS media FROM images")
def op_media_types(spark, sf):
    return table(spark, sf, "images").select("image_id", files.media_type(F.col("rel_path")).alias("media"))


@query("""SELECT section_id, row_number() OVER (PARTITION BY topic ORDER BY list_transform(string_split(coalesce(sid, ''), '.'), lambda p: CASE WHEN regexp_full_match(p, '[0-9]+') THEN CAST(p AS INT) ELSE 9999 END), section_id) AS place FROM sections""")
def op_section_order(spark, sf):
    from pyspark.sql import Window

    place = F.row_number().over(Window.partitionBy("topic").orderBy(X.sid_order("sid"), "section_id")).cast("long")
    return table(spark, sf, "sections").select("section_id", "topic", "sid").select("section_id", place.alias("place"))


@query()
def op_parsed_sections(spark, sf):
    """Sections that the parser finds in the texts of documents."""
    docs = table(spark, sf, "documents").select("doc_id", "text", F.coalesce("rel_path", F.lit("text")).alias("stem"))
    return S.sections_of(docs, "doc_id", "text", "stem").drop("images")


@query()
def op_oversize_parts(spark, sf):
    """Sections split at blank lines outside fences."""
    return S.split_oversize(table(spark, sf, "sections").select("section_id", "sid", "title", "body"))


@query("SELECT topic, CASE WHEN max(CASE WHEN level = 1 AND sid <> '0' THEN 1 ELSE 0 END) = 1 THEN arg_min(title, CAST(pos AS BIGINT) * 1000000000 + section_id) FILTER (level = 1 AND sid <> '0') ELSE arg_min(title, CAST(pos AS BIGINT) * 1000000000 + section_id) END AS doc_title FROM sections WHERE title IS NOT NULL GROUP BY 1")
def op_document_titles(spark, sf):
    told = table(spark, sf, "sections").where(F.col("title").isNotNull()).select("topic", "title", "level", "sid", (F.col("pos").cast("long") * 1000000000 + F.col("section_id")).alias("pos"))
    return S.document_titles(told, "topic")


# --- Units ---


@query(f"SELECT 'qa' AS kind, qa_id AS id, substr(sha256('QA::' || {_strip('query')}), 1, 16) AS unit FROM qa_units UNION ALL SELECT 'sop', sop_id, substr(sha256('SOP::' || {_strip('title')}), 1, 16) FROM sop_units")
def op_unit_ids(spark, sf):
    qa = table(spark, sf, "qa_units").select(F.lit("qa").alias("kind"), F.col("qa_id").alias("id"), X.unit_id("QA", "query").alias("unit"))
    return qa.unionByName(table(spark, sf, "sop_units").select(F.lit("sop").alias("kind"), F.col("sop_id").alias("id"), X.unit_id("SOP", "title").alias("unit")))


@query("SELECT DISTINCT topic, 'vision:' || substr(sha256('vision' || chr(0) || topic), 1, 20) AS decision, substr(sha256(topic), 1, 24) AS audit, substr(sha256(concat_ws(chr(31), topic, ext)), 1, 32) AS content FROM source_scans WHERE topic IS NOT NULL")
def op_keys(spark, sf):
    scans = table(spark, sf, "source_scans").where(F.col("topic").isNotNull())
    return scans.select("topic", X.decision_key(F.lit("vision"), F.col("topic")).alias("decision"), X.audit_key("topic").alias("audit"), X.content_key("topic", "ext").alias("content")).distinct()


_KEYS = f"(SELECT qa_id, answer, sources, publication_status, semantic_ok, unnest(list_distinct(list_filter(list_transform(list_prepend(query, coalesce(paraphrases, [])), lambda x: {_strip('x')}), lambda x: x <> ''))) AS key FROM qa_units)"


@query(f"SELECT qa_id, key FROM {_KEYS}")
def op_query_keys(spark, sf):
    return table(spark, sf, "qa_units").select("qa_id", F.explode(X.query_keys("query", "paraphrases")).alias("key"))


@query(f"SELECT key AS query, answer, {_MODULE} AS module FROM {_KEYS} WHERE {_GOOD}")
def op_export_rows(spark, sf):
    return E.qa_rows(table(spark, sf, "qa_units"))


_STEM = f"""coalesce(nullif(left(regexp_replace(regexp_replace(coalesce(sources[1].topic, '_unknown'), '[^\\p{{L}}\\p{{M}}\\p{{Nd}}\\p{{Pc}}.-]+', '_', 'g'), '^_+|_+$', '', 'g'), 80), ''), 'untitled') || '__' ||
  CASE WHEN regexp_extract(t, '^{_SPACE}*(\\p{{Nd}}+(?:\\.\\p{{Nd}}+)*)', 1) <> '' THEN regexp_extract(t, '^{_SPACE}*(\\p{{Nd}}+(?:\\.\\p{{Nd}}+)*)', 1) WHEN contains(upper(t), 'FAQ') THEN 'FAQ'
  ELSE coalesce(nullif(left(regexp_replace(regexp_replace({_strip('t')}, '[^\\p{{L}}\\p{{M}}\\p{{Nd}}\\p{{Pc}}]+', '_', 'g'), '^_+|_+$', '', 'g'), 8), ''), 'untitled') END"""


@query(f"""SELECT stem || CASE WHEN n > 1 THEN '-' || n ELSE '' END || '.md' AS name FROM (SELECT stem, row_number() OVER (PARTITION BY stem ORDER BY sop_id) AS n
FROM (SELECT sop_id, {_STEM} AS stem FROM (SELECT *, coalesce(title, '') AS t FROM sop_units WHERE {_GOOD} AND coalesce(struct_ok, false))))""")
def op_sop_names(spark, sf):
    return E.sop_files(table(spark, sf, "sop_units"), ["sop_id"]).select("name")


@query(f"""SELECT sop_id, md5(array_to_string(list_transform(string_split(markdown, chr(10)), lambda l: regexp_replace(l, '^(#{{1,5}})({_SPACE}+.*)$', '#\\1\\2')), chr(10))) AS digest FROM sop_units WHERE markdown IS NOT NULL""")
def op_demoted(spark, sf):
    return table(spark, sf, "sop_units").where(F.col("markdown").isNotNull()).select("sop_id", F.md5(F.encode(X.demoted("markdown"), "UTF-8")).alias("digest"))


_PLAN = f"""SELECT *, CASE WHEN n > 6 AND thick >= 2 THEN module || '::' || chapter ELSE module END AS group_key FROM (
SELECT *, count(*) OVER (PARTITION BY module) AS n, max(c) OVER (PARTITION BY module) AS thick FROM (SELECT *, count(*) OVER (PARTITION BY module, chapter) AS c FROM (
SELECT *, CASE WHEN len(sources) > 0 THEN sources[1].topic ELSE '_unknown' END AS module,
  coalesce(list_filter(list_transform(string_split(sources[1].heading_path, '/'), lambda p: {_strip('p')}), lambda p: p <> '')[2], title) AS chapter FROM sop_units)))"""


@query(f"SELECT sop_id, group_key FROM ({_PLAN})")
def op_merge_plan(spark, sf):
    return U.merge_plan(table(spark, sf, "sop_units").select("sop_id", "title", "sources")).select("sop_id", "group_key")


@query()
def op_merged_files(spark, sf):
    return E.merged_files(table(spark, sf, "sop_units"))


_PASSED = "coalesce(publication_status <> 'failed_review' AND struct_ok, false)"


@query(f"""WITH q AS (SELECT topic, count(*) AS extracted, count_if({_PASSED}) AS passed, count_if(NOT {_PASSED}) AS rejected, count_if(coalesce(needs_review, false)) AS needs_review FROM qa_units GROUP BY 1),
s AS (SELECT topic, count(*) AS sop_count FROM sop_units GROUP BY 1)
SELECT topic, coalesce(extracted, 0) AS extracted, coalesce(passed, 0) AS passed, coalesce(rejected, 0) AS rejected, coalesce(needs_review, 0) AS needs_review, coalesce(sop_count, 0) AS sop_count FROM q FULL JOIN s USING (topic)""")
def op_topic_counts(spark, sf):
    return U.topic_counts(table(spark, sf, "qa_units"), table(spark, sf, "sop_units"))


@query(f"SELECT count(DISTINCT qa_id) AS qa_units, count(*) AS qa_rows, count(DISTINCT {_MODULE}) AS modules FROM {_KEYS} WHERE {_GOOD}")
def op_export_stats(spark, sf):
    good = table(spark, sf, "qa_units").where(G.publishable(F.col("publication_status"), F.col("semantic_ok")))
    counted = good.select(F.size(X.query_keys("query", "paraphrases")).alias("n"), U.module_of(F.col("sources")).alias("module")).where("n > 0")
    return counted.agg(F.count("*").alias("qa_units"), F.coalesce(F.sum("n"), F.lit(0)).alias("qa_rows"), F.count_distinct("module").alias("modules"))


@query(f"SELECT module, publication_status, unit_id, min(qa_id) AS qa_id FROM (SELECT *, {_MODULE} AS module FROM qa_units) GROUP BY 1, 2, 3")
def op_stored_units(spark, sf):
    named = table(spark, sf, "qa_units").select("qa_id", "publication_status", "unit_id", U.module_of(F.col("sources")).alias("module"))
    return U.first_of(named, ["module", "publication_status", "unit_id"], ["qa_id"])


@query(f"""SELECT qa_id, md5(coalesce(nullif(left(array_to_string(list_transform(list_filter(sources, lambda s: coalesce({_strip('s.source_excerpt')}, '') <> ''),
  lambda s: '[' || coalesce(nullif(s.heading_path, ''), s.doc_title, '') || ']' || chr(10) || s.source_excerpt), chr(10) || chr(10)), 12000), ''), '（原文缺失）')) AS digest FROM qa_units""")
def op_evidence(spark, sf):
    return table(spark, sf, "qa_units").select("qa_id", F.md5(F.encode(X.evidence(F.col("sources")), "UTF-8")).alias("digest"))


def _questions(spark, sf):
    return table(spark, sf, "qa_units").withColumn("ord", F.col("qa_id"))


@query()
def op_query_groups(spark, sf):
    """Greedy clusters of like queries within a module."""
    return U.query_groups(_questions(spark, sf).select("ord", "query", "sources"))


@query()
def op_dedup_questions(spark, sf):
    return U.dedup_questions(_questions(spark, sf))


@query()
def op_batches(spark, sf):
    """Sections packed in order into batches of at most 25 and 18,000 characters, within their topic."""
    rows = table(spark, sf, "sections").select("topic", "section_id", F.char_length("body").alias("chars"))
    return U.batches(rows, "topic", ["section_id"], F.col("chars"), 25, 18000)


@query()
def op_masked(spark, sf):
    return table(spark, sf, "sections").select("section_id", X.mask("body").alias("masked"))


@query()
def op_redactions(spark, sf):
    return E.redactions(table(spark, sf, "sections"), "body")


@query()
def op_model_answers(spark, sf):
    """Canonical JSON of what a model's answer holds, here in documents."""
    return table(spark, sf, "documents").select("doc_id", X.json_array("text").alias("array"), X.json_object("text").alias("object"))


# --- State ---


@query(f"SELECT topic, state_seq, status, source_sha FROM {_LATEST}")
def op_manifest(spark, sf):
    return C.manifest(table(spark, sf, "doc_states").select("topic", "updated_at", "state_seq", "status", "source_sha")).select("topic", "state_seq", "status", "source_sha")


@query(f"SELECT topic, CASE WHEN status = 'running' THEN 'interrupted' ELSE status END AS status, CASE WHEN status = 'running' THEN true ELSE retryable END AS retryable FROM {_LATEST}")
def op_recovered(spark, sf):
    return C.recovered(C.manifest(table(spark, sf, "doc_states").select("topic", "updated_at", "state_seq", "status", "retryable"))).select("topic", "status", "retryable")


@query(f"""WITH s AS (SELECT topic, source_sha FROM source_scans WHERE topic IS NOT NULL QUALIFY row_number() OVER (PARTITION BY topic ORDER BY observed_at DESC NULLS LAST, scan_id DESC NULLS LAST) = 1)
SELECT s.topic, CASE WHEN coalesce(m.preflight_status = 'excluded', false) OR coalesce(m.status = 'excluded', false) THEN 'excluded' WHEN m.status = 'awaiting_review' THEN 'awaiting' WHEN coalesce(m.pinned, false) THEN 'pinned'
  WHEN m.status = 'done' AND m.source_sha IS NOT DISTINCT FROM s.source_sha THEN 'unchanged' ELSE 'todo' END AS admission FROM s LEFT JOIN {_LATEST} m ON m.topic = s.topic""")
def op_admission(spark, sf):
    scans = table(spark, sf, "source_scans").where(F.col("topic").isNotNull()).select("topic", "observed_at", "scan_id", "source_sha")
    sources = incremental.newest(scans, ["topic"], ["observed_at", "scan_id"]).select("topic", "source_sha")
    states = table(spark, sf, "doc_states").select("topic", "updated_at", "state_seq", "status", "pinned", "source_sha", "pipeline_version", "decision_id", "preflight_status")
    return C.admission(sources, C.manifest(states)).select("topic", "admission")


@query(f"SELECT topic, status, error_code FROM {_LATEST} WHERE coalesce(retryable, false) AND status IN ('failed', 'interrupted', 'pending', 'partial')")
def op_retry_selection(spark, sf):
    return C.retry_selection(C.manifest(table(spark, sf, "doc_states").select("topic", "updated_at", "state_seq", "status", "retryable", "error_code")))


@query(f"SELECT coalesce(nullif(error_code, ''), 'unknown') AS error_code, count(*) AS topics FROM {_LATEST} WHERE status IN ('failed', 'interrupted', 'partial', 'awaiting_review') GROUP BY 1")
def op_failure_summary(spark, sf):
    return C.failure_summary(C.manifest(table(spark, sf, "doc_states").select("topic", "updated_at", "state_seq", "status", "error_code")))


@query(f"SELECT coalesce(preflight_status, 'none') AS preflight_status, count(*) AS topics FROM {_LATEST} GROUP BY 1")
def op_preflight_counts(spark, sf):
    return C.preflight_counts(C.manifest(table(spark, sf, "doc_states").select("topic", "updated_at", "state_seq", "preflight_status")))


@query("SELECT state_seq, row_number() OVER (PARTITION BY topic, current_stage ORDER BY state_seq) AS attempt FROM (SELECT DISTINCT state_seq, topic, current_stage FROM doc_states)")
def op_attempts(spark, sf):
    log = table(spark, sf, "doc_states").select("state_seq", "topic", "current_stage")
    return C.attempts(log, ["topic", "current_stage"], ["state_seq"]).select("state_seq", F.col("attempt").cast("long").alias("attempt"))


@query("SELECT topic, state_seq, error FROM (SELECT DISTINCT topic, state_seq, error FROM doc_states WHERE error IS NOT NULL) QUALIFY row_number() OVER (PARTITION BY topic ORDER BY state_seq DESC) = 1")
def op_last_errors(spark, sf):
    errors = table(spark, sf, "doc_states").where(F.col("error").isNotNull()).select("topic", "state_seq", "error")
    return incremental.newest(errors, ["topic"], ["state_seq"])


@query("SELECT DISTINCT state_seq, topic FROM doc_states WHERE error IS NOT NULL ORDER BY state_seq DESC LIMIT 50")
def op_recent_errors(spark, sf):
    """The last 50 errors: the report's size is the feature."""
    return C.last(table(spark, sf, "doc_states").where(F.col("error").isNotNull()).select("state_seq", "topic").distinct(), ["state_seq"], 50)


@query("""SELECT topic, current_stage AS stage, arg_max(status, state_seq) AS status, max(state_seq) AS seq FROM doc_states WHERE topic IS NOT NULL AND current_stage IS NOT NULL AND status <> 'concurrency' GROUP BY 1, 2""")
def op_latest_stages(spark, sf):
    states = table(spark, sf, "doc_states").where(F.col("status") != journal.HEARTBEAT)
    return journal.latest_stages(states.select(F.col("state_seq").alias("seq"), F.col("status").alias("kind"), "topic", F.col("current_stage").alias("stage"), "status"))


_TOPIC = "CASE WHEN par = '' THEN stem WHEN stem IN ('原始文档', 'index') THEN par ELSE par || '__' || stem END"


@query(rf"""WITH f AS (SELECT DISTINCT rel_path, regexp_replace(string_split(rel_path, '/')[-1], '(.)\.[^.]*$', '\1') AS stem, regexp_extract(rel_path, '(?:^|/)([^/]+)/[^/]+$', 1) AS par FROM source_scans WHERE rel_path IS NOT NULL),
t AS (SELECT *, {_TOPIC} AS topic FROM f)
SELECT rel_path, CASE WHEN count(*) OVER (PARTITION BY topic) > 1 THEN topic || '__' || substr(sha256(rel_path), 1, 8) ELSE topic END AS topic FROM t""")
def op_source_topics(spark, sf):
    return files.with_topics(table(spark, sf, "source_scans").where(F.col("rel_path").isNotNull()).select("rel_path").distinct())
