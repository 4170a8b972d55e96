"""State of documents as append-only logs: their newest view, recovery, admission, rollups and audit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.gates import failure_code, failure_stage, retryable
from millrace.functions.text import decision_key
from millrace.operators.incremental import newest

# States that a retry takes up, and those that count as failures.
RETRIED = ("failed", "interrupted", "pending", "partial")
FAILED = ("failed", "interrupted", "partial", "awaiting_review")


def manifest(states: DataFrame) -> DataFrame:
    """The newest state of every topic: by updated_at, equal times by state_seq. Rows delivered twice collapse."""
    return newest(states.where(F.col("topic").isNotNull()), ["topic"], ["updated_at", "state_seq"])


def recovered(view: DataFrame) -> DataFrame:
    """Topics that a died run left ``running`` are ``interrupted`` and may be retried."""
    died = F.coalesce(F.col("status") == "running", F.lit(False))
    return view.withColumn("retryable", F.when(died, True).otherwise(F.col("retryable"))).withColumn("status", F.when(died, "interrupted").otherwise(F.col("status")))


def coded(view: DataFrame) -> DataFrame:
    """error_code, retryable and current_stage of failed topics that lack a code, from the text of their error."""
    lacks = (F.coalesce("error", F.lit("")) != "") & (F.coalesce("error_code", F.lit("")) == "")
    code = F.when(lacks, failure_code(F.col("error"))).otherwise(F.col("error_code"))
    stage = F.when(lacks & (F.coalesce("current_stage", F.lit("")) == ""), failure_stage(F.col("error"))).otherwise(F.col("current_stage"))
    again = F.when(lacks, retryable(failure_code(F.col("error")))).otherwise(F.col("retryable"))
    return view.withColumns({"error_code": code, "current_stage": stage, "retryable": again})


def seeded(sources: DataFrame, view: DataFrame) -> DataFrame:
    """Every source topic with its state; a topic without one is ``new`` and not pinned."""
    known = view.select("topic", "status", "pinned", F.col("source_sha").alias("held_sha"), "pipeline_version", "decision_id", "preflight_status")
    both = sources.join(known, "topic", "left")
    return both.withColumn("status", F.coalesce("status", F.lit("new"))).withColumn("pinned", F.coalesce("pinned", F.lit(False)))


def admission(sources: DataFrame, view: DataFrame, version: str | None = None, force: bool = False) -> DataFrame:
    """``sources`` (topic, source_sha) with ``admission``: excluded, awaiting, pinned, unchanged or todo; the first that fits.

    With ``force`` unchanged topics are to do, pinned ones never are. ``version`` is the pipeline that a result must come from.
    """
    s = seeded(sources, view)
    same = (F.col("status") == "done") & F.col("held_sha").eqNullSafe(F.col("source_sha"))
    if version is not None:
        same = same & F.col("pipeline_version").eqNullSafe(F.lit(version))
    told = F.when(F.coalesce(F.col("preflight_status") == "excluded", F.lit(False)) | (F.col("status") == "excluded"), "excluded").when(F.col("status") == "awaiting_review", "awaiting").when(F.col("pinned"), "pinned")
    return s.withColumn("admission", (told if force else told.when(same, "unchanged")).otherwise("todo"))


def retry_selection(view: DataFrame) -> DataFrame:
    return view.where(F.coalesce("retryable", F.lit(False)) & F.col("status").isin(*RETRIED)).select("topic", "status", "error_code")


def failure_summary(view: DataFrame) -> DataFrame:
    """error_code, topics of failed topics; a missing code is ``unknown``."""
    code = F.coalesce(F.when(F.col("error_code") != "", F.col("error_code")), F.lit("unknown")).alias("error_code")
    return view.where(F.col("status").isin(*FAILED)).groupBy(code).agg(F.count("*").alias("topics"))


def preflight_counts(view: DataFrame) -> DataFrame:
    return view.groupBy(F.coalesce("preflight_status", F.lit("none")).alias("preflight_status")).agg(F.count("*").alias("topics"))


def attempts(log: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """``log`` with ``attempt``: the number of an entry among those of its keys, from 1. Rows delivered twice count once."""
    return log.dropDuplicates().withColumn("attempt", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def proposals(view: DataFrame, stage: str) -> DataFrame:
    """decision_id, topic, reason of the topics that wait for a person; the id is a hash, so proposing twice makes one."""
    waiting = view.where(F.col("status") == "awaiting_review")
    return waiting.select(decision_key(F.lit(stage), F.col("topic")).alias("decision_id"), "topic", F.coalesce("error", F.lit("")).alias("reason"))


def pending_first(status: Column) -> list[Column]:
    """The order of decisions: pending ones first."""
    return [(F.coalesce(status, F.lit("")) != "pending").asc()]


def last(log: DataFrame, order: list[str], n: int) -> DataFrame:
    """The newest ``n`` rows, newest first; a top-n of every partition is merged, nothing else is sorted."""
    return log.orderBy(*[F.col(o).desc() for o in order]).limit(n)


def last_good(previous: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of ``new``, and those of ``previous`` whose key has none: a failed retry doesn't erase the last good result."""
    return new.unionByName(previous.join(new.select(*keys).distinct(), keys, "left_anti"))
