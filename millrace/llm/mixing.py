"""A mix of documents by source: whole passes over a source, then a weighted sample by Efraimidis and Spirakis.

A source gets tokens in proportion to its target share, as many as the scarcest source allows. Its quota is filled by
whole passes over its records and, for the rest, by the records of the least exponential key ``-ln(u) / w``, where u is a
hash of the record and w its quality: the share of letters, digits and blanks of its text, over the number of records with
that text. Running sums are taken within ranges of the key, so no task holds a source: ranges are STEPS to a factor of two,
which parts keys of any weight finely, and the sums of whole ranges are added up first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.tokens import with_ids
from millrace.session import cut, spread, table

STEPS, SEED = 256, 9


def mixed(spark: SparkSession, counted: DataFrame, targets: DataFrame) -> DataFrame:
    """doc_id, source, tokens, times of the chosen records. ``counted`` has doc_id, source, tokens (over 0), weight (0 to 1).

    Only sources with a target share and a number of repeats above 0 and with documents are mixed; a null source is none.
    Without any the result is empty. Equal keys are taken by doc_id. The driver gets a row for each target.
    """
    have = counted.groupBy("source").agg(F.sum("tokens").alias("available"))
    goal = targets.where("target_share > 0 and max_repeats > 0").join(have, "source").toPandas()  # a row for each target
    if goal.empty:
        return counted.select("doc_id", "source", "tokens", F.lit(0).alias("times")).limit(0)
    total = (goal.available * goal.max_repeats / goal.target_share).min()
    goal["quota"] = (total * goal.target_share).clip(upper=(goal.available * goal.max_repeats).astype(float))
    goal["passes"] = (goal.quota / goal.available + 1e-12).astype(int).clip(upper=goal.max_repeats)
    goal["rest"] = (goal.quota - goal.passes * goal.available).clip(lower=0.0)
    quotas = F.broadcast(spark.createDataFrame(goal[["source", "passes", "rest", "max_repeats"]].values.tolist(), "source string, passes int, rest double, max_repeats int"))
    u = (F.pmod(F.xxhash64(F.lit(SEED), "doc_id"), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    keyed = counted.withColumn("key", -F.log(u) / F.greatest("weight", F.lit(1e-12)))
    keyed = keyed.withColumn("range", F.floor(F.log2("key") * STEPS).cast("int"))
    sums = keyed.groupBy("source", "range").agg(F.sum("tokens").alias("t"))  # keys span few factors of two: some STEPS * 100 rows a source at most
    below = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    before = F.broadcast(sums.select("source", "range", F.coalesce(F.sum("t").over(below), F.lit(0)).alias("before")))
    within = Window.partitionBy("source", "range").orderBy("key", "doc_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = keyed.join(before, ["source", "range"]).withColumn("upto", F.col("before") + F.sum("tokens").over(within)).join(quotas, "source")
    # a record is taken if the sum comes nearer the quota with it, hence if at least its half is within
    extra = ((F.col("upto") - F.col("tokens") / 2 <= F.col("rest")) & (F.col("passes") < F.col("max_repeats"))).cast("int")
    return ranked.withColumn("times", F.col("passes") + extra).where("times > 0").select("doc_id", "source", "tokens", "times")


def quality(text: str):
    """The share of letters, digits and blanks of a text, a column; at least 0.05, and 0.05 for a text without characters."""
    odd = F.length(F.regexp_replace(text, r"[\p{L}\p{N}\s]+", ""))
    return F.greatest(F.lit(0.05), F.coalesce(F.try_divide(F.length(text) - odd, F.length(text)), F.lit(0.0)))


def _chosen(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    targets = table(spark, sf_dir, "mix_targets")
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "source", "text")).join(F.broadcast(targets.where("target_share > 0").select("source")), "source", "left_semi")
    counts = with_ids(docs.select("doc_id", "source", "text", F.xxhash64("text").alias("same"), quality("text").alias("quality")), "text", "tokens", count_only=True)
    stored = cut(counts.where("tokens > 0"), "tokens")
    copies = stored.groupBy("source", "same", "tokens").agg(F.count("*").alias("n")).where("n > 1")
    counted = stored.join(copies, ["source", "same", "tokens"], "left").select("doc_id", "source", "tokens", (F.col("quality") / F.coalesce("n", F.lit(1))).alias("weight"))
    return mixed(spark, counted, targets), targets


def p9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, source, tokens, times, and source_share and target_share of the record's source in the whole mix."""
    chosen, targets = _chosen(spark, sf_dir)
    chosen = cut(chosen, "mix")
    shares = _shares(chosen, targets)
    return chosen.join(F.broadcast(shares.select("source", "actual_share", "target_share")), "source").select("doc_id", "source", "tokens", "times", "actual_share", "target_share")


def _shares(chosen: DataFrame, targets: DataFrame) -> DataFrame:
    by = chosen.groupBy("source").agg(F.count("*").alias("records"), F.sum(F.col("tokens") * F.col("times")).alias("mix_tokens"), F.max("times").alias("most_times"))
    by = targets.join(by, "source", "left").fillna(0, ["records", "mix_tokens", "most_times"])
    return by.withColumn("actual_share", F.coalesce(F.col("mix_tokens") / F.sum("mix_tokens").over(Window.partitionBy()), F.lit(0.0)))


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each target: the records, tokens and share that its source has in the mix."""
    chosen, targets = _chosen(spark, sf_dir)
    return _shares(chosen, targets).select("source", "target_share", "max_repeats", "records", "mix_tokens", "most_times", "actual_share")
