"""Stages over batches of rows: ask, parse, join back by id, ask again for what is missing, and remember answers."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.gates import qa_reasons, whitelisted
from millrace.functions.text import content_key, loads_tolerant
from millrace.model.client import BadOutput, Client, ModelError
from millrace.operators.units import batches
from millrace.session import cut

Factory = Callable[[], Client]
ROWS = "batch_key string, pos int, row string, truncated boolean, prompt_tokens long, completion_tokens long, model string, error string"


def ask(prompts: DataFrame, client: Factory, max_tokens: int = 4096, more_tokens: int = 12288) -> DataFrame:
    """A row for each object of the list that answers a prompt (batch_key, prompt), with its JSON; or one with the error.

    A truncated answer is asked for once more with ``more_tokens``. No error fails the task; prompts are asked where they lie.
    """

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = client()
        names = [c.split(" ")[0] for c in ROWS.split(", ")]
        for part in parts:
            out = []
            for key, prompt in zip(part["batch_key"], part["prompt"]):
                try:
                    a = model.complete(prompt, max_tokens)
                    if a.truncated:
                        a = model.complete(prompt, more_tokens)
                    found = loads_tolerant(a.text, list)
                    if found is None:
                        raise BadOutput("invalid json in the answer")
                    used = (a.truncated, a.prompt_tokens, a.completion_tokens, a.model, None)
                    told = [json.dumps(r, ensure_ascii=False) for r in found if isinstance(r, dict)] or [None]
                    # tokens are counted with the first row only, so that they can be summed
                    out.extend((key, i, r, *(used if i == 0 else (a.truncated, 0, 0, a.model, None))) for i, r in enumerate(told))
                except ModelError as e:
                    out.append((key, 0, None, False, 0, 0, "", str(e) or type(e).__name__))
            yield pd.DataFrame(out, columns=names)

    return prompts.select("batch_key", "prompt").mapInPandas(run, ROWS)


def joined_back(items: DataFrame, answers: DataFrame, fields: str, defaults: dict[str, object]) -> DataFrame:
    """``items`` (batch_key, id and others) with the fields of their answers: by integer id, the last of repeated ones, else the defaults."""
    told = answers.where(F.col("row").isNotNull()).select("batch_key", "pos", F.from_json("row", f"id string, {fields}").alias("r"))
    told = told.withColumn("id", F.expr("try_cast(r.id as bigint)")).where(F.col("id").isNotNull())
    last = told.groupBy("batch_key", "id").agg(F.max_by("r", "pos").alias("r"))
    names = [f.strip().split(" ")[0] for f in fields.split(",")]
    both = items.join(last, ["batch_key", "id"], "left")
    return both.select(*[F.col(c) for c in items.columns], F.col("r").isNotNull().alias("answered"), *[F.coalesce(F.col(f"r.{n}"), F.lit(defaults.get(n))).alias(n) for n in names])


def batched(items: DataFrame, group: str, order: list[str], text: Column, max_items: int, max_chars: int) -> DataFrame:
    """``items`` with ``batch_key`` and ``id`` (from 0 within the batch), packed in order under both limits."""
    packed = batches(items, group, order, F.char_length(text), max_items, max_chars)
    members = F.array_sort(F.collect_list(F.struct(*order)))
    by = packed.groupBy(group, "batch").agg(members.alias("_m")).select(group, "batch", F.posexplode("_m").alias("id", "_o"))
    ids = by.select(group, "batch", F.col("id").cast("long").alias("id"), *[F.col(f"_o.{o}").alias(o) for o in order])
    return packed.join(ids, [group, "batch", *order]).withColumn("batch_key", F.concat_ws("#", F.col(group), "batch")).drop("batch")


def prompts_of(items: DataFrame, head: str, text: Column) -> DataFrame:
    """batch_key, prompt: the head and a JSON object with id and text for each item of a batch."""
    one = F.struct("id", text.alias("text"))
    return items.groupBy("batch_key").agg(F.concat(F.lit(head + "\n"), F.to_json(F.array_sort(F.collect_list(one)))).alias("prompt"))


def stage(items: DataFrame, head: str, text: Column, fields: str, defaults: dict[str, object], client: Factory, repair: bool = True) -> tuple[DataFrame, DataFrame]:
    """Answered items and the log of all answers. With ``repair`` items without an answer are asked for once more."""
    answers = cut(ask(prompts_of(items, head, text), client), "answers")
    done = joined_back(items, answers, fields, defaults)
    if not repair:
        return done, answers
    done = cut(done, "stage")
    again = done.where(~F.col("answered")).select(*items.columns)
    more = cut(ask(prompts_of(again, head, text), client), "answers")
    return done.where("answered").unionByName(joined_back(again, more, fields, defaults)), answers.unionByName(more)


def usage(answers: DataFrame) -> DataFrame:
    """calls, prompt_tokens, completion_tokens, failed for each model."""
    calls = F.count_if(F.col("pos") == 0).alias("calls")
    return answers.groupBy("model").agg(calls, F.sum("prompt_tokens").alias("prompt_tokens"), F.sum("completion_tokens").alias("completion_tokens"), F.count_if(F.col("error").isNotNull()).alias("failed"))


def with_cache(prompts: DataFrame, cache: DataFrame | None, client: Factory, version: str) -> tuple[DataFrame, DataFrame]:
    """Answers for prompts, those in ``cache`` (key, batch_key and the answer's rows) not asked for; and the rows to add to it."""
    keyed = prompts.withColumn("key", content_key(F.lit(version), F.col("prompt")))
    if cache is None:
        fresh = keyed
    else:
        fresh = keyed.join(cache.select("key").distinct(), "key", "left_anti")
    asked = cut(ask(fresh, client).join(fresh.select("batch_key", "key"), "batch_key"), "asked")
    new = asked.where(F.col("error").isNull())
    if cache is None:
        return asked, new
    known = keyed.select("batch_key", "key").join(cache.drop("batch_key"), "key")
    return asked.unionByName(known), new


def reviewed(units: DataFrame, verdicts: DataFrame) -> DataFrame:
    """``units`` (key, query, answer, truncated, paraphrases) with semantic_ok, publication_status and the paraphrases that were echoed.

    ``verdicts`` has key, verdict (pass, revise, fail) and valid. Without a verdict a unit needs review and isn't approved.
    """
    both = units.join(verdicts, "key", "left")
    ok = F.when(F.col("verdict").isNull(), None).otherwise((F.col("verdict") == "pass") & (qa_reasons(F.col("query"), F.col("answer"), F.col("truncated")) == ""))
    kept = F.when(F.col("verdict").isNull(), F.col("paraphrases")).otherwise(whitelisted(F.col("paraphrases"), F.col("valid")))
    out = both.withColumn("paraphrases", kept).withColumn("semantic_ok", ok).withColumn("needs_review", ok.isNull())
    return out.withColumn("publication_status", F.when(F.col("semantic_ok"), "approved").when(F.col("semantic_ok").isNull(), "pending").otherwise("failed_review")).drop("verdict", "valid")


def review_rounds(units: DataFrame, review: Callable[[DataFrame], DataFrame], revise: Callable[[DataFrame], DataFrame], attempts: int = 2) -> DataFrame:
    """Review, revise what failed, and review that again, at most ``attempts`` times; what has no verdict isn't revised."""
    done = cut(review(units).withColumn("review_attempts", F.lit(0)), "reviewed")
    for n in range(1, attempts + 1):
        failed = done.where("publication_status = 'failed_review'")
        if failed.isEmpty():
            break
        again = review(revise(failed.select(*units.columns))).withColumn("review_attempts", F.lit(n))
        done = cut(done.where("publication_status <> 'failed_review'").unionByName(again), "reviewed")
    return done
