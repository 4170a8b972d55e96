"""What users get: CSV of questions, Markdown of procedures, provenance lines, redactions, and an archive of them."""

from __future__ import annotations

import json
import os
import shutil
import zipfile

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.gates import publishable, without_excerpts
from millrace.functions.text import demoted, inject_questions, masked_values, query_keys, safe_name, section_key, tokens
from millrace.operators.units import by_sid, merge_plan, module_of
from millrace.sources.files import numbered

BOM = "﻿"


def qa_rows(qa: DataFrame) -> DataFrame:
    """query, answer, module of publishable units, a row for each of their keys."""
    good = qa.where(publishable(F.col("publication_status"), F.col("semantic_ok")))
    return good.select(F.explode(query_keys("query", "paraphrases")).alias("query"), "answer", module_of(F.col("sources")).alias("module"))


def sop_files(sop: DataFrame, order: list[str]) -> DataFrame:
    """name, body of publishable procedures: ``module__key[-n].md``, with their entry questions."""
    good = sop.where(publishable(F.col("publication_status"), F.col("semantic_ok")) & F.coalesce("struct_ok", F.lit(False)))
    module = F.coalesce(F.try_element_at("sources", F.lit(1))["topic"], F.lit("_unknown"))
    named = good.withColumn("_stem", F.concat(safe_name(module), F.lit("__"), section_key(F.coalesce("title", F.lit("")))))
    told = numbered(named, "_stem", order, "_name")
    return told.select(F.concat("_name", F.lit(".md")).alias("name"), F.concat(inject_questions(F.coalesce("markdown", F.lit("")), F.col("entry_questions")), F.lit("\n")).alias("body"))


def merged_files(sop: DataFrame) -> DataFrame:
    """name, units, body: publishable procedures of a group in the order of their sections, headings one level deeper."""
    good = sop.where(publishable(F.col("publication_status"), F.col("semantic_ok")) & F.coalesce("struct_ok", F.lit(False)))
    one = F.struct(by_sid(F.col("sources")).alias("at"), F.col("sop_id").alias("id"), demoted(F.coalesce("markdown", F.lit(""))).alias("body"))
    by = merge_plan(good).groupBy("group_key", "label").agg(F.array_sort(F.collect_list(one)).alias("m"))
    body = F.concat(F.lit("# "), F.col("label"), F.lit("\n\n"), F.array_join(F.transform("m", lambda x: x["body"]), "\n\n"), F.lit("\n"))
    return by.select(F.concat(safe_name("group_key", 100), F.lit(".md")).alias("name"), F.size("m").alias("units"), body.alias("body"))


def metadata_lines(qa: DataFrame) -> DataFrame:
    """value: a line of JSON for each unit, with its sources but for their excerpts."""
    return qa.select(F.to_json(F.struct("unit_id", "query", "topic", without_excerpts(F.col("sources")).alias("sources"))).alias("value"))


def redactions(texts: DataFrame, text: str) -> DataFrame:
    """token, value, values: the map of all masked values; ``values`` above 1 tells a collision of tokens."""
    pairs = texts.select(F.explode(masked_values(text)).alias("p")).select("p.*").distinct()
    return pairs.groupBy("token").agg(F.min("value").alias("value"), F.count("*").alias("values"))


def unresolved_tokens(texts: DataFrame, text: str, known: DataFrame) -> DataFrame:
    """Tokens of the texts that ``known`` (token) doesn't hold; an export with any is refused before it overwrites."""
    return texts.select(F.explode(tokens(text)).alias("token")).distinct().join(known.select("token"), "token", "left_anti")


def write_csv(rows: DataFrame, folder: str) -> None:
    """All fields quoted, quotes doubled, by module; parts have no mark, ``archive`` puts it before the one file it makes."""
    rows.select(F.col("query").alias("Query"), F.col("answer").alias("Answer"), F.col("module").alias("Module"), safe_name(F.when(F.col("module") == "", "_unknown").otherwise(F.col("module"))).alias("part")).write.mode(
        "overwrite"
    ).partitionBy("part").option("quoteAll", True).option("escape", '"').option("header", True).csv(folder)


def write_files(files: DataFrame, folder: str) -> int:
    """Write name and body as files below ``folder``, which all workers share; what was there is replaced. Returns their number."""
    shutil.rmtree(folder, ignore_errors=True)
    os.makedirs(folder)

    def run(batches):
        for b in batches:
            for name, body in zip(b["name"], b["body"]):
                temp = os.path.join(folder, f".{name}.{os.getpid()}")
                with open(temp, "w", encoding="utf-8", newline="") as f:
                    f.write(body)
                os.replace(temp, os.path.join(folder, name))  # a task that runs twice writes the same file
            yield b[["name"]]

    return files.select("name", "body").mapInPandas(run, "name string").count()


def export(qa: DataFrame, sop: DataFrame, known: DataFrame, folder: str, order: list[str]) -> dict[str, int]:
    """Write qa.csv, sop files, metadata and the redactions below ``folder``; refused before anything is written if a token has no value."""
    rows, files = qa_rows(qa), sop_files(sop, order)
    open_ = unresolved_tokens(rows.select(F.col("answer").alias("t")).unionByName(files.select(F.col("body").alias("t"))), "t", known)
    lost = [r[0] for r in open_.orderBy("token").limit(10).collect()]
    if lost:
        raise ValueError(f"tokens without a value: {', '.join(lost)}")
    os.makedirs(folder, exist_ok=True)
    write_csv(rows, f"file://{folder}/qa")
    metadata_lines(qa).write.mode("overwrite").text(f"file://{folder}/metadata")
    known.write.mode("overwrite").json(f"file://{folder}/redactions")
    return {"qa_rows": rows.count(), "sop_files": write_files(files, f"{folder}/sop")}


def archive(folder: str, target: str) -> int:
    """A ZIP of the exported files, in order of their names, hidden ones left out; CSV parts get their mark. Returns their number."""
    temp = f"{target}.{os.getpid()}"
    n = 0
    with zipfile.ZipFile(temp, "w", zipfile.ZIP_DEFLATED) as z:
        for here, folders, names in os.walk(folder):
            folders[:] = sorted(f for f in folders if not f.startswith("."))
            for name in sorted(x for x in names if not x.startswith((".", "_"))):
                path = os.path.join(here, name)
                with open(path, "rb") as f, z.open(os.path.relpath(path, folder), "w") as out:
                    if name.endswith(".csv"):
                        out.write(BOM.encode())
                    shutil.copyfileobj(f, out)
                n += 1
    os.replace(temp, target)
    return n


def split_results(units: DataFrame, verdict: Column) -> dict[str, DataFrame]:
    """Units by verdict: active, quarantine, invalid."""
    told = units.withColumn("_verdict", verdict)
    return {v: told.where(F.col("_verdict") == v).drop("_verdict") for v in ("active", "quarantine", "invalid")}


def rehydrated(texts: DataFrame, column: str = "value") -> tuple[DataFrame, DataFrame]:
    """Question and procedure units out of stored JSON ``{"qa": […], "sop": […]}``, missing fields filled in."""
    source = "array<struct<topic:string,doc_title:string,heading_path:string,section_sid:string,source_sha:string>>"
    q = f"array<struct<query:string,answer:string,paraphrases:array<string>,sources:{source},semantic_ok:boolean,publication_status:string,needs_review:boolean>>"
    s = f"array<struct<title:string,markdown:string,entry_questions:array<string>,sources:{source},struct_ok:boolean,semantic_ok:boolean,publication_status:string,needs_review:boolean>>"
    told = texts.select(F.from_json(column, f"qa {q}, sop {s}").alias("r"))
    none = F.array().cast("array<string>")
    qa = told.select(F.inline("r.qa")).withColumns({"semantic_ok": F.coalesce("semantic_ok", F.lit(True)), "publication_status": F.coalesce("publication_status", F.lit("approved")), "paraphrases": F.coalesce("paraphrases", none)})
    sop = told.select(F.inline("r.sop")).withColumns({"publication_status": F.coalesce("publication_status", F.lit("pending")), "entry_questions": F.coalesce("entry_questions", none), "struct_ok": F.coalesce("struct_ok", F.lit(True))})
    return qa, sop


def results_json(qa: DataFrame, sop: DataFrame) -> DataFrame:
    """value: a line of JSON for each unit, with its kind."""
    return qa.select(F.to_json(F.struct(F.lit("qa").alias("kind"), "*")).alias("value")).unionByName(sop.select(F.to_json(F.struct(F.lit("sop").alias("kind"), "*")).alias("value")))


def redaction_file(known: DataFrame, path: str) -> None:
    """The map of a run as one private JSON file. It is written line by line, never held as a whole."""
    fd = os.open(path, os.O_WRONLY | os.O_CREAT | os.O_TRUNC, 0o600)
    with os.fdopen(fd, "w", encoding="utf-8") as f:
        f.write("{")
        for i, r in enumerate(known.select("token", "value").orderBy("token").toLocalIterator()):
            f.write(f"{',' if i else ''}\n{json.dumps(r['token'], ensure_ascii=False)}: {json.dumps(r['value'], ensure_ascii=False)}")
        f.write("\n}\n")
