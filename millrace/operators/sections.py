"""Documents to sections: a parser for fenced Markdown, its splitter, and what is built from sections."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import best_text, mask, stripped

# The patterns of headings, fences, images and OCR marks, and the sign of a preamble beside headings.
HEADING, FENCE = re.compile(r"^(#{1,6})\s+(.*\S)\s*$"), re.compile(r"^\s*(`{3,}|~{3,})")
IMAGE, OCR = re.compile(r"!\[[^\]]*\]\(([^)]+)\)"), re.compile(r"<!--\s*ocr-source:\s*(.+?)\s*-->")
PREAMBLE, IMAGE_MARK, LIMIT, EXCERPT = "（前言）", "图片", 14000, 16000
_ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"))

SECTION = "sid string, parent_sid string, pos int, level int, title string, heading_path array<string>, full_title string, body string, images array<struct<rel_path:string,inline_ocr:string>>"


@dataclass
class _Node:
    level: int
    title: str
    sid: str
    path: list[str]
    parent: str | None
    lines: list[str] = field(default_factory=list)
    images: list[dict] = field(default_factory=list)
    children: int = 0

    def row(self, pos: int) -> tuple:
        return self.sid, self.parent, pos, self.level, self.title, self.path, " / ".join([*self.path, self.title]), "\n".join(self.lines).strip("\n"), self.images


def _ocr_block(lines: list[str]) -> str:
    """Takes the lines of an OCR block off ``lines`` (a reversed list), up to its ``</details>``; gives the text in ``<pre>``.

    What follows ``</details>`` in its line goes back to ``lines``; a block that isn't closed takes all that is left.
    """
    text, inside = [], False
    while lines:
        line = lines.pop()
        while line is not None:
            mark = re.search(r"</pre>" if inside else r"<pre[^>]*>|</details>", line, re.I)
            if mark is None:
                if inside:
                    text.append(line)
                break
            if inside:
                text.append(line[: mark.start()])
            elif mark[0].lower() == "</details>":
                if line[mark.end() :].strip():
                    lines.append(line[mark.end() :])
                lines_of = "\n".join(text)
                for name, sign in _ENTITIES:
                    lines_of = lines_of.replace(name, sign)
                return lines_of.strip()
            inside = not inside
            line = line[mark.end() :] or None
    lines_of = "\n".join(text)
    for name, sign in _ENTITIES:
        lines_of = lines_of.replace(name, sign)
    return lines_of.strip()


def parse(text: str | None, stem: str) -> list[tuple]:
    """The sections of a Markdown text in document order, each a SECTION.

    Headings and images count outside fences only; a fence is closed by any line that begins with its sign. Ids are dotted
    positions under the parent. Text before the first heading is a section ``0``, titled by ``stem``.
    """
    root = _Node(0, "", "", [], None)
    stack, nodes = [root], []
    lines = (text or "").splitlines()[::-1]
    fence = ""
    while lines:
        line = lines.pop()
        at = stack[-1]
        mark = FENCE.match(line)
        if mark or fence:
            if mark and not fence:
                fence = mark[1][:3]
            elif mark and line.strip().startswith(fence):
                fence = ""
            at.lines.append(line)
            continue
        if found := OCR.search(line):
            path, told = found[1].strip(), _ocr_block(lines)
            same = [i for i in at.images if i["rel_path"].endswith(path) or path.endswith(i["rel_path"])]
            for image in (same or at.images)[-1:]:
                image["inline_ocr"] = told
            continue
        if head := HEADING.match(line):
            level = len(head[1])
            while stack[-1].level >= level:
                stack.pop()
            parent = stack[-1]
            parent.children += 1
            sid = f"{parent.sid}.{parent.children}" if parent.sid else str(parent.children)
            node = _Node(level, head[2].strip(), sid, [*parent.path, parent.title] if parent.level else [], parent.sid or None)
            nodes.append(node)
            stack.append(node)
            continue
        at.images.extend({"rel_path": p.strip(), "inline_ocr": ""} for p in IMAGE.findall(line))
        at.lines.append(line)
    if "".join(root.lines).strip() or root.images:
        nodes.insert(0, _Node(1, f"{stem}{PREAMBLE}" if nodes else stem, "0", [], None, root.lines, root.images))
    return [n.row(i) for i, n in enumerate(nodes)]


def sections_of(documents: DataFrame, key: str, text: str, stem: Column | str) -> DataFrame:
    """``key`` and the SECTION columns for every section of every document; a null or empty text has none. No shuffle."""
    kind = documents.schema[key].dataType.simpleString()
    names = [c.split(" ")[0] for c in SECTION.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(k, *s) for k, t, n in zip(b["_key"], b["_text"], b["_stem"]) for s in parse(t, n or "")]
            yield pd.DataFrame(rows, columns=[key, *names])

    stem = F.col(stem) if isinstance(stem, str) else stem
    return documents.select(F.col(key).alias("_key"), F.col(text).cast("string").alias("_text"), stem.cast("string").alias("_stem")).mapInPandas(run, f"`{key}` {kind}, {SECTION}")


def document_titles(sections: DataFrame, key: str) -> DataFrame:
    """``key``, doc_title: the first level-1 heading that is no preamble, else the first section's title."""
    first = F.min_by("title", F.when((F.col("level") == 1) & (F.col("sid") != "0"), F.col("pos")))
    return sections.groupBy(key).agg(F.coalesce(first, F.min_by("title", "pos")).alias("doc_title"))


def worth_reading(body: Column, images: Column | None = None) -> Column:
    has = F.coalesce(stripped(body) != "", F.lit(False))
    return has if images is None else has | (F.coalesce(F.size(images), F.lit(0)) > 0)


def chunks(text: str, limit: int) -> list[str]:
    """Paragraphs packed into chunks of at most ``limit`` characters; blank lines inside a fence part none, and one that is longer stays whole."""
    blocks: list[list[str]] = [[]]
    inside = False
    for line in text.splitlines():
        inside ^= line.lstrip().startswith(("```", "~~~"))
        if not line.strip() and not inside and blocks[-1]:
            blocks.append([])
        else:
            blocks[-1].append(line)
    out: list[list[str]] = []
    size = 0
    for block in ("\n".join(b).strip() for b in blocks if b):
        if out and size + 2 + len(block) <= limit:
            out[-1].append(block)
            size += 2 + len(block)
        else:
            out.append([block])
            size = len(block)
    return ["\n\n".join(c) for c in out] or [text]


def split_oversize(sections: DataFrame, limit: int = LIMIT) -> DataFrame:
    """``sections`` (title, body, sid and any others) with those longer than ``limit`` replaced by their parts.

    A part has the title ``title（i/n）`` and the sid ``sid.parti``; images, where there is such a column, stay with the first.
    Sections that fit pass by without Python.
    """
    long = F.coalesce(F.char_length("body") > limit, F.lit(False))

    @F.pandas_udf("array<string>")
    def cut_up(bodies: pd.Series) -> pd.Series:
        return bodies.map(lambda b: chunks(b, limit))

    parts = sections.where(long).withColumn("_all", cut_up("body"))
    parts = parts.select(*[F.col(c) for c in sections.columns], F.size("_all").alias("_n"), F.posexplode("_all").alias("_i", "_part"))
    i = F.col("_i") + 1
    made = {"title": F.concat(F.col("title"), F.lit("（"), i, F.lit("/"), F.col("_n"), F.lit("）")), "sid": F.concat("sid", F.lit(".part"), i), "body": F.col("_part")}
    if "images" in sections.columns:
        made["images"] = F.when(i == 1, F.col("images")).otherwise(F.array().cast(sections.schema["images"].dataType))
    return sections.where(~long).unionByName(parts.select(*[made.get(c, F.col(c)).alias(c) for c in sections.columns]))


def image_texts(images: DataFrame) -> DataFrame:
    """topic, section_sid, texts: the best text of each image of a section that has one, under a mark with its path, by image_id."""
    told = images.select("topic", "section_sid", "image_id", "rel_path", best_text("vision_text", "inline_ocr").alias("t")).where("t <> ''")
    one = F.struct("image_id", F.concat(F.lit(f"[{IMAGE_MARK} "), F.coalesce("rel_path", F.lit("")), F.lit("]\n"), F.col("t")).alias("text"))
    return told.groupBy("topic", "section_sid").agg(F.array_join(F.transform(F.array_sort(F.collect_list(one)), lambda x: x["text"]), "\n\n").alias("texts"))


def section_content(sections: DataFrame, images: DataFrame) -> DataFrame:
    """``sections`` with ``content``: the body, then the texts of the images of the section, parted by blank lines."""
    both = sections.join(image_texts(images).withColumnRenamed("section_sid", "sid"), ["topic", "sid"], "left")
    return both.withColumn("content", F.concat_ws("\n\n", F.when(F.coalesce("body", F.lit("")) != "", F.col("body")), F.col("texts"))).drop("texts")


def provenance(topic: Column, doc_title: Column, heading_path: Column, sid: Column, sha: Column, content: Column) -> Column:
    """Where a unit comes from, with the masked text it was made of, cut to EXCERPT characters."""
    return F.struct(topic.alias("topic"), doc_title.alias("doc_title"), heading_path.alias("heading_path"), sid.alias("section_sid"), sha.alias("source_sha"), F.substring(mask(content), 1, EXCERPT).alias("source_excerpt"))


def coverage_gaps(sections: DataFrame, units: DataFrame) -> DataFrame:
    """topic, sid of the sections with text for which no sound unit names the section as its source.

    ``units`` has struct_ok and sources. An anti-join on (topic, sid), so a topic with a third of all sections is spread.
    """
    covered = units.where("struct_ok").select(F.explode("sources").alias("s")).select(F.col("s.topic").alias("topic"), F.col("s.section_sid").alias("sid")).distinct()
    return sections.where(worth_reading(F.col("body"))).select("topic", "sid").distinct().join(covered, ["topic", "sid"], "left_anti")
