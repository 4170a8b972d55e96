"""Source files to texts: discovery, topics, bundle hashes, and conversion of each format to Markdown."""

from __future__ import annotations

import hashlib
import html
import io
import os
import re
import zipfile
from collections.abc import Iterator
from html.parser import HTMLParser
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Extensions that are read, those of images and their media types, stems named by their folder, and the namespace of DOCX.
EXTENSIONS = ("md", "markdown", "txt", "html", "htm", "docx", "pdf")
MEDIA = {"png": "image/png", "jpg": "image/jpeg", "jpeg": "image/jpeg", "gif": "image/gif", "webp": "image/webp"}
FOLDER_STEMS = ("原始文档", "index")
_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
_FILES = "rel_path string, path string, ext string, size_bytes long"


def topic_of(rel_path: Column) -> Column:
    """``parent__stem``; the stem alone at the root, the parent alone for a stem that says nothing."""
    name = F.element_at(F.split(rel_path, "/"), -1)
    stem, parent = F.regexp_replace(name, r"(?<=.)\.[^.]*$", ""), F.regexp_extract(rel_path, r"(?:^|/)([^/]+)/[^/]+$", 1)
    return F.when(parent == "", stem).when(stem.isin(*FOLDER_STEMS), parent).otherwise(F.concat(parent, F.lit("__"), stem))


def with_topics(files: DataFrame) -> DataFrame:
    """``files`` with ``topic``; topics that several files share get a piece of the hash of their path. Counts are joined, so no window holds a topic."""
    named = files.withColumn("topic", topic_of(F.col("rel_path")))
    shared = named.groupBy("topic").agg(F.count("*").alias("_n")).where("_n > 1")
    told = named.join(shared, "topic", "left")
    return told.withColumn("topic", F.when(F.col("_n").isNull(), F.col("topic")).otherwise(F.concat("topic", F.lit("__"), F.substring(F.sha2("rel_path", 256), 1, 8)))).drop("_n")


def _walk(folder: str, top: str, extensions: tuple[str, ...]) -> Iterator[tuple[str, str, str, int]]:
    for here, folders, names in os.walk(folder):
        folders[:] = sorted(f for f in folders if not f.startswith("."))
        for n in sorted(names):
            path = os.path.join(here, n)
            ext = os.path.splitext(n)[1].lower().lstrip(".")
            if not n.startswith(".") and ext in extensions and os.path.isfile(path):
                yield os.path.relpath(path, top).replace(os.sep, "/"), path, ext, os.path.getsize(path)


def discover(spark: SparkSession, folder: str, extensions: tuple[str, ...] = EXTENSIONS) -> DataFrame:
    """rel_path, path, ext, size_bytes of the files below ``folder``, hidden files and folders left out; none if it is missing.

    The folder is listed by the workers, one task for each of its entries, and must be mounted on all of them.
    """
    top = os.path.abspath(folder)
    entries = sorted(e for e in os.listdir(top) if not e.startswith(".")) if os.path.isdir(top) else []
    if not entries:
        return spark.createDataFrame([], _FILES)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = []
            for e in b["entry"]:
                path = os.path.join(top, e)
                if os.path.isdir(path):
                    found.extend(_walk(path, top, extensions))
                elif (ext := os.path.splitext(e)[1].lower().lstrip(".")) in extensions:
                    found.append((e, path, ext, os.path.getsize(path)))
            yield pd.DataFrame(found, columns=["rel_path", "path", "ext", "size_bytes"])

    tasks = min(len(entries), 4 * spark.sparkContext.defaultParallelism)
    return spark.createDataFrame([(e,) for e in entries], "entry string").repartition(tasks, "entry").mapInPandas(run, _FILES)


def decoded(raw: bytes) -> str:
    """UTF-8 with or without its mark, else GB 18030, else UTF-8 with the wrong bytes replaced."""
    for name in ("utf-8-sig", "gb18030"):
        try:
            return raw.decode(name)
        except UnicodeDecodeError:
            pass
    return raw.decode("utf-8", "replace")


class _Markdown(HTMLParser):
    """Blocks of a page as Markdown lines: headings, fences, list items, cells parted by bars."""

    ENDS = frozenset(("p", "div", "section", "article", "tr"))

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks: list[str] = []
        self.text: list[str] = []
        self.code, self.depth, self.level = False, 0, 0

    def close_block(self, mark: str = "") -> None:
        told, self.text = html.unescape("".join(self.text)).strip(), []
        if told:
            self.blocks.append(mark + re.sub(r"[ \t]+", " ", told))

    def fence(self, opened: bool) -> None:
        self.close_block()
        self.blocks.append("```")
        self.code = opened

    def handle_starttag(self, tag, attrs):
        if re.fullmatch("h[1-6]", tag):
            self.close_block()
            self.level = int(tag[1])
        elif tag == "pre":
            self.fence(True)
        elif tag == "li":
            self.close_block()
        elif tag == "br":
            self.text.append("\n")
        self.depth += tag in ("ul", "ol")

    def handle_endtag(self, tag):
        if re.fullmatch("h[1-6]", tag):
            self.close_block("#" * self.level + " ")
            self.level = 0
        elif tag == "pre":
            self.fence(False)
        elif tag == "li":
            self.close_block("  " * max(0, self.depth - 1) + "- ")
        elif tag in self.ENDS:
            self.close_block()
        elif tag in ("td", "th"):
            self.text.append(" | ")
        if tag in ("ul", "ol"):
            self.depth = max(0, self.depth - 1)

    def handle_data(self, data):
        self.text.append(data if self.code else re.sub(r"\s+", " ", data))


def html_to_markdown(text: str) -> str:
    page = _Markdown()
    page.feed(text)
    page.close()
    page.close_block()
    return "\n\n".join(b for b in page.blocks if b.strip()).strip()


def docx_to_markdown(raw: bytes) -> str:
    """Paragraphs, headings by their style, and table rows between bars; an error where there is no text."""
    try:
        with zipfile.ZipFile(io.BytesIO(raw)) as archive:
            body = ElementTree.fromstring(archive.read("word/document.xml")).find(f"{_W}body")
    except (zipfile.BadZipFile, KeyError, ElementTree.ParseError) as e:
        raise ValueError("invalid DOCX") from e
    told = lambda node: "".join(t.text or "" for t in node.iter(f"{_W}t")).strip()
    blocks = []
    for node in body if body is not None else ():
        if node.tag == f"{_W}p" and told(node):
            style = node.find(f"{_W}pPr/{_W}pStyle")
            level = re.search(r"(?:Heading|标题)\s*([1-6])", style.get(f"{_W}val", "") if style is not None else "", re.I)
            blocks.append(("#" * int(level[1]) + " " if level else "") + told(node))
        elif node.tag == f"{_W}tbl":
            rows = ([told(c) for c in row.findall(f"{_W}tc")] for row in node.findall(f"{_W}tr"))
            blocks.extend(f"| {' | '.join(cells)} |" for cells in rows if any(cells))
    if not blocks:
        raise ValueError("DOCX contains no readable text")
    return "\n\n".join(blocks)


def pdf_to_text(raw: bytes) -> str:
    """The text of each page; needs the optional package pypdf."""
    try:
        from pypdf import PdfReader
    except ImportError as e:
        raise ValueError("PDF input needs the package pypdf") from e
    try:
        pages = [p.extract_text() or "" for p in PdfReader(io.BytesIO(raw)).pages]
    except Exception as e:  # its errors have no common class
        raise ValueError("invalid PDF") from e
    text = "\n\n".join(p.strip() for p in pages if p.strip())
    if not text:
        raise ValueError("PDF has no extractable text (OCR required)")
    return text


def to_markdown(ext: str, raw: bytes) -> str:
    if ext in ("md", "markdown", "txt"):
        return decoded(raw)
    if ext in ("html", "htm"):
        return html_to_markdown(decoded(raw))
    if ext == "docx":
        return docx_to_markdown(raw)
    if ext == "pdf":
        return pdf_to_text(raw)
    raise ValueError(f"unsupported source format: {ext or '<none>'}")


def load(files: DataFrame) -> DataFrame:
    """rel_path, text, error of discovered files: the text as Markdown, or why there is none. A bad file fails no task."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for rel, path, ext in zip(b["rel_path"], b["path"], b["ext"]):  # one document at a time
                text = error = None
                try:
                    with open(path, "rb") as f:
                        text = to_markdown(ext, f.read())
                except (OSError, ValueError) as e:
                    error = str(e)
                yield pd.DataFrame({"rel_path": [rel], "text": [text], "error": [error]})

    return files.select("rel_path", "path", "ext").mapInPandas(run, "rel_path string, text string, error string")


def bundle_hashes(files: DataFrame) -> DataFrame:
    """rel_path, source_sha: of a file's name and bytes and of all images below its folder, by path. Files are read in pieces."""

    def feed(digest, path: str) -> None:
        with open(path, "rb") as f:
            while piece := f.read(1 << 20):
                digest.update(piece)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for path in b["path"]:
                digest = hashlib.sha256(os.path.basename(path).encode() + b"\0")
                try:
                    feed(digest, path)
                    folder = os.path.dirname(path)
                    images = (os.path.join(h, n) for h, _, names in os.walk(folder) for n in names if os.path.splitext(n)[1].lower().lstrip(".") in MEDIA)
                    for image in sorted(images, key=lambda p: p.split(os.sep)):
                        digest.update(b"\0" + os.path.relpath(image, folder).replace(os.sep, "/").encode() + b"\0")
                        feed(digest, image)
                    out.append(digest.hexdigest())
                except OSError:
                    out.append(None)  # unreadable
            yield pd.DataFrame({"rel_path": b["rel_path"], "source_sha": out})

    return files.select("rel_path", "path").mapInPandas(run, "rel_path string, source_sha string")


def media_type(path: Column) -> Column:
    ext = F.lower(F.regexp_extract(path, r"\.([^./]+)$", 1))
    out = F
    for e, kind in MEDIA.items():
        out = out.when(ext == e, kind)
    return out.otherwise("image/png")


def numbered(df: DataFrame, stem: str, order: list[str], name: str) -> DataFrame:
    """``df`` with ``name``: the stem, and ``-2``, ``-3`` for its repetitions in order."""
    at = F.row_number().over(Window.partitionBy(stem).orderBy(*order))
    return df.withColumn("_at", at).withColumn(name, F.when(F.col("_at") == 1, F.col(stem)).otherwise(F.concat(stem, F.lit("-"), F.col("_at")))).drop("_at")
