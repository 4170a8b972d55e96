"""Scalar functions on texts, as columns; Python only where Spark has no such function."""

from __future__ import annotations

import difflib
import json
import re
import unicodedata
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What a normalised query leaves out, kinds and patterns of masked values in their order, and the sign of a mask.
QUERY_SIGNS = r"[?？!！。，,、:：;；]+"
MASKS = (
    ("MAC", r"\b(?:[0-9A-Fa-f]{2}[:-]){5}[0-9A-Fa-f]{2}\b"),
    ("IPV6", r"\bfe80::[0-9A-Fa-f:]{2,}\b"),
    ("IP", r"\b(?:10\.\d{1,3}\.\d{1,3}\.\d{1,3}|172\.(?:1[6-9]|2\d|3[01])\.\d{1,3}\.\d{1,3}|192\.168\.\d{1,3}\.\d{1,3})\b"),
    ("PHONE", r"\b1[3-9]\d{9}\b"),
    ("EMAIL", r"(?i)\b[A-Z0-9._%+\-]+@[A-Z0-9.\-]+\.[A-Z]{2,}\b"),
    ("BEARER", r"(?i)(?<=bearer )[A-Za-z0-9._\-]{8,}"),
    ("KEY", r"(?i)(?<=api[_-]key[=: ])[A-Za-z0-9._\-]{12,}"),
    ("PASSWORD", r"(?i)(?:\b[A-Za-z0-9_-]*(?:password|passwd|pwd)|密码)\s*[:=：]\s*[^\s,，;；'\"`]{4,}"),
    ("SECRET", r"(?i)\b(?:client[_-]?secret|access[_-]?token|secret[_-]?key)\s*[:=]\s*[^\s,，;；'\"`]{8,}"),
    ("HEX32", r"\b[0-9a-f]{32}\b"),
)
TOKEN = r"〔[A-Z0-9_]+:[0-9a-f]{6}〕"
QUESTIONS_LABEL, QUESTIONS_SEPARATOR = "**常见问法（便于检索）：** ", "｜"
NO_EVIDENCE = "（原文缺失）"
#: What str.strip takes off in Python, as a class of a Java pattern.
BLANK = r"[\s\x1c-\x1f\x85\p{Z}]"


def stripped(c: Column | str) -> Column:
    """Without white space of any kind at both ends; null stays null."""
    return F.regexp_replace(c, rf"^{BLANK}+|{BLANK}+\z", "")


@F.pandas_udf(T.StringType())
def query_norm(s: pd.Series) -> pd.Series:
    """NFKC, without white space and query signs, case folded; null as empty."""
    return s.map(lambda q: re.sub(QUERY_SIGNS, "", re.sub(r"\s+", "", unicodedata.normalize("NFKC", q or ""))).casefold())


@F.pandas_udf(T.StringType())
def answer_norm(s: pd.Series) -> pd.Series:
    """NFKC, without white space, case folded; null as empty."""
    return s.map(lambda a: re.sub(r"\s+", "", unicodedata.normalize("NFKC", a or "")).casefold())


def lcs_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, by bits: one integer operation for each character of ``b``."""
    masks: dict[str, int] = {}
    for i, c in enumerate(a):
        masks[c] = masks.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        hit = row & masks.get(c, 0)
        row = (row + hit | row - hit) & full
    return len(a) - row.bit_count()


def similarity(a: str, b: str) -> float:
    """0 to 100: twice the longest common subsequence over both lengths; 0 where either is empty."""
    return 200.0 * lcs_length(a, b) / (len(a) + len(b)) if a and b else 0.0


@F.pandas_udf(T.DoubleType())
def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([similarity(x or "", y or "") for x, y in zip(a, b)], dtype=float)


def unit_id(prefix: str, text: Column | str) -> Column:
    """Sixteen hex digits of a unit's kind (QA, SOP) and its query or title."""
    return F.substring(F.sha2(F.concat(F.lit(f"{prefix}::"), stripped(text)), 256), 1, 16)


def content_key(*parts: Column | str) -> Column:
    """Thirty-two hex digits of texts joined by the unit separator; nulls are left out."""
    return F.substring(F.sha2(F.concat_ws("\x1f", *parts), 256), 1, 32)


def decision_key(stage: Column | str, topic: Column | str) -> Column:
    return F.concat(stage, F.lit(":"), F.substring(F.sha2(F.concat(stage, F.lit("\0"), topic), 256), 1, 20))


def audit_key(topic: Column | str) -> Column:
    return F.substring(F.sha2(topic, 256), 1, 24)


def safe_name(text: Column | str, limit: int = 80) -> Column:
    """A file name: runs of other signs than letters, digits, dots and hyphens become ``_``; ``untitled`` if nothing is left."""
    name = F.substring(F.regexp_replace(F.regexp_replace(text, r"(?U)[^\w一-鿿.-]+", "_"), "^_+|_+$", ""), 1, limit)
    return F.when(name == "", "untitled").otherwise(name)


def section_key(title: Column | str) -> Column:
    """The leading dotted number of a title, else FAQ, else its first eight signs."""
    number = F.regexp_extract(title, r"(?U)^\s*(\d+(?:\.\d+)*)", 1)
    slug = F.substring(F.regexp_replace(F.regexp_replace(stripped(title), r"(?U)[^\w一-鿿]+", "_"), "^_+|_+$", ""), 1, 8)
    return F.when(number != "", number).when(F.upper(title).contains("FAQ"), "FAQ").when(slug == "", "untitled").otherwise(slug)


def inject_questions(markdown: Column, questions: Column) -> Column:
    """The questions as a line behind the first heading of level 1 (one blank line there is taken), else before the text."""
    line = F.concat(F.lit(QUESTIONS_LABEL), F.array_join(questions, QUESTIONS_SEPARATOR))
    lines = F.split(markdown, "\n", -1)
    heading = F.array_position(F.transform(lines, lambda x: F.regexp_replace(x, rf"^{BLANK}+", "").startswith("# ")), True).cast("int")
    count = F.size(lines)
    after = F.slice(lines, heading + 1, F.greatest(count - heading, F.lit(0)))
    rest = F.when((F.size(after) > 0) & (stripped(F.try_element_at(after, F.lit(1))) == ""), F.slice(after, 2, F.greatest(F.size(after) - 1, F.lit(0)))).otherwise(after)
    inside = F.array_join(F.concat(F.slice(lines, 1, heading), F.array(F.lit(""), line, F.lit("")), rest), "\n")
    return F.when(F.coalesce(F.size(questions), F.lit(0)) <= 0, markdown).when(heading > 0, inside).otherwise(F.concat(line, F.lit("\n\n"), markdown))


def _token(kind: str, value: Column) -> Column:
    return F.concat(F.lit(f"〔{kind}:"), F.substring(F.sha2(value, 256), 1, 6), F.lit("〕"))


def _values_of(text: Column | str, kind: str, pattern: str) -> Column:
    return F.transform(F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), 0)), lambda v: F.struct(_token(kind, v).alias("token"), v.alias("value")))


def masked_values(text: Column | str) -> Column:
    """Array of (token, value) of every value that a pattern finds in the text as it stands."""
    return F.concat(*[_values_of(text, kind, pattern) for kind, pattern in MASKS])


def _masked(text: Column, kind: str, pattern: str) -> Column:
    values = F.array_sort(F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), 0)), lambda x, y: F.length(y) - F.length(x))
    return F.aggregate(values, text, lambda acc, v: F.replace(acc, v, _token(kind, v)))


def mask(text: Column | str) -> Column:
    """The text with a token for each value, pattern after pattern; of one pattern longer values first, so none is cut by another."""
    out = F.col(text) if isinstance(text, str) else text
    for kind, pattern in MASKS:
        # bound by a lambda, as the text is named twice: written out, the steps would double each time
        out = F.get(F.transform(F.array(out), _masking(kind, pattern)), F.lit(0))
    return out


def _masking(kind: str, pattern: str):
    return lambda text: _masked(text, kind, pattern)


def tokens(text: Column | str) -> Column:
    return F.array_sort(F.array_distinct(F.regexp_extract_all(text, F.lit(TOKEN), 0)))


def restore(text: Column, known: Column, rounds: int = 3) -> Column:
    """The text with the values of ``known`` (map of token to value), again for tokens within values."""
    for _ in range(rounds):
        text = F.aggregate(F.map_entries(known), text, lambda acc, e: F.replace(acc, e["key"], e["value"]))
    return text


def unresolved(text: Column | str, known: Column) -> Column:
    """Tokens of a text that ``known`` (array of tokens) doesn't hold, sorted."""
    return F.array_sort(F.array_except(tokens(text), known))


def demoted(markdown: Column | str) -> Column:
    """Every heading one level deeper, at most six."""
    return F.array_join(F.transform(F.split(markdown, "\n", -1), lambda x: F.regexp_replace(x, r"(?U)^(#{1,5})(\s+.*)$", "#$1$2")), "\n")


def top_chapter(heading_path: Column | str, title: Column | str) -> Column:
    """The second part of a path ``a / b / c``, else the title."""
    parts = F.filter(F.transform(F.split(heading_path, "/", -1), stripped), lambda x: x != "")
    return F.coalesce(F.get(parts, F.lit(1)), title)


def sid_order(sid: Column | str) -> Column:
    """A dotted id as numbers to sort by; a part that is no number is 9999."""
    return F.transform(F.split(F.coalesce(sid, F.lit("")), r"\.", -1), lambda p: F.when(p.rlike("^[0-9]+$"), p.try_cast("int")).otherwise(9999))


def query_keys(query: Column | str, paraphrases: Column | str) -> Column:
    """Query and paraphrases, stripped, without empty and repeated ones, in their order."""
    every = F.concat(F.array(query), F.coalesce(paraphrases, F.array().cast("array<string>")))
    return F.array_distinct(F.filter(F.transform(every, stripped), lambda x: x != ""))


def unescaped(text: Column | str) -> Column:
    """Five entities, the ampersand last."""
    for name, sign in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        text = F.replace(text, F.lit(name), F.lit(sign))
    return text


def best_text(vision: Column | str, ocr: Column | str) -> Column:
    v, o = stripped(vision), stripped(ocr)
    return F.coalesce(F.when(v != "", v), o, F.lit(""))


def vision_parts(text: Column | str) -> Column:
    """transcript and meaning of an answer with the marks [TRANSCRIPT] and [MEANING]; all is meaning where the latter is missing."""
    parts = F.split(text, r"\[MEANING\]", 2)
    transcript = stripped(F.replace(parts[0], F.lit("[TRANSCRIPT]"), F.lit("")))
    whole = F.size(parts) < 2
    return F.struct(F.when(whole, "").otherwise(transcript).alias("transcript"), F.when(whole, stripped(text)).otherwise(stripped(F.get(parts, F.lit(1)))).alias("meaning"))


def evidence(sources: Column, limit: int = 12000) -> Column:
    """Headings and excerpts of the sources that have one, cut to ``limit``."""
    told = F.filter(sources, lambda s: F.coalesce(stripped(s["source_excerpt"]), F.lit("")) != "")
    text = F.array_join(F.transform(told, lambda s: F.concat(F.lit("["), F.coalesce(F.when(s["heading_path"] != "", s["heading_path"]), s["doc_title"], F.lit("")), F.lit("]\n"), s["source_excerpt"])), "\n\n")
    return F.when(F.coalesce(text, F.lit("")) == "", NO_EVIDENCE).otherwise(F.substring(text, 1, limit))


def retry_delay(attempt: Column | str, asked: Column | str, chance: Column) -> Column:
    """Seconds to wait: as asked, within 0 and 30, else 2^attempt up to 10, times 0.75 to 1.25 by ``chance`` (0 to 1)."""
    own = F.least(F.pow(F.lit(2.0), attempt), F.lit(10.0)) * (F.lit(0.75) + chance * 0.5)
    asked = F.col(asked) if isinstance(asked, str) else asked
    return F.when(asked.isNotNull(), F.least(F.greatest(asked.cast("double"), F.lit(0.0)), F.lit(30.0))).otherwise(own)


def _candidates(text: str, opening: str) -> Sequence[str]:
    """Stretches from an opening bracket to the one that closes it, strings skipped."""
    closing = {"[": "]", "{": "}"}[opening]
    out = []
    at = text.find(opening)
    while at >= 0:
        depth, quoted, i = 0, False, at
        while i < len(text):
            c = text[i]
            if quoted:
                i += c == "\\"
                quoted = c != '"'
            elif c == '"':
                quoted = True
            elif c == opening:
                depth += 1
            elif c == closing:
                depth -= 1
                if not depth:
                    out.append(text[at : i + 1])
                    break
            i += 1
        at = text.find(opening, at + 1)
    return out


def loads_tolerant(text: str | None, kind: type) -> list | dict | None:
    """The first list or dict that a model's answer holds: fences around it, text about it, raw line ends and trailing commas are allowed."""
    if not text:
        return None
    bare = re.sub(r"^\s*```[a-zA-Z]*\s*\n?|\n?\s*```\s*$", "", text.strip())
    for c in (bare, *_candidates(bare, "[" if kind is list else "{")):
        for t in (c, re.sub(r",\s*(?=[\]}])", "", c)):
            try:
                value = json.loads(t, strict=False)
            except ValueError:
                continue
            if isinstance(value, kind):
                return value
    return None


@F.pandas_udf(T.StringType())
def json_array(s: pd.Series) -> pd.Series:
    """Canonical JSON of the list in each text, null where there is none."""
    return s.map(lambda t: None if (v := loads_tolerant(t, list)) is None else json.dumps(v, ensure_ascii=False))


@F.pandas_udf(T.StringType())
def json_object(s: pd.Series) -> pd.Series:
    return s.map(lambda t: None if (v := loads_tolerant(t, dict)) is None else json.dumps(v, ensure_ascii=False))


@F.pandas_udf(T.StringType())
def unified_diff(a: pd.Series, b: pd.Series) -> pd.Series:
    """A unified diff with three lines about each change; empty for equal texts."""
    return pd.Series(["\n".join(difflib.unified_diff((x or "").splitlines(), (y or "").splitlines(), "input", "output", lineterm="", n=3)) for x, y in zip(a, b)], dtype=object)
