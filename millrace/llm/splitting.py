"""Split oversized texts at natural boundaries, by bounded-quantifier regular expressions in the JVM.

One pattern cuts a text into cores of at most ``max_chars - overlap_chars`` characters. Its alternatives are
ordered by the strength of the boundary they end at, and each takes as much as the limit allows; the last
takes the limit itself. What stands in a fenced code block is hidden from them, so no boundary lies in code; only where
there is none outside, the end of a line of code serves before the limit does. A piece is its core behind the last ``overlap_chars`` characters of the core before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import table

#: Ends of a core, strongest first: before a heading, after a blank line, a line, a sentence, a clause or word.
BOUNDARIES = (
    r"(?=\n(?:#{1,6}\s|={2,6}[^=\n]|<h[1-6]\b|\\(?:sub)*section\b))",
    r"(?<=\n[ \t]{0,8}\r?\n)",
    r"(?<=\n|(?:</p>|<br/>|</li>|</tr>))",
    r"(?<=[。！？!?]|[.;；]\s)",
    r"(?<=[\s，、,])",
)
_ASTRAL = r"[\x{10000}-\x{10FFFF}]"
#: Private-use characters that stand for a supplementary character, and for a line end and another character of code.
_WIDE, _CODE_END, _CODE = "\ue000", "\ue001", "\ue002"


def core_pattern(limit: int, overlap_chars: int = 0) -> str:
    """The pattern whose successive matches are cores of 1 to ``limit`` code points that cover the whole text.

    A boundary in the second half of the limit is preferred, then one before it, behind the overlap; then the end of a line
    of code, and then none.
    """
    halves = (max(1, limit // 2), max(1, overlap_chars))
    ends = "|".join([*(f".{{{least},{limit}}}{b}" for least in halves for b in BOUNDARIES), *(f".{{{least},{limit}}}(?<={_CODE_END})" for least in halves)])
    return f"(?s)(?:.{{1,{limit}}}\\z|{ends}|.{{1,{limit}}})"


def shadow(text: Column) -> Column:
    """The text with one character for each code point, and the inside of fenced code hidden; an unclosed fence ends with the text.

    java.util.regex recurses where a quantified atom changes its width, so supplementary characters are replaced too.
    """
    parts = F.split(F.concat(F.lit("\n"), F.regexp_replace(text, _ASTRAL, _WIDE)), "(?m)(?=^ {0,3}(?:```|~~~))")
    hidden = lambda x: F.regexp_replace(F.regexp_replace(x, r"[^\n]", _CODE), r"\n", _CODE_END)
    return F.substring(F.array_join(F.transform(parts, lambda x, i: F.when(i % 2 == 1, hidden(x)).otherwise(x)), ""), 2, 2**31 - 1)


def cores(text: Column, max_chars: int, overlap_chars: int) -> Column:
    """Array of struct(start, core); one core for a text of at most ``max_chars``, null for null."""
    limit = max_chars - overlap_chars
    if overlap_chars < 0 or limit < 1 or overlap_chars > max(1, limit // 2):
        raise ValueError("overlap_chars must be at least 0 and at most a third of max_chars")
    sizes = F.transform(F.regexp_extract_all(shadow(text), F.lit(core_pattern(limit, overlap_chars)), 0), lambda x: F.char_length(x))

    def placed(z: Column) -> Column:
        ends = F.transform(z, lambda x, i: F.struct(x.alias("size"), F.aggregate(F.slice(z, 1, i), F.lit(1), lambda acc, y: acc + y).alias("start")))
        return F.transform(ends, lambda x: F.struct(x["start"].alias("start"), F.substring(text, x["start"], x["size"]).alias("core")))

    # bound by a lambda, as the sizes are named twice: written out, they would be found anew for each piece
    pieces = F.get(F.transform(F.array(sizes), placed), F.lit(0))
    whole = F.array(F.struct(F.lit(1).alias("start"), text.alias("core")))
    return F.when(text.isNull(), F.lit(None)).when(F.char_length(text) <= max_chars, whole).otherwise(pieces)


def split_text(df: DataFrame, text: str, max_chars: int, overlap_chars: int = 0) -> DataFrame:
    """One row for each piece: the columns of ``df`` without ``text``, then piece_no (from 1), pieces, start, piece.

    ``start`` is the code point (from 1) at which the piece's core begins; the piece itself begins
    ``overlap_chars`` earlier, but for the first. Lengths are code points. A null text gives no row, an empty or
    blank one a single piece, as does every text of at most ``max_chars``. Repeated rows are split each. Columns of
    ``df`` with the names of the new ones are replaced. No shuffle and no Python: a projection and a generator.
    """
    new = ["piece_no", "pieces", "start", "piece"]
    keep = [c for c in df.columns if c not in (text, *new)]
    cut = df.where(F.col(text).isNotNull()).select(*keep, cores(F.col(text), max_chars, overlap_chars).alias("_cores"))
    both = cut.withColumn("_before", F.concat(F.array(F.lit("")), F.transform("_cores", lambda c: F.right(c["core"], F.lit(overlap_chars)))))
    rows = both.select(*keep, F.size("_cores").alias("pieces"), "_before", F.posexplode("_cores").alias("_i", "_c"))
    return rows.select(
        *keep, (F.col("_i") + 1).alias("piece_no"), "pieces", F.col("_c.start").alias("start"), F.concat(F.col("_before")[F.col("_i")], F.col("_c.core")).alias("piece")
    )


def budget(spark: SparkSession, sf_dir: str, name: str) -> tuple[int, int]:
    """max_chars and overlap_chars of a budget of the fixed table size_budgets."""
    row = table(spark, sf_dir, "size_budgets").where(F.col("budget_name") == name).first()
    return row["max_chars"], row["overlap_chars"]


def p7_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every section."""
    return split_text(table(spark, sf_dir, "sections").select("section_id", "body"), "body", *budget(spark, sf_dir, "section_split"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sections that the splitter divides."""
    return p7_pieces(spark, sf_dir).where((F.col("pieces") > 1) & (F.col("piece_no") == 1)).select("section_id")


def p7_rebuilt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """section_id, chars and digest of each section, from its pieces less their overlap, and whether every piece fits."""
    limit, overlap = budget(spark, sf_dir, "section_split")
    pieces = p7_pieces(spark, sf_dir).withColumn("core", F.when(F.col("piece_no") == 1, F.col("piece")).otherwise(F.substring("piece", overlap + 1, 2**31 - 1)))
    by = pieces.groupBy("section_id").agg(F.array_sort(F.collect_list(F.struct("piece_no", "core"))).alias("p"), (F.max(F.char_length("piece")) <= limit).alias("fits"))
    body = F.array_join(F.col("p.core"), "")
    return by.select("section_id", F.char_length(body).cast("long").alias("chars"), F.md5(F.encode(body, "UTF-8")).alias("digest"), "fits")


P7_REBUILT_SQL = """
SELECT section_id, CAST(length(body) AS BIGINT) AS chars, md5(body) AS digest, true AS fits FROM sections WHERE body IS NOT NULL
"""

P7_FOUND_SQL = """
SELECT section_id FROM sections
WHERE length(body) > (SELECT max_chars FROM size_budgets WHERE budget_name = 'section_split')
"""
