"""The queries of this package and, where SQL can state them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import defects, markup, mixing, neardup, packing, personal, repetition, splitting, tokens

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p1_clean": markup.p1_clean,
    "p1_found": markup.p1_found,
    "p2_found": personal.p2_found,
    "p2_masked": personal.p2_masked,
    "p3_found": defects.p3_found,
    "p4_batches": packing.p4_batches,
    "p4_sections": packing.p4_sections,
    "p5_classes": neardup.p5_classes,
    "p5_found": neardup.p5_found,
    "p7_found": splitting.p7_found,
    "p7_pieces": splitting.p7_pieces,
    "p7_rebuilt": splitting.p7_rebuilt,
    "p8_ids": tokens.p8_ids,
    "p9_mix": mixing.p9_mix,
    "p9_shares": mixing.p9_shares,
    "p10_found": repetition.p10_found,
    "p10_shares": repetition.p10_shares,
}

SQL: dict[str, str] = {"p4_sections": packing.P4_SECTIONS_SQL, "p7_found": splitting.P7_FOUND_SQL, "p7_rebuilt": splitting.P7_REBUILT_SQL}
