"""Question and procedure units: exact and near duplicates within a module, folds that lose nothing, and their counts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.text import answer_norm, query_keys, query_norm, sid_order, top_chapter
from millrace.operators.alike import leading_edges, near_edges, settled_by  # noqa: F401  (near_edges is read from here)
from millrace.session import cut

# The least similarity of queries and of answers that are merged, the size from which a module is split by chapter,
# and the pairs of a module that one task settles.
QUERY_LIKE, ANSWER_LIKE, SPLIT_ABOVE, HELD = 90.0, 88.0, 6, 1 << 21


def module_of(sources: Column) -> Column:
    """The topic of the first source, empty without one."""
    return F.coalesce(F.try_element_at(sources, F.lit(1))["topic"], F.lit(""))


def first_of(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row for each key: the least by ``order``. Reduced before the shuffle, so a hot key costs a row for each split."""
    rest = [c for c in df.columns if c not in keys]
    payload = F.struct(*[c for c in order], *[c for c in rest if c not in order])
    return df.groupBy(*keys).agg(F.min_by(payload, F.struct(*order)).alias("_r")).select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])


def leaders(norms: DataFrame, least: float) -> DataFrame:
    """module, ord, leader: whom greedy clustering in order gives each unit to; a leader leads itself.

    A unit joins the first leader it is similar to, or leads. Equal norms go with the first of them, empty ones lead themselves.
    A module that lies whole in a task is settled there, a larger one from its pairs; only one of more than HELD pairs goes
    through rounds.
    """
    named = norms.where("norm <> ''")
    first = cut(named.groupBy("module", "norm").agg(F.min("ord").alias("ord")), "norms")
    edges = cut(leading_edges(first, least), "edges")
    settled = edges.where("whole").select("module", "b", F.col("a").alias("leader"))
    parts = edges.where("not whole")
    counts = [(r["module"], r["count"]) for r in parts.groupBy("module").count().collect()]  # a row for each module of more than SMALL norms
    many = [m for m, n in counts if n > HELD]
    if len(many) < len(counts):
        settled = settled.unionByName(settled_by(parts.where(~F.col("module").isin(many))))
    if many:
        settled = settled.unionByName(in_rounds(cut(parts.where(F.col("module").isin(many)).drop("whole"), "edges")))
    settled = cut(settled, "settled")  # its size is known then, and few are broadcast
    own = first.select("module", "norm", F.col("ord").alias("b"))
    led = own.join(settled, ["module", "b"], "left").select("module", "norm", F.coalesce("leader", "b").alias("leader"))
    return named.join(led, ["module", "norm"]).select("module", "ord", "leader").unionByName(norms.where("norm = ''").select("module", "ord", F.col("ord").alias("leader")))


def in_rounds(edges: DataFrame) -> DataFrame:
    """module, b, leader of every b of ``edges`` (module, a, b).

    Whether a unit leads depends only on its earlier neighbours: in each round all those are settled whose earlier neighbours
    are, wherever they lie, and nothing is sequential but the chains of neighbours.
    """
    settled = None  # module, b, leader of the units with an earlier neighbour
    while True:
        if settled is None:
            open_ = edges
        else:
            open_ = edges.join(settled.select("module", "b"), ["module", "b"], "left_anti")
        # an earlier neighbour without one of its own leads
        begun = edges.select("module", F.col("b").alias("a")).distinct()
        known = open_.join(begun.withColumn("waits", F.lit(True)), ["module", "a"], "left")
        if settled is not None:
            known = known.join(settled.select("module", F.col("b").alias("a"), (F.col("leader") == F.col("b")).alias("leads"), F.lit(True).alias("done")), ["module", "a"], "left")
        else:
            known = known.withColumn("leads", F.lit(None).cast("boolean")).withColumn("done", F.lit(None).cast("boolean"))
        state = known.select("module", "a", "b", F.coalesce("leads", F.col("waits").isNull()).alias("leads"), (F.col("waits").isNull() | F.coalesce("done", F.lit(False))).alias("ready"))
        first_leader, first_open = F.min(F.when(F.col("leads") & F.col("ready"), F.col("a"))), F.min(F.when(~F.col("ready"), F.col("a")))
        by = state.groupBy("module", "b").agg(first_leader.alias("to"), first_open.alias("open"))
        # settled if an earlier leader precedes all open neighbours, or if none is open
        new = by.where("open is null or to < open").select("module", "b", F.coalesce("to", "b").alias("leader"))
        new = cut(new, "settled")
        if new.isEmpty():
            break
        settled = new if settled is None else settled.unionByName(new)
    return settled


def fold(units: DataFrame, groups: DataFrame, semantic: bool) -> DataFrame:
    """One row for each leader: module, ord, query, answer, paraphrases, sources, needs_review (and semantic_ok).

    The longest answer wins, the leader's or the earliest of equal ones; queries and paraphrases of the others become
    paraphrases, without repetition; sources are joined in order; one that needs review is enough. With ``semantic`` the
    leader's semantic_ok stays unless any is null. ``units`` has module and ord besides these columns.
    """
    both = units.join(groups, ["module", "ord"])
    one = F.struct(
        "ord",
        query_keys("query", "paraphrases").alias("keys"),
        F.col("query").alias("query"),
        F.coalesce("paraphrases", F.array().cast("array<string>")).alias("paraphrases"),
        F.coalesce("answer", F.lit("")).alias("answer"),
        F.col("sources").alias("sources"),
    )
    told = F.array_sort(F.collect_list(one))
    by = both.groupBy("module", "leader").agg(
        told.alias("m"), F.bool_or(F.coalesce("needs_review", F.lit(False))).alias("needs_review"), F.bool_or(F.col("semantic_ok").isNull()).alias("open"), F.min_by("semantic_ok", "ord").alias("first_ok")
    )
    longest = F.aggregate(F.transform("m", lambda x: x["answer"]), F.lit(""), lambda acc, a: F.when(F.length(a) > F.length(acc), a).otherwise(acc))
    others = F.flatten(F.transform(F.slice("m", F.lit(2), F.greatest(F.size("m") - 1, F.lit(0))), lambda x: x["keys"]))
    first = F.col("m")[0]
    added = F.filter(F.array_distinct(others), lambda k: ~F.array_contains(first["keys"], k))
    columns = [
        "module",
        F.col("leader").alias("ord"),
        first["query"].alias("query"),
        longest.alias("answer"),
        F.concat(first["paraphrases"], added).alias("paraphrases"),
        F.flatten(F.filter(F.transform("m", lambda x: x["sources"]), lambda s: s.isNotNull())).alias("sources"),
        "needs_review",
    ]
    return by.select(*columns, *([F.when(~F.col("open"), F.col("first_ok")).alias("semantic_ok")] if semantic else []))


def _clustered(units: DataFrame, norm: Callable, text: str, least: float) -> tuple[DataFrame, DataFrame]:
    named = units.withColumn("module", module_of(F.col("sources")))
    norms = named.select("module", "ord", norm(F.coalesce(F.col(text), F.lit(""))).alias("norm"))
    return named, leaders(cut(norms, "units"), least)


def query_groups(units: DataFrame, least: float = QUERY_LIKE) -> DataFrame:
    """module, ord, leader of each question unit, by its query. ``ord`` must be unique within a module."""
    return _clustered(units, query_norm, "query", least)[1]


def dedup_questions(units: DataFrame, least: float = QUERY_LIKE) -> DataFrame:
    """Question units merged within their module where their queries are alike."""
    named, groups = _clustered(units, query_norm, "query", least)
    return fold(named, groups, semantic=False)


def aggregate_answers(units: DataFrame, least: float = ANSWER_LIKE) -> DataFrame:
    """Question units merged within their module where their answers are alike."""
    named, groups = _clustered(units, answer_norm, "answer", least)
    return fold(named, groups, semantic=True)


def merge_plan(sops: DataFrame) -> DataFrame:
    """``sops`` with module, chapter, group_key and label: which merged file a procedure belongs to.

    A module of more than SPLIT_ABOVE procedures is split by chapter if any chapter has two or more. Counts are aggregated and
    joined, so no window holds a module.
    """
    first = F.try_element_at("sources", F.lit(1))
    named = sops.withColumn("module", F.coalesce(F.when(F.size("sources") > 0, first["topic"]), F.lit("_unknown"))).withColumn("chapter", top_chapter(first["heading_path"], F.col("title")))
    chapters = named.groupBy("module", "chapter").agg(F.count("*").alias("n"))
    modules = chapters.groupBy("module").agg(F.sum("n").alias("_units"), F.max("n").alias("_thickest"))
    split = (F.col("_units") > SPLIT_ABOVE) & (F.col("_thickest") >= 2)
    told = named.join(modules, "module").withColumn("group_key", F.when(split, F.concat("module", F.lit("::"), "chapter")).otherwise(F.col("module")))
    return told.withColumn("label", F.when(split, F.concat("module", F.lit(" — "), "chapter")).otherwise(F.col("module"))).drop("_units", "_thickest")


def by_sid(sources: Column) -> Column:
    return sid_order(F.try_element_at(sources, F.lit(1))["section_sid"])


def topic_counts(qa: DataFrame, sop: DataFrame) -> DataFrame:
    """topic, extracted, passed, rejected, needs_review, sop_count."""
    passed = F.coalesce((F.col("publication_status") != "failed_review") & F.col("struct_ok"), F.lit(False))
    q = qa.groupBy("topic").agg(
        F.count("*").alias("extracted"), F.count_if(passed).alias("passed"), F.count_if(~passed).alias("rejected"), F.count_if(F.coalesce("needs_review", F.lit(False))).alias("needs_review")
    )
    s = sop.groupBy("topic").agg(F.count("*").alias("sop_count"))
    return q.join(s, "topic", "full").na.fill(0)


def batches(df: DataFrame, group: str, order: list[str], size: Column, max_items: int, max_chars: int) -> DataFrame:
    """``df`` with batch (from 0): rows of a group packed in order under both limits; an item larger than the limit is alone.

    A group is folded as an array of its sizes, as packing in order is sequential; groups should be documents, not modules.
    """
    rows = df.withColumn("_size", F.greatest(F.lit(1), F.coalesce(size.cast("long"), F.lit(1))))
    sizes = rows.groupBy(group).agg(F.array_sort(F.collect_list(F.struct(*order, "_size"))).alias("_all"))
    zero = F.struct(F.lit(-1).alias("batch"), F.lit(max_items).alias("items"), F.lit(0).cast("long").alias("chars"), F.array().cast("array<int>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        full = (acc["items"] >= max_items) | (acc["chars"] + x["_size"] > max_chars) | (acc["batch"] < 0)
        b = F.when(full, acc["batch"] + 1).otherwise(acc["batch"]).cast("int")
        return F.struct(b.alias("batch"), F.when(full, 1).otherwise(acc["items"] + 1).cast("int").alias("items"), F.when(full, x["_size"]).otherwise(acc["chars"] + x["_size"]).alias("chars"), F.concat(acc["out"], F.array(b)).alias("out"))

    packed = sizes.select(group, "_all", F.aggregate("_all", zero, step)["out"].alias("_b"))
    told = packed.select(group, F.explode(F.arrays_zip("_all", "_b")).alias("z")).select(group, *[F.col(f"z._all.{o}").alias(o) for o in order], F.col("z._b").alias("batch"))
    return df.join(told, [group, *order])
