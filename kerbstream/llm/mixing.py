"""Mixing sources to target weights by entropy balancing.

Each source is given a number of words. Among all ways to weigh its documents that meet it, with
weights from 0 to ``most`` copies, entropy balancing takes the one closest to "every document
once" in relative entropy. Its weights are exponentially tilted, min(most, exp(a * size / mean
size)), where the source's one dual variable a solves a convex problem. All sources are solved at
once by Newton iterations: a pass over the sizes sums gradient and curvature per source in Spark,
and a step updates the table of duals, which stays a table. Steps are kept inside a bracket that
shrinks around the root, so an iteration that would overshoot halves the bracket instead.

Rates are then rounded to whole copies so that a source's total is met: documents are dealt to
slots of bounded size by a hash of their ids and sizes, and in each slot, largest first, a document
gets the number of copies that keeps the running total closest to the running target. Documents
that are equal in all of this are rounded as one, and their copies divided among them.

All sums of fractions go through decimals, which add up the same in any order, so reruns agree.

Sizes are counted in full; sources are ordered by code point, null last, to deal the weights.

Defined cases: null and empty texts have size 0 and are taken once if their source's rate is at
least one half; rows without an id are told apart by their size; repeated rows are documents of
their own, and of rows that tie any may get the copy that is left over; a source whose documents are
all empty has target 0; a very long text is one size; empty tables give empty results. ``repeated``
returns the table's own columns, whatever their names; ``mixed`` reads id, source and text alone.
"""

from __future__ import annotations

import functools
import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbstream.llm.common import map_texts, whole_row
from kerbstream.operators.ordering import numbered
from kerbstream.session import materialise

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0
ITERATIONS = 60
TOLERANCE = 1e-4  # of a source's target
SLOT_ROWS = 2000
EXACT = "decimal(38,6)"


def word_counts(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id", "source")
                ) -> DataFrame:
    """Columns ``keep`` and size, the words of each whole text. ``bytes.split`` cuts at ASCII
    white space only, as the definition of a word asks."""
    return map_texts(docs, list(keep), text, "size long",
                     lambda texts: [[len((t or b"").split()) for t in texts]], binary=True)


def _exact_sum(value: Column) -> Column:
    return F.sum(value.cast(EXACT)).cast("double")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
                   most: float = MOST) -> DataFrame:
    """One row per source: source, documents, source_size, target.

    Targets are weight * level up to ``most`` times the source's size. Capping a source raises
    the level for the others; the level only rises, so repeating until no further source is
    capped gives the one solution. Each round sends two sums to the driver.
    """
    totals = sizes.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count("*").alias("documents"))
    places = numbered(totals, F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)),
                          (F.pmod(F.col("position") - 1, F.lit(len(weights))) + 1).cast("int"))
    table = materialise(places.select(
        "source", "source_size", "documents", weight.cast("double").alias("weight"),
        (F.col("source_size") * F.lit(most)).alias("cap")), "sources")
    total = share * (table.agg(F.sum("source_size")).first()[0] or 0)
    level, capped = 0.0, -1
    while True:
        full = F.col("cap") < F.col("weight") * F.lit(level)
        row = table.agg(F.count(F.when(full, 1)).alias("n"),
                        F.sum(F.when(full, F.col("cap"))).alias("full"),
                        F.sum(F.when(~full, F.col("weight"))).alias("open")).first()
        if row.n == capped or not row.open:
            break
        capped, level = row.n, (total - (row.full or 0.0)) / row.open
    return table.select("source", "documents", "source_size",
                        F.least("cap", F.col("weight") * F.lit(level)).alias("target"))


def tilted(dual: Column, size: Column, mean: Column, most: float = MOST) -> Column:
    """The rate of a document. The exponent is bounded where the cap holds anyway."""
    return F.least(F.lit(most), F.exp(F.least(dual * size / mean, F.lit(50.0))))


def solve_duals(sizes: DataFrame, targets: DataFrame, most: float = MOST,
                iterations: int = ITERATIONS, tolerance: float = TOLERANCE) -> DataFrame:
    """``targets`` with mean (size) and dual of each source.

    A source at its cap needs no dual: its rate is ``most``, written as an infinite dual. Brackets
    at least halve from the second step on, so ``iterations`` are more than a solvable source
    needs; if one is still open then, that is an error and no result.
    """
    mean = F.greatest(F.col("source_size") / F.col("documents"), F.lit(1e-9))
    at_cap = F.col("target") >= F.col("source_size") * F.lit(most * (1 - 1e-12))
    state = materialise(targets.select(
        "*", mean.alias("mean"), F.lit(0.0).alias("dual"),
        F.lit(None).cast("double").alias("low"), F.lit(None).cast("double").alias("high"),
        (at_cap | (F.col("source_size") == 0)).alias("done")), "duals")
    for left in range(iterations, -1, -1):
        if not state.filter(~F.col("done")).limit(1).count():
            break
        if not left:
            raise ArithmeticError(f"sources miss their targets after {iterations} iterations")
        state = materialise(_newton(sizes, state, most, tolerance), "duals")
    return state.select(
        "source", "documents", "source_size", "target", "mean",
        F.when(at_cap, F.lit(float("inf"))).otherwise(F.col("dual")).alias("dual"))


def _newton(sizes: DataFrame, state: DataFrame, most: float, tolerance: float) -> DataFrame:
    """One iteration for every open source."""
    open_now = state.filter(~F.col("done")).select(
        F.col("source").alias("_source"), "mean", F.col("dual"))
    joined = sizes.join(open_now, F.col("source").eqNullSafe(F.col("_source")))
    rate = tilted(F.col("dual"), F.col("size"), F.col("mean"), most)
    moments = joined.groupBy("_source").agg(
        _exact_sum(F.col("size") * rate).alias("reached"),
        _exact_sum(F.when(rate < most, F.col("size") * F.col("size") / F.col("mean") * rate)
                   .otherwise(0.0)).alias("slope"))
    after = state.join(moments, F.col("source").eqNullSafe(F.col("_source")), "left")
    miss = F.col("reached") - F.col("target")
    low = F.when(miss < 0, F.col("dual")).otherwise(F.col("low"))
    high = F.when(miss > 0, F.col("dual")).otherwise(F.col("high"))
    after = after.withColumns({
        "miss": miss, "low": low, "high": high,
        "step": F.col("dual") - miss / F.greatest("slope", F.lit(1e-12))})
    # Without a bracket yet, a step at most doubles the way from 0 (and goes at least by 1).
    bound = 1.0 + 2.0 * F.abs("dual")
    inside = (F.col("low").isNull() | (F.col("step") > F.col("low"))) & (
        F.col("high").isNull() | (F.col("step") < F.col("high")))
    halved = (F.col("low") + F.col("high")) / 2
    moved = (F.when(F.col("low").isNotNull() & F.col("high").isNotNull(),
                    F.when(inside, F.col("step")).otherwise(halved))
             .otherwise(F.greatest(-bound, F.least(bound, F.col("step")))))
    close = F.abs("miss") <= F.lit(tolerance) * F.greatest("target", F.lit(1.0))
    finished = F.col("done") | close
    return after.select(
        "source", "documents", "source_size", "target", "mean",
        F.when(finished, F.col("dual")).otherwise(F.round(moved, 12)).alias("dual"),
        "low", "high", finished.alias("done"))


def rounded(rates: DataFrame, slot_rows: int = SLOT_ROWS, alike: tuple[str, ...] = ()
            ) -> DataFrame:
    """``rates`` (doc_id, source, documents, size, rate) with copies, whole numbers near the
    rates.

    Rows that are equal in source, id, size and the columns ``alike`` are one record, however
    many they are. A source of many rows has its records dealt over as many slots as it needs,
    so no task holds more than about ``slot_rows`` of them, whatever the source's share. Copies
    are chosen per record and then divided evenly among its rows.
    """
    key = ["source", "doc_id", "size", *alike]
    records = rates.groupBy(*key, "documents", "rate").agg(F.count("*").alias("times"))
    slots = F.ceil(F.col("documents") / F.lit(float(slot_rows))).cast("long")
    dealt = records.withColumn("_slot", F.pmod(F.xxhash64("doc_id", "size", *alike), slots))
    schema = records.schema.add("total", "long")

    def choose(group: pa.Table) -> pa.Table:
        group = group.sort_by([("size", "descending"), ("doc_id", "ascending"),
                               *[(name, "ascending") for name in alike]])
        wanted = given = 0.0
        totals = []
        for size, rate, times in zip(*(group[c].to_pylist() for c in ("size", "rate", "times"))):
            wanted += size * rate * times
            n = round((wanted - given) / size) if size else int(rate >= 0.5) * times
            n = min(max(n, int(rate) * times), math.ceil(rate) * times)
            given += n * size
            totals.append(n)
        return group.drop_columns("_slot").append_column("total", pa.array(totals, pa.int64()))

    chosen = materialise(dealt.groupBy("source", "_slot").applyInArrow(choose, schema), "chosen")
    return _divided(rates, chosen, key)


def _divided(rates: DataFrame, chosen: DataFrame, key: list[str]) -> DataFrame:
    """``rates`` with copies: each row an equal part of its record's total, and the first rows one
    more, until nothing is left. First are those of the first task that wrote them, so the rows
    of a large record are numbered in many tasks: a row's number is that in its task, and how
    many rows the tasks before it have."""
    named = chosen.select(*[F.col(k).alias(f"_{k}") for k in key], "times", "total")
    same = functools.reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in key])
    placed = materialise(rates.join(named, same).select(
        *rates.columns, "times", "total", F.spark_partition_id().alias("_task")), "placed")
    part = F.floor(F.col("total") / F.col("times"))
    left = F.col("total") - part * F.col("times")
    uneven = (F.col("times") > 1) & (left > 0)
    even = placed.filter(~uneven).select(*rates.columns, part.alias("copies"))
    rest = placed.filter(uneven)
    if not rest.limit(1).count():
        return even
    numbered_rows = rest.withColumn(
        "_at", F.row_number().over(Window.partitionBy("_task", *key).orderBy("total")))
    before = Window.partitionBy(*key).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    tasks = rest.groupBy("_task", *key).agg(F.count("*").alias("_n")).select(
        F.col("_task").alias("_in"), *[F.col(k).alias(f"_{k}") for k in key],
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    found = numbered_rows.join(tasks, same & (F.col("_task") == F.col("_in")))
    one_more = (F.col("_before") + F.col("_at") <= left).cast("long")
    return even.unionByName(found.select(*rates.columns, (part + one_more).alias("copies")))


def mixed(docs: DataFrame, text: str = "text", weights: tuple[int, ...] = WEIGHTS,
          share: float = SHARE, most: float = MOST, also: tuple[str, ...] = (),
          alike: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, source, size, source_size, target, rate, copies and taken of each document, and the
    columns ``also``, which decide nothing, and ``alike``, which tell rows of one id and size
    apart."""
    sizes = materialise(word_counts(docs, text, ("doc_id", "source", *also, *alike)), "sizes")
    duals = solve_duals(sizes, source_targets(sizes, weights, share, most), most)
    duals = materialise(duals.withColumnRenamed("source", "_source"), "solved")
    rate = F.when(F.col("dual") == float("inf"), F.lit(most)).otherwise(
        tilted(F.col("dual"), F.col("size"), F.col("mean"), most))
    rates = sizes.join(duals, F.col("source").eqNullSafe(F.col("_source"))).select(
        "doc_id", "source", *also, *alike, "size", "documents", "source_size", "target",
        F.round(rate, 9).alias("rate"))
    return rounded(rates, alike=alike).withColumn("taken", F.col("copies") * F.col("size"))


def repeated(docs: DataFrame, text: str = "text", weights: tuple[int, ...] = WEIGHTS,
             share: float = SHARE, most: float = MOST) -> DataFrame:
    """``docs`` with each row as often as the mix takes it, which may be never.

    Rows are written with a number of their own first, so that each finds its own decision,
    also where ids are missing or repeated. The decision depends on ids, sizes and texts only,
    and which of equal rows stands more often is all the same, so reruns agree.
    """
    numbered_rows = materialise(docs.select(
        whole_row(docs).alias("row"), F.monotonically_increasing_id().alias("number")),
        "numbered-rows")
    words = F.col(f"row.{text}")
    slim = numbered_rows.select("number", "row.doc_id", "row.source", words.alias("text"),
                                F.xxhash64(words).alias("print"))
    taken = mixed(slim, "text", weights, share, most, ("number",), ("print",)).filter(
        "copies > 0").select("number", "copies")
    # By a shuffle at any size, so that the work grows evenly with the table.
    return (numbered_rows.join(taken.hint("merge"), "number")
            .select("row", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))))
            .select("row.*"))
