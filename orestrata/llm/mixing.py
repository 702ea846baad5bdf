"""Mixing sources to target weights by entropy balancing (operator 6).

Sources in order of code point, null last, weigh 5, 2, 1, 5, 2, 1 ... and share the words of all documents; a
target stops at `CAP` times its source's words, and what is over is shared again by weight until none is above.

Rates: among all document rates whose words add up to the targets, those closest to one in relative entropy are exponential in
the constrained quantity, rate = exp(l * size / mean size of the source), here cut at CAP, with one multiplier l for each source's
token constraint. Newton iterations on the convex dual find the multipliers: each sums words and slopes over the
cells (source, size, number of documents) of every source; a step that leaves the bracket known so far is halved instead.

Copies: the documents of a cell have one rate, so a cell gets round(rate x number) copies; what rounding leaves is
carried from the largest size of a source to the smallest, so a source ends within half of its smallest document. All
documents of a cell get the same whole number of copies, and those of smallest hash one more. Nothing exceeds CAP copies.

Scale: one pass counts words; everything after works on cells. The smallest hashes of a cell are found in
sub-cells of about `SUB` documents, so that a hot cell is no single task. A task holds one source's distinct sizes, which
are less than the root of twice its words (5 million for 10^13 words).

Edge cases: a null or empty text has size 0 and no copies, target or not; a source without words has target 0. Rows that share an id
are documents each; equal rows may differ by one copy, so that the target is met. Null sources are one source, the last. An empty table gives an empty
result. Other columns are never read by `mixed`, and kept by `mixture`.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orestrata.llm.shared import WORD, cut

WEIGHTS = (5.0, 2.0, 1.0)
CAP = 3
SUB = 10_000
TOLERANCE = 1e-10
STEPS = 100
STEPS_AT_ONCE = 10
_TOP = float(np.log(CAP))


def _size(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def _targets(sources: DataFrame) -> DataFrame:
    """(source, no, source_size, target) of sources with their sizes."""
    # A number for each source in order, by ranges, so that no task sorts all sources.
    ranged = cut(sources.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id()))
    before = ranged.groupBy("part").count()
    before = before.withColumn("before", F.sum("count").over(Window.orderBy("part")) - F.col("count"))
    place = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last()))
    numbered = ranged.withColumn("place", place).join(before, "part").select(
        "source", "source_size", (F.col("before") + F.col("place") - 1).alias("no")
    )
    pick = F.get(F.array(*map(F.lit, WEIGHTS)), (F.col("no") % len(WEIGHTS)).cast("int"))
    numbered = cut(numbered.withColumn("weight", pick).withColumn("most", CAP * F.col("source_size").cast("double")))
    # A share of weight x level is too much for a source whose ceiling is lower; the level rises as ceilings are met.
    total = numbered.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    level = 0.0
    while True:
        capped = F.col("weight") * level >= F.col("most")
        row = numbered.agg(
            F.sum(F.when(capped, F.col("most")).otherwise(0.0)), F.sum(F.when(~capped, F.col("weight")).otherwise(0.0))
        ).first()
        if not row[1]:
            break
        raised = (total - row[0]) / row[1]
        if raised <= level:
            break
        level = raised
    target = F.least(F.col("weight") * level, F.col("most"))
    return numbered.select("source", "no", "source_size", target.alias("target"))


def _step(state: DataFrame) -> DataFrame:
    """One safeguarded Newton step on the dual, all sources at once."""
    own = Window.partitionBy("no").orderBy("size").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    grown = F.col("n") * F.col("size") * F.exp(F.least(F.col("l") * F.col("x"), F.lit(_TOP)))
    free = F.when(F.col("l") * F.col("x") < _TOP, grown * F.col("x")).otherwise(0.0)
    summed = state.withColumns({"f": F.sum(grown).over(own), "slope": F.sum(free).over(own)})
    off = F.col("f") - F.col("target")
    bound = summed.withColumns(
        {
            "lo": F.when(off < 0, F.col("l")).otherwise(F.col("lo")),
            "hi": F.when(off > 0, F.col("l")).otherwise(F.col("hi")),
            "next": F.col("l") - off / F.col("slope"),
        }
    )
    near = F.abs(off) <= TOLERANCE * F.col("target")
    narrow = F.col("hi") - F.col("lo") <= 1e-14 * F.abs("hi")
    moved = F.when((F.col("slope") > 0) & (F.col("next") > F.col("lo")) & (F.col("next") < F.col("hi")), F.col("next"))
    ended = bound.withColumn("done", F.col("done") | near | narrow)
    moved = F.coalesce(moved, (F.col("lo") + F.col("hi")) / 2)
    return ended.withColumn("l", F.when(F.col("done"), F.col("l")).otherwise(moved)).drop("f", "slope", "next")


def _multipliers(cells: DataFrame) -> DataFrame:
    """`cells` (no, size, n, target, x) with their source's multiplier l.

    The cells carry the state of their source, and lie partitioned and sorted by it, so that steps need no exchange.
    """
    least = F.min("x").over(Window.partitionBy("no").orderBy("size"))
    state = cells.withColumn("x0", least).select(
        "no", "size", "n", "target", "x",
        F.lit(0.0).alias("l"), (-700.0 / F.col("x0")).alias("lo"), (_TOP / F.col("x0")).alias("hi"), F.lit(False).alias("done"),
    )
    for _ in range(0, STEPS, STEPS_AT_ONCE):
        for _ in range(STEPS_AT_ONCE):
            state = _step(state)
        state = cut(state)
        if state.where("not done").isEmpty():
            break
    return state


def _rounded(cells: pd.DataFrame) -> pd.DataFrame:
    """Whole copies for the cells of one source, from the largest size down, carrying what is left of the words."""
    cells = cells.sort_values("size", ascending=False)
    copies, carry = [], 0.0
    for size, n, rate in zip(cells["size"], cells["n"], cells["rate"]):
        want = n * rate * size + carry
        given = min(max(round(want / size), 0), CAP * n)
        carry = want - given * size
        copies.append(given)
    return pd.DataFrame({"no": cells["no"], "size": cells["size"], "n": cells["n"], "copies": np.array(copies, "int64")})


def _sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """A row (id, source, size, draw) for each document."""
    size, draw = _size(F.col(text_col)), F.xxhash64(id_col, text_col)
    return docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), size.alias("size"), draw.alias("draw"))


def _plan(rows: DataFrame) -> DataFrame:
    """For each (source, size) of sized rows: source_size, target, base copies, and the largest hash that gets one more."""
    counted = cut(rows.groupBy("source", "size").agg(F.count("*").alias("n")))
    totals = counted.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("docs"))
    sources = _targets(totals.select("source", "source_size"))
    named = sources.withColumnRenamed("source", "named")
    cells = counted.join(named, counted["source"].eqNullSafe(named["named"]))
    mean = F.col("source_size") / F.sum("n").over(Window.partitionBy("no"))
    cells = cut(cells.select("source", "no", "size", "n", "source_size", "target", (F.col("size") / mean).alias("x")))
    solved = _multipliers(cells.where("size > 0").select("no", "size", "n", "target", "x"))
    rate = F.least(F.lit(float(CAP)), F.exp(F.least(F.col("l") * F.col("x"), F.lit(2.0))))
    rated = solved.select("no", "size", "n", rate.alias("rate"))
    rounded = rated.groupBy("no").applyInPandas(_rounded, "no bigint, size bigint, n bigint, copies bigint")
    rounded = rounded.select("no", "size", F.expr("copies div n").alias("base"), (F.col("copies") % F.col("n")).alias("extra"))
    plan = cut(cells.join(rounded, ["no", "size"], "left").fillna(0, ["base", "extra"]))

    # The extra-th smallest hash of a cell: by sub-cells that are ranges of the hash, then within the one that holds it.
    some = plan.where("extra > 0").select(F.col("source").alias("s"), F.col("size").alias("z"), "no", "n", "extra")
    inside = rows.join(some, rows["source"].eqNullSafe(some["s"]) & (rows["size"] == some["z"])).select("no", "size", "n", "extra", "draw")
    parts = F.ceil(F.col("n") / SUB)
    sub = F.least(parts - 1, F.floor((F.col("draw") / F.lit(2.0**64) + 0.5) * parts))
    inside = inside.withColumn("sub", sub)
    counts = inside.groupBy("no", "size", "sub", "extra").agg(F.count("*").alias("m"))
    until = F.sum("m").over(Window.partitionBy("no", "size").orderBy("sub"))
    holds = counts.withColumn("before", until - F.col("m")).where("before < extra and before + m >= extra")
    holds = holds.select("no", "size", "sub", (F.col("extra") - F.col("before")).alias("rank"))
    # Equal rows have equal hashes: they are merged first, and only some of them may get one more.
    drawn = inside.select("no", "size", "sub", "draw").join(holds, ["no", "size", "sub"])
    drawn = drawn.groupBy("no", "size", "sub", "rank", "draw").agg(F.count("*").alias("tied"))
    upto = F.sum("tied").over(Window.partitionBy("no", "size", "sub").orderBy("draw"))
    last = drawn.withColumn("take", F.col("rank") - (upto - F.col("tied"))).where("take between 1 and tied")
    last = last.select("no", "size", F.col("draw").alias("last"), "take", "tied")
    return plan.join(last, ["no", "size"], "left").select("source", "size", "source_size", "target", "base", "last", "take", "tied")


def _copied(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """`rows`, with source, size and draw of each document, and what the plan says of them. `plan` is stored."""
    some_tied = not plan.where("take < tied").isEmpty()
    plan = plan.select(*[F.col(c).alias(f"__plan_{c}") for c in plan.columns])
    same = rows["__source"].eqNullSafe(plan["__plan_source"]) & (rows["__size"] == plan["__plan_size"])
    met = rows.join(plan, same)
    more = F.coalesce((F.col("__draw") <= F.col("__plan_last")).cast("long"), F.lit(0))
    if not some_tied:
        return met.withColumn("__copies", F.col("__plan_base") + more)
    between = F.coalesce((F.col("__draw") == F.col("__plan_last")) & (F.col("__plan_take") < F.col("__plan_tied")), F.lit(False))
    clear = met.where(~between).withColumn("__copies", F.col("__plan_base") + more)
    # Of rows with one hash the first ones get one more: they are numbered by the stored part they lie in, then within it.
    tied = cut(met.where(between).withColumn("__part", F.spark_partition_id()))
    cell = ["__plan_source", "__plan_size"]
    counts = tied.groupBy(*cell, "__part").agg(F.count("*").alias("__here"))
    before = F.sum("__here").over(Window.partitionBy(*cell).orderBy("__part")) - F.col("__here")
    counts = counts.select(F.col(cell[0]).alias("__s"), F.col(cell[1]).alias("__z"), F.col("__part").alias("__p"), before.alias("__before"))
    own = tied[cell[0]].eqNullSafe(counts["__s"]) & (tied[cell[1]] == counts["__z"]) & (tied["__part"] == counts["__p"])
    place = F.row_number().over(Window.partitionBy(*cell, "__part").orderBy("__draw"))
    numbered = tied.join(counts, own).withColumn("__place", place + F.col("__before"))
    more = (F.col("__place") <= F.col("__plan_take")).cast("long")
    numbered = numbered.withColumn("__copies", F.col("__plan_base") + more)
    return clear.unionByName(numbered.select(*clear.columns))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """A row for each row of `docs`: id_col, size, source_size, target, taken, copies."""
    rows = cut(_sized(docs, id_col, text_col, source_col))
    named = rows.select("id", *[F.col(c).alias(f"__{c}") for c in ("source", "size", "draw")])
    found = _copied(named, cut(_plan(rows)))
    return found.select(
        F.col("id").alias(id_col),
        F.col("__size").alias("size"),
        F.col("__plan_source_size").alias("source_size"),
        F.col("__plan_target").alias("target"),
        (F.col("__size") * F.col("__copies")).alias("taken"),
        F.col("__copies").alias("copies"),
    )


def mixture(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of `docs`, each as often as the mix takes it, with all their columns."""
    plan = cut(_plan(cut(_sized(docs, id_col, text_col, source_col))))
    draw = F.xxhash64(id_col, text_col).alias("__draw")
    rows = docs.select(*docs.columns, F.col(source_col).alias("__source"), _size(F.col(text_col)).alias("__size"), draw)
    found = _copied(rows, plan).where("__copies > 0")
    times = F.explode(F.array_repeat(F.lit(0), F.col("__copies").cast("int")))
    return found.withColumn("__time", times).select(*docs.columns)
