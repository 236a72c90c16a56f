"""Mixing sources to target weights along a time-varying curriculum.

Each source gets a token target; its share of training follows a linear
schedule ``g(u)`` over training time ``u`` in [0, 1], from ``start`` to ``end``.
The integral ``G(u) = (start*u + (end-start)*u^2/2) / ((start+end)/2)`` is the part
of the target due by time ``u``.  A document whose tokens fill the demand up to
``c`` is trained at the time ``u`` with ``G(u) * target = c``, found by inverting
the quadratic.  Sorting by that time gives the training order.

Only DataFrame functions are used.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendlake.llm.common import cut

#: A word: a run of anything but space, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Schedule:
    """A repeating cycle of weights and of (start, end) ramps, dealt to the sources
    by code point order of their names, null last."""

    weights: tuple[float, ...] = (3.0, 1.0, 2.0)
    ramps: tuple[tuple[float, float], ...] = ((1.5, 0.5), (1.0, 1.0), (0.5, 1.5))
    total_share: float = 1.5
    max_epochs: int = 2


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _cycle(values: tuple, index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(float(v)) for v in values]), (index % len(values) + 1).cast("int"))


def source_targets(sized: DataFrame, source: str, size: str, plan: Schedule = Schedule()) -> DataFrame:
    """One row per source: ``source_size``, ``weight``, ``target``, ramp.

    The shares stop at ``max_epochs`` times a source's size and what is over is
    reshared by weight until none is above.  That fixed point is
    ``min(cap, level * weight)``: with the sources in the order of
    ``cap / weight``, the level follows from running sums.  One row per source
    goes through these windows, whatever the number of documents.
    """
    per = sized.groupBy(F.col(source).alias("_src")).agg(F.sum(size).alias("source_size"))
    whole = Window.partitionBy()
    named = per.withColumn("_i", F.row_number().over(Window.orderBy(F.col("_src").asc_nulls_last())) - 1)
    w = named.select(
        "_src", "source_size", "_i",
        _cycle(plan.weights, F.col("_i")).alias("weight"),
        _cycle(tuple(a for a, _ in plan.ramps), F.col("_i")).alias("ramp_start"),
        _cycle(tuple(b for _, b in plan.ramps), F.col("_i")).alias("ramp_end"),
        (F.col("source_size") * plan.max_epochs).cast("double").alias("_cap"),
        (F.sum("source_size").over(whole) * plan.total_share).alias("_budget"),
    )
    before = Window.orderBy(F.col("_cap") / F.col("weight"), "_i").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.orderBy(F.col("_cap") / F.col("weight"), "_i").rowsBetween(0, Window.unboundedFollowing)
    level = (F.col("_budget") - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    leveled = w.withColumn("_level", level)
    # the first source that its share does not fill sets the level of all after it
    free = F.min(F.when(F.col("_level") * F.col("weight") <= F.col("_cap"), F.struct(F.col("_cap") / F.col("weight"), "_i", F.col("_level").alias("l")))).over(whole)
    return leveled.withColumn("_l", free["l"]).select(
        "_src", "source_size", "weight", "ramp_start", "ramp_end",
        F.coalesce(F.least("_cap", F.col("_l") * F.col("weight")), F.col("_cap")).alias("target"),
    )


def plan_mix(docs: DataFrame, plan: Schedule = Schedule(), *, id_col: str = "doc_id", text_col: str = "text",
             source_col: str = "source", carry: tuple[str, ...] = (), buckets: int = 4096) -> DataFrame:
    """One row per document: ``carry`` columns (prefixed ``doc_``), ``id_col``,
    ``mix_source, size, source_size, target, taken`` and ``uses``, the sorted
    array of (epoch, position) at which the whole document is trained on.

    Within a source documents stand in the order of md5 digests of id and text, so
    reruns agree.  Running sums come in two steps, sums of ``buckets`` digest
    ranges per source first, so a source that holds a third of all rows is not
    summed by one task.  A whole document is used in an epoch if its middle lies
    before the target, so a source misses its target by at most half a document.

    Null text: size 0. Null source: a source of its own, last. Null ids count like
    any other value. Rows repeated in id and text follow each other in the order.
    An empty table gives an empty plan. A document of size 0 is never used.
    """
    digest = F.md5(F.concat_ws("\x01", F.coalesce(F.col(id_col).cast("string"), F.lit("\x02")), F.coalesce(F.col(text_col), F.lit("\x02"))))
    name = F.when(F.col(source_col).isNull(), "n").otherwise(F.concat(F.lit("s"), F.col(source_col).cast("string")))  # joins like a value
    bucket = F.conv(F.substring("_d", 1, 8), 16, 10).cast("long") % 2**32 * buckets / 2**32
    sized = docs.select(
        *[F.col(c).alias(f"doc_{c}") for c in carry],
        F.col(id_col).alias("_id"), F.col(source_col).alias("_src"), name.alias("_key"),
        word_count(F.col(text_col)).alias("size"), digest.alias("_d"),
    ).withColumn("_b", F.floor(bucket).cast("int"))
    # a row per source and bucket, read twice below: once for offsets, once for targets
    sums = cut(sized.groupBy("_key", "_src", "_b").agg(F.sum("size").alias("_n")), "mix-sums")
    offsets = sums.select(
        "_key", F.col("_src").alias("_s"), "_b",
        (F.sum("_n").over(Window.partitionBy("_key").orderBy("_b")) - F.col("_n")).alias("_off"))
    targets = source_targets(sums.withColumnRenamed("_n", "size"), "_src", "size", plan)
    heads = offsets.join(targets, F.col("_s").eqNullSafe(F.col("_src"))).drop("_src", "_s")

    tie = F.xxhash64(*[F.col(f"doc_{c}") for c in carry]) if carry else F.lit(0)
    inside = Window.partitionBy("_key", "_b").orderBy("_d", "_id", tie).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = sized.withColumn("_run", F.sum("size").over(inside)).join(heads, ["_key", "_b"])
    middle = F.col("_off") + F.col("_run") - F.col("size") / 2
    uses = F.transform(
        F.filter(F.array(*[F.lit(e) for e in range(plan.max_epochs)]),
                 lambda e: (F.col("size") > 0) & (F.col("_mid") + e * F.col("source_size") < F.col("target"))),
        lambda e: F.struct(e.alias("epoch"), invert_ramp(
            F.try_divide(F.col("_mid") + e * F.col("source_size"), F.col("target")),
            F.col("ramp_start"), F.col("ramp_end")).alias("position")))
    return ranked.withColumn("_mid", middle).withColumn("uses", uses).select(
        *[F.col(f"doc_{c}") for c in carry], F.col("_id").alias(id_col), F.col("_src").alias("mix_source"),
        "size", "source_size", "target", (F.col("size") * F.size("uses")).cast("long").alias("taken"), "uses")


def invert_ramp(part: Column, start: Column, end: Column) -> Column:
    """The time by which ``part`` of a source's target is due: the root in [0, 1] of
    ``(end-start)/2 u^2 + start u - part (start+end)/2 = 0``, in the form that stays
    accurate when the ramp is flat."""
    need = part * (start + end) / 2
    return F.try_divide(2 * need, start + F.sqrt(start * start + 2 * (end - start) * need))


def training_stream(planned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The mix itself: one row per use of a document, range-sorted by position.

    Documents without a use are not in it. Ties: epoch, then id.
    """
    return planned.select(
        *[c for c in planned.columns if c != "uses"], F.explode("uses").alias("_u")
    ).select(*[c for c in planned.columns if c != "uses"], "_u.epoch", "_u.position").orderBy(
        "position", "epoch", F.col(id_col).asc_nulls_last())
