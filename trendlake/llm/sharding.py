"""A uniform shuffle of all rows into shards of exact sizes.

The number of rows that a uniform shuffle moves from a partition to a shard follows a
hypergeometric law.  These numbers are drawn first, as a matrix of partitions by
shards whose margins are the partitions' row counts and the shards' sizes; then every
partition permutes its rows and deals them out in runs of the drawn lengths, the rows
are exchanged, and every shard permutes what it got.  No row is compared with another
partition's, and no shard is one task: a shard's second permutation goes by random
keys, in stretches of bounded size.

The rows and their random keys are written once before anything is drawn, so a task
that runs again after an executor was lost finds the same rows in the same order.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trendlake.llm.common import cut, prepare

#: numpy draws from urns below this size; larger ones are halved first.
URN_LIMIT = 10**9
#: Bits of ``monotonically_increasing_id`` that count the rows of one partition.
ROW_BITS = 33


@dataclass(frozen=True)
class Settings:
    shards: int = 40
    seed: int = 13
    stretch_rows: int = 50_000   # rows of a shard that one group permutes, about
    block_partitions: int = 512  # partitions whose row of the matrix one task draws


def hypergeometric(rng, good: int, bad: int, take: int) -> int:
    """How many of ``take`` items drawn from an urn are good, for urns of any size.

    Think of the urn's items in random order, of which the first ``take`` are drawn. The
    place of the middle good item follows from a beta and a binomial number; it leaves
    an urn with half the good (or bad) items to draw from.
    """
    got, sign = 0, 1
    while max(good, bad) >= URN_LIMIT and take and good and bad:
        if bad > good:  # count the bad ones instead
            got, sign, good, bad = got + sign * take, -sign, bad, good
        k = (good + 1) // 2
        before = int(rng.binomial(bad, rng.beta(k, good + 1 - k)))
        if k + before <= take:
            got, good, bad, take = got + sign * k, good - k, bad - before, take - k - before
        else:
            good, bad = k - 1, before
    if not take or not good:
        return got
    return got + sign * (take if not bad else int(rng.hypergeometric(good, bad, take)))


def deal(rng, margins: list[int], take: int) -> list[int]:
    """How many of ``take`` items drawn from all go to each margin (multivariate law)."""
    out, rest = [], sum(margins)
    for m in margins:
        x = hypergeometric(rng, m, rest - m, take)
        out.append(x)
        rest, take = rest - m, take - x
    return out


def shard_sizes(rows: int, shards: int) -> list[int]:
    """As equal as can be; the first shards have the row more."""
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def communication_matrix(sizes: DataFrame, settings: Settings) -> DataFrame:
    """``part, starts`` from ``part, n``: the first place, among a partition's permuted rows, of
    the run that goes to each shard.

    Blocks of partitions are drawn on the driver (one row per ``block_partitions``
    partitions), and a block's own partitions in a task, under the block's margins.
    """
    import numpy as np

    spark = sizes.sparkSession
    sizes = sizes.withColumn("block", F.floor(F.col("part") / settings.block_partitions))
    blocks = sizes.groupBy("block").agg(F.sum("n").alias("n")).orderBy("block").collect()
    left = shard_sizes(sum(b["n"] for b in blocks), settings.shards)
    rng, margins = np.random.default_rng(settings.seed), []
    for b in blocks:
        quota = deal(rng, left, b["n"])
        left = [x - y for x, y in zip(left, quota)]
        margins.append((b["block"], quota))
    seed = settings.seed

    def draw(pdf):
        import numpy as np
        import pandas as pd

        pdf = pdf.sort_values("part")
        left = [int(x) for x in pdf["quota"].iloc[0]]
        rng = np.random.default_rng([seed, int(pdf["block"].iloc[0])])
        starts = []
        for n in pdf["n"]:
            row = deal(rng, left, int(n))
            left = [x - y for x, y in zip(left, row)]
            starts.append(np.cumsum([0, *row[:-1]]).tolist())
        return pd.DataFrame({"part": pdf["part"].to_numpy(), "starts": starts})

    known = spark.createDataFrame(margins, "block long, quota array<long>")
    return sizes.join(known, "block").groupBy("block").applyInPandas(draw, "part long, starts array<long>")


def shuffle_into_shards(rows: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``rows`` with ``shard`` and ``slot`` (both replaced if the rows have them).

    Every assignment of rows to shards of the exact sizes is equally likely, and so is
    every order inside a shard; sizes differ by one row at most and slots run from 0
    without gaps. Equal rows are rows like any other: each gets a place of its own, and a
    group of copies is dealt over all shards. Nulls and very long values are carried
    as they are; an empty table gives an empty result, and fewer rows than shards leave
    shards empty. The draw depends on the seed and on how the input is partitioned.
    The names ``__at__``, ``__key__``, ``__part__`` are reserved and must not be in ``rows``.
    """
    spark = rows.sparkSession
    prepare(spark)
    rows = rows.drop("shard", "slot")
    if taken := {"__at__", "__key__", "__part__"}.intersection(rows.columns):
        raise ValueError(f"reserved column names: {sorted(taken)}")
    # each partition's permutation: its rows sorted by random keys, numbered, and written
    mixed = rows.withColumn("__mix__", F.rand(settings.seed)).sortWithinPartitions("__mix__").drop("__mix__") \
        .withColumn("__at__", F.monotonically_increasing_id()).withColumn("__key__", F.rand(settings.seed + 1))
    kept = cut(mixed, "permuted").withColumn("__part__", F.shiftright("__at__", ROW_BITS))
    sizes = kept.groupBy(F.col("__part__").alias("part")).agg(F.count(F.lit(1)).alias("n"))
    starts = cut(communication_matrix(sizes, settings), "matrix").withColumnRenamed("part", "__part__")

    total = F.lit(kept.count())
    stretches = F.greatest(F.lit(1), F.ceil(total / (settings.shards * settings.stretch_rows)))
    place = F.col("__at__").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    dealt = kept.join(starts, "__part__") \
        .withColumn("shard", (F.size(F.filter("starts", lambda s: s <= place)) - 1).cast("int")) \
        .withColumn("__part__", F.floor(F.col("__key__") * stretches)).drop("starts")

    # where each stretch of a shard begins: a row per stretch
    before = Window.partitionBy("shard").orderBy("__part__").rowsBetween(Window.unboundedPreceding, -1)
    first = dealt.groupBy("shard", "__part__").agg(F.count(F.lit(1)).alias("n")) \
        .select("shard", "__part__", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("shard", "__part__").orderBy("__key__", "__at__")
    slot = (F.col("first") + F.row_number().over(inside) - 1).alias("slot")
    return dealt.join(first, ["shard", "__part__"]).select(*[F.col(c) for c in rows.columns], "shard", slot)


def shard_documents(docs: DataFrame, settings: Settings = Settings(), *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` for every row of ``docs``.

    Size is the text's UTF-8 bytes plus 16, and a null text has none of them and the
    crc32 of no bytes, 0. The law is ``rows``: shards differ by one row at most, whatever
    the sizes; so ``grown_shard`` is null. Texts do not travel. See
    ``shuffle_into_shards`` for copies, empty tables and ties; other columns are not read.
    """
    octets = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    narrow = docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(octets) + F.lit(16)).cast("long").alias("size"),
                         F.crc32(octets).alias("text_crc32"))
    return shuffle_into_shards(narrow, settings).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def write_shards(docs: DataFrame, path: str, settings: Settings = Settings()) -> None:
    """All columns of ``docs`` as Parquet folders ``shard=<k>`` below ``path``, with ``slot``. Files
    hold stretches of a shard in the order of their slots, several to a shard."""
    shuffle_into_shards(docs, settings).sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
