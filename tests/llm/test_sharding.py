"""Exact shard sizes, gapless slots, the law of the drawn matrix, and uniform places."""

import collections
import zlib

import numpy as np
import pytest

from tests.llm.test_llm_operators import docs_of, words
from trendlake.llm import sharding


def check(rows, shards):
    sizes = collections.Counter(r.shard for r in rows)
    assert sorted(sizes.values(), reverse=True) == [n for n in sharding.shard_sizes(len(rows), shards) if n]
    for s in sizes:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sizes[s]))


def test_documents_get_exact_shards(spark):
    rows = [(k, " ".join(words(k % 50, k)), "s") for k in range(900)] + [(k, "copy É", "s") for k in range(900, 1300)]
    rows += [(5, rows[5][1], "s"), (5, rows[5][1], "s"), (None, None, None), (2000, "", "s"), (2001, "日" * 100_000, "s"), (None, None, None)]
    docs = docs_of(spark, rows, ("shard", "slot", "part", "size", "n"))
    for settings in (sharding.Settings(), sharding.Settings(shards=7, stretch_rows=20, block_partitions=2)):
        got = sharding.shard_documents(docs.repartition(9), settings).collect()
        check(got, settings.shards)
        want = collections.Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, _ in rows)
        assert collections.Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == want
        assert {(r.law, r.grown_shard) for r in got} == {("rows", None)}
        copies = collections.Counter(r.shard for r in got if r.doc_id in range(900, 1300))
        assert len(copies) == settings.shards and max(copies.values()) < 4 * 400 / settings.shards  # copies are dealt out
    assert sharding.shard_documents(docs.limit(0)).count() == 0
    few = sharding.shard_documents(docs.limit(3)).collect()
    assert [(r.shard, r.slot) for r in sorted(few, key=lambda r: r.shard)] == [(0, 0), (1, 0), (2, 0)]
    with pytest.raises(ValueError, match="reserved"):
        sharding.shuffle_into_shards(docs.withColumnRenamed("n", "__at__"))


def test_whole_rows_are_shuffled_and_written(spark, tmp_path):
    docs = docs_of(spark, [(k, f"text {k}", "s") for k in range(200)], ("shard",))
    sharding.write_shards(docs, str(tmp_path / "out"), sharding.Settings(shards=4, stretch_rows=10))
    back = spark.read.parquet(str(tmp_path / "out")).collect()
    check(back, 4)
    assert sorted((r.doc_id, r.text) for r in back) == sorted((k, f"text {k}") for k in range(200))
    assert len(list((tmp_path / "out").glob("shard=*"))) == 4


def test_places_are_uniform(spark):
    docs = spark.range(200).selectExpr("id as doc_id", "cast(id as string) as text").repartition(3).cache()
    first, where = collections.Counter(), collections.Counter()
    for seed in range(0, 16, 2):
        for r in sharding.shuffle_into_shards(docs, sharding.Settings(shards=4, seed=seed, stretch_rows=20)).collect():
            first[r.shard, r.slot // 10] += r.doc_id < 100  # half of the rows
            where[r.doc_id % 4, r.shard] += 1
    assert max(abs(n - 40) for n in first.values()) <= 19   # of 80 in each tenth: four deviations are 18
    assert max(abs(n - 100) for n in where.values()) <= 32


def test_matrix_keeps_its_margins(spark):
    n = [0, 5, 100, 3, 250, 1, 77, 41]
    sizes = spark.createDataFrame(list(enumerate(n)), "part long, n long")
    for block in (1, 3, 100):
        rows = {r.part: r.starts for r in sharding.communication_matrix(sizes, sharding.Settings(shards=6, block_partitions=block)).collect()}
        matrix = np.array([np.diff([*rows[p], n[p]]) for p in range(len(n))])
        assert (matrix >= 0).all() and matrix.sum(0).tolist() == sharding.shard_sizes(sum(n), 6)


def test_large_urns_follow_the_hypergeometric_law(monkeypatch):
    rng = np.random.default_rng(5)
    want = np.bincount(rng.hypergeometric(30, 50, 20, 40_000), minlength=21) / 40_000
    monkeypatch.setattr(sharding, "URN_LIMIT", 8)  # halves the urn again and again
    got = np.bincount([sharding.hypergeometric(rng, 30, 50, 20) for _ in range(40_000)], minlength=21) / 40_000
    assert np.abs(got - want).max() < 0.012
    monkeypatch.undo()
    x = [sharding.hypergeometric(rng, 3 * 10**10, 10**10, 4 * 10**6) for _ in range(200)]
    assert abs(np.mean(x) - 3 * 10**6) < 250 and 700 < np.std(x) < 1050  # deviation 866
    assert sharding.hypergeometric(rng, 10**10, 0, 7) == 7 and sharding.hypergeometric(rng, 0, 10**10, 7) == 0
    assert sum(sharding.deal(rng, [10**10, 1, 0, 2 * 10**9], 5 * 10**9)) == 5 * 10**9
