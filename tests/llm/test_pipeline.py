"""The corpus pipeline, stage by stage, against brute force on planted documents."""

import collections
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_llm_operators import DOCS, brute_align, brute_components, sentences
from trendlake.llm import decontam

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """sf_dir with clean, toxic, copied, passage-sharing and leaking documents."""
    rng, rows, labels, kind = random.Random(21), [], [], collections.defaultdict(set)

    def add(text, what, source="s1"):
        rows.append((len(rows), text, "en", source, len(text or "")))
        kind[what].add(len(rows) - 1)
        return len(rows) - 1

    items = [sentences(30, 40_000 + k) for k in range(5)]
    passage = sentences(65, 50_000)
    for k in range(150):
        add(sentences(80, k), "clean", f"s{k % 3}" if k % 10 else None)
    for k in range(60):
        w = sentences(60, 1000 + k).split()
        for _ in range(4):
            w.insert(rng.randrange(len(w)), rng.choice(["scum", "vermin", "dolt"]))
        add(" ".join(w), "toxic")
    add(sentences(50, 2000) + " You s c u m and v3rm1n dollt! vermin scum", "toxic")
    first = add(sentences(60, 3000) + "\n" + passage + "\n" + sentences(60, 3001), "clean")
    for k in range(4):
        add(sentences(60, 3100 + k) + " " + passage + " " + sentences(40, 3200 + k), "passage")
    add(rows[first][1], "copy")
    base = sentences(23, 4000).split()  # too short a run for line dedup
    for k in range(6):
        add(" ".join(base[:-1] + [f"end{k}"]), "near")
    for k, item in enumerate(items):
        add(sentences(70, 5000 + k) + " " + item + " " + sentences(30, 5100 + k), "leak")
    add(None, "clean")
    add("", "clean", None)
    for i, *_ in rows:
        if i % 2 or i in kind["toxic"]:
            labels.append((i, 1, int(i in kind["toxic"])))
    sf = str(tmp_path_factory.mktemp("corpus"))
    docs = spark.createDataFrame(rows, DOCS)
    docs.repartition(4).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    return sf, rows, kind, items, passage


def test_stages_do_what_brute_force_does(spark, corpus, tmp_path_factory):
    sf, rows, kind, items, passage = corpus
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_duplicates", "decontamination", "mixing"]
    docs, seen = spark.read.parquet(f"{sf}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        out = str(tmp_path_factory.mktemp("stage")) + "/out"
        before = {r.doc_id: r.text for r in docs.collect()}
        stage(spark, docs, sf).write.parquet(out)
        docs = spark.read.parquet(out)
        after = {r.doc_id: r for r in docs.collect()}
        seen.append(name)
        if name != "mixing":
            assert docs.columns == COLUMNS
        if name == "toxicity":
            assert set(before) - set(after) == kind["toxic"]
        elif name == "line_dedup":
            assert set(before) - set(after) == kind["copy"]
            for i, r in after.items():
                if i in kind["passage"]:
                    assert passage not in " ".join(r.text.split()) and 90 <= len(r.text.split()) <= 110
                else:
                    assert r.text == before[i]
                assert r.n_chars == len(r.text or "")
        elif name == "near_duplicates":
            comps = brute_components(sorted(before.items()))
            assert set(after) == {c for _, n, c in comps if n} | {i for i, n, _ in comps if not n}
            assert len(kind["near"] & set(after)) == 1
        elif name == "decontamination":
            how = decontam.Settings()
            bad = {i for i, t in before.items() if t and max(brute_align(x.split(), t.split(), how) for x in items) >= how.threshold}
            assert bad >= kind["leak"] and set(before) - set(after) == bad
        else:
            assert [r.position for r in docs.orderBy("position").collect()] == sorted(r.position for r in docs.collect())
            per = docs.groupBy("source").agg(F.sum("size").alias("taken"), F.first("target").alias("t"), F.max("size").alias("m")).collect()
            assert all(abs(r.taken - r.t) <= r.m for r in per)
            assert max(docs.groupBy("doc_id").count().collect(), key=lambda r: r["count"])["count"] <= 2
    assert len(seen) == 5


def test_run_chains_the_stages(spark, corpus):
    sf, rows, kind, *_ = corpus
    got = {r.doc_id for r in corpus_pipeline.run(spark, sf).collect()}
    assert not got & (kind["toxic"] | kind["copy"] | kind["leak"]) and len(got & kind["near"]) <= 1
    assert len(got & kind["clean"]) > 0.9 * len(kind["clean"]) / 2


def test_stages_survive_odd_tables(spark, corpus):
    sf = corpus[0]
    odd = [(None, None, None, None, None), (None, "", "en", "s", 0), (1, "z " * 40_000, None, None, None), (1, "z " * 40_000, None, None, None),
           (2, "same text of seven words in here", "en", "s", 1), (2, "same text of seven words in here", "en", "s", 1), (3, None, "en", "s", 9)]
    table = spark.createDataFrame(odd, DOCS)
    for docs in (table, table.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, sf)
            rows = out.collect()
            if name in ("toxicity", "line_dedup", "decontamination"):
                assert len(rows) == docs.count(), name
            elif name == "near_duplicates":
                assert len(rows) == (5 if docs is table else 0)
