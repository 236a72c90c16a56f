"""The document scan against a plain ranking over split texts."""

import collections
import math
import random
import re

from tests.llm.test_llm_operators import docs_of
from trendlake.llm import lexical_scan

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def split(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute_search(rows, items, best=50):
    docs = [(i, collections.Counter(split(t)), len(split(t))) for i, t in rows]
    docs = [d for d in docs if d[2]]
    n, total = len(docs), sum(d[2] for d in docs)
    df = collections.Counter(t for _, c, _ in docs for t in c)
    out = []
    for item, text in items:
        terms, scores = set(split(text)), []
        for i, c, size in docs:
            m = 100 - 50 + (50 * size * n) // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 20 * m)) for t in terms if c[t])
            if s > 0:
                scores.append((-s, i is None, i or 0, i))
        out += [(item, k + 1, x[3], -x[0]) for k, x in enumerate(sorted(scores, key=lambda x: x[:3])[:best])]
    return out


def corpus():
    rng = random.Random(12)
    pool = [f"t{i}" for i in range(40)] + ["É", "é", "日本", "naïve", "x_y", "a-b", "ab", "abab", "b"]
    text = lambda n: "".join(rng.choice(pool).upper() + rng.choice([" ", "  ", "\n", ".", "_", "\x7f", "\x00"[:0] + "-"]) if rng.random() < 0.3
                             else rng.choice(pool) + " " for _ in range(n))
    rows = [(k, text(rng.randint(1, 60))) for k in range(300)]
    rows += [(k, rows[0][1]) for k in range(400, 470)]  # ties, more of them than are kept
    rows += [(None, rows[1][1]), (None, None), (500, None), (501, ""), (502, " .-_ "), (5, rows[5][1]), (5, rows[5][1]), (503, text(9000)), (504, "ab" * 9000)]
    items = [(k, text(12)) for k in range(8)] + [(8, rows[0][1]), (9, None), (10, "..."), (11, "nowhere else"), (None, "t1 É"), (3, "ab abab"), (12, "t1 t1 T1")]
    return rows, items


def test_ranking_is_that_of_split_texts(spark):
    rows, items = corpus()
    docs = docs_of(spark, [(i, t, None) for i, t in rows], ("item_id", "rank", "score", "salt", "id"))
    bench = spark.createDataFrame([(i, t, 1, 1) for i, t in items], "item_id long, text string, rank int, item int")
    want = collections.Counter(brute_search(rows, items))
    for how in (lexical_scan.Settings(), lexical_scan.Settings(block_bytes=40, piece=64, salt=2)):
        got = lexical_scan.search(docs.repartition(5), bench, how)
        assert got.columns == ["item_id", "rank", "doc_id", "score"]
        assert collections.Counter(tuple(r) for r in got.collect()) == want
    assert lexical_scan.search(docs.limit(0), bench).count() == lexical_scan.search(docs, bench.limit(0)).count() == 0
    assert lexical_scan.search(docs.where("text is null"), bench).count() == 0


def test_automaton_counts_whole_terms_only():
    table = lexical_scan.boundary_table()
    terms = ["ab", "abab", "b", "é".encode().decode("latin-1")]
    auto = lexical_scan.automaton_of(terms)
    text = "ab abab AB,b  é xab É ab"
    n, tf = lexical_scan.scan(text.encode(), auto, table, 10**6)
    assert n == 8 and {terms[k]: v for k, v in tf.items()} == {"ab": 3, "abab": 1, "b": 1, terms[3]: 1}
    for piece in (1, 2, 5):
        assert lexical_scan.scan(text.encode(), auto, table, piece) == (n, tf)


def test_a_task_keeps_a_bounded_number_of_candidates():
    import numpy as np

    top, rng = lexical_scan.Best(3, 2), random.Random(1)
    top.ROOM = 10
    seen = []
    for doc in range(500):
        s = rng.randrange(1, 50)
        seen.append((-s, doc))
        top.add(np.array([0, 2]), np.array([s, 1]), doc, True)
        assert top.size <= 10 + 2 * 2 * 3 + 2
    item, score, doc, _ = top.prune()
    assert list(zip((-score[:2]).tolist(), doc[:2].tolist())) == sorted(seen)[:2]
    assert item.tolist() == [0, 0, 2, 2] and doc[2:].tolist() == [0, 1]
