"""The training-data operators against brute force on small fixtures, with the awkward
rows that any corpus has: nulls, empty and long texts, ties, repeats, no rows at all."""

import collections
import gzip
import hashlib
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from trendlake.llm import (
    components, curriculum, decontam, embedding_join, jaccard_join, line_align, quality, textnum, token_counts, toxicity,
    url_trust, warc,
)

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(n, seed, size=4000):
    rng = random.Random(seed)
    return [f"w{rng.randrange(size):x}{chr(97 + rng.randrange(26))}" for _ in range(n)]


def docs_of(spark, rows, extra=()):
    df = spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], DOCS)
    for name in extra:  # names that operators use inside
        df = df.withColumn(name, F.lit(7))
    return df


# ---- word arrays -------------------------------------------------------------------------


def test_words_and_shingles_follow_the_definition():
    texts = ["a b\tc\x0bd\x0ce\r\nf", None, "", "  ", "é\u00a0x y", "A B C D E F"]
    data, off = textnum.buffers(pa.array(texts))
    starts, ends, first = textnum.words(data, off)
    raw = data.tobytes()
    got = [[raw[s:e].decode() for s, e in zip(starts[a:b], ends[a:b])] for a, b in zip(first[:-1], first[1:])]
    assert got == [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    h = textnum.Hasher(lower=True).ranges(data, starts, ends)
    sh, at = textnum.shingles(h, first, 5)
    assert np.diff(at).tolist() == [2, 0, 0, 0, 1, 2]
    assert set(sh[at[0]:at[1]].tolist()) == set(sh[at[5]:at[6]].tolist())  # A-Z count as a-z
    sliced = pa.array(["zz", "a b c d e f"]).slice(1)
    data, off = textnum.buffers(sliced)
    s, e, f = textnum.words(data, off)
    assert set(textnum.shingles(textnum.Hasher(True).ranges(data, s, e), f, 5)[0].tolist()) == set(sh[at[0]:at[1]].tolist())


# ---- 1 -----------------------------------------------------------------------------------


def brute_trust(edges, seeds, damping=0.85, rounds=400):
    out = collections.Counter()
    for a, _ in edges.items():
        out[a[0]] += edges[a]
    score = dict(seeds)
    for _ in range(rounds):
        flow = collections.Counter()
        for (a, b), n in edges.items():
            flow[b] += damping * n / out[a] * score.get(a, 0)
        score = {h: seeds.get(h, 0) + flow.get(h, 0) for h in set(flow) | set(seeds)}
    return score


def test_url_verdicts_follow_rules_then_links(spark):
    link = lambda *hosts: "".join(f"<a href='http://{h}/x'>" for h in hosts)
    rows = [
        (1, "http://A.Example.NET/en/1?q#f", ""), (2, "https://a.example.net/fr/1", ""), (3, "http://net/", ""),
        (4, "http://notexample.net", ""), (5, "http://x.org/fr/", link("good.com")), (6, "http://x.org/de/", None),
        (7, None, None), (8, "no scheme", ""), (9, "http://farm.com/1", link("bad.net", "bad.net", "worse.net")),
        (10, "http://bad.net/1", link("farm.com")), (11, "http://good.com/?x", link("x.org")), (12, "http://EXAMPLE.com/de/a/://b", ""),
        (None, "http://good.com/?x", ""), (11, "http://good.com/?x", ""), (13, "a://b.org#/fr/", ""), (14, "http://worse.net/2", ""),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("clash")).withColumn("kind", F.lit(1))
    got = url_trust.judge_urls(pages).collect()
    assert len(got) == len(rows)
    by = {r.page_id: r for r in got}
    assert [(by[i].rule, by[i].verdict) for i in (1, 2, 3, 4, 5, 12)] == [
        ("example.net/en/", "allow"), ("net/", "block"), ("net/", "block"), (None, "allow"), ("org/fr/", "allow"), ("example.com/de/", "block")]
    assert (by[1].host, by[1].path, by[11].host, by[11].path, by[7].host, by[7].path, by[8].host) == ("a.example.net", "/en/1", "good.com", "/", "", "", "")
    assert (by[9].rule, by[9].verdict) == (None, "block")  # it links to blocked hosts only
    assert by[6].verdict == by[11].verdict == by[13].verdict == by[7].verdict == "allow"
    edges = collections.Counter({("x.org", "good.com"): 1, ("farm.com", "bad.net"): 2, ("farm.com", "worse.net"): 1,
                                 ("bad.net", "farm.com"): 1, ("good.com", "x.org"): 1})
    trust = brute_trust(edges, {"x.org": 0.5, "a.example.net": 0.5})
    distrust = brute_trust({(b, a): n for (a, b), n in edges.items()},
                           {"a.example.net": 0.5, "net": 1, "bad.net": 1, "worse.net": 1, "example.com": 1})
    for r in got:
        assert r.trust == pytest.approx(trust.get(r.host, 0), abs=6e-4)
        assert r.distrust == pytest.approx(distrust.get(r.host, 0), abs=6e-4)
    assert url_trust.judge_urls(pages.limit(0)).count() == 0


# ---- 2 and 5 -----------------------------------------------------------------------------


def held(i):
    import zlib

    return zlib.crc32(str(i).encode()) % 4 == 2


def test_quality_learns_and_survives_odd_rows(spark):
    rows, labels = [], []
    for i in range(240):
        good = i % 3 > 0
        text = " ".join(w.capitalize() if k % 9 == 0 else w for k, w in enumerate(words(90, i)))
        rows.append((i, text + "." if good else text.upper().replace(" ", "!! "), "s"))
        labels.append((i, int(good)))
    rows += [(1000, None, None), (1001, "", "s"), (None, "x y", "s"), (1002, "z " * 30_000, "s"), (0, rows[0][1], "s")]
    lab = spark.createDataFrame(labels + [(5, 1), (9999, 0), (None, 1), (7, None)], "doc_id long, quality int").withColumn("text", F.lit("clash"))
    few = quality.Settings(epochs=120)
    docs = docs_of(spark, rows, ("score", "x", "label"))
    got = quality.quality(docs, lab, few).collect()
    assert len(got) == len(rows)
    test = [(r.predicted, r.doc_id % 3 > 0) for r in got if r.doc_id is not None and r.doc_id < 240 and r.held_out]
    assert all(r.held_out == held(r.doc_id) for r in got if r.doc_id is not None)
    assert sum(p == y for p, y in test) >= 0.95 * len(test)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    twice = [r.score for r in got if r.doc_id == 0]
    assert len(twice) == 2 and twice[0] == twice[1]
    assert quality.quality(docs.limit(0), lab, few).count() == 0
    blind = quality.quality(docs, lab.limit(0), few)
    assert {r.score for r in blind.collect()} == {0.5}


def test_attention_gradient_is_right():
    rng = np.random.default_rng(1)
    x, bag, y = rng.normal(size=(12, 5)), np.array([0] * 3 + [1] * 4 + [2] * 5), np.array([1.0, 0.0, 1.0])
    one = quality.train(x, bag, y, quality.Settings(epochs=1, hidden=4, gate=3, rate=1e-6, decay=0.0))
    many = quality.train(x, bag, y, quality.Settings(epochs=300, hidden=4, gate=3, decay=0.0))

    def loss(net):
        z, _ = quality.forward(net, x, bag, 3)
        return float(np.mean(np.log1p(np.exp(-np.where(y > 0, z, -z)))))

    assert loss(many) < 0.05 < loss(one)
    _, (_, _, _, _, a, _) = quality.forward(many, x, bag, 3)
    assert np.allclose(np.bincount(bag, weights=a), 1)


def test_attention_steps_go_down_the_finite_differences():
    """The first step moves every weight by the rate against its gradient's sign."""
    rng = np.random.default_rng(3)
    x, bag, y = rng.normal(size=(12, 5)), np.array([0] * 3 + [1] * 4 + [2] * 5), np.array([1.0, 0.0, 1.0])

    def loss(net):
        z, _ = quality.forward(net, x, bag, 3)
        return float(np.mean(np.log1p(np.exp(-np.where(y > 0, z, -z)))))

    compared = 0
    for seed in range(8):
        how = dict(hidden=4, gate=3, rate=1e-3, decay=0.0, seed=seed)
        start, moved = (quality.train(x, bag, y, quality.Settings(epochs=e, **how)) for e in (0, 1))
        for name in ("W", "b", "V", "v", "U", "u", "w", "c", "d"):
            for i in np.ndindex(start[name].shape):
                near = []
                for h in (1e-5, -1e-5):
                    net = {k: v.copy() for k, v in start.items()}
                    net[name][i] += h
                    near.append(loss(net))
                slope = (near[0] - near[1]) / 2e-5
                if abs(slope) > 1e-5:
                    compared += 1
                    assert (moved[name][i] - start[name][i]) / how["rate"] == pytest.approx(-np.sign(slope), abs=0.01), (seed, name, i)
    assert compared > 300


@pytest.fixture(scope="module")
def toxic_case(spark):
    rng, rows, labels = random.Random(5), [], []
    syllables = ["ka", "lo", "min", "ter", "us", "ra", "den", "ti", "so", "pel", "va", "or"]

    def words(n, seed):
        own = random.Random(seed)
        return ["".join(own.choices(syllables, k=own.randint(1, 4))) for _ in range(n)]

    for i in range(400):
        w = words(60, i)
        if i % 5 == 0:
            for _ in range(3):
                w.insert(rng.randrange(len(w)), rng.choice(["stupid", "moron", "loser", "trash"]))
        rows.append((i, " ".join(w), "s"))
        labels.append((i, int(i % 5 == 0)))
    rows += [(1000 + k, " ".join(words(40, 900 + k)) + f" {t} and more words. {t}", "s") for k, t in enumerate(
        ["m0r0n", "s t u p i d", "stuuupid", "tr@sh", "l.o.s.e.r", "5tup1d", "MORON!!"])]
    rows += [(2000, None, None), (2001, "", None), (None, "a b", "s"), (2002, "y " * 50_000, "s"), (2003, "1 2 3 4 5 12.5% $$$ a.b.c", "s")]
    docs = docs_of(spark, rows, ("score", "label", "feature"))
    lab = spark.createDataFrame(labels + [(3, 0), (None, 1), (8, None)], "doc_id long, toxic int")
    return docs, lab, rows


def test_toxicity_restores_and_scores(spark, toxic_case):
    docs, lab, rows = toxic_case
    got = {r.doc_id: r for r in toxicity.toxicity(docs, lab).collect()}
    assert len(got) == len(rows)
    for i in range(400):
        assert got[i].predicted == int(i % 5 == 0), i
        assert got[i].held_out == held(i)
    assert [got[1000 + k].predicted for k in range(7)] == [1] * 7
    assert [got[i].predicted for i in (2000, 2001, None, 2002, 2003)] == [0] * 5
    assert all(0 <= r.score <= 1 for r in got.values())
    text = {r.doc_id: r.restored for r in toxicity.restored(docs.where("doc_id >= 1000"), toxicity.fit(docs, lab)).collect()}
    assert [text[1000 + k].split()[-1] for k in range(7)] == ["moron", "stupid", "stupid", "trash", "loser", "stupid", "moron"]
    assert text[2000] == text[2001] == ""
    assert toxicity.toxicity(docs.limit(0), lab.limit(0)).count() == 0
    assert {r.score for r in toxicity.toxicity(docs, lab.limit(0)).collect()} == {0.0}


def test_viterbi_finds_the_best_path():
    """Against all paths of a short lattice."""
    import itertools

    rng = np.random.default_rng(3)
    log_p = np.log(rng.dirichlet(np.ones(64), (64, 64))).astype(np.float32)
    index = {c: i + 1 for i, c in enumerate(toxicity.LETTERS)} | {" ": 0}
    for span in ("a1b", "s s", "l.o0", "bb4", "$x!"):
        def value(path):
            a = b = 0
            total = 0.0
            for c, cost in path:
                total -= cost
                if c:
                    s = index.get(c, toxicity.OTHER)
                    total += 0.0 if b == s == 0 else float(log_p[a, b, s])
                    a, b = b, s
            return total + (float(log_p[a, b, 0]) if b else 0.0)

        best = max(itertools.product(*toxicity.lattice(span)), key=value)
        assert toxicity.viterbi(span, log_p) == "".join(c for c, _ in best).strip()


def small_reader(known, evidence):
    codes = toxicity._symbols("\n\n" + " \n".join(known * 50) + "\n\n", toxicity.symbol_table())
    counts = collections.Counter(((codes[:-2] * 64 + codes[1:-1]) * 64 + codes[2:]).tolist())
    return toxicity.Reader(toxicity.character_model(counts.items(), 8.0), {"=" + w: 0.9 for w in evidence})


def test_broken_words_are_read_as_one():
    reader = small_reader("idiot moron clown the was hello in a more is or on".split(), ["idiot", "moron", "clown"])
    for span in ("id iot", "idi ot", "m o ron", "mo ro n", "m()ron", "mor-on", "1d 10t", "id\n\tiot", "cl0 wn,", "(m0 ron)", "i diot"):
        assert reader.numbers(f"the {span} was")[0] == 0.9, span
        assert reader.text(f"the {span} was").split()[1:-1] in (["idiot"], ["moron"], ["clown"]), span
    for span in ("more on", "id is", "in a", "mor was on", "c low n0w", "idio", "i was d"):
        assert reader.numbers(f"the {span} was")[0] == 0, span


def test_skeletons_leave_out_no_reading():
    known = "idiot moron clown boss hello was the allow".split()
    reader, rng = small_reader(known, known[:4]), random.Random(8)
    undo = {"o": "0", "i": "1!|", "l": "1|", "e": "3", "a": "4@", "s": "5$", "t": "7+", "c": "("}
    tokens = set()
    for _ in range(3000):
        w = "".join(rng.choice([c, c, c, *undo.get(c, ""), c + c, c + rng.choice(".-_*")]) for c in rng.choice(known))
        tokens.add(rng.choice(["", "", "x.", "!", "\"", "#"]) + w + rng.choice(["", "", "!", "+", "?", "$", "s"]))
    read = 0
    for t in tokens:
        want = max((reader._best((w,)) for w in reader.restorer.readings(t)), default=0)
        assert reader.value(t) == reader.reading(t)[0] == want, t
        read += want > 0
    assert read > len(tokens) / 5


def test_reader_does_no_work_that_nothing_asks_for(monkeypatch):
    known = "idiot moron clown the was hello in a more is or on".split()
    reader, rng = small_reader(known, known[:3]), random.Random(9)
    for _ in range(2000):  # without three single characters in a row nothing is spaced out
        text = "".join(rng.choice(["a", "b", "id", " ", " ", "\t\n", "\x1c", "\u00a0"]) for _ in range(rng.randint(0, 12)))
        assert toxicity.three_singles(text.split()) == bool(toxicity.SPACED.search(text)), repr(text)
    tokens = [*known, "id", "iot", "i", "mo", "m", "r0n", "RON", "Iot", "(l", "lown", "0wn", "dd", "2"]
    first = [rng.choices(tokens, k=30) for _ in range(300)]
    fast = [(reader.learn(set(t)), reader.runs(t))[1] for t in first]
    monkeypatch.setattr(toxicity.Reader, "letter", lambda self, c: "")  # no run ends by its first letter
    slow = small_reader(known, known[:3])
    assert fast == [(slow.learn(set(t)), slow.runs(t))[1] for t in first] and any(fast)
    monkeypatch.undo()
    asked = []
    monkeypatch.setattr(toxicity.Reader, "fragment", lambda self, token: asked.append(token) or "")
    monkeypatch.setattr(toxicity.Reader, "value", lambda self, token: asked.append(token) or 0.0)
    monkeypatch.setattr(toxicity.Restorer, "decoded", lambda self, span: asked.append(span) or ())
    other = small_reader(known, known[:3])
    other.numbers("id was id the id hello idxx ids idioms mo was m the idealism")
    assert not asked and other.starts


def test_long_tokens_are_read_in_bounded_memory():
    import tracemalloc

    reader = small_reader("idiot moron the".split(), ["idiot", "moron"])
    token = "1d10t." * 30_000
    tracemalloc.start()
    assert reader.numbers(token)[0] == 0.9
    assert tracemalloc.get_traced_memory()[1] < 25e6 and token not in reader.known
    tracemalloc.stop()


def test_readings_of_doubled_letters_edge_symbols_and_any_white_space():
    known = "idiot moron clown toxic dolt vermin the was hello" .split()
    codes = toxicity._symbols("\n\n" + " \n".join(known * 50) + "\n\n", toxicity.symbol_table())
    counts = collections.Counter(((codes[:-2] * 64 + codes[1:-1]) * 64 + codes[2:]).tolist())
    reader = toxicity.Reader(toxicity.character_model(counts.items(), 8.0), {"=" + w: 0.9 for w in known[:6]})
    for token in ("iidiot", "morron", "iddiott", "!diot", "(lown", "\"(lown\",", "|diot!", "dol+", "do1+", "+oxic.", "idiot!", "(moron)"):
        assert reader.numbers(f"the {token} was")[0] == 0.9, token
    for spaced in ("d o l t", "d\to\tl\tt", "d\no\nl\nt", "d   o   l   t"):
        assert reader.numbers(f"the {spaced} was")[0] == 0.9, spaced
    for token in ("hello!", "(was)", "the", "+", "!!!", "||", "a+b"):
        assert reader.numbers(f"the {token} was")[0] == 0.0, token
    three = toxicity.Reader(reader.restorer.log_p, {"=the": 0.9})
    assert three.numbers("was t h e was")[0] == three.numbers("was t\t h\ne was")[0] == 0.9


# ---- 3 -----------------------------------------------------------------------------------


def brute_align(item, text, how):
    p, q = [decontam.plain(w) for w in item], [decontam.plain(w) for w in text]
    h = [[0.0] * (len(q) + 1) for _ in range(len(p) + 1)]
    best = 0.0
    for i in range(1, len(p) + 1):
        for j in range(1, len(q) + 1):
            s = how.same if p[i - 1] == q[j - 1] else how.near if p[i - 1][:4] == q[j - 1][:4] else how.other
            h[i][j] = max(0, h[i - 1][j - 1] + s, h[i - 1][j] + how.gap, h[i][j - 1] + how.gap)
            best = max(best, h[i][j])
    return best / (how.same * len(item))


def test_alignment_is_smith_waterman():
    how, rng = decontam.Settings(), random.Random(2)
    for k in range(60):
        item = words(rng.randint(1, 15), k, 12)
        text = words(rng.randint(1, 30), 100 + k, 12)
        score, s, e = decontam.align(item, text, how)
        assert score == pytest.approx(brute_align(item, text, how))
        if score > 0:
            assert brute_align(item, text[s:e], how) == pytest.approx(score)


def test_decontamination_finds_edited_copies_only(spark):
    items = [(k, " ".join(words(30, 5000 + k))) for k in range(6)] + [(6, "too short"), (7, None), (None, "a b c d e f g h i"), (8, ""), (0, " ".join(words(30, 5000)))]
    bench = spark.createDataFrame(items, "item_id long, text string")

    def planted(k, edit):
        w = items[k][1].split()
        return " ".join(words(40, k) + edit(w) + words(50, 77 + k))

    def every(n, f):
        return lambda w: [f(x) if i % n == n - 1 else x for i, x in enumerate(w)]

    rows = [
        (0, planted(0, lambda w: w), "s"), (1, planted(1, every(6, lambda x: "other")), "s"), (2, planted(2, lambda w: [x.upper() + "," for x in w]), "s"),
        (3, planted(3, lambda w: w[:10] + ["put", "in"] + w[10:]), "s"), (4, planted(4, lambda w: w[:20]), "s"), (5, planted(5, lambda w: w[:6]), "s"),
        (6, " ".join(words(200, 999)), "s"), (7, None, None), (8, "", "s"), (None, planted(0, lambda w: w), "s"), (0, planted(0, lambda w: w), "s"),
        (9, items[0][1] + " " + items[1][1], "s"), (10, "too short text", "s"), (11, "q " * 60_000 + items[2][1], "s"),
    ]
    docs = docs_of(spark, rows, ("item_id", "score"))
    found = decontam.contaminated(docs, bench).collect()
    got = collections.Counter((r.doc_id, r.item_id) for r in found)
    # case and punctuation count neither in a seed nor in the alignment: row 2 is a full copy
    assert got == collections.Counter({(0, 0): 2, (1, 1): 1, (2, 2): 1, (3, 3): 1, (4, 4): 1, (None, 0): 1, (9, 0): 1, (9, 1): 1, (11, 2): 1})
    clean = decontam.without_contaminated(docs, bench)
    assert clean.columns == docs.columns and sorted(r.doc_id for r in clean.collect()) == [5, 6, 7, 8, 10]
    blocks = decontam.Settings(block_bytes=150)  # the items in many blocks give the same
    assert collections.Counter((r.doc_id, r.item_id) for r in decontam.contaminated(docs, bench, blocks).collect()) == got
    assert decontam.contaminated(docs.limit(0), bench).count() == decontam.contaminated(docs, bench.limit(0)).count() == 0
    assert decontam.without_contaminated(docs, bench.limit(0)).count() == len(rows)


def test_decontamination_finds_edited_copies_of_frequent_items(spark):
    w = words(30, 6000)
    edited = " ".join("other" if i % 4 == 3 else x for i, x in enumerate(w))  # unchanged runs of three words
    docs = docs_of(spark, [(i, " ".join(words(10, i) + w + words(10, 500 + i)), "s") for i in range(150)] + [(150, edited, "s")])
    bench = spark.createDataFrame([(1, " ".join(w))], "item_id long, text string")
    assert sorted(r.doc_id for r in decontam.contaminated(docs, bench).collect()) == list(range(151))
    assert decontam.without_contaminated(docs, bench).count() == 0


def test_decontamination_sees_through_case_and_punctuation(spark):
    latin = " ".join(words(30, 7000))
    other = " ".join(f"{w}É ñÜ{w} ΛΌΓΟΣ{k}Σ {w}İ" for k, w in enumerate(words(8, 7001)))
    bench = spark.createDataFrame([(1, latin), (2, other), (3, "a b - , c d e f g h")], "item_id long, text string")
    edits = [lambda x: x.upper() + ",", lambda x: f"“{x}”", lambda x: "**" + x + "**", lambda x: "- " + x, lambda x: x + " …", lambda x: x.lower(),
             lambda x: "«" + x + "»!?", lambda x: x + "\n*"]
    rows = [(10 * i + k, " ".join(words(20, i) + [f(x) for x in t.split()] + words(20, 90 + i)), "s")
            for i, f in enumerate(edits) for k, t in ((1, latin), (2, other))]
    docs = docs_of(spark, [*rows, (503, "x y a b c d e f g h", "s"), (504, "- - - - , , …", "s"), (505, "”", "s"), (506, None, "s")])
    got = {(r.doc_id, r.item_id): (r.start_word, r.end_word) for r in decontam.contaminated(docs, bench).collect()}
    assert set(got) == {(i, i % 10) for i, *_ in rows} | {(503, 3)}
    assert got[1, 1] == (20, 50) and got[503, 3] == (2, 10)
    assert sorted(r.doc_id for r in decontam.without_contaminated(docs, bench).collect()) == [504, 505, 506]


def test_decontamination_finds_all_that_alignment_would(spark):
    """Seeds lose nothing: the result is that of aligning every item with every whole text."""
    how, rng = decontam.Settings(), random.Random(12)
    items = [(k, words(n, 8000 + k, 300)) for k, n in enumerate([30, 30, 12, 9, 7, 5, 3, 45])] + [(None, words(20, 8100, 300))]
    edits = {
        "changed": lambda w, rate: [x if rng.random() > rate else rng.choice(words(1, rng.random(), 300)) for x in w],
        "deleted": lambda w, rate: [x for x in w if rng.random() > rate],
        "inserted": lambda w, rate: [y for x in w for y in ([x] if rng.random() > rate else [x, words(1, rng.random(), 300)[0]])],
        "inflected": lambda w, rate: [x if rng.random() > rate else x + "ing" for x in w],
    }
    texts = [words(rng.randrange(20), 9000, 300) + edit(w, rate) + words(rng.randrange(30), 9001, 300)
             for edit in edits.values() for rate in (0.1, 0.2, 0.35, 0.6) for _, w in items for _ in range(2)]
    docs = docs_of(spark, [(i, " ".join(t), "s") for i, t in enumerate(texts)])
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.score for r in decontam.contaminated(docs, bench).collect()}
    want = {(i, k): s for i, t in enumerate(texts) for k, w in items
            if (s := brute_align(w, t, how)) * how.same * len(w) >= decontam.least_points(len(w), how) - 1e-9}
    assert got == pytest.approx(want) and len(want) > 150


def test_decontamination_of_regular_edits(spark):
    items = [words(30, 8200 + k) for k in range(40)]
    edits = [lambda w: ["other" if i % 3 == 2 else x for i, x in enumerate(w)], lambda w: [x for i, x in enumerate(w) if i % 3 != 2],
             lambda w: [y for i, x in enumerate(w) for y in ([x, "more"] if i % 2 else [x])], lambda w: [y for x in w for y in (x, "more")]]
    rows = [(100 * e + k, " ".join(words(20, k) + edit(w) + words(20, 60 + k)), "s") for e, edit in enumerate(edits) for k, w in enumerate(items)]
    docs = docs_of(spark, rows)
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)], "item_id long, text string")
    assert sorted((r.doc_id, r.item_id) for r in decontam.contaminated(docs, bench).collect()) == sorted((i, i % 100) for i, *_ in rows)


def test_frequent_pairs_are_no_seeds(spark):
    usual, rare = words(6, 8301), words(12, 8302)
    docs = docs_of(spark, [(i, " ".join(words(5, i) + usual), "s") for i in range(50)])
    bench = spark.createDataFrame([(1, " ".join(rare[:6] + usual + rare[6:]))], "item_id long, text string")
    seeds = decontam.find_seeds(decontam._blocks(bench, decontam.Settings(), "item_id", "text")[0], docs.select("text"), decontam.Settings())
    h, first, *_ = decontam.heads(pa.array([" ".join(usual)]), decontam.Settings())
    assert not len(seeds["keys"].find(decontam.pairs(h, first, 1)[0][1:4])[0])
    assert decontam.contaminated(docs, bench).count() == 0


def test_alignment_holds_rows_only():
    import tracemalloc

    item, text = words(2000, 8401), words(8000, 8402)
    tracemalloc.start()
    decontam.align(item, text[:3000] + item + text[3000:], decontam.Settings())
    assert tracemalloc.get_traced_memory()[1] < 20 << 20
    tracemalloc.stop()


def test_seeds_are_equal_where_the_plain_words_are():
    marks, rng = decontam.PUNCTUATION, random.Random(4)
    for _ in range(200):
        w = [rng.choice(["É", "Σ", "aΣ", "İx", "ß", "Ab", "日", "x-y", "", "#"]) for _ in range(6)]
        raw = [rng.choice(marks) * rng.randrange(3) + x + rng.choice(marks) * rng.randrange(3) or "-" for x in w]
        data, off = decontam.folded(pa.array([" ".join(raw)]))
        starts, ends, _ = textnum.words(data, off)
        a, b, lone = decontam.trimmed(data, starts, ends)
        assert [data.tobytes()[s:e].decode().lower() for s, e in zip(a, b)] == [decontam.plain(x) for x in raw]
        assert lone.tolist() == [not x.strip(marks) for x in raw]


def test_no_alignment_scores_more_than_its_bound():
    how, rng = decontam.Settings(), random.Random(3)
    for k in range(60):
        item, text = words(rng.randint(1, 15), k, 12), words(rng.randint(1, 30), 100 + k, 12)
        assert decontam.most(item, text, how) >= brute_align(item, text, how)


# ---- 4 -----------------------------------------------------------------------------------


def test_archives_come_back_whole(spark):
    long = "ü" * 300_000
    rows = [(1, "http://a/1", "x" * 200), (2, None, "x" * 200), (2, "http://a/2", "x" * 200), (3, "http://a/ b\r\nc", "short"), (4, "u", "short"),
            (5, "u", None), (6, "u", ""), (7, "u", "\r\n\r\nWARC/1.1\r\n\r\n" * 20), (None, "u", "x" * 200), (None, "u", long), (8, "u", long),
            (9, "u", "y" * 100), (9, "u", "y" * 100), (10, "u", "z" * 99), (11, "u", "z" * 99)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit(1)).repartition(3)
    got = collections.Counter(map(tuple, warc.archive_round_trip(pages).collect()))
    least = {}
    for i, _, h in rows:
        if i is not None:
            least[h] = min(least.get(h, i), i)
    want = collections.Counter()
    for i, _, h in rows:
        body = (h or "").encode()
        first = least.get(h) if len(body) >= 100 else None
        again = first is not None and first != i
        want[i, len(body), hashlib.sha256(body).hexdigest(), "revisit" if again else "response", first if again else None] += 1
    assert got == want
    assert warc.archive_round_trip(pages.limit(0)).count() == 0


def test_payloads_shuffle_by_page_and_digest(spark):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    pages = spark.createDataFrame([(i, "u", "x" * 200) for i in range(50)], "page_id long, url string, html string")
    plan = warc.page_records(pages)._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    wide = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert any("page_id" in line and "digest" in line for line in wide) and not any("hashpartitioning(digest" in line for line in wide)


def test_normaliser_makes_members_with_an_index(spark, tmp_dir):
    pages = spark.createDataFrame([(i, f"http://h/{i}", f"body {i} " * 50) for i in range(20)], "page_id long, url string, html string")
    warc.write_monolithic(warc.page_records(pages.coalesce(1)), f"{tmp_dir}/in")
    index = warc.normalise(spark, f"{tmp_dir}/in", f"{tmp_dir}/out").collect()
    assert len(index) == 20 and len({r.file for r in index}) == 1
    path = index[0].file
    data = open(path, "rb").read()
    lines = open(path + ".idx").read().splitlines()
    assert len(lines) == 20 and sum(r.length for r in index) == len(data)
    for r in index:
        one = gzip.decompress(data[r.offset:r.offset + r.length])  # any record by itself
        assert one.startswith(b"WARC/1.1\r\nWARC-Type: response") and f"body {r.page_id} ".encode() in one
    assert b"".join(gzip.decompress(data[r.offset:r.offset + r.length]) for r in sorted(index, key=lambda r: r.offset)) == gzip.decompress(data)


def test_damaged_archives_raise():
    import io

    whole = gzip.compress(b"WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" * 3)
    assert len(list(warc.records(warc.inflated(io.BytesIO(whole), 7)))) == 3
    assert len(list(warc.records(warc.inflated(io.BytesIO(whole + whole), 7)))) == 6  # many members are read as well
    with pytest.raises(EOFError):
        list(warc.records(warc.inflated(io.BytesIO(whole[:-12]), 7)))
    with pytest.raises(ValueError):
        list(warc.records([b"WARC/1.1\r\nContent-Length: 2\r\n\r\nabc\r\n\r\n"]))


# ---- 6 -----------------------------------------------------------------------------------


def test_cells_let_near_points_meet_once():
    rng = np.random.default_rng(6)
    for axes in (1, 2, 3):
        x, budget = rng.uniform(-1, 1, (400, axes)), 0.02
        rows, codes, home = embedding_join.cells(x, budget)
        at_home = dict(zip(rows[home].tolist(), codes[home].tolist()))
        places = set(zip(rows.tolist(), codes.tolist()))
        assert len(at_home) == len(x) and len(places) == len(rows)
        d = ((x[:, None] - x[None]) ** 2).sum(axis=2)
        for a, b in zip(*np.nonzero(np.triu(d <= budget, 1))):
            assert (at_home[a] == at_home[b]) or (((a, at_home[b]) in places) != ((b, at_home[a]) in places))


def test_cells_leave_half_of_the_pairs():
    """In a block of the whole table's vectors, labels pooled, each pair met once (one coordinate alone: 0.83, from both sides)."""
    import pyarrow.parquet as pq

    lists = pq.read_table("/root/testdata/sf0.1/embeddings.parquet").column("embedding").combine_chunks()
    v = embedding_join._unit(np.stack([np.array(x, float) for x in lists.to_pylist() if x and None not in x and np.isfinite(x).all() and any(x)]))
    turned = v @ embedding_join.rotation(v.shape[1])
    for part, budget in embedding_join.block_budgets(v.shape[1], 0.93):
        _, codes, home = embedding_join.cells(turned[:, part][:, : embedding_join.AXES], budget)
        own, n = np.unique(codes[home], return_counts=True)
        there, m = np.unique(codes[~home], return_counts=True)
        met = (n * (n - 1) // 2).sum() + (n[np.searchsorted(own, there[np.isin(there, own)])] * m[np.isin(there, own)]).sum()
        assert met < 0.6 * len(v) * (len(v) - 1) / 2


def test_embedding_join_equals_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(30, 16))
    vecs = [v for b in base for v in (b, b, 3 * b, b + 0.25 * rng.normal(size=16), b + 0.45 * rng.normal(size=16))]
    rows = [(i, [float(x) for x in v], int(i % 2)) for i, v in enumerate(vecs)]
    rows += [(900, None, 0), (901, [], 0), (902, [0.0] * 16, 0), (903, [float("nan")] * 16, 0), (904, [None] * 16, 0), (905, rows[0][1], None),
             (906, [1.0, 2.0], 0), (907, [2.0, 4.0], 0), (None, rows[0][1], 0), (0, rows[0][1], 0), (908, [1e200] * 16, 1), (909, [1e-200] * 16, 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("v", F.lit(1)).withColumn("cls", F.lit(1))
    ok = [k for k, (_, v, lab) in enumerate(rows) if lab is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    links, root = collections.Counter(), list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in ok:
        for b in ok:
            if a < b and rows[a][2] == rows[b][2] and len(rows[a][1]) == len(rows[b][1]):
                x, y = (np.array(rows[k][1]) / np.abs(rows[k][1]).max() for k in (a, b))
                if x @ y / math.sqrt((x @ x) * (y @ y)) >= 0.93:
                    links[a] += 1
                    links[b] += 1
                    root[find(a)] = find(b)
    least = {}
    for k in ok:
        if rows[k][0] is not None:
            least[find(k)] = min(least.get(find(k), 10**9), rows[k][0])
    want = collections.Counter()
    for k, (i, _, _) in enumerate(rows):
        c = least.get(find(k), i) if k in ok else i
        want[i, links[k], c, i is not None and i == c] += 1
    assert collections.Counter(map(tuple, embedding_join.embedding_components(df).collect())) == want
    monkeypatch.setattr(embedding_join, "CHUNK", 7)  # hot slabs cut into chunks
    assert collections.Counter(map(tuple, embedding_join.embedding_components(df).collect())) == want
    assert embedding_join.embedding_components(df.limit(0)).count() == 0


# ---- 7 -----------------------------------------------------------------------------------


def test_mix_meets_its_targets(spark):
    rng, rows = random.Random(8), []
    for i in range(600):
        src = None if i % 50 == 0 else "hot" if i % 3 == 0 else f"s{i % 7}"
        rows.append((i, " ".join(["w"] * rng.randint(0, 60)), src))
    rows += [(1, "a b c", "s1"), (1, "a b c", "s1"), (None, "x y", "s1"), (2000, None, "s2"), (2001, "w " * 4000, "s2")]
    docs = docs_of(spark, rows, ("size", "target", "_key", "position"))
    got = curriculum.plan_mix(docs).collect()
    assert len(got) == len(rows) and sorted(map(repr, got)) == sorted(map(repr, curriculum.plan_mix(docs.repartition(5)).collect()))
    size = collections.Counter()
    for _, t, s in rows:
        size[s] += len((t or "").split())
    names = sorted((s for s in size if s is not None)) + [None]
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    budget, target, free = 1.5 * sum(size.values()), {}, set(names)
    while free:  # reshare what is over until none is above
        level = (budget - sum(target.values())) / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > 2 * size[s]}
        if not over:
            target |= {s: level * weight[s] for s in free}
            break
        target |= {s: 2.0 * size[s] for s in over}
        free -= over
    taken = collections.Counter()
    for r in got:
        assert r.target == pytest.approx(target[r.mix_source]) and r.source_size == size[r.mix_source]
        assert 0 <= r.taken <= 2 * r.size and r.taken == r.size * len(r.uses)
        assert all(0 <= u.position <= 1 for u in r.uses)
        taken[r.mix_source] += r.taken
    largest = max(r.size for r in got)
    assert all(abs(taken[s] - target[s]) <= largest / 2 + 1 for s in names)
    order = [r.position for r in curriculum.training_stream(curriculum.plan_mix(docs)).collect()]
    assert order == sorted(order) and len(order) == sum(len(r.uses) for r in got)
    assert curriculum.plan_mix(docs.limit(0)).count() == 0


def test_positions_invert_the_schedule(spark):
    for start, end in ((1.5, 0.5), (1.0, 1.0), (0.0, 2.0), (2.0, 0.0)):
        df = spark.range(11).select((F.col("id") / 10).alias("p"))
        for r in df.select("p", curriculum.invert_ramp(F.col("p"), F.lit(start), F.lit(end)).alias("u")).collect():
            if r.u is not None:
                assert (start * r.u + (end - start) * r.u**2 / 2) / ((start + end) / 2) == pytest.approx(r.p)


# ---- 8 -----------------------------------------------------------------------------------


def shingle_set(text):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))))
    return frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute_components(rows):
    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            k = len(sets[a] & sets[b])
            if k and 100 * k >= 75 * (len(sets[a]) + len(sets[b]) - k):
                root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(least.get(find(k), 10**9), i)
    return collections.Counter((i, len(sets[k]), least.get(find(k)) if sets[k] else i) for k, (i, _) in enumerate(rows))


def edited(text, rng, n):
    w = text.split()
    for _ in range(n):
        w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
    return " ".join(w)


def jaccard_rows():
    rng, rows = random.Random(11), []
    common = " ".join(words(30, 1))
    for g in range(12):
        base = " ".join(words(rng.choice([6, 20, 60, 150, 400]), 100 + g))
        rows += [(len(rows) + k, edited(base, rng, rng.randint(0, max(1, len(base.split()) // 25)))) for k in range(8)]
    rows += [(len(rows) + k, " ".join(words(rng.randint(30, 120), 700 + k)) + " " + common) for k in range(20)]
    chain = " ".join(words(200, 9)).split()
    rows += [(len(rows) + k, " ".join(chain[k * 10:k * 10 + 100])) for k in range(10)]
    return rows + [(500, None), (501, ""), (502, " \t"), (503, "one two"), (504, "ONE two"), (505, "one  two\n"), (506, "two one"), (None, rows[0][1]),
                   (0, rows[0][1]), (None, "all by itself here now ok"), (507, "z " * 3000)]


def test_jaccard_components_equal_brute_force(spark, monkeypatch):
    rows = jaccard_rows()
    docs = docs_of(spark, [(i, t, "s") for i, t in rows], ("cls", "k", "block", "bucket")).repartition(3)
    want = brute_components(rows)
    got = lambda: collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(docs).collect())
    assert got() == want
    monkeypatch.setattr(jaccard_join, "CHUNK", 300)  # blocks cut into chunks, searched pair by pair
    monkeypatch.setattr(jaccard_join, "FLUSH", 100)
    assert got() == want
    assert jaccard_join.jaccard_components(docs.limit(0)).count() == 0


def test_one_of_each_group_stays(spark):
    rows = jaccard_rows()
    docs = docs_of(spark, [(i, t, "s") for i, t in rows], ("cls", "component"))
    kept = jaccard_join.one_of_each(docs)
    assert kept.columns == docs.columns
    got = collections.Counter(r.doc_id for r in kept.collect())
    comps = brute_components(rows)
    want = {c for i, n, c in comps if n} | {500, 501, 502}
    assert set(got) == want and max(got.values()) == 1


def test_divide_skip_search_equals_counting():
    rng = np.random.default_rng(7)
    sets = [np.unique(rng.choice(60, rng.integers(1, 50)).astype(np.uint64)) for _ in range(60)]
    index = jaccard_join.Index(sets, jaccard_join.Threshold())
    for q in range(60):
        for need in (1, 3, 10, 25):
            found, count = index.search(q, need)
            want = {b: len(np.intersect1d(sets[q], sets[b])) for b in range(60) if b != q}
            assert dict(zip(found.tolist(), count.tolist())) == {b: n for b, n in want.items() if n >= need}


def test_clustering_loses_no_link():
    """Chains, where what a search covers has further partners of its own."""
    how, rng = jaccard_join.Threshold(), np.random.default_rng(9)
    for trial in range(15):
        line = rng.choice(10**6, 400, replace=False).astype(np.uint64)
        sets = [np.sort(line[a:a + 60]) for a in rng.integers(0, 340, 40)]
        root = list(range(len(sets)))

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for a in range(len(sets)):
            for b in range(a):
                if how.linked(len(np.intersect1d(sets[a], sets[b])), len(sets[a]), len(sets[b])):
                    root[max(find(a), find(b))] = min(find(a), find(b))
        assert jaccard_join.cluster(sets, how).tolist() == [find(i) for i in range(len(sets))]


def test_components_that_do_not_settle_are_an_error(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(60)], "a long, b long")
    with pytest.raises(RuntimeError):
        components.connected_components(chain, limit=1)


def test_components_of_chains_stars_and_loops(spark):
    edges = [(k, k + 1) for k in range(60)] + [(100, k) for k in range(101, 140)] + [(200, 200), (None, 3), (300, 301), (301, 300), (300, 301)]
    got = dict(components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {k: 0 for k in range(61)} | {k: 100 for k in range(100, 140)} | {300: 300, 301: 300}


# ---- 9 -----------------------------------------------------------------------------------


def sentences(n, seed):
    w, rng, out = words(n, seed), random.Random(seed), []
    while w:
        k = rng.randint(4, 14)
        out.append(" ".join([w[0].capitalize(), *w[1:k]]) + ".")
        w = w[k:]
    return " ".join(out)


def test_patience_aligns_in_order():
    assert line_align.patience(list("abcd"), list("abcd")) == [(k, k) for k in range(4)]
    assert line_align.patience(list("xaybz"), list("paqbr")) == [(1, 1), (3, 3)]
    assert line_align.patience(list("aab"), list("caab")) == [(0, 1), (1, 2), (2, 3)]
    assert line_align.patience([], list("a")) == []
    rng = random.Random(6)
    for _ in range(200):
        x, a = ([rng.randrange(8) for _ in range(rng.randint(0, 14))] for _ in range(2))
        out = line_align.patience(x, a)
        assert all(x[i] == a[j] for i, j in out) and all(p[0] < q[0] and p[1] < q[1] for p, q in zip(out, out[1:]))


def test_passages_leave_the_later_documents(spark):
    passage, lead = sentences(70, 1), sentences(60, 2)
    own = {k: sentences(150, 50 + k) for k in range(40)}
    rows = [(0, own[0] + "\n" + passage + "\n" + own[1], "s"), (1, own[2] + "\n" + passage, "s"),
            (2, own[3].rstrip(".") + " " + passage + " " + own[4], "s"), (3, own[0] + "\n" + passage + "\n" + own[1], "s"),
            (4, passage + " " + own[5] + " " + passage, "s"), (5, own[6], "s"), (6, None, None), (7, "", "s"), (8, "Short line.", "s"), (9, "Short line.", "s"),
            (None, own[7] + " " + lead, "s"), (10, lead, "s"), (10, lead + " " + own[8], "s"), (5, own[6], "s"), (11, sentences(9000, 77), "s")]
    docs = docs_of(spark, rows, ("removed_words", "k", "blocks")).repartition(4)
    out = line_align.dedup_lines(docs)
    assert set(out.columns) == set(docs.columns) | {"removed_words", "left_words"}
    got = collections.defaultdict(list)
    for r in out.collect():
        got[r.doc_id].append(r)
    clean = lambda s: " ".join((s or "").split())
    assert sum(map(len, got.values())) == len(rows)
    assert got[0][0].text == rows[0][1] and got[0][0].removed_words == 0  # the first holder keeps all
    assert clean(got[1][0].text) == clean(own[2])
    assert clean(got[2][0].text) == clean(own[3].rstrip(".") + " " + own[4])
    assert got[3][0].text == "" and got[3][0].left_words == 0  # a copy under a later id
    assert clean(got[4][0].text) == clean(own[5])
    assert [r.text for r in got[5]] == [own[6]] * 2 and got[6][0].text is None and got[7][0].text == ""
    assert got[8][0].text == got[9][0].text == "Short line."
    assert clean(got[None][0].text) == clean(own[7])  # null ids come last
    assert sorted(clean(r.text) for r in got[10]) in ([clean(lead), clean(own[8])], sorted([clean(own[8] and lead + " " + own[8]), ""]))
    assert got[11][0].removed_words == 0
    assert line_align.dedup_lines(docs.limit(0)).count() == 0


def test_line_dedup_equals_brute_force_on_sentences(spark):
    """Passages of whole lines between own lines: exactly the repeated ones go."""
    rng, rows, seen, want = random.Random(3), [], {}, {}
    pool = [[sentences(12, 9000 + 10 * p + k) for k in range(4)] for p in range(6)]
    for i in range(60):
        parts, keep = [], []
        for b in range(rng.randint(1, 4)):
            mine = sentences(40, 20_000 + 10 * i + b)
            parts.append(mine)
            keep.append(mine)
            if rng.random() < 0.5:
                p = rng.randrange(6)
                text = "\n".join(pool[p])
                parts.append(text)
                if seen.setdefault(p, i) == i:  # also a second time in its first holder
                    keep.append(text)
        rows.append((i, "\n".join(parts), "s"))
        want[i] = " ".join(" ".join(keep).split())
    got = {r.doc_id: " ".join(r.text.split()) for r in line_align.dedup_lines(docs_of(spark, rows)).collect()}
    assert got == want


def test_passages_in_paragraphs_without_sentence_ends_leave(spark):
    sizes = list(range(51, 101, 3))
    passages = [words(n, 30_000 + n) for n in sizes]
    rows = [(100 * d + i, " ".join(words(90, 31_000 + 100 * d + i) + p + words(80, 32_000 + 100 * d + i)), "s") for d in (0, 1) for i, p in enumerate(passages)]
    got = {r.doc_id: r for r in line_align.dedup_lines(docs_of(spark, rows).repartition(3)).collect()}
    for i, (n, p) in enumerate(zip(sizes, passages)):
        assert got[i].removed_words == 0
        left = got[100 + i].text.split()
        assert n - 2 * line_align.GREATEST < got[100 + i].removed_words <= n and left[:90] + left[-80:] == words(90, 31_100 + i) + words(80, 32_100 + i)


def test_no_line_is_longer_than_stated_and_other_scripts_sentences_end():
    texts = [" ".join(words(500, 1)), "q " * 300, "क ख ग। घ ङ", "أ ب؟ ت", "一 二。 三", None, ""]
    _, _, first, line, at, _ = line_align.lines_of(pa.array(texts))
    assert np.diff(line).max() <= line_align.GREATEST
    assert [np.diff(line[at[i] : at[i + 1] + 1]).tolist() for i in (2, 3, 4)] == [[3, 2], [2, 1], [2, 1]]
    rng = np.random.default_rng(1)
    for _ in range(50):
        v = rng.integers(0, 9, 40)
        want = {i + max(k for k in range(6) if v[i + k] == v[i : i + 6].min()) for i in range(35) if v[i : i + 6].min() > 0}
        assert set(line_align.least_of_windows(v, 6).tolist()) == want


def test_lines_are_aligned_again_only_where_a_run_may_be_left(monkeypatch):
    calls, patience = [], line_align.patience
    monkeypatch.setattr(line_align, "patience", lambda x, a: calls.append(1) or patience(x, a))
    whole = list(range(10))
    assert line_align.common_runs(whole, [5] * 10, whole, 24) == [(0, 10)] and len(calls) == 1  # before: two
    assert line_align.common_runs(whole, [5] * 10, [0, 1, 2, 3, 90, 6, 7], 24) == [] and len(calls) == 1  # before: aligned
    moved = [*range(5, 10), *range(5)]
    assert line_align.common_runs(whole, [5] * 10, moved, 24) == [(0, 5), (5, 10)] and len(calls) == 3


def test_stretches_of_many_texts_are_those_of_each():
    rng = np.random.default_rng(3)
    sizes = rng.integers(0, 30, 200)
    hashes, words = rng.integers(0, 2**63, sizes.sum(), dtype=np.uint64), rng.integers(1, 11, sizes.sum()).astype(np.uint16)
    first = np.r_[0, np.cumsum(sizes)]
    make = line_align.Stretches(line_align.Settings())
    place, token, count = make.of(hashes, words, first)
    apart = [make.of(hashes[a:b], words[a:b], np.array([0, b - a])) for a, b in zip(first[:-1], first[1:])]
    assert count.tolist() == [len(p) for p, _, _ in apart] and count.sum() == len(place) > 1000
    assert place.tolist() == [i for p, _, _ in apart for i in p.tolist()] and token.tolist() == [t for _, u, _ in apart for t in u.tolist()]


def test_one_hasher_serves_many_pieces():
    rng = random.Random(4)
    hasher = line_align.textnum.Hasher()
    for n in (3, 400, 90_000, 5):
        texts = pa.array(["".join(rng.choice(["word ", "Two. ", "x\n", "\n", "Äh ", "é! "]) for _ in range(n)), None, "", "One last"])
        for got, want in zip(line_align.lines_of(texts, hasher), line_align.lines_of(texts)):
            assert got.tolist() == want.tolist()
    assert len(hasher.powers) > 90_000


def test_passages_of_short_lines_leave(spark):
    w = words(60, 33_000)
    passage = " ".join(x.capitalize() if i % 2 == 0 else x for i, x in enumerate(w))  # lines of two words
    rows = [(i, sentences(60, 34_000 + i) + "\n" + passage + "\n" + sentences(60, 35_000 + i), "s") for i in range(3)]
    got = {r.doc_id: r.removed_words for r in line_align.dedup_lines(docs_of(spark, rows)).collect()}
    assert got == {0: 0, 1: 60, 2: 60}


def test_passages_leave_whose_long_lines_have_other_first_holders(spark):
    long = [" ".join(words(5, 36_000 + k)).capitalize() + "." for k in range(12)]
    short = [" ".join(words(2, 37_000 + k)).capitalize() + "." for k in range(13)]
    passage = " ".join(x for k in range(12) for x in (short[k], long[k])) + " " + short[12]
    rows = [(k, sentences(30, 38_000 + k) + "\n" + x + "\n" + sentences(30, 38_500 + k), "s") for k, x in enumerate(long)]
    rows += [(k, sentences(60, 39_000 + k) + "\n" + passage + "\n" + sentences(60, 39_500 + k), "s") for k in (20, 21)]
    got = {r.doc_id: r.removed_words for r in line_align.dedup_lines(docs_of(spark, rows)).collect()}
    assert got == {**dict.fromkeys(range(12), 0), 20: 0, 21: 86}


def test_stock_phrases_of_several_documents_are_not_added_up(spark):
    phrases = [" ".join(words(9, 51_000 + k)).capitalize() + "." for k in range(4)]
    rows = [(k, sentences(30, 52_000 + k) + "\n" + x + "\n" + sentences(30, 52_500 + k), "s") for k, x in enumerate(phrases)]
    rows += [(10, sentences(40, 53_000) + "\n" + " ".join(phrases) + "\n" + sentences(40, 53_500), "s")]
    rows += [(11, sentences(40, 54_000) + "\n" + " ".join(phrases) + "\n" + sentences(40, 54_500), "s")]  # a passage of the one before
    got = {r.doc_id: r.removed_words for r in line_align.dedup_lines(docs_of(spark, rows)).collect()}
    assert got == {**dict.fromkeys(range(4), 0), 10: 0, 11: 36}


def test_frequent_passages_are_led_inside_tasks(spark, monkeypatch):
    """However few postings a task gathers, the same goes, and a frequent passage has many holders."""
    passage = sentences(60, 55_000)
    rows = [(i, sentences(40, 56_000 + i) + "\n" + passage + "\n" + sentences(40, 57_000 + i), "s") for i in range(80)]
    docs = docs_of(spark, rows).repartition(4, "doc_id")
    want = {i: 60 if i else 0 for i in range(80)}
    for flush in (1, 300, 1_000_000):
        monkeypatch.setattr(line_align, "FLUSH", flush)
        got = {r.doc_id: r.removed_words for r in line_align.dedup_lines(docs).collect()}
        assert got == want
    pairs = line_align._pairs(line_align._units(docs, id_col="doc_id", text_col="text"), line_align.Settings())
    assert pairs.select("xk").distinct().count() == 79 and pairs.select("ak").distinct().count() == 4  # one of each task


def test_reserved_names_are_refused(spark):
    docs = docs_of(spark, [(0, "a b c", "s")])
    for name, operator in (("__key__", jaccard_join.one_of_each), ("__blocks__", line_align.dedup_lines)):
        with pytest.raises(ValueError, match=name):
            operator(docs.withColumn(name, F.lit(1)))


# ---- 10 ----------------------------------------------------------------------------------


def test_token_counts_are_the_librarys(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    rng = random.Random(12)
    texts = [None, "", " ", "a" * 3001, "  \n\n x \t", "<|endoftext|>a<|endoftext|><|endoftext|> b", "don't I'll we've", "日本語" * 50, "👍🏽" * 9, "\x00é",
             "0123456789 1 22 333", " " * 777, "!?" * 200] + ["".join(rng.choice("ab \n'sté1!𝄞.-") for _ in range(rng.randint(1, 200))) for _ in range(150)]
    docs = docs_of(spark, [(i, t, "s") for i, t in enumerate(texts)] + [(None, "x", "s"), (3, "x", "s")], ("n_tokens", "n_bytes")).repartition(3)
    library = Tokenizer.from_file(path)
    count = lambda t: len(library.encode(t or "", add_special_tokens=False).ids)
    got = collections.Counter(map(tuple, token_counts.count_tokens(docs, path).collect()))
    want = collections.Counter((r.doc_id, len((r.text or "").encode()), count(r.text), count(r.text) > 512) for r in docs.collect())
    assert got == want
    assert token_counts.count_tokens(docs.limit(0), path).count() == 0
    with pytest.raises(ValueError):
        token_counts.load_byte_bpe(public_tokenizers.path("word_bpe_49k.json"))
