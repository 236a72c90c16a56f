"""Spelling groups against all pairs of words, and the choice of pivots against all choices."""

import collections
import itertools
import random
import re
import zlib

from tests.llm.test_llm_operators import docs_of
from trendlake.llm import spelling


def one_apart(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute_words(rows):
    n = collections.Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= 6 and k >= 5}


def brute_groups(rows):
    n = brute_words(rows)
    near = {w: [v for v in n if one_apart(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out)


def corpus():
    rng = random.Random(11)
    base = ["".join(rng.choice("abcdeéÿß×") for _ in range(rng.randint(6, 9))) for _ in range(40)] + ["aaaaaa", "aaaaaaa", "ababab", "babbab"]
    words = ["spellinga"] * 6 + ["spelling"] * 50 + ["spellin"] * 400  # a form of a form
    for w in base:
        often = rng.choice([1, 6, 40, 300])
        words += [w] * often
        for _ in range(rng.randrange(6)):
            i = rng.randrange(len(w))
            words += [rng.choice([w[:i] + w[i + 1 :], w[:i] + "e" + w[i:], w[:i] + rng.choice("aÉz") + w[i + 1 :]])] * rng.choice([1, 5, 7, 30])
    rng.shuffle(words)
    cuts = [words[i : i + 50] for i in range(0, len(words), 50)]
    seps = [" ", "-", "1", "\n", "Ā", "日"]
    rows = [(k, "".join(x.upper() + rng.choice(seps) if rng.random() < 0.2 and x.isascii() else x + rng.choice(seps) for x in c)) for k, c in enumerate(cuts)]
    return rows + [(None, None), (9000, ""), (9001, "1 2 3"), (None, rows[0][1]), (3, rows[3][1]), (3, rows[3][1]), (9002, "İstanbul " * 5 + "kelvinK " * 6)]


def test_groups_are_those_of_all_pairs(spark):
    rows = corpus()
    docs = docs_of(spark, [(i, t, None) for i, t in rows], ("word", "n", "form", "gram"))
    got = spelling.spelling_groups(docs)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(tuple(r) for r in got.collect()) == (want := brute_groups(rows))
    assert any(w[1] and w[2] != w[1] for w in want) and sum(w[1] is not None for w in want) > 10  # forms of forms too
    assert spelling.spelling_groups(docs.limit(0)).count() == 0


def test_long_texts_are_read_whole_in_pieces():
    rng = random.Random(3)
    text = " ".join("".join(rng.choice("abÀ") for _ in range(rng.randint(1, 12))) for _ in range(2000)) + "x" * 500
    for piece in (7, 64, 10**6):
        got = sum(spelling.read_words(5, text, 6, piece), collections.Counter())
        want = brute_words([(5, text)] * 5)
        assert {w: 5 * n for w, n in got.items()} == want


def test_near_words_are_complete(spark):
    rng = random.Random(2)
    words = {"".join(rng.choice("ab") for _ in range(rng.randint(6, 9))) for _ in range(300)}
    words |= {"".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(600)}
    got = {tuple(r) for r in spelling.near_words(spark.createDataFrame([(w,) for w in words], "word string")).collect()}
    assert got == {(a, b) for a, b in itertools.permutations(words, 2) if one_apart(a, b)}


def test_pivots_are_the_rarest_disjoint_bigrams():
    rng = random.Random(1)
    for _ in range(300):
        grams = [(p, rng.randrange(1, 9)) for p in sorted(rng.sample(range(12), rng.randint(3, 7)))]
        chosen = spelling.pivots(grams)
        pairs = [(x, y) for x, y in itertools.combinations(grams, 2) if y[0] - x[0] >= 2]
        assert grams[chosen[1]][0] - grams[chosen[0]][0] >= 2
        assert sum(grams[k][1] for k in chosen) == min(x[1] + y[1] for x, y in pairs)


def test_near_words_never_meet_in_a_cross_join(spark):
    plan = spelling.near_words(spark.createDataFrame([("abcdef",), ("abcdeg",)], "word string"))._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
