"""Words grouped with their likeliest spelling, one edit apart, by pivotal grams.

Of two words that one edit separates, the edit can spoil only one of two disjoint
bigrams of either word.  So each word chooses two disjoint bigrams as pivots, by
dynamic programming the two that are rarest among its first three in a global order
of bigrams, and the word whose first three end earlier in that order has a pivot among
the first three of the other (the pivotal prefix filter of Deng, Li and Feng, 2014).
Pivots are joined to these prefixes on the bigram, its position and the word's length,
which one edit moves by one at most, and what remains is verified.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendlake.llm.common import cut, prepare

# The letters of a word, once A-Z are lower-cased, and what ends one.
RUN = re.compile("[a-zÀ-ÿ]+")
NO_LETTER = re.compile("[^a-zÀ-ÿ]")
#: A run whose checksum this divides loses a letter.
EVERY = 199


@dataclass(frozen=True)
class Settings:
    least_length: int = 6
    least_count: int = 5
    times: int = 5             # a form is at least so many times as frequent
    piece: int = 1 << 20       # code points of a text that are read at once
    memory: int = 200_000      # words that a task counts before it hands the counts on


def read_words(doc_id, text: str, least_length: int, piece: int) -> Iterator[Counter]:
    """How often each word is in a text, piece by piece; single letters are lost by checksum."""
    before = zlib.crc32(("" if doc_id is None else f"{doc_id}").encode() + b":")
    low = text.encode("utf-8", "replace").lower().decode("utf-8")  # of bytes, lower() changes A-Z only
    at = 0
    while at < len(low):
        end = at + piece
        if end < len(low):
            cut_at = NO_LETTER.search(low, end)
            end = cut_at.start() if cut_at else len(low)
        out = Counter()
        for run, n in Counter(RUN.findall(low, at, end)).items():
            h = zlib.crc32(run.encode(), before)
            if h % EVERY == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            if len(run) >= least_length:
                out[run] += n
        yield out
        at = end


def vocabulary(docs: DataFrame, settings: Settings = Settings(), *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, n`` of all words that are long and frequent enough in all whole texts."""

    def run(batches) -> Iterator:
        import pyarrow as pa

        def rows(seen: Counter):
            return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["word", "n"])

        seen = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                for part in read_words(doc_id, text.as_py(), settings.least_length, settings.piece):
                    seen.update(part)
                    if len(seen) > settings.memory:  # partial sums; Spark adds them up
                        yield rows(seen)
                        seen.clear()
        yield rows(seen)

    given = docs.select(F.col(id_col).cast("string"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    return given.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= settings.least_count)


def pivots(grams: list[tuple[int, int]]) -> list[int]:
    """Places, in a list of ``(position, weight)`` by position, of two disjoint bigrams of least
    weight in sum (ties: the first found). ``best[j]`` is the cheapest choice of j disjoint
    bigrams so far; a bigram takes its own letter and the next."""
    best: list[list[tuple[int, list[int]]]] = []  # [i][j] after the first i bigrams
    best.append([(0, []), (math.inf, []), (math.inf, [])])
    for i, (position, weight) in enumerate(grams):
        apart = next((k for k in range(i, 0, -1) if grams[k - 1][0] + 2 <= position), 0)  # bigrams that end before this one
        row = []
        for j in range(3):
            skip = best[i][j]
            take = (best[apart][j - 1][0] + weight, [*best[apart][j - 1][1], i]) if j else (math.inf, [])
            row.append(take if take[0] < skip[0] else skip)
        best.append(row)
    return best[-1][2][1]


def signature(word: str, order: dict[str, tuple[int, int]]) -> tuple[int, list[tuple[int, int, bool]]]:
    """The rank that the word's prefix ends with, and the prefix: ``(rank, position, is pivot)``.

    ``order`` has a bigram's rank and frequency. The prefix is the three bigrams of least rank; those
    that equal the last of them belong to it too, so that no equal bigram is left out.
    """
    grams = sorted((*order[word[i : i + 2]], i) for i in range(len(word) - 1))
    last = grams[min(2, len(grams) - 1)][0]
    prefix = sorted((i, n, rank) for rank, n, i in grams if rank <= last)
    chosen = set(pivots([(i, n) for i, n, _ in prefix]))
    return last, [(rank, i, k in chosen) for k, (i, _, rank) in enumerate(prefix)]


def letters(word: str) -> int:
    """The letters of a word as bits: one edit changes two of them at most."""
    bits = 0
    for c in word:
        bits |= 1 << ord(c) % 63
    return bits


def near_words(words: DataFrame, word_col: str = "word") -> DataFrame:
    """``a, b`` in both directions: all pairs of different words that one inserted, deleted or
    replaced code point separates. ``words`` are distinct, not null and of at least four letters
    (three bigrams); the alphabet bounds the order of bigrams, which is sent to all tasks."""
    spark = words.sparkSession
    words = words.select(F.col(word_col).alias("word"))
    gram = F.explode(F.expr("transform(sequence(1, char_length(word) - 1), i -> substring(word, i, 2))")).alias("gram")
    counts = words.select(gram).groupBy("gram").agg(F.count(F.lit(1)).alias("n")).collect()  # at most letters squared
    order = spark.sparkContext.broadcast({g: (k, n) for k, (n, g) in enumerate(sorted((r["n"], r["gram"]) for r in counts))})

    def sign(batches) -> Iterator:
        import pyarrow as pa

        shape = pa.list_(pa.struct([("gram", pa.int32()), ("place", pa.int32()), ("pivot", pa.bool_())]))
        for batch in batches:
            signed = [signature(w, order.value) for w in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([letters(w) for w in batch.column(0).to_pylist()], pa.int64()), pa.array([s[0] for s in signed], pa.int32()),
                pa.array([[dict(zip(("gram", "place", "pivot"), g)) for g in s[1]] for s in signed], shape)], names=["word", "bits", "last", "prefix"])

    signed = cut(words.mapInArrow(sign, "word string, bits long, last int, prefix array<struct<gram: int, place: int, pivot: boolean>>"), "signatures")
    signed = signed.select("word", "bits", "last", F.char_length("word").alias("len"), F.explode("prefix").alias("g"))
    prefix = signed.select("g.gram", "g.place", "len", F.col("word").alias("b"), F.col("last").alias("last_b"), F.col("bits").alias("bits_b"))
    # where an unspoilt bigram stands in a word of the same length, one longer or one shorter
    moves = F.array(*[F.struct(F.lit(d).alias("len"), F.lit(p).alias("place")) for d, p in ((0, 0), (1, 0), (1, 1), (-1, 0), (-1, -1))])
    pivot = signed.where("g.pivot").withColumn("move", F.explode(moves)).select(
        "g.gram", (F.col("g.place") + F.col("move.place")).alias("place"), (F.col("len") + F.col("move.len")).alias("len"),
        F.col("word").alias("a"), F.col("last").alias("last_a"), F.col("bits").alias("bits_a"))
    same = [pivot[c] == prefix[c] for c in ("gram", "place", "len")]
    near = (F.col("last_a") <= F.col("last_b")) & (F.bit_count(F.col("bits_a").bitwiseXOR(F.col("bits_b"))) <= 2) \
        & (F.levenshtein("a", "b", 1) == 1)  # verified inside the join; words that are not near leave no row
    condition = near
    for c in same:
        condition = condition & c
    one = pivot.join(prefix, condition).select("a", "b")
    return one.unionByName(one.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()


def _by_frequency(n: Column, word: Column) -> Column:
    """Orders structs so that the least has the greatest n and, of those, the smallest word."""
    return F.struct((-n).alias("minus_n"), word.alias("word"))


def spelling_groups(docs: DataFrame, settings: Settings = Settings(), *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every distinct word that is long and frequent enough.

    Null and empty texts have no words; long texts are read whole, in pieces that end between
    words; the id decides which runs lose a letter, and a null id counts as an empty one;
    repeated rows count again; equally frequent forms go by code point; other columns
    are not read; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    prepare(spark)
    words = cut(vocabulary(docs, settings, id_col=id_col, text_col=text_col), "words")
    near = cut(near_words(words), "near-words")
    other = words.select(F.col("word").alias("b"), F.col("n").alias("n_b"))
    best = near.join(other, "b").groupBy(F.col("a").alias("word")).agg(
        F.count(F.lit(1)).alias("n_near"), F.min(_by_frequency(F.col("n_b"), F.col("b"))).alias("best"))
    formed = words.join(best, "word", "left").withColumn("form_n", -F.col("best.minus_n"))
    is_form = F.coalesce(F.col("form_n") >= settings.times * F.col("n"), F.lit(False))
    formed = cut(formed.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                               F.when(is_form, F.col("best.word")).alias("form"), F.when(is_form, F.col("form_n")).alias("form_n")), "forms")

    # a form is `times` times as frequent as its word, so the greatest count bounds the way to a root;
    # each round doubles the way that is known
    steps = cut(formed.where("form is not null").select("word", F.col("form").alias("to")), "steps-0")
    most = formed.agg(F.max("n")).first()[0] or settings.least_count
    longest = max(int(math.log(most / settings.least_count, settings.times)) + 1, 1)
    for k in range(math.ceil(math.log2(longest))):
        further = steps.select(F.col("word").alias("to"), F.col("to").alias("next"))
        steps = cut(steps.join(further, "to", "left").select("word", F.coalesce("next", "to").alias("to")), f"steps-{k + 1}")
    return formed.join(steps, "word", "left").select("word", "form", F.coalesce("to", "word").alias("root"), "n", "n_near", "form_n")
