"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Seeds are pairs of near words (2-grams and skip-grams) of the test items, compared by
the words' first letters. How often the corpus holds each is counted over all rows; an
item keeps those over its rarest steps, so many that every passage that scores the
threshold must hold some: what frequency leaves out never loses a copy (see
``find_seeds``). The seeds join passages to items; where those within a copy's reach are
worth enough, the passage is aligned with the item word by word: equal words score,
words of the same beginning score less, changed and inserted words cost. The score is
in parts of the item's score against itself.

Items go to all tasks in blocks of a stated size, so nothing that is broadcast grows
with the corpus or beyond the block; texts never shuffle, counts are summed before they do.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendlake.llm import textnum
from trendlake.llm.common import pieces

PUNCTUATION = "\"'`.,;:!?()[]{}<>«»¿¡*-_…“”‘’"


@dataclass(frozen=True)
class Settings:
    letters: int = 4          # that words of the same beginning share
    same: float = 2.0         # score of equal words
    near: float = 1.0         # of words of the same beginning
    other: float = -1.0       # of different words
    gap: float = -1.0         # of a word without a partner
    threshold: float = 0.4    # least part of an item's own score
    least: float = 14.0       # least score, or the item's own if that is lower: short items must be copied (nearly) whole
    least_words: int = 3      # items of fewer words say nothing and are not searched
    seed_part: float = 0.5    # of what a copy needs, the part that must come from rare steps
    block_bytes: int = 4 << 20  # of item texts that are matched at a time

    @property
    def cost(self) -> float:
        return min(-self.other, -self.gap)

    @property
    def reach(self) -> int:
        """Longer steps between matched words cost as much as the next match brings."""
        return max(1, math.ceil(self.same / self.cost))


def folded(texts):
    """(bytes, offsets) of the texts; those with other than ASCII characters in lower case, as
    the hasher folds A-Z only."""
    import numpy as np

    data, offsets = textnum.buffers(texts)
    if not len(data) or data.max() < 0x80:
        return data, offsets
    raw = data.tobytes()
    parts = [raw[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
    parts = [x if x.isascii() else x.decode("utf-8", "surrogateescape").lower().encode("utf-8", "surrogateescape") for x in parts]
    return np.frombuffer(b"".join(parts), np.uint8), np.r_[0, np.cumsum([len(x) for x in parts])]


def trimmed(data, starts, ends):
    """(starts, ends, lone): the words without punctuation at their ends; a word of nothing
    else is lone and stays whole."""
    import numpy as np

    mark = np.zeros(256, bool)
    mark[[ord(c) for c in PUNCTUATION if ord(c) < 0x80]] = True
    out = mark[data]
    leads = {x: np.flatnonzero(data == x) for x in {c.encode()[0] for c in PUNCTUATION if ord(c) >= 0x80}}
    for code in (c.encode() for c in PUNCTUATION if ord(c) >= 0x80):
        at = leads[code[0]]
        at = at[at + len(code) <= len(data)]
        for k, x in enumerate(code):
            at = at[data[at + k] == x]
        out[(at[:, None] + np.arange(len(code))).ravel()] = True
    solid = np.r_[np.flatnonzero(~out), len(data)]
    a = solid[np.searchsorted(solid, starts)]
    lone = a >= ends
    b = np.where(lone, ends, solid[np.searchsorted(solid, ends) - 1] + 1)
    return np.where(lone, starts, a), b, lone


def heads(texts, how: Settings):
    """(hashes of the words' first letters, first word of each text + total, word starts, word
    ends, bytes), the words in the normal form of ``plain``."""
    import numpy as np

    data, offsets = folded(texts)
    starts, ends, first = textnum.words(data, offsets)
    a, b, _ = trimmed(data, starts, ends)
    if not len(data) or data.max() < 0x80:
        stop = a + how.letters
    else:  # letters, not bytes
        letter = np.r_[np.flatnonzero((data & 0xC0) != 0x80), np.full(how.letters, len(data))]
        stop = letter[np.searchsorted(letter, a) + how.letters]
    return textnum.Hasher(lower=True).ranges(data, a, np.minimum(stop, b)), first, starts, ends, data


def pairs(h, first, step: int):
    """(keys, first words) of the pairs of words ``step`` apart within a text."""
    import numpy as np

    text = np.repeat(np.arange(len(first) - 1, dtype=np.int32), np.diff(first))
    at = np.flatnonzero(text[:-step] == text[step:])
    return textnum.mixed(h[at] * np.uint64(0xD6E8FEB86659FD93) + h[at + step] * np.uint64(0xA0761D6478BD642F)), at


def plain(word: str) -> str:
    return word.lower().strip(PUNCTUATION) or word


def align(item: list[str], text: list[str], how: Settings) -> tuple[float, int, int]:
    """(score part, start, end): the best local alignment of the item with a part [start, end)
    of the text. Memory is a row of the text's length."""
    import numpy as np

    def codes(a: list[str], b: list[str]):
        names: dict[str, int] = {}
        return [np.array([names.setdefault(w, len(names)) for w in x]) for x in (a, b)]

    i1, t1 = codes([plain(w) for w in item], [plain(w) for w in text])
    i2, t2 = codes([plain(w)[: how.letters] for w in item], [plain(w)[: how.letters] for w in text])

    def best(i1, i2, t1, t2) -> tuple[float, int]:
        """Smith-Waterman by rows; a running maximum carries gaps along a row."""
        slope = how.gap * np.arange(len(t1))
        above, top, end = np.zeros(len(t1)), 0.0, 0
        for word, head in zip(i1.tolist(), i2.tolist()):
            row = np.where(t1 == word, how.same, np.where(t2 == head, how.near, how.other))
            here = np.maximum(np.maximum(np.r_[0, above[:-1]] + row, above + how.gap), 0)
            above = np.maximum(np.maximum.accumulate(here - slope) + slope, 0)
            j = int(above.argmax())
            if above[j] > top:
                top, end = float(above[j]), j
        return top, end

    top, end = best(i1, i2, t1, t2)
    _, back = best(i1[::-1], i2[::-1], t1[end::-1], t2[end::-1])
    return top / (how.same * len(item)), end - back, end + 1


def most(item: list[str], text: list[str], how: Settings) -> float:
    """No alignment of the item with the text scores a greater part: the words are compared
    in any order. Both are in plain form."""
    whole, begun = set(text), {w[: how.letters] for w in text}
    return sum(how.same if w in whole else how.near if w[: how.letters] in begun else 0.0 for w in item) / (how.same * len(item))


def least_points(n, how: Settings):
    """The score that a copy of an item of ``n`` words must reach."""
    import numpy as np

    own = how.same * np.asarray(n, float)
    return np.maximum(how.threshold * own, np.minimum(own, how.least))


class Keys:
    """Sorted pair keys with a bit table before the search."""

    def __init__(self, keys):
        import numpy as np

        self.keys = keys
        self.mask = np.uint64((1 << max(10, (16 * len(keys)).bit_length())) - 1)
        self.bits = np.zeros(int(self.mask) + 1, bool)
        self.bits[(keys & self.mask).astype(np.int64)] = True

    def find(self, wanted):
        """(indices of those wanted that are there, their indices here)"""
        import numpy as np

        maybe = np.flatnonzero(self.bits[(wanted & self.mask).view(np.int64)])
        at = np.minimum(np.searchsorted(self.keys, wanted[maybe]), len(self.keys) - 1)
        there = self.keys[at] == wanted[maybe]
        return maybe[there], at[there]


def pair_counts(texts: DataFrame, keys: Keys, how: Settings) -> dict[int, int]:
    """How often the texts (one column) hold each of the pairs, in all rows; summed in the
    tasks before the shuffle. There are no more results than pairs of a block of items."""
    sent = texts.sparkSession.sparkContext.broadcast(keys)

    def run(batches) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        total = np.zeros(len(sent.value.keys), np.int64)
        for batch in batches:
            column = batch.column(0).cast(pa.large_string())
            for a, b in pieces(pc.binary_length(column).fill_null(0).to_numpy(zero_copy_only=False)):
                h, first, *_ = heads(column.slice(a, b - a), how)
                for step in range(1, how.reach + 1):
                    total += np.bincount(sent.value.find(pairs(h, first, step)[0])[1], minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["pair", "n"])

    found = texts.mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    return {r["pair"]: r["n"] for r in found.collect()}


def find_seeds(block: DataFrame, texts: DataFrame, how: Settings) -> dict | None:
    """The items of a block and their seeds: pairs of words over the rarest steps.

    An alignment is a chain of matched words. A step from one to the next over ``d`` words of
    item or text, whichever is more, adds at most ``same - (d - 1) * cost``; so all that lifts a
    score above one word's are steps of at most ``reach`` words. Of each item as many of
    its most frequent steps are left out as can hold ``1 - seed_part`` of what a copy needs; so
    a copy always holds seeds worth the rest (``need``), and hits worth less are no copy.
    """
    import numpy as np
    import pyarrow as pa

    rows = sorted(((r["item"], r["text"]) for r in block.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))  # bounded by block_bytes
    if not rows:
        return None
    h, first, *_ = heads(pa.array([r[1] for r in rows]), how)
    n = np.diff(first)
    parts = []
    for step in range(1, how.reach + 1):
        key, at = pairs(h, first, step)
        parts.append(np.rec.fromarrays([key, at, np.full(len(at), step)], names="key,at,step"))
    seeds = np.concatenate(parts)
    item = np.repeat(np.arange(len(n)), n)
    seeds = seeds[n[item[seeds["at"]]] >= how.least_words]
    if not len(seeds):
        return None
    keys, where = np.unique(seeds["key"], return_inverse=True)
    counts = pair_counts(texts, Keys(keys), how)
    often = np.array([counts.get(k, 0) for k in range(len(keys))], np.int64)[where]

    usual = np.zeros(len(h))  # of the step from a word to the next, the counts of all pairs over it
    for k in range(how.reach):
        over = seeds["step"] > k
        np.add.at(usual, seeds["at"][over] + k, often[over])
    usual[first[1:][n > 0] - 1] = -1.0  # no step from an item's last word
    points = least_points(n, how)
    spare = np.maximum(0, np.floor((points - how.same) * (1 - how.seed_part) / how.same)).astype(np.int64)
    order = np.lexsort((-usual, item))
    rank = np.empty(len(h), np.int64)
    rank[order] = np.arange(len(h)) - first[item]
    rare = (rank >= spare[item]) & (usual >= 0)
    kept = np.zeros(len(seeds), bool)
    for k in range(how.reach):
        over = seeds["step"] > k
        kept[over] |= rare[seeds["at"][over] + k]
    seeds = np.sort(seeds[kept], order=["key", "at", "step"])
    keys, start = np.unique(seeds["key"], return_index=True)
    owner = item[seeds["at"]]
    return {
        "keys": Keys(keys), "start": np.r_[start, len(seeds)], "item": owner, "step": seeds["step"],
        "need": points - how.same - how.same * spare, "points": points,
        "window": (n + np.ceil((how.same * n - points) / -how.gap)).astype(np.int64),  # words that a copy can spread over
        "items": [[plain(w) for w in word_list(r[1])] for r in rows], "ids": [r[0] for r in rows],
    }


def word_list(text: str) -> list[str]:
    import pyarrow as pa

    data, offsets = textnum.buffers(pa.array([text]))
    starts, ends, _ = textnum.words(data, offsets)
    raw = data.tobytes()
    return [raw[s:e].decode("utf-8") for s, e in zip(starts.tolist(), ends.tolist())]


def candidates(h, first, seeds: dict, how: Settings) -> Iterator[tuple[int, int, list[list[int]]]]:
    """(text, item, spans of words) wherever the seeds within a copy's reach are worth enough."""
    import numpy as np

    at, item, worth = [], [], []
    for step in range(1, how.reach + 1):
        key, place = pairs(h, first, step)
        hit, s = seeds["keys"].find(key)
        many = seeds["start"][s + 1] - seeds["start"][s]
        which = np.repeat(seeds["start"][s], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        at.append(np.repeat(place[hit], many))
        item.append(seeds["item"][which])
        worth.append(how.same - (np.maximum(seeds["step"][which], step) - 1) * how.cost)
    at, item, worth = map(np.concatenate, (at, item, worth))
    if not len(at):
        return
    text = np.searchsorted(first, at, side="right") - 1
    wide = np.int64(len(h) + seeds["window"].max() + 1)
    line = (text * len(seeds["items"]) + item) * wide + at  # hits of a text and item side by side
    order = np.argsort(line, kind="stable")
    line, at, item, text = line[order], at[order], item[order], text[order]
    total = np.r_[0.0, np.cumsum(worth[order])]
    window = seeds["window"][item]
    enough = total[np.searchsorted(line, line, side="right")] - total[np.searchsorted(line, line - window)] >= seeds["need"][item] - 1e-9
    spans: list[list[int]] = []
    last = None
    for t, i, p, w in zip(*(x[enough].tolist() for x in (text, item, at, window))):
        if (t, i) != last:
            if spans:
                yield *last, spans
            last, spans = (t, i), []
        lo, hi = max(int(first[t]), p - w), min(int(first[t + 1]), p + w + how.reach)
        if spans and lo <= spans[-1][1]:
            spans[-1][1] = hi
        else:
            spans.append([lo, hi])
    if spans:
        yield *last, spans


def _near_misses(texts, seeds: dict, how: Settings) -> Iterator[tuple[int, int, float, int, int]]:
    """(text, item, score part, start word, end word) of the best passage of each item above
    the threshold in each text of an array."""
    h, first, starts, ends, data = heads(texts, how)
    raw = None
    for t, item, spans in candidates(h, first, seeds, how):
        raw = data.tobytes() if raw is None else raw
        words = seeds["items"][item]
        least = seeds["points"][item] / (how.same * len(words)) - 1e-9
        best = (0.0, 0, 0)
        for lo, hi in spans:
            part = [plain(raw[s:e].decode("utf-8")) for s, e in zip(starts[lo:hi].tolist(), ends[lo:hi].tolist())]
            if most(words, part, how) < max(least, best[0]):
                continue
            score, s, e = align(words, part, how)
            if score > best[0]:
                best = (score, lo - int(first[t]) + s, lo - int(first[t]) + e)
        if best[0] >= least:
            yield t, item, *best


def _blocks(items: DataFrame, how: Settings, id_col: str, text_col: str) -> list[DataFrame]:
    """The items in blocks of about ``block_bytes``."""
    src = items.select(F.col(id_col).cast("long").alias("item"), F.col(text_col).cast("string").alias("text")).where(F.col("text").isNotNull())
    total = src.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    n = max(1, -(-int(total) // how.block_bytes))
    return [src.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == i).distinct() for i in range(n)]


def contaminated(docs: DataFrame, items: DataFrame, how: Settings = Settings(), *, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``doc_id, item_id, score, start_word, end_word``: a row for every training row and
    test item that a passage of the row copies, with edits or without.

    Words are split at white space; letter case and punctuation at words' ends do not count.
    A copy scores ``threshold`` of the item's own score, and ``least`` or the item's own.
    Null items and those of fewer than ``least_words`` words are not searched; an item with a
    null id is, under a null ``item_id``. Null and empty texts match nothing; very long ones are
    aligned around their seeds only, one row of a matrix at a time; repeated training rows
    repeat their matches, repeated items count once; other columns are not read; empty
    tables give an empty result.
    """
    return _searched(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")), items, how, "text", item_col, item_text_col, None)


def without_contaminated(docs: DataFrame, items: DataFrame, how: Settings = Settings(), *, text_col: str = "text",
                         item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that copy no test item, unchanged and with all their columns."""
    return _searched(docs, items, how, text_col, item_col, item_text_col, "clean")


def _searched(docs: DataFrame, items: DataFrame, how: Settings, text_col: str, item_col: str, item_text_col: str, keep: str | None) -> DataFrame:
    spark = docs.sparkSession
    out = T.StructType([docs.schema[0], T.StructField("item_id", T.LongType()), T.StructField("score", T.DoubleType()),
                        T.StructField("start_word", T.LongType()), T.StructField("end_word", T.LongType())])
    where = docs.columns.index(text_col)

    def search(seeds):
        def run(batches) -> Iterator:
            import numpy as np
            import pyarrow as pa
            import pyarrow.compute as pc

            for batch in batches:
                texts = batch.column(where).cast(pa.large_string())
                sizes = pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False)
                found = [(a + t, item, *rest) for a, b in pieces(sizes)
                         for t, item, *rest in _near_misses(texts.slice(a, b - a), seeds.value, how)]
                if keep:
                    clean = np.ones(batch.num_rows, bool)
                    clean[[f[0] for f in found]] = False
                    yield batch.filter(pa.array(clean))
                else:
                    rows, item, score, start, end = zip(*found) if found else ((),) * 5
                    yield pa.RecordBatch.from_arrays([
                        batch.column(0).take(pa.array(rows, pa.int64())), pa.array([seeds.value["ids"][i] for i in item], pa.int64()),
                        pa.array(score, pa.float64()), pa.array(start, pa.int64()), pa.array(end, pa.int64())], names=out.names)

        return run

    parts, left = [], docs
    for block in _blocks(items, how, item_col, item_text_col):
        seeds = find_seeds(block, docs.select(F.col(text_col).cast("string").alias("text")), how)
        if seeds is None:
            continue
        sent = spark.sparkContext.broadcast(seeds)
        if keep:
            left = left.mapInArrow(search(sent), docs.schema)
        else:
            parts.append(docs.mapInArrow(search(sent), out))
    if keep:
        return left
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], out)
