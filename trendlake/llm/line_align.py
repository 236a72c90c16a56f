"""Removing passages that earlier documents hold, by pairwise line alignment.

A line here is a physical line cut further at sentence ends, before a capital after
a small letter, and, where ``GREATEST`` words have no such cut, after the word of the
least hash.  So no line is longer, and as the cuts depend on that many words only, a
passage set into the middle of a paragraph has the same lines wherever it stands, but
for less than ``GREATEST`` words at either end.  A line by itself may be a stock phrase;
with the lines after it, up to as many words as are deleted at least, it is rare unless
it was copied.  Documents that share such a stretch meet through its first holder only,
of all or of those that one task has gathered: one held by n documents makes n - 1 pairs,
however common it is, and its rows need not meet in one task.  Each pair is aligned
by patience diff on line hashes, and an aligned run is deleted from the later document
if it has enough words within this pair; phrases that come from several documents are
not added up.  What is deleted stands in one earlier document in the same order, so the
first holder of a passage keeps it.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendlake.llm import textnum
from trendlake.llm.common import CHUNK_BYTES, cut, pieces, row_key
from trendlake.llm.packets import FLUSH, Packer, unpacked


GREATEST = 10  # words of a line
SENTENCE_ENDS = ".!?。！？｡؟۔।॥።"


@dataclass(frozen=True)
class Settings:
    block_words: int = 24   # an aligned run of at least so many words is deleted; documents meet by stretches of so many
    frequent: int = 8       # postings of a stretch from which a task leads them to its own first holder
    gap: int = 4            # lines between two shared ones of a run, at most
    margin: int = 24        # lines beside the leading ones that the alignment sees too: a stretch has no more


def _ends_sentence(data, starts, ends):
    """Whether a word's last character is a mark that ends sentences."""
    import numpy as np

    codes, out = [c.encode() for c in SENTENCE_ENDS], np.zeros(len(ends), bool)
    may = np.zeros(256, bool)
    may[[code[-1] for code in codes]] = True
    last = data[ends - 1]
    places = np.flatnonzero(may[last])
    last = last[places]
    for code in codes:
        at = places[last == code[-1]]
        at = at[ends[at] - starts[at] >= len(code)]
        for k in range(2, len(code) + 1):
            at = at[data[ends[at] - k] == code[-k]]
        out[at] = True
    return out


def least_of_windows(values, n: int):
    """Places of the least value, the last of equal ones, of each run of ``n`` values; runs
    that hold a 0 count for nothing."""
    import numpy as np

    m = len(values) - n + 1
    if m <= 0:
        return np.zeros(0, np.int64)
    least, at = values[:m].copy(), np.zeros(m, np.min_scalar_type(n))
    for k in range(1, n):
        np.putmask(at, values[k : m + k] <= least, k)
        np.minimum(least, values[k : m + k], out=least)
    found = np.zeros(len(values), bool)
    found[(at + np.arange(m))[least > 0]] = True
    return np.flatnonzero(found)


def lines_of(texts, hasher=None):
    """(word starts, word ends, first word of each text, first word of each line + total,
    first line of each text + total, line hashes) of a pyarrow string array. A task gives
    its ``hasher``, so that powers are not raised again for every piece."""
    import numpy as np

    data, offsets = textnum.buffers(texts)
    starts, ends, first = textnum.words(data, offsets)
    if hasher is None or len(data) > 2 * CHUNK_BYTES:  # tables of a very long text are not kept
        hasher = textnum.Hasher()
    h = hasher.ranges(data, starts, ends)
    n = len(starts)
    new = np.zeros(n, bool)
    if n:
        new[first[:-1][np.diff(first) > 0]] = True
        after_newline = np.searchsorted(starts, np.flatnonzero(data == 0x0A))
        new[after_newline[after_newline < n]] = True
        head = data[starts]
        capital = (head >= 0x41) & (head <= 0x5A)
        wide = np.flatnonzero(head == 0xC3)
        second = data[np.minimum(starts[wide] + 1, len(data) - 1)]
        capital[wide] = (second >= 0x80) & (second <= 0x9E)
        new[1:] |= _ends_sentence(data, starts, ends)[:-1]
        new[1:] |= capital[1:] & ~capital[:-1]
        new[least_of_windows(np.where(np.r_[new[1:], True], np.uint64(0), h | np.uint64(1)), GREATEST) + 1] = True
    line = np.r_[np.flatnonzero(new), n]
    powers, roots = hasher.steps(n + 1)
    total = np.r_[np.uint64(0), np.cumsum(h * powers[:n])]
    a, b = line[:-1], line[1:]
    hashes = textnum.mixed((total[b] - total[a]) * roots[a] + (b - a).astype(np.uint64))
    return starts, ends, first, line, np.searchsorted(line[:-1], first), hashes


def longest_rise(values: list[int]) -> list[int]:
    """Places of a longest increasing subsequence."""
    tails: list[int] = []
    at: list[int] = []
    before = [-1] * len(values)
    for i, v in enumerate(values):
        k = bisect_left(tails, v)
        before[i] = at[k - 1] if k else -1
        if k == len(tails):
            tails.append(v)
            at.append(i)
        else:
            tails[k], at[k] = v, i
    out, i = [], at[-1] if at else -1
    while i >= 0:
        out.append(i)
        i = before[i]
    return out[::-1]


def _anchors(x: list, a: list) -> list[tuple[int, int]]:
    """Common lines that are single in both lists, in the longest common order; without
    any, lines paired by their number of occurrence."""

    def places(lines):
        out: dict = {}
        for i, v in enumerate(lines):
            out.setdefault(v, []).append(i)
        return out

    px, pa = places(x), places(a)
    both = [v for v in px if v in pa]
    pairs = sorted((px[v][0], pa[v][0]) for v in both if len(px[v]) == len(pa[v]) == 1)
    if not pairs:
        pairs = sorted(p for v in both for p in zip(px[v], pa[v]))
    return [pairs[i] for i in longest_rise([q for _, q in pairs])]


def patience(x: list, a: list) -> list[tuple[int, int]]:
    """Aligned places (in x, in a): anchors, the equal lines that adjoin them, and the same
    again between them."""
    out, todo = [], [(0, len(x), 0, len(a))]
    while todo:
        x0, x1, a0, a1 = todo.pop()
        found = _anchors(x[x0:x1], a[a0:a1])
        here, there = x0, a0
        for i, j in [(x0 + i, a0 + j) for i, j in found]:
            if i < here or j < there:
                continue  # reached from the anchor before
            p, q = i, j
            while p > here and q > there and x[p - 1] == a[q - 1]:
                p, q = p - 1, q - 1
            if p > here and q > there:
                todo.append((here, p, there, q))
            while i < x1 and j < a1 and x[i] == a[j]:
                i, j = i + 1, j + 1
            out += [(p + k, q + k) for k in range(i - p)]
            here, there = i, j
        if found and here < x1 and there < a1:
            todo.append((here, x1, there, a1))
    return sorted(out)


def common_runs(x: list, words: list[int], a: list, least: int) -> list[tuple[int, int]]:
    """Runs of lines [start, end) of ``x``, of at least ``least`` words, that stand in the
    same run in ``a``. While any are found, what is left of ``x`` is aligned again."""
    x, out, held = list(x), [], set(a)
    while True:
        most = here = 0  # words that lines of ``a`` have without a break: no run has more
        for v, n in zip(x, words):
            here = here + n if v in held else 0
            most = max(most, here)
        if most < least:
            return sorted(out)
        runs: list[list[int]] = []
        for i, j in patience(x, a):
            if runs and runs[-1][1] == i and runs[-1][2] == j:
                runs[-1][1:] = [i + 1, j + 1]
            else:
                runs.append([i, i + 1, j + 1])
        fresh = [(s, e) for s, e, _ in runs if sum(words[s:e]) >= least]
        out += fresh
        if not fresh:
            return sorted(out)
        for s, e in fresh:
            x[s:e] = [None] * (e - s)


def _units(docs: DataFrame, *, id_col: str, text_col: str) -> DataFrame:
    """``doc, k, hashes, words`` per row: line hashes (8 bytes each) and word counts (2)."""

    def run(batches) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        hasher = textnum.Hasher()
        for batch in batches:
            sizes = pc.binary_length(batch.column(2)).fill_null(0).to_numpy(zero_copy_only=False)
            for a, b in pieces(sizes):
                _, _, _, line, at, hashes = lines_of(batch.column(2).slice(a, b - a), hasher)
                words = np.minimum(np.diff(line), 0xFFFF).astype(np.uint16)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a),
                    pa.array([hashes[i:j].tobytes() for i, j in zip(at[:-1], at[1:])], pa.binary()),
                    pa.array([words[i:j].tobytes() for i, j in zip(at[:-1], at[1:])], pa.binary())], names=["doc", "k", "hashes", "words"])

    # the order of documents: by id, null last; equal ids by the row key
    doc = F.coalesce(F.col(id_col).cast("long"), F.lit(2**63 - 1))
    src = docs.select(doc.alias("doc"), row_key(id_col, text_col).alias("k"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, "doc long, k long, hashes binary, words binary")


class Stretches:
    """Hashes of runs of lines, by differences of running polynomial sums."""

    def __init__(self, settings: Settings):
        self.least, self.hasher = settings.block_words, textnum.Hasher()

    def of(self, hashes, words, first):
        """(places, tokens, number in each text) of the stretches of lines that begin at each line and
        end with the line that makes them ``block_words`` words; none where the text ends before.
        ``first`` is the first line of each text + total; places are counted within the text."""
        import numpy as np

        n = len(hashes)
        size = np.r_[0, np.cumsum(words, dtype=np.int64)]
        text = np.repeat(np.arange(len(first) - 1), np.diff(first))
        end = np.searchsorted(size, size[:-1] + self.least)
        start = np.flatnonzero(end <= first[1:][text])
        end, text = end[start], text[start]
        powers, roots = self.hasher.steps(n + 1)
        total = np.r_[np.zeros(1, np.uint64), np.cumsum(hashes * powers[:n], dtype=np.uint64)]
        token = textnum.mixed((total[end] - total[start]) * roots[start] + (end - start).astype(np.uint64))
        return start - first[text], token, np.bincount(text, minlength=len(first) - 1)


def _pairs(units: DataFrame, settings: Settings) -> DataFrame:
    """``xk, ak``, the lines [x0, x1] of document ``xk`` at which a run of stretches begins that
    earlier documents have, and the range [a0, a1] of those that were met in ``ak``."""
    bits = min(28, max(8, math.ceil(math.log2(units.count() / 250 + 1))))

    def postings(batches) -> Iterator:
        import numpy as np
        import pyarrow.compute as pc

        out, stretches = Packer(["token", "doc", "k", "place"]), Stretches(settings)
        for batch in batches:
            doc, k = (c.to_numpy(zero_copy_only=False) for c in batch.columns[:2])
            for low, high in pieces(pc.binary_length(batch.column(2)).to_numpy(zero_copy_only=False)):
                hashes, words = (c.slice(low, high - low).to_pylist() for c in batch.columns[2:])
                first = np.r_[0, np.cumsum([len(w) // 2 for w in words])]
                place, token, count = stretches.of(np.frombuffer(b"".join(hashes), np.uint64), np.frombuffer(b"".join(words), np.uint16), first)
                token = token >> np.uint64(32 - bits)
                bucket, token = (token >> np.uint64(32)).astype(np.int64), (token & np.uint64(0xFFFFFFFF)).astype(np.uint32)
                own, after = np.repeat(np.arange(low, high), count), np.cumsum(count)
                done = 0
                while done < len(own):  # as many whole texts as make ``FLUSH``
                    at = min(int(np.searchsorted(after, done + FLUSH - out.size)), len(after) - 1)
                    part, done = slice(done, int(after[at])), int(after[at])
                    out.add(bucket[part], token[part], doc[own[part]], k[own[part]], place[part].astype(np.int32))
                    if out.size >= FLUSH:
                        yield from met(out)
        yield from met(out)

    def met(out: Packer) -> Iterator:
        """What a task has gathered: of each frequent stretch its first holder here goes on, the others
        are led to it at once, as it is an earlier document too. So a stretch that a third of all
        documents hold reaches its bucket once a task, and its pairs have many first holders. What
        is led travels in negative buckets."""
        import numpy as np

        if not out.size:
            return
        bucket, token, doc, k, place = (np.concatenate(x) for x in zip(*out.parts))
        out.parts, out.size = [], 0
        bucket, token, doc, k, place, first = holders(bucket, token, doc, k, place)
        own = (k == k[first]) | (np.bincount(first)[first] < settings.frequent)
        out.add(bucket[own], token[own], doc[own], k[own], place[own])
        later, first = np.flatnonzero(~own), first[~own]
        out.add(-1 - home(k[later]), place[first].view(np.uint32), k[later], k[first], place[later])
        yield from out.flush()

    def holders(bucket, token, doc, k, place):
        """All five by stretch, and in a stretch by document; the row of each one's first holder."""
        import numpy as np

        order = np.lexsort((place, k, doc, token, bucket))
        bucket, token, doc, k, place = (v[order] for v in (bucket, token, doc, k, place))
        head = np.r_[True, (token[1:] != token[:-1]) | (bucket[1:] != bucket[:-1])]
        return bucket, token, doc, k, place, np.flatnonzero(head)[np.cumsum(head) - 1]

    def home(k):
        """The bucket in which all about a document meets."""
        import numpy as np

        return (k.view(np.uint64) >> np.uint64(64 - bits)).astype(np.int64)

    def led(batches) -> Iterator:
        import numpy as np

        got = unpacked(batches, (np.uint32, np.int64, np.int64, np.int32))
        if got is None:
            return
        out = Packer(["xk", "place", "ak", "there"])
        done = got[0] < 0
        _, there, xk, ak, place = (v[done] for v in got)
        out.add(home(xk), xk, place, ak, there.view(np.int32))
        if not done.all():
            _, _, _, k, place, first = holders(*(v[~done] for v in got))
            later = np.flatnonzero(k != k[first])
            out.add(home(k[later]), k[later], place[later], k[first[later]], place[first[later]])
        yield from out.flush()

    def runs(batches) -> Iterator:
        """Of each document the runs of shared stretches, and the first holders met in each."""
        import numpy as np
        import pyarrow as pa

        got = unpacked(batches, (np.int64, np.int32, np.int64, np.int32))
        if got is None:
            return
        _, xk, place, ak, there = got
        order = np.lexsort((place, xk))
        xk, place, ak, there = (v[order] for v in (xk, place, ak, there))
        new = np.r_[True, (xk[1:] != xk[:-1]) | (place[1:] - place[:-1] > settings.gap + 1)]
        run = np.cumsum(new) - 1
        start = np.flatnonzero(new)
        x0, x1 = place[start], place[np.r_[start[1:], len(place)] - 1]
        keep = np.lexsort((ak, run))
        own, a, t = run[keep], ak[keep], there[keep].astype(np.int64)
        head = np.flatnonzero(np.r_[True, (own[1:] != own[:-1]) | (a[1:] != a[:-1])])
        yield pa.RecordBatch.from_arrays([
            pa.array(xk[keep][head]), pa.array(a[head]), pa.array(x0[own[head]].astype(np.int64)), pa.array(x1[own[head]].astype(np.int64)),
            pa.array(np.minimum.reduceat(t, head)), pa.array(np.maximum.reduceat(t, head))], names=["xk", "ak", "x0", "x1", "a0", "a1"])

    packed = "bucket long, token binary, doc binary, k binary, place binary"
    shared = units.mapInArrow(postings, packed).repartition("bucket").mapInArrow(
        led, "bucket long, xk binary, place binary, ak binary, there binary")
    return shared.repartition("bucket").mapInArrow(runs, "xk long, ak long, x0 long, x1 long, a0 long, a1 long")


def common_passages(docs: DataFrame, settings: Settings = Settings(), *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``k, blocks``: for the rows with lines that earlier ones have, the aligned runs
    [start, end) of lines."""
    units = cut(_units(docs, id_col=id_col, text_col=text_col), "lines")
    pairs = cut(_pairs(units, settings), "line-pairs")
    involved = pairs.select(F.col("xk").alias("k")).unionByName(pairs.select(F.col("ak").alias("k"))).distinct()
    held = cut(units.join(involved.hint("merge"), "k").dropDuplicates(["k"]).select("k", "hashes", "words"), "lines-involved")

    def part(column: str, low: str, high: str, width: int):
        start = F.greatest(F.col(low) - settings.margin, F.lit(0))
        return F.substring(F.col(column), (start * width + 1).cast("int"), ((F.col(high) + settings.margin + 1 - start) * width).cast("int"))

    sides = pairs.join(held.withColumnRenamed("k", "ak"), "ak").select(
        "xk", "x0", "x1", part("hashes", "a0", "a1", 8).alias("a")) \
        .join(held.withColumnRenamed("k", "xk"), "xk").select(
        "xk", F.greatest(F.col("x0") - settings.margin, F.lit(0)).alias("at"), part("hashes", "x0", "x1", 8).alias("x"),
        part("words", "x0", "x1", 2).alias("words"), "a")

    def aligned(batches) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            k, start, end = [], [], []
            for xk, at, x, words, a in zip(*(c.to_pylist() for c in batch.columns)):
                for s, e in common_runs(np.frombuffer(x, np.uint64).tolist(), np.frombuffer(words, np.uint16).tolist(),
                                        np.frombuffer(a, np.uint64).tolist(), settings.block_words):
                    k.append(xk)
                    start.append(at + s)
                    end.append(at + e)
            yield pa.RecordBatch.from_arrays([pa.array(k, pa.int64()), pa.array(start, pa.int64()), pa.array(end, pa.int64())], names=["k", "start", "end"])

    return sides.mapInArrow(aligned, "k long, start long, end long").groupBy("k").agg(
        F.sort_array(F.collect_set(F.struct("start", "end"))).alias("blocks"))


def without_blocks(texts, blocks: list, least: int, hasher=None):
    """(text, words removed) of each text without the runs of at least ``least`` words that
    its blocks make together."""
    import numpy as np

    data, _ = textnum.buffers(texts)
    raw = data.tobytes()
    starts, ends, first, line, at, _ = lines_of(texts, hasher)
    _, offsets = textnum.buffers(texts)
    out = []
    for i, own in enumerate(blocks):
        gone = np.zeros(at[i + 1] - at[i], bool)
        for s, e in own:
            gone[s:e] = True
        edge = np.diff(np.r_[0, gone.astype(np.int8), 0])
        kept, here, removed = [], int(offsets[i]), 0
        for s, e in zip(np.flatnonzero(edge == 1) + at[i], np.flatnonzero(edge == -1) + at[i]):
            if line[e] - line[s] < least:
                continue
            kept.append(raw[here : starts[line[s]]])
            here = int(starts[line[e]]) if e < at[i + 1] else int(offsets[i + 1])
            removed += int(line[e] - line[s])
        kept.append(raw[here : int(offsets[i + 1])])
        out.append((b"".join(kept).decode("utf-8"), removed))
    return out


def dedup_lines(docs: DataFrame, settings: Settings = Settings(), *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with passages deleted that an earlier document holds, and the columns
    ``removed_words`` and ``left_words``.

    Documents are ordered by id, null last, equal ids by a hash of the text. Rows equal
    in id and text are one document and lose the same; a copy under a later id loses
    all (``left_words`` 0, the row stays). Null texts stay null, empty ones empty. What a
    document repeats within itself only stays. Bytes that are not deleted do not change. An
    empty table gives an empty result. All columns of ``docs`` are kept, but for such as
    are named like the two new ones, which take their place; the names ``__key__``, ``__k__``
    and ``__blocks__`` are reserved and must not be in ``docs``.
    """
    docs = docs.drop("removed_words", "left_words")
    if taken := {"__key__", "__k__", "__blocks__"}.intersection(docs.columns):
        raise ValueError(f"reserved column names: {sorted(taken)}")
    blocks = common_passages(docs, settings, id_col=id_col, text_col=text_col).select(F.col("k").alias("__k__"), F.col("blocks").alias("__blocks__"))
    names = docs.columns
    where = names.index(text_col)
    joined = docs.withColumn("__key__", row_key(id_col, text_col)).join(blocks.hint("merge"), F.col("__key__") == F.col("__k__"), "left").select(*names, "__blocks__")

    def run(batches) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        hasher = textnum.Hasher()
        for batch in batches:
            sizes = pc.binary_length(batch.column(where)).fill_null(0).to_numpy(zero_copy_only=False)
            for a, b in pieces(sizes):
                part = batch.slice(a, b - a)
                texts = part.column(where)
                data, offsets = textnum.buffers(texts)
                _, _, first = textnum.words(data, offsets)
                total = np.diff(first)
                lose = np.flatnonzero(pc.is_valid(part.column(len(names))).to_numpy(zero_copy_only=False))
                removed = np.zeros(b - a, np.int64)
                values = texts
                if len(lose):
                    values = texts.to_pylist()
                    own = [[(r["start"], r["end"]) for r in part.column(len(names))[int(i)].as_py()] for i in lose]
                    for i, (text, n) in zip(lose.tolist(), without_blocks(texts.take(pa.array(lose)), own, settings.block_words, hasher)):
                        values[i], removed[i] = text, n
                    values = pa.array(values, texts.type)
                columns = [values if c == where else part.column(c) for c in range(len(names))]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(removed), pa.array(total - removed)], names=[*names, "removed_words", "left_words"])

    out = T.StructType([*docs.schema.fields, T.StructField("removed_words", T.LongType()), T.StructField("left_words", T.LongType())])
    return joined.mapInArrow(run, out)
