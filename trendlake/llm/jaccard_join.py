"""Exact Jaccard self-join of word shingle sets by T-occurrence search (DivideSkip).

1. Every text becomes a set of 64-bit shingle hashes; equal sets form a class.
2. Which shingles occur in more than one class is counted on a part of the hash
   space (``SHARE``), all of it for sets too small for the part. A set that lacks
   too many of its own shingles elsewhere has no partner. The others link by the
   rarest shingles that any partner must share one of; linked sets form blocks, and
   no similar pair crosses blocks.
3. Inside a block the sets are searched with DivideSkip: a query's short inverted
   lists are merged, its long ones probed by binary search, and sets that reach the
   required overlap are kept. A block too large for one task is cut into chunks
   and every pair of chunks is searched by a task of its own.

Postings travel as packed arrays, one row per task and bucket. No pair is listed
for a group of copies: a searched set covers all it links to, and a covered set is
searched again only if the triangle inequality allows a link that is not known yet.

Hashes of 64 bits stand for shingles and sets: among a billion distinct sets
about 0.03 pairs are expected to share a hash by chance.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendlake.llm import textnum
from trendlake.llm.common import cut, pieces, row_key
from trendlake.llm.components import connected_components
from trendlake.llm.packets import FLUSH, Packer, unpacked

#: Part of the hash space on which shared shingles are counted, in 256ths (about two fifths).
SHARE = 102
#: Sets that a task remembers as posted.
POSTED = 500_000
#: Shingles in a search chunk.
CHUNK = 2_000_000
#: DivideSkip's weight of list length in the number of long lists.
MU = 0.01


@dataclass(frozen=True)
class Threshold:
    """Sets link when ``100 * intersection >= percent * union``."""

    words: int = 5
    percent: int = 75

    def misses(self, size):
        """Shingles that a set may lack in a partner at most: size - ceil(percent/100 * size)."""
        return size * (100 - self.percent) // 100

    def linked(self, inter, a, b):
        return 100 * inter >= self.percent * (a + b - inter)


def shingle_sets(texts, words: int):
    """Sorted distinct shingle hashes per text, as a list of uint64 arrays."""
    import numpy as np

    data, offsets = textnum.buffers(texts)
    starts, ends, first = textnum.words(data, offsets)
    h = textnum.Hasher(lower=True).ranges(data, starts, ends)
    sh, at = textnum.shingles(h, first, words)
    return [np.unique(sh[at[i] : at[i + 1]]) for i in range(len(texts))]


def set_hash(hashes) -> int:
    """A signed 64-bit key of a set, from order-free sums of two mixings of its members."""
    import numpy as np

    one = textnum.mixed(hashes ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(keepdims=True)
    two = np.bitwise_xor.reduce(textnum.mixed(hashes + np.uint64(0x1F83D9ABFB41BD6B)), keepdims=True)
    return int(textnum.mixed(one * np.uint64(31) + two + np.uint64(len(hashes))).view(np.int64)[0])


def _each_set(batches, words: int) -> Iterator:
    """(batch, row, set) of record batches whose column 0 holds texts."""
    import pyarrow.compute as pc

    for batch in batches:
        sizes = pc.binary_length(batch.column(0)).fill_null(0).to_numpy(zero_copy_only=False)
        for a, b in pieces(sizes):
            for i, s in enumerate(shingle_sets(batch.column(0).slice(a, b - a), words)):
                yield batch, a + i, s


def classes(docs: DataFrame, how: Threshold, *, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, k, n_shingles, n_part, cls`` per row; ``k`` is a key of id and text,
    ``n_part`` how many shingles lie in the counted part of the hash space, ``cls``
    the key of the shingle set (null for an empty set)."""

    def run(batches) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            n, part, cls = [], [], []
            for _, _, s in _each_set([batch], how.words):
                n.append(len(s))
                part.append(int(np.count_nonzero((s >> np.uint64(56)) < SHARE)))
                cls.append(set_hash(s) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), batch.column(2), pa.array(n, pa.int64()), pa.array(part, pa.int64()), pa.array(cls, pa.int64())],
                names=["doc_id", "k", "n_shingles", "n_part", "cls"])

    src = docs.select(F.col(text_col).cast("string").alias("text"), F.col(id_col).alias("doc_id"), row_key(id_col, text_col).alias("k"))
    return src.mapInArrow(run, T.StructType([src.schema["doc_id"], src.schema["k"], T.StructField("n_shingles", T.LongType()),
                                             T.StructField("n_part", T.LongType()), T.StructField("cls", T.LongType())]))


def _spread(df: DataFrame) -> DataFrame:
    return df.repartition("bucket")


def candidate_blocks(docs: DataFrame, sets: DataFrame, how: Threshold, *, text_col: str) -> DataFrame:
    """``cls, block`` for all sets that may have a partner; similar sets share a block."""
    bits = min(28, max(8, math.ceil(math.log2(sets.count() / 250 + 1))))
    in_share = SHARE << (bits - 8)

    def home(cls):
        """The bucket in which all about a set meets."""
        import numpy as np

        return (cls.view(np.uint64) >> np.uint64(64 - bits)).astype(np.int64)

    def partial(size, part):
        """Whether the counted part of the hash space suffices for a set."""
        return (part > how.misses(size)) & (size > 64)

    def postings(batches) -> Iterator:
        import numpy as np

        out, posted = Packer(["token", "cls"]), set()
        for _, _, s in _each_set(batches, how.words):
            cls = set_hash(s) if len(s) else None
            if cls is None or cls in posted:  # a task posts equal sets once
                continue
            if len(posted) >= POSTED:  # a set posted again is dropped where its shingles meet
                posted.clear()
            posted.add(cls)
            token = s >> np.uint64(64 - bits - 32)
            bucket = (token >> np.uint64(32)).astype(np.int64)
            inside = bucket < in_share
            if partial(len(s), np.count_nonzero(inside)):
                token, bucket = token[inside], bucket[inside]
            out.add(bucket, (token & np.uint64(0xFFFFFFFF)).astype(np.uint32), np.full(len(token), cls, np.int64))
            if out.size >= FLUSH:
                yield from out.flush()
        yield from out.flush()

    def shared(batches) -> Iterator:
        """Per set the shingles that other sets have too, and in how many sets they are."""
        import numpy as np

        got = unpacked(batches, (np.uint32, np.int64))
        if got is None:
            return
        bucket, token, cls = got
        token = (bucket.astype(np.uint64) << np.uint64(32)) | token
        order = np.lexsort((cls, token))
        token, cls = token[order], cls[order]
        new = np.r_[True, (token[1:] != token[:-1]) | (cls[1:] != cls[:-1])]
        token, cls = token[new], cls[new]
        first = np.flatnonzero(np.r_[True, token[1:] != token[:-1]])
        df = np.diff(np.r_[first, len(token)])
        df = np.repeat(df, df)
        many = df > 1
        if many.any():
            out = Packer(["cls", "token", "df"])
            out.add(home(cls[many]), cls[many], token[many], df[many])
            yield from out.flush()

    def sizes(batches) -> Iterator:
        import numpy as np

        out = Packer(["cls", "token", "df"])
        for batch in batches:
            cls, n, part = (batch.column(j).to_numpy() for j in range(3))
            if len(cls):
                out.add(home(cls), cls, n, part)
            if out.size >= FLUSH:
                yield from out.flush()
        yield from out.flush()

    def rarest(batches) -> Iterator:
        """Of each set its rarest shared shingles, as many as make sure that any partner
        has one of them; sets under one shingle are linked as far as seen here."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        kept: tuple[list, list] = ([], [])
        for batch in batches:
            table = pa.Table.from_batches([batch])
            for kind in (0, 1):
                kept[kind].extend(table.filter(pc.equal(table["kind"], kind)).drop_columns(["kind"]).to_batches())
        found, known = unpacked(kept[0], (np.int64, np.uint64, np.int64)), unpacked(kept[1], (np.int64, np.int64, np.int64))
        if found is None:
            return
        _, cls, token, df = found
        order = np.lexsort((token, df, cls))
        cls, token = cls[order], token[order]
        first = np.flatnonzero(np.r_[True, cls[1:] != cls[:-1]])
        last = np.r_[first[1:], len(cls)]
        _, names, size, part = known
        order = np.argsort(names)
        at = order[np.searchsorted(names, cls[first], sorter=order)]
        out = Packer(["token", "cls"])
        for a, b, n, p in zip(first.tolist(), last.tolist(), size[at].tolist(), part[at].tolist()):
            room = how.misses(n) + 1
            own = token[a:b]
            inside = own[(own >> np.uint64(32)) < np.uint64(in_share)]
            take = inside[: max(0, room - (p - len(inside)))]
            if not partial(n, p):
                take = np.union1d(take, own[: max(0, room - (n - len(own)))])
            if len(take):
                out.add(take, take, np.full(len(take), cls[a], np.int64))
            if out.size >= FLUSH:
                yield from started(out)
        yield from started(out)

    def started(out: Packer):
        """What a task has gathered, linked; each shingle goes on with its least set only.
        Links travel in negative buckets."""
        import numpy as np

        if out.size:
            _, token, cls = (np.concatenate(x) for x in zip(*out.parts))
            out.parts, out.size = [], 0
            a, b, token, cls = stars(token, cls)
            out.add(np.r_[(token >> np.uint64(32)).astype(np.int64), -1 - (a & 0xFFF)], np.r_[token, a.view(np.uint64)], np.r_[cls, b])
            yield from out.flush()

    def linked(batches) -> Iterator:
        import numpy as np
        import pyarrow as pa

        got = unpacked(batches, (np.uint64, np.int64))
        if got is None:
            return
        bucket, token, cls = got
        done = bucket < 0
        a, b, _, _ = stars(token[~done], cls[~done])
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[a, token[done].view(np.int64)]), pa.array(np.r_[b, cls[done]])], names=["a", "b"])

    packed = "bucket long, cls binary, token binary, df binary"
    counted = _spread(docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(
        postings, "bucket long, token binary, cls binary")).mapInArrow(shared, packed).withColumn("kind", F.lit(0))
    sized = sets.where(F.col("cls").isNotNull()).groupBy("cls").agg(F.max("n_shingles"), F.max("n_part")) \
        .mapInArrow(sizes, packed).withColumn("kind", F.lit(1))
    rare = _spread(counted.unionByName(sized)).mapInArrow(rarest, "bucket long, token binary, cls binary")
    edges = _spread(rare).mapInArrow(linked, "a long, b long")
    return connected_components(edges).select(F.col("node").alias("cls"), F.col("component").alias("block"))


def stars(token, cls):
    """Links (set, least set) of all sets under the same shingle, without repeats; then
    each shingle with its least set."""
    import numpy as np

    order = np.lexsort((cls, token))
    token, cls = token[order], cls[order]
    first = np.flatnonzero(np.r_[True, token[1:] != token[:-1]])[: len(token)]
    least = np.repeat(cls[first], np.diff(np.r_[first, len(token)]))
    pair = np.unique(np.column_stack([cls, least])[cls != least], axis=0)
    return pair[:, 0].copy(), pair[:, 1].copy(), token[first], cls[first]


class Index:
    """Inverted lists over the sets of one block, searched by DivideSkip."""

    def __init__(self, sets: list, how: Threshold):
        import numpy as np

        self.how, self.n = how, len(sets)
        self.size = np.array([len(s) for s in sets], np.int64)
        owner = np.repeat(np.arange(self.n), self.size)
        _, token = np.unique(np.concatenate(sets), return_inverse=True)
        order = np.lexsort((owner, token))
        # posting keys, sorted by list and then by set: a list is a slice, a probe a binary search
        self.member = owner[order]
        self.keys = token[order] * self.n + self.member
        length = np.bincount(token)
        self.start = np.r_[0, np.cumsum(length)]
        useful = length[token] > 1
        ends = np.cumsum(np.bincount(owner[useful], minlength=self.n))
        self.lists = np.split(token[useful], ends[:-1])

    def search(self, q: int, need: int):
        """(sets, overlaps): all others that share at least ``need`` shingles with set ``q``."""
        import numpy as np

        lists = self.lists[q]
        empty = np.zeros(0, np.int64)
        if len(lists) < need:
            return empty, empty
        length = self.start[lists + 1] - self.start[lists]
        order = np.argsort(-length, kind="stable")
        lists, length = lists[order], length[order]
        long = min(need - 1, int(need / (MU * math.log2(length[0]) + 1)))
        short = lists[long:]
        merged = np.concatenate([self.member[self.start[t] : self.start[t + 1]] for t in short]) if len(short) else empty
        found, count = np.unique(merged, return_counts=True)
        keep = (count >= need - long) & (found != q)
        found, count = found[keep], count[keep]
        step = max(1, 1_000_000 // max(1, len(found)))
        for i in range(0, long, step):  # the longest lists come last: those left may add one each
            if not len(found):
                break
            probe = lists[i : min(long, i + step)][:, None] * self.n + found[None, :]
            at = np.minimum(np.searchsorted(self.keys, probe.ravel()), len(self.keys) - 1)
            count = count + (self.keys[at] == probe.ravel()).reshape(probe.shape).sum(0)
            left = long - min(long, i + step)
            keep = count + left >= need
            found, count = found[keep], count[keep]
        return found, count

    def partners(self, q: int):
        """All sets that link with ``q``, and their distances (1 - Jaccard)."""
        size = int(self.size[q])
        found, inter = self.search(q, size - self.how.misses(size))
        ok = self.how.linked(inter, size, self.size[found])
        found, inter = found[ok], inter[ok]
        return found, 1 - inter / (size + self.size[found] - inter)


def cluster(sets: list, how: Threshold):
    """The least member of each set's component under the linking rule; exact.

    Sets are searched one after another; what a search finds is covered and not
    searched itself. A link between two covered sets of different leaders is possible
    only if the leaders' distance is at most both radii plus the linking distance;
    only then, and while the two are not connected otherwise, the covered sets of one
    of them are searched too.
    """
    import numpy as np

    index = Index(sets, how)
    n, reach = len(sets), 1 - how.percent / 100
    root = np.arange(n)

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return int(x)

    def join(x: int, others) -> None:
        top = find(x)
        for o in others.tolist():
            o = find(o)
            if o != top:
                top, o = min(top, o), max(top, o)
                root[o] = top

    covered = np.full(n, -1)
    radius = np.zeros(n)
    for q in np.argsort([-len(x) for x in index.lists], kind="stable").tolist():
        if covered[q] >= 0:
            continue
        found, distance = index.partners(q)
        covered[q] = q
        fresh = covered[found] < 0
        covered[found[fresh]] = q
        if fresh.any():
            radius[q] = distance[fresh].max()
        join(q, found)
    leaders = np.unique(covered[covered != np.arange(n)])
    if len(leaders) > 1:
        widest = radius[leaders].max()
        for q in leaders.tolist():
            far = radius[q] + widest + reach
            size = int(index.size[q])
            # J >= 1 - far needs an overlap of (1 - far) * size at least
            near, inter = index.search(q, max(1, math.ceil((1 - far) * size - 1e-9)))
            lead = np.isin(near, leaders) & (near != q)
            near, inter = near[lead], inter[lead]
            distance = 1 - inter / (size + index.size[near] - inter)
            for o in near[distance <= radius[q] + radius[near] + reach + 1e-9].tolist():
                if find(o) == find(q):
                    continue
                for m in np.flatnonzero(covered == q).tolist():
                    join(m, index.partners(m)[0])
    return np.array([find(i) for i in range(n)])


def block_links(docs: DataFrame, sets: DataFrame, blocks: DataFrame, how: Threshold, *, id_col: str, text_col: str) -> DataFrame:
    """``a, b``: links inside the blocks that connect all similar sets."""
    one_each = sets.where(F.col("cls").isNotNull()).groupBy("cls").agg(F.min("k").alias("k"), F.max("n_shingles").alias("n"))
    members = cut(blocks.join(one_each, "cls"), "block-members")
    chunks = members.groupBy("block").agg(F.ceil(F.sum("n") / CHUNK).cast("int").alias("chunks"))
    dealt = members.join(chunks, "block").select(
        F.col("k").alias("_k"), "cls", "block", "chunks", F.pmod(F.xxhash64("cls"), "chunks").cast("int").alias("chunk"))

    def hashed(batches) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array([s.tobytes() for _, _, s in _each_set([batch], how.words)], pa.binary())],
                                             names=["cls", "block", "chunks", "chunk", "shingles"])

    def searched(batches) -> Iterator:
        import numpy as np
        import pyarrow as pa

        def links(group: list):
            cls = np.array([g[0] for g in group], np.int64)
            cls, at = np.unique(cls, return_index=True)
            least = cluster([np.frombuffer(group[i][1], np.uint64) for i in at.tolist()], how)
            linked = least != np.arange(len(cls))
            if linked.any():
                yield pa.RecordBatch.from_arrays([pa.array(cls[linked]), pa.array(cls[least[linked]])], names=["a", "b"])

        tile, group = None, []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[:3] != tile:
                    if len(group) > 1:
                        yield from links(group)
                    tile, group = row[:3], []
                group.append(row[3:])
        if len(group) > 1:
            yield from links(group)

    # a merge join at every size: the members grow with the corpus, so they are never broadcast
    texts = docs.select(F.col(text_col).cast("string").alias("text"), row_key(id_col, text_col).alias("_k"))
    shingled = texts.join(dealt.hint("merge"), "_k").select("text", "cls", "block", "chunks", "chunk").mapInArrow(
        hashed, "cls long, block long, chunks int, chunk int, shingles binary")
    tiles = shingled.select("cls", "block", "chunk", "shingles", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other")).select(
        "block", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"), "cls", "shingles")
    return tiles.repartition("block", "i", "j").sortWithinPartitions("block", "i", "j").mapInArrow(searched, "a long, b long")


def jaccard_components(docs: DataFrame, how: Threshold = Threshold(), *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, k, n_shingles, cls, component, component_id`` per row of ``docs``: a key of id
    and text, the set's size and key, the least set key and the smallest id reachable by
    links, its own included.

    A-Z count as a-z; words are runs of bytes other than space and 0x09-0x0D. A text of
    fewer words than a shingle has its whole sequence as one; null texts and texts
    without words have an empty set, a null ``cls``, and link with nothing. Rows with
    equal sets, repeated rows included, are linked. Null ids are passed over in the
    minimum; a component of null ids has a null id. Other columns are not read. An empty
    table gives an empty result.
    """
    sets = cut(classes(docs, how, id_col=id_col, text_col=text_col), "shingle-sets")
    blocks = cut(candidate_blocks(docs, sets, how, text_col=text_col), "blocks")
    links = block_links(docs, sets, blocks, how, id_col=id_col, text_col=text_col)
    group = connected_components(links).withColumnRenamed("node", "cls")
    of_class = sets.where(F.col("cls").isNotNull()).groupBy("cls").agg(F.min("doc_id").alias("least")).join(group, "cls", "left") \
        .withColumn("component", F.coalesce("component", "cls"))
    least = cut(of_class.groupBy("component").agg(F.min("least").alias("component_id")), "component-ids")
    named = cut(of_class.select("cls", "component").join(least, "component").select("cls", "component", "component_id"), "class-components")
    return sets.join(named, "cls", "left").select(
        "doc_id", "k", "n_shingles", "cls", "component", F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def one_of_each(docs: DataFrame, how: Threshold = Threshold(), *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without near copies: of every component the row with the least
    id (null last; of equal ids any text, of equal rows any one), all columns unchanged.

    Rows without words link with nothing and all stay. Two different rows whose keys are equal by
    chance both stay, as repeated rows are told by a second key. The names ``__key__``,
    ``__other_key__`` and ``__k__`` are reserved and must not be in ``docs``.
    """
    if taken := {"__key__", "__other_key__", "__k__"}.intersection(docs.columns):
        raise ValueError(f"reserved column names: {sorted(taken)}")
    found = jaccard_components(docs, how, id_col=id_col, text_col=text_col)
    kept = found.where(F.col("cls").isNotNull()).groupBy("component").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "k")).alias("first")).select(F.col("first.k").alias("__k__"))
    kept = cut(kept, "kept-keys")
    keyed = docs.withColumn("__key__", row_key(id_col, text_col)).withColumn("__other_key__", F.xxhash64(F.lit(1), id_col, text_col))
    wordless = ~F.coalesce(F.col(text_col).cast("string").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    return keyed.join(kept.hint("merge"), F.col("__key__") == F.col("__k__"), "left_semi").dropDuplicates(["__key__", "__other_key__"]) \
        .drop("__key__", "__other_key__").unionByName(docs.where(wordless))
