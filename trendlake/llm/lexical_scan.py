"""Ranked lexical search by scanning documents with an automaton of all item terms.

The terms of all items form an Aho-Corasick automaton; every term stands in it between
two boundary marks, so it matches whole terms only.  One scan of the documents finds
the corpus counts (documents, terms, document frequencies); a second one reads the
term frequencies of a document off the automaton's outputs, maps them to the items
that hold the terms, and scores.  There is no index of documents: a task keeps no more
than each item's best documents so far, and only these are shuffled.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trendlake.llm.common import prepare

# Fixed value: what a term is made of; all other characters are below 0x80.
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


@dataclass(frozen=True)
class Settings:
    best: int = 50
    block_bytes: int = 1 << 20  # bytes of item terms in one automaton
    piece: int = 1 << 22        # bytes of a text that are scanned at once
    salt: int = 64              # an item's candidates are cut down in so many parts before they meet


def boundary_table() -> bytes:
    """Byte -> byte: A-Z as a-z, all other ASCII characters that are in no term as a space."""
    return bytes(c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or TERM.fullmatch(chr(c)) else 0x20 for c in range(256))


def terms_of(text: str | None, table: bytes) -> list[str]:
    """The terms of a text, each as its UTF-8 bytes in a string of characters below 0x100."""
    return (text or "").encode("utf-8", "replace").translate(table).decode("latin-1").split(" ")


def automaton_of(terms: list[str]):
    import ahocorasick

    found = ahocorasick.Automaton()
    for k, t in enumerate(terms):
        found.add_word(f" {t} ", k)
    found.make_automaton()
    return found


def scan(text: bytes, automaton, table: bytes, piece: int) -> tuple[int, Counter]:
    """The number of terms of a whole UTF-8 text, and how often each term of the automaton
    is among them. Long texts are scanned in pieces that end at a boundary."""
    import numpy as np

    text, n, tf, at = text.translate(table), 0, Counter(), 0
    while at < len(text):
        end = at + piece
        if end < len(text):
            end = text.find(b" ", end)
        if end < 0 or end > len(text):
            end = len(text)
        part = b" " + text[at:end] + b" "
        gap = np.frombuffer(part, np.uint8) == 0x20
        n += int(np.count_nonzero(gap[:-1] & ~gap[1:]))
        tf.update(k for _, k in automaton.iter(part.decode("latin-1")))
        at = end
    return n, tf


class Best:
    """The best documents of every item among those seen so far; memory is bounded by items
    times documents kept, and a constant."""

    ROOM = 200_000

    def __init__(self, items: int, best: int):
        import numpy as np

        self.best, self.least = best, np.ones(items, np.int64)  # scores of 0 do not count
        self.parts, self.size = [], 0

    def add(self, items, scores, doc: int, known: bool) -> None:
        import numpy as np

        fit = scores >= self.least[items]
        items, scores = items[fit], scores[fit]
        if len(items):
            self.parts.append((items, scores, np.full(len(items), doc, np.int64), np.full(len(items), not known)))
            self.size += len(items)
            if self.size > self.ROOM + 2 * self.best * len(self.least):
                self.prune()

    def prune(self):
        """Columns item, score, doc, without id; sorted, ``best`` rows per item at most."""
        import numpy as np

        if not self.parts:
            return None
        item, score, doc, no_id = (np.concatenate(x) for x in zip(*self.parts))
        order = np.lexsort((doc, no_id, -score, item))
        item, score, doc, no_id = item[order], score[order], doc[order], no_id[order]
        first = np.flatnonzero(np.r_[True, item[1:] != item[:-1]])
        rank = np.arange(len(item)) - np.repeat(first, np.diff(np.r_[first, len(item)]))
        keep = rank < self.best
        last = rank == self.best - 1
        self.least[item[last]] = score[last]
        self.parts = [(item[keep], score[keep], doc[keep], no_id[keep])]
        self.size = int(keep.sum())
        return self.parts[0]


def item_blocks(items: list[list[str]], limit: int) -> Iterator[range]:
    """Ranges of items whose terms have about ``limit`` bytes in sum."""
    start = total = 0
    for k, terms in enumerate(items):
        size = sum(map(len, terms))
        if k > start and total + size > limit:
            yield range(start, k)
            start, total = k, 0
        total += size
    if start < len(items):
        yield range(start, len(items))


def search(docs: DataFrame, items: DataFrame, settings: Settings = Settings(), *, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``item_id, rank, doc_id, score``: each item's best documents with a score above 0.

    Equal scores go by ascending doc_id, null ids last. A repeated document row counts as a
    document of its own, and so does a repeated item row as an item. Null and empty
    texts, and texts without terms, are found by no item and count in no statistic;
    items without terms find nothing; texts are scanned whole, of any length. Items are
    collected (they are the query set) and searched in blocks of ``block_bytes`` of terms,
    a scan each; other columns are not read; an empty table on either side gives an
    empty result.
    """
    spark = docs.sparkSession
    prepare(spark)
    table = boundary_table()
    asked = items.select(F.col(item_col), F.col(item_text_col).cast("string")).collect()
    terms = [sorted(set(terms_of(r[1], table)) - {""}) for r in asked]
    given = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").cast("binary").alias("text")).where("text is not null")
    found = None
    for block in item_blocks(terms, settings.block_bytes):
        part = _search_block(given, terms[block.start : block.stop], block.start, settings, table)
        if part is not None:
            found = part if found is None else found.unionByName(part)
    ids = spark.createDataFrame([(k, r[0]) for k, r in enumerate(asked)], f"item int, item_id {items.schema[item_col].dataType.simpleString()}")
    if found is None:
        found = spark.createDataFrame([], "item int, doc_id long, score long")

    def ranked(df: DataFrame, *by: str) -> DataFrame:
        order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= settings.best)

    salted = found.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(settings.salt)))
    return ranked(ranked(salted, "item", "salt"), "item").join(ids, "item").select("item_id", "rank", "doc_id", "score")


def _search_block(given: DataFrame, items: list[list[str]], offset: int, settings: Settings, table: bytes) -> DataFrame | None:
    import numpy as np

    spark = given.sparkSession
    words = sorted({t for ts in items for t in ts})
    if not words:
        return None
    automaton = spark.sparkContext.broadcast(automaton_of(words))  # at most block_bytes of terms, or one item's
    piece, best = settings.piece, settings.best

    def counted(batches) -> Iterator:
        import numpy as np
        import pyarrow as pa

        df, docs, total = np.zeros(len(words), np.int64), 0, 0
        for batch in batches:
            for text in batch.column(0):
                n, tf = scan(text.as_py(), automaton.value, table, piece)
                docs, total = docs + (n > 0), total + n
                df[list(tf)] += 1
        term = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[-2, -1, term]), pa.array(np.r_[docs, total, df[term]])], names=["term", "n"])

    seen = {r[0]: r[1] for r in given.select("text").mapInArrow(counted, "term long, n long").groupBy("term").agg(F.sum("n")).collect()}
    n_docs, n_terms = seen.get(-2, 0), seen.get(-1, 0)
    if not n_docs:
        return None
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * seen.get(k, 0) + 1))) for k in range(len(words))], np.int64)
    index = {t: k for k, t in enumerate(words)}
    holders: list[list[int]] = [[] for _ in words]
    for i, ts in enumerate(items):
        for t in ts:
            holders[index[t]].append(i)
    outputs = spark.sparkContext.broadcast((weight, np.concatenate(holders).astype(np.int32), np.cumsum([0, *map(len, holders)])))
    n_items = len(items)

    def scored(batches) -> Iterator:
        import numpy as np
        import pyarrow as pa

        weight, holder, first = outputs.value
        top = Best(n_items, best)
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                n, tf = scan(text.as_py(), automaton.value, table, piece)
                if not tf:
                    continue
                term = np.fromiter(tf.keys(), np.int64, len(tf))
                often = np.fromiter(tf.values(), np.int64, len(tf))
                m = 50 + 50 * n * n_docs // n_terms
                gain = weight[term] * (1_000_000_000 * often // (1000 * often + 20 * m))
                many = first[term + 1] - first[term]
                at = np.repeat(first[term + 1] - np.cumsum(many), many) + np.arange(int(many.sum()))
                score = np.zeros(n_items, np.int64)
                np.add.at(score, holder[at], np.repeat(gain, many))
                hit = np.flatnonzero(score)
                top.add(hit, score[hit], 0 if doc is None else doc, doc is not None)
        kept = top.prune()
        if kept is not None:
            item, score, doc, no_id = kept
            yield pa.RecordBatch.from_arrays([pa.array((item + offset).astype(np.int32)), pa.array(doc, mask=no_id), pa.array(score)],
                                             names=["item", "doc_id", "score"])

    return given.mapInArrow(scored, "item int, doc_id long, score long")
