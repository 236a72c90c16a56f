"""Quality of documents by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE_WORDS`` words.  Every passage is
encoded from its writing (letter case, symbols, word shapes, repetition, hashed
common words); a gated attention, learned from document labels alone, weighs the
encodings; the weighted representation gives the score (Ilse, Tomczak and
Welling, 2018).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendlake.llm import textnum
from trendlake.llm.common import cut, held_out, labelled_sample, pieces

PASSAGE_WORDS = 64
WORD_BUCKETS = 16
SYMBOL_BYTES = b"!|%$&*#@<>{}[]()=+~^_/\\\"';:?.,-"


@dataclass(frozen=True)
class Settings:
    sample_docs: int = 6_000     # labelled training documents the network is fitted on, at most
    sample_passages: int = 96    # of each of them, evenly spread, for the fit only
    hidden: int = 24
    gate: int = 12
    epochs: int = 400
    rate: float = 0.01
    decay: float = 1e-4
    seed: int = 7


def passage_features(texts):
    """(features, first): one row per passage, and the first passage of each text (+ total).
    Every text has at least one passage; that of a text without words is all zero."""
    import numpy as np

    data, offsets = textnum.buffers(texts)
    starts, ends, first = textnum.words(data, offsets)
    n_words = np.diff(first)
    n_pass = np.maximum(1, -(-n_words // PASSAGE_WORDS))
    pass_first = np.r_[0, np.cumsum(n_pass)]
    total = pass_first[-1]
    text_of = np.repeat(np.arange(len(n_words)), n_words)
    place = np.arange(len(starts)) - first[text_of]
    passage = pass_first[text_of] + place // PASSAGE_WORDS
    h = textnum.Hasher(lower=True).ranges(data, starts, ends)

    kinds = np.zeros(256, np.int64)  # 0 other, 1 upper, 2 lower, 3 digit, 4 symbol, 5 beyond ASCII
    kinds[0x41:0x5B], kinds[0x61:0x7B], kinds[0x30:0x3A], kinds[0x80:] = 1, 2, 3, 5
    kinds[np.frombuffer(SYMBOL_BYTES, np.uint8)] = 4

    def per_word(mask):
        sums = np.r_[0, np.cumsum(mask)]
        return (sums[ends] - sums[starts]).astype(np.float64)

    kind = kinds[data]
    upper, lower, digit, symbol, beyond = (per_word(kind == k) for k in range(1, 6))
    length = (ends - starts).astype(np.float64)
    last = data[ends - 1] if len(ends) else np.zeros(0, np.uint8)
    head = data[starts] if len(starts) else np.zeros(0, np.uint8)

    def per_passage(x):
        return np.bincount(passage, weights=x, minlength=total)

    words_in = per_passage(np.ones(len(starts)))
    some, chars = np.maximum(words_in, 1), np.maximum(per_passage(length), 1)
    order = np.lexsort((h, passage))
    new = np.ones(len(h), bool)
    if len(h):
        new[1:] = (h[order][1:] != h[order][:-1]) | (passage[order][1:] != passage[order][:-1])
    distinct = np.bincount(passage[order][new], minlength=total)
    order = np.lexsort((place, h, text_of))  # repeats over the whole text
    seen = np.zeros(len(h), bool)
    if len(h):
        o = order
        seen[o[1:]] = (h[o][1:] == h[o][:-1]) & (text_of[o][1:] == text_of[o][:-1])
    pair = np.zeros(len(h), np.uint64)
    if len(h) > 1:
        pair[:-1] = h[:-1] * np.uint64(3) + h[1:]
    o = np.lexsort((place, pair, text_of))
    again = np.zeros(len(h), bool)
    if len(h):
        again[o[1:]] = (pair[o][1:] == pair[o][:-1]) & (text_of[o][1:] == text_of[o][:-1])

    columns = [
        words_in / PASSAGE_WORDS, chars / some / 10, per_passage(upper) / chars, per_passage(lower) / chars,
        per_passage(digit) / chars, per_passage(symbol) / chars, per_passage(beyond) / chars,
        per_passage(symbol >= 2) / some, per_passage(symbol == length) / some, per_passage((upper > 1) & (lower == 0)) / some,
        per_passage((head >= 0x41) & (head <= 0x5A)) / some, per_passage(last == 0x2E) / some, per_passage(last == 0x2C) / some,
        per_passage(length == 1) / some, per_passage(length > 14) / some, per_passage(digit > 0) / some,
        distinct / some, per_passage(seen) / some, per_passage(again) / some,
        np.sqrt(np.maximum(per_passage(length * length) / some - (chars / some) ** 2, 0)) / 10,
    ]
    symbol_of = np.full(256, -1)
    symbol_of[np.frombuffer(SYMBOL_BYTES, np.uint8)] = np.arange(len(SYMBOL_BYTES))
    at = np.flatnonzero(kind == 4)
    word_at = np.searchsorted(starts, at, side="right") - 1
    by_symbol = np.bincount(passage[word_at] * len(SYMBOL_BYTES) + symbol_of[data[at]], minlength=total * len(SYMBOL_BYTES))
    short = np.flatnonzero(length <= 4)  # common function words, by hash
    by_bucket = np.bincount(passage[short] * WORD_BUCKETS + (h[short] % np.uint64(WORD_BUCKETS)).astype(np.int64),
                            minlength=total * WORD_BUCKETS)
    x = np.column_stack([*columns, by_symbol.reshape(total, -1) / some[:, None], by_bucket.reshape(total, -1) / some[:, None]])
    x[words_in == 0] = 0
    return x.astype(np.float32), pass_first


def forward(net: dict, x, bag, n_bags: int):
    """Bag logits and what the gradient needs. ``bag``: the bag of each passage,
    ascending; no bag is empty."""
    import numpy as np

    xs = (x - net["mean"]) / net["scale"]
    h = np.tanh(xs @ net["W"] + net["b"])
    t, g = np.tanh(h @ net["V"] + net["v"]), 1 / (1 + np.exp(-(h @ net["U"] + net["u"])))
    e = (t * g) @ net["w"]
    first = np.searchsorted(bag, np.arange(n_bags))
    a = np.exp(e - np.maximum.reduceat(e, first)[bag])
    a /= np.add.reduceat(a, first)[bag]
    z = np.add.reduceat(a[:, None] * h, first)
    return z @ net["c"] + net["d"], (xs, h, t, g, a, z)


def train(x, bag, y, settings: Settings) -> dict:
    """Full-batch Adam on the mean log loss; the same result in every run."""
    import numpy as np

    rng = np.random.default_rng(settings.seed)
    d, k, m, n = x.shape[1], settings.hidden, settings.gate, len(y)
    net = {
        "mean": x.mean(0), "scale": np.maximum(x.std(0), 0.02), "W": rng.normal(0, d**-0.5, (d, k)), "b": np.zeros(k),
        "V": rng.normal(0, k**-0.5, (k, m)), "v": np.zeros(m), "U": rng.normal(0, k**-0.5, (k, m)), "u": np.zeros(m),
        "w": rng.normal(0, m**-0.5, m), "c": rng.normal(0, k**-0.5, k), "d": np.zeros(1),
    }
    free = [p for p in net if p not in ("mean", "scale")]
    m1, m2 = ({p: np.zeros_like(net[p]) for p in free} for _ in range(2))
    for step in range(1, settings.epochs + 1):
        logit, (xs, h, t, g, a, z) = forward(net, x, bag, n)
        err = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - y) / n
        dz = err[:, None] * net["c"]
        da = (dz[bag] * h).sum(1)
        de = a * (da - np.bincount(bag, weights=a * da, minlength=n)[bag])
        dt, dg = de[:, None] * net["w"] * g * (1 - t * t), de[:, None] * net["w"] * t * g * (1 - g)
        dh = (a[:, None] * dz[bag] + dt @ net["V"].T + dg @ net["U"].T) * (1 - h * h)
        grad = {"c": z.T @ err, "d": err.sum(keepdims=True), "w": ((t * g) * de[:, None]).sum(0), "V": h.T @ dt, "v": dt.sum(0),
                "U": h.T @ dg, "u": dg.sum(0), "W": xs.T @ dh, "b": dh.sum(0)}
        for p in free:
            gp = grad[p] + settings.decay * net[p]
            m1[p] = 0.9 * m1[p] + 0.1 * gp
            m2[p] = 0.999 * m2[p] + 0.001 * gp * gp
            net[p] = net[p] - settings.rate * (m1[p] / (1 - 0.9**step)) / (np.sqrt(m2[p] / (1 - 0.999**step)) + 1e-8)
    return net


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), *, label_col: str = "quality",
        id_col: str = "doc_id", text_col: str = "text") -> dict | None:
    """The network, fitted on a bounded sample of labelled documents outside the
    held-out fold; None without labels."""
    import numpy as np

    def run(batches) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            x, first = passage_features(batch.column(1))
            out = []
            for i in range(batch.num_rows):
                own = x[first[i] : first[i + 1]]
                if len(own) > settings.sample_passages:
                    own = own[np.linspace(0, len(own) - 1, settings.sample_passages).astype(int)]
                out.append(own.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(out, pa.binary())], names=["id", "label", "x"])

    sample = labelled_sample(docs, labels, label_col, settings.sample_docs, id_col=id_col, text_col=text_col)
    bags = cut(sample.selectExpr("cast(_id as string) id", "text", "label").mapInArrow(run, "id string, label int, x binary"), "quality-bags")
    rows = sorted((r["id"], r["label"], bytes(r["x"])) for r in bags.collect())
    if not rows:
        return None
    width = passage_features(_one_text(""))[0].shape[1]
    xs = [np.frombuffer(r[2], np.float32).reshape(-1, width) for r in rows]
    bag = np.repeat(np.arange(len(xs)), [len(x) for x in xs])
    return train(np.concatenate(xs).astype(np.float64), bag, np.array([float(r[1]) for r in rows]), settings)


def _one_text(text: str):
    import pyarrow as pa

    return pa.array([text])


def quality(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), *, id_col: str = "doc_id",
            text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """``doc_id, held_out, score, predicted, passages`` per row of ``docs``; all passages of whole texts.

    Null and empty texts are one empty passage; null ids are scored and not held out;
    repeated rows score alike; labels without document, null labels and repeated
    labels (the greatest counts) do no harm; without any label all scores are 0.5;
    other columns are not read; an empty table gives an empty result.
    """
    net = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, settings, id_col=id_col, text_col=text_col))

    def run(batches) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        for batch in batches:
            sizes = pc.binary_length(batch.column(1)).fill_null(0).to_numpy(zero_copy_only=False)
            for a, b in pieces(sizes):
                x, first = passage_features(batch.column(1).slice(a, b - a))
                n = np.diff(first)
                score = np.full(b - a, 0.5)
                if net.value is not None:
                    logit, _ = forward(net.value, x.astype(np.float64), np.repeat(np.arange(b - a), n), b - a)
                    score = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(score), pa.array(n, pa.int64())],
                                                 names=["doc_id", "score", "passages"])

    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    out = T.StructType([src.schema[0], T.StructField("score", T.DoubleType()), T.StructField("passages", T.LongType())])
    return src.mapInArrow(run, out).select("doc_id", held_out("doc_id").alias("held_out"), "score",
                                           (F.col("score") >= threshold).cast("int").alias("predicted"), "passages")
