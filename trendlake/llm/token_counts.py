"""Exact byte-level BPE token counts by rank-synchronous array merging.

A batch's distinct pre-tokens are held as one ragged numpy array.  In each
round every sequence finds its lowest-ranked adjacent pair and applies it at
all its places at once; sequences without a ranked pair are done, and their
surviving symbols are the tokens.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendlake.llm.common import pieces

#: How byte-level tokenizers split text before merging (a fixed value of the format).
BYTE_LEVEL_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Distinct pre-tokens whose counts a task remembers before it starts afresh.
MEMORY = 400_000
NO_RANK = 2**31 - 1


def _byte_symbols() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(0x100 + i) for i, b in enumerate(rest)}


def load_byte_bpe(path: str) -> dict:
    """Merge tables of a ``tokenizers`` JSON file with a plain byte-level BPE model.

    Refuses files whose options would change counts (normalizer, prefix space,
    continuing prefixes, stripping special tokens), rather than miscount.
    """
    import numpy as np

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, pre = spec["model"], spec.get("pre_tokenizer") or {}
    odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges") if model.get(k)]
    if model["type"] != "BPE" or spec.get("normalizer") or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True) or odd:
        raise ValueError(f"not a plain byte-level BPE file: {path} {odd}")
    special = spec.get("added_tokens") or []
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in special):
        raise ValueError("special tokens that strip or need word borders are not supported")
    vocab = model["vocab"]
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    left = np.array([vocab[a] for a, _ in merges], np.int64)
    right = np.array([vocab[b] for _, b in merges], np.int64)
    made = np.array([vocab[a + b] for a, b in merges], np.int64)
    width = max(vocab.values()) + 1
    key = left * width + right
    order = np.argsort(key, kind="stable")
    symbols = _byte_symbols()
    return {
        "key": key[order], "rank": order.astype(np.int32), "made": made, "width": width,
        "byte": np.array([vocab[symbols[b]] for b in range(256)], np.int64),
        "special": sorted((t["content"] for t in special), key=len, reverse=True),
    }


def merge_counts(tokens: list[bytes], bpe: dict):
    """Number of symbols left of each byte string after all merges."""
    import numpy as np

    n = len(tokens)
    out = np.zeros(n, np.int64)
    lengths = np.fromiter(map(len, tokens), np.int64, n)
    sym = bpe["byte"][np.frombuffer(b"".join(tokens), np.uint8)]
    seq = np.repeat(np.arange(n), lengths)
    key, rank, made, width = bpe["key"], bpe["rank"], bpe["made"], bpe["width"]
    while len(sym):
        pair = sym[:-1] * width + sym[1:]
        at = np.searchsorted(key, pair)
        at[at == len(key)] = 0
        ranks = np.full(len(sym), NO_RANK, np.int32)
        good = (key[at] == pair) & (seq[:-1] == seq[1:])
        ranks[:-1][good] = rank[at[good]]
        first = np.flatnonzero(np.r_[True, seq[1:] != seq[:-1]])
        best = np.minimum.reduceat(ranks, first)
        sizes = np.diff(np.r_[first, len(sym)])
        done = best == NO_RANK
        out[seq[first[done]]] = sizes[done]
        live = np.repeat(~done, sizes)
        sym, seq, ranks = sym[live], seq[live], ranks[live]
        hit = ranks == np.repeat(best[~done], sizes[~done])
        if not len(sym):
            break
        # of hits that overlap (runs like a a a), every second one holds
        run_start = np.flatnonzero(hit & ~np.r_[False, hit[:-1]])
        where = np.flatnonzero(hit)
        start_of = run_start[np.searchsorted(run_start, where, side="right") - 1]
        where = where[(where - start_of) % 2 == 0]
        sym[where] = made[ranks[where]]
        keep = np.ones(len(sym), bool)
        keep[where + 1] = False
        sym, seq = sym[keep], seq[keep]
    return out


def _counter(bpe: dict):
    import regex

    split = regex.compile(BYTE_LEVEL_SPLIT)
    special = regex.compile("|".join(map(regex.escape, bpe["special"]))) if bpe["special"] else None
    known: dict[str, int] = {}

    def count(texts: list[str]) -> list[int]:
        whole, extra = [], []
        for t in texts:
            if special and special.search(t):
                parts = special.split(t)
                extra.append(len(parts) - 1)
                whole.append([x for p in parts for x in split.findall(p)])
            else:
                extra.append(0)
                whole.append(split.findall(t))
        if len(known) > MEMORY:
            known.clear()
        new = list({x for ws in whole for x in ws if x not in known})
        if new:
            known.update(zip(new, merge_counts([x.encode("utf-8") for x in new], bpe).tolist()))
        look = known.__getitem__
        return [sum(map(look, ws)) + e for ws, e in zip(whole, extra)]

    return count


def count_tokens(docs: DataFrame, tokenizer_path: str, *, id_col: str = "doc_id", text_col: str = "text",
                 max_tokens: int = 512) -> DataFrame:
    """Per row: id, ``n_bytes`` (UTF-8), ``n_tokens``, ``over_limit``.

    Null and empty texts have 0 tokens; null ids stay null; repeated rows give
    repeated rows; other columns are not read, so their names cannot clash.
    One narrow pass: no shuffle, and the tables sent to tasks are bounded by the
    vocabulary.
    """
    spark = docs.sparkSession
    bpe = spark.sparkContext.broadcast(load_byte_bpe(tokenizer_path))

    def run(batches) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc

        count = _counter(bpe.value)
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            sizes = pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False)
            for a, b in pieces(sizes):
                values = [t or "" for t in texts.slice(a, b - a).to_pylist()]
                n = count(values)
                yield pa.RecordBatch.from_arrays([
                    ids.slice(a, b - a),
                    pa.array(sizes[a:b], pa.int64()),
                    pa.array(n, pa.int64()),
                    pa.array([x > max_tokens for x in n], pa.bool_()),
                ], names=out.names)

    src = docs.select(id_col, F.col(text_col).cast("string").alias("_text"))
    out = T.StructType([src.schema[0], T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()),
                        T.StructField("over_limit", T.BooleanType())])
    return src.mapInArrow(run, out)
