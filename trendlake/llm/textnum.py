"""Words of many texts as numpy arrays, straight from Arrow's UTF-8 buffers.

A word is a maximal run of bytes other than space and 0x09-0x0D, as in
``[^\\x20\\x09-\\x0D]+``; UTF-8 never uses these bytes inside a character.
Hashes are 64 bits wide.
"""

from __future__ import annotations

SEED = 0x5EED


def mixed(x):
    """The finalizer of splitmix64: mixes all bits of unsigned 64-bit integers."""
    import numpy as np

    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def buffers(texts):
    """(bytes, offsets) of a pyarrow string array; nulls are empty."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    off = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


class Hasher:
    """Hashes byte ranges of a buffer by differences of running polynomial sums."""

    def __init__(self, lower: bool = False):
        import numpy as np

        rng = np.random.default_rng(SEED)
        table = rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
        if lower:
            table[0x41:0x5B] = table[0x61:0x7B]
        self.table = table
        self.base = np.uint64(0x9E3779B97F4A7C15)
        self.inverse = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
        self.powers = self.roots = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        import numpy as np

        if len(self.powers) < n:
            for name, b in (("powers", self.base), ("roots", self.inverse)):
                x = np.full(max(n, 1 << 16), b, np.uint64)
                x[0] = 1
                setattr(self, name, np.cumprod(x))

    def steps(self, n: int):
        """The base's first ``n`` powers, and those of its inverse."""
        self._grow(n)
        return self.powers[:n], self.roots[:n]

    def ranges(self, data, starts, ends):
        import numpy as np

        n = len(data)
        self._grow(n + 1)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(self.table[data] * self.powers[:n], out=total[1:])
        return mixed((total[ends] - total[starts]) * self.roots[starts] + (ends - starts).astype(np.uint64))


def words(data, offsets):
    """Starts and ends of all words, and the number of words before each text
    (length of texts + 1)."""
    import numpy as np

    n = len(data)
    inside = np.ones(n + 2, bool)
    inside[0] = inside[-1] = False
    inside[1:-1] = (data != 0x20) & ((data < 0x09) | (data > 0x0D))
    border = np.zeros(n + 1, bool)
    border[offsets] = True
    starts = np.flatnonzero(inside[1:] & (~inside[:-1] | border))
    ends = np.flatnonzero(inside[:-1] & (~inside[1:] | border))
    return starts, ends, np.searchsorted(starts, offsets)


def shingles(word_hashes, first, n: int):
    """Hashes of all runs of ``n`` words inside each text; a text with fewer words, but
    at least one, has its whole sequence as one. Returns (hashes, first shingle of each
    text + total)."""
    import numpy as np

    count = np.diff(first)
    have = np.where(count >= n, count - n + 1, (count > 0).astype(np.int64))
    out_first = np.r_[0, np.cumsum(have)]
    odd = [np.uint64(int(x) | 1) for x in np.random.default_rng(SEED + n).integers(2**62, 2**63, n)]
    if len(word_hashes) >= n:
        rolled = np.zeros(len(word_hashes) - n + 1, np.uint64)
        for k in range(n):
            rolled += word_hashes[k : len(word_hashes) - n + 1 + k] * odd[k]
    else:
        rolled = np.zeros(0, np.uint64)
    out = np.empty(out_first[-1], np.uint64)
    full = count >= n
    text_of = np.repeat(np.arange(len(count)), have)
    at = first[text_of] + np.arange(len(out)) - out_first[text_of]
    whole = full[text_of]
    out[whole] = rolled[at[whole]]
    for t in np.flatnonzero(~full & (count > 0)):
        short = word_hashes[first[t] : first[t + 1]]
        out[out_first[t]] = (short * np.array(odd[: len(short)], np.uint64)).sum() ^ np.uint64(len(short))
    return mixed(out), out_first
