"""Toxicity scores of text restored from leetspeak, spacing and repetition.

Writing is seen as a noisy channel: an intended text passed through character
substitutions (``1d10t``), inserted separators (``s t u p i d``) and repeated
letters (``stuuupid``).  Every token that the channel may have touched becomes a
lattice of characters, and Viterbi decoding finds its likeliest source under a
character trigram model counted over all documents.  All other tokens have one
path and stay.  The restored words are then scored by evidence from labels: lower
bounds of how often a word, or words of one beginning, stand in toxic documents,
weighed per document by a logistic regression.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendlake.llm.common import cut, held_out, labelled_sample, pieces

# The letters of the character model, and what a symbol may stand for.
LETTERS = "abcdefghijklmnopqrstuvwxyzßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ"
STANDS_FOR = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
              "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c"}
SEPARATORS = ".-_*~'` "

SYMBOLS = 64  # of the character model: 0 is everything else (a word border), 63 any other letter
OTHER = 63
#: Channel costs in nats: a substituted symbol, a symbol kept as it is, a dropped separator and one kept between
#: single characters, a separator dropped elsewhere, a dropped repeat (of a run of two, of a longer run); and what
#: each written character earns, so that dropping is no gain by itself.
SUBSTITUTE, KEEP_SYMBOL, DROP_SEPARATOR, SPLIT, DROP_ELSEWHERE, DROP_DOUBLE, DROP_RUN, EARNS = 0.5, 8.0, 0.3, 4.0, 3.0, 4.0, 0.5, 2.5

DOUBLE = re.compile(r"(.)\1")
RUN_OF_THREE = re.compile(r"(.)\1\1")
SPACED = re.compile(r"(?:(?<=\s)|^)\S(?:\s+\S){2,}(?=\s|$)")
#: A word that nearly always stands in toxic documents speaks for itself: its bound to this power is a least score.
ALONE = 4
#: The most that a text without any evidence scores.
NO_EVIDENCE = 0.1
EDGES = "\"'`.,;:!?()[]{}<>«»¿¡*%&#=~^/\\|…“”‘’-_+"
EDGE_SYMBOLS = "".join(c for c in EDGES if c in STANDS_FOR)
NO_SYMBOL_IN = frozenset(EDGE_SYMBOLS).isdisjoint
PREFIXES = (4, 5, 6)


@dataclass(frozen=True)
class Settings:
    sample_docs: int = 20_000   # labelled training documents that evidence is counted on, at most
    z: float = 3.2              # deviations by which a share's lower bound lies below it
    least_share: float = 0.15   # features below this bound are not kept
    model_strength: float = 8.0  # pseudo counts of the lower order in the character model


def symbol_table():
    """Code point -> symbol for all code points below 0x250."""
    import numpy as np

    out = np.zeros(0x250, np.int64)
    for c in range(0x250):
        low = chr(c).lower()[:1]
        out[c] = LETTERS.index(low) + 1 if low in LETTERS else OTHER if low.isalpha() else 0
    return out


def _symbols(text: str, lut):
    import numpy as np

    points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    return np.where(points < 0x250, lut[np.minimum(points, 0x24F)], OTHER)


def trigram_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``code, n`` of all character trigrams of all whole texts; at most 64**3 rows."""

    def run(batches) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        lut, total = symbol_table(), np.zeros(SYMBOLS**3, np.int64)
        for batch in batches:
            texts = batch.column(0).drop_null()
            for a, b in pieces(pc.binary_length(texts).to_numpy(zero_copy_only=False)):
                s = _symbols("\n\n" + "\n\n".join(texts.slice(a, b - a).to_pylist()) + "\n\n", lut)
                total += np.bincount((s[:-2] * SYMBOLS + s[1:-1]) * SYMBOLS + s[2:], minlength=SYMBOLS**3)
        code = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(total[code])], names=["code", "n"])

    return docs.select(F.col(text_col).cast("string")).mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


def character_model(counts, strength: float):
    """log P(third | first two) as a 64x64x64 array, interpolated with shorter contexts."""
    import numpy as np

    n3 = np.zeros(SYMBOLS**3)
    for code, n in counts:
        n3[code] = n
    n3 = n3.reshape(SYMBOLS, SYMBOLS, SYMBOLS)
    n2 = n3.sum(0)
    p1 = (n2.sum(0) + 1) / (n2.sum() + SYMBOLS)
    p2 = (n2 + strength * p1) / (n2.sum(1, keepdims=True) + strength)
    p3 = (n3 + strength * p2[None]) / (n3.sum(2, keepdims=True) + strength)
    return np.log(p3).astype(np.float32)


def lattice(span: str) -> list[list[tuple[str, float]]]:
    """Per character of a lower-case span, the outputs it may have come from and their
    costs; '' drops the character and ' ' is a word border."""
    out: list[list[tuple[str, float]]] = []
    n = len(span)
    for i, c in enumerate(span):
        if c.isalpha():
            options = [(c, -EARNS)]
            if i and span[i - 1] == c:
                longer = (i > 1 and span[i - 2] == c) or (i + 1 < n and span[i + 1] == c)
                options.append(("", DROP_RUN if longer else DROP_DOUBLE))
        elif c in STANDS_FOR:
            options = [(x, SUBSTITUTE - EARNS) for x in STANDS_FOR[c]] + [(" ", KEEP_SYMBOL)]
            if i and span[i - 1] == c:
                options.append(("", DROP_RUN))
        elif c in SEPARATORS:
            single = (i < 2 or span[i - 2] in SEPARATORS) and (i + 2 >= n or span[i + 2] in SEPARATORS or span[i + 1] == c)
            options = [(" ", SPLIT), ("", DROP_SEPARATOR)] if single else [(" ", 0.0), ("", DROP_ELSEWHERE)]
        else:
            options = [(" ", 0.0)]
        out.append(options)
    return out


def viterbi(span: str, log_p) -> str:
    """The likeliest source text of a span; linear in its length."""
    index = {c: i + 1 for i, c in enumerate(LETTERS)} | {" ": 0}
    best: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
    for options in lattice(span):
        after: dict[tuple[int, int], tuple[float, tuple | None]] = {}
        for (a, b), (score, path) in best.items():
            for c, cost in options:
                if not c:
                    state, value, step = (a, b), score - cost, path
                else:
                    s = index.get(c, OTHER)
                    state = (b, s)
                    value, step = score - cost + (0.0 if b == s == 0 else float(log_p[a, b, s])), (c, path)
                if state not in after or value > after[state][0]:
                    after[state] = (value, step)
        best = after
    ends = ((v + (float(log_p[a, b, 0]) if b else 0.0), p) for (a, b), (v, p) in best.items())
    _, path = max(ends, key=lambda x: x[0])
    letters = []
    while path is not None:
        letters.append(path[0])
        path = path[1]
    return "".join(reversed(letters)).strip()


#: What a character may at most be restored to, letters that look alike taken as one: every option of a symbol folds alike.
FOLDED = {c: x[0] for c, x in STANDS_FOR.items()} | {"l": "i"}


FOLD = str.maketrans(FOLDED | dict.fromkeys(SEPARATORS))
REPEAT = re.compile(r"(.)\1+", re.DOTALL)


def skeleton(text: str) -> str:
    """A lower-case text with symbols folded to letters, separators dropped and repeats made one."""
    return REPEAT.sub(r"\1", text.translate(FOLD))


class Skeletons:
    """Which tokens, and which runs of fragments, may be restored to a word with evidence.

    Whatever the channel did to a word, its skeleton is left unchanged, so text in which no
    feature's skeleton begins at a place where a word may begin has no such reading.
    """

    HEAD = 5  # first letters by which plain words are told that have no evidence

    def __init__(self, share: dict[str, float]):
        self.begins = {skeleton(f.removeprefix("=")) for f in share} - {""}
        self.whole = {skeleton(f[1:]) for f in share if f[0] == "="} - {""}
        self.parts = {w[:n] for w in self.whole for n in range(1, len(w) + 1)}
        self.lengths = sorted({len(w) for w in self.begins})
        self.opens = {w[:n] for w in self.begins for n in range(len(w) + 1)}
        #: The letters with which the next fragment of a broken word may begin, after each part of one.
        self.follows: dict[str, str] = {}
        for w in self.whole:
            for n in range(1, len(w)):
                known = self.follows.setdefault(w[:n], w[n - 1])
                if w[n] not in known:
                    self.follows[w[:n]] = known + w[n]

    def opened(self, head: str) -> bool:
        """Whether a feature may begin as a plain word does, given the first letters of the word in lower case."""
        s = skeleton(head)
        return s in self.opens or any(s[:n] in self.begins for n in range(1, len(s)))

    def reached(self, token: str) -> bool:
        """Whether a feature may begin somewhere in a lower-case token: at its first
        character or after one that is no letter."""
        if token.isalpha():
            word = skeleton(token)
            return any(word[:n] in self.begins for n in self.lengths)
        for start in [0, *[i + 1 for i, c in enumerate(token) if not c.isalpha()]]:
            seen = ""
            for c in token[start:]:
                if not (c.isalpha() or c in FOLDED or c in SEPARATORS):
                    break
                c = FOLDED.get(c, c)
                if c not in SEPARATORS and not seen.endswith(c):
                    seen += c
                    if seen in self.begins:
                        return True
                    if seen not in self.opens:
                        break
        return False


def three_singles(tokens: list[str]) -> bool:
    """Whether three tokens of one character follow each other."""
    return b"\1\1\1" in bytes(map((1).__eq__, map(len, tokens)))


class Restorer:
    """Restores tokens and spaced-out spans; remembers what it has decoded."""

    #: Spans longer than this are decoded in pieces (each begins a word), and longer than ``SHORT`` are not remembered.
    PIECE, SHORT = 4096, 64

    def __init__(self, log_p, memory: int = 100_000):
        self.log_p, self.memory, self.known = log_p, memory, {}

    def words(self, token: str) -> tuple[str, ...]:
        """The restored words of one token (no white space in it)."""
        core = token.strip(EDGES).lower()
        if core.isalpha() and not RUN_OF_THREE.search(core):
            return (core,)
        core = token.lower().strip("\"'`.,;:?)[]{}<>«»¿¡*%&#=~^/\\…“”‘’-_").rstrip("!|+(")
        if core.endswith("$$$"):  # three or more are a price mark or a line, not letters
            core = core.rstrip("$")
        core = core.replace("()", "0")
        if not any(map(str.isalpha, core)):
            return ()
        return self.decoded(core)

    def readings(self, token: str) -> set[str]:
        """The words of ``words``, and those that doubled letters and symbols at the token's
        edges may stand for."""
        out, low = set(self.words(token)), token.lower()
        core = low.strip(EDGES)
        if not any(map(str.isalpha, core)):
            return out
        at = low.index(core)
        head, tail = low[:at], low[at + len(core) :]
        head, tail = head[len(head.rstrip(EDGE_SYMBOLS)) :], tail[: len(tail) - len(tail.lstrip(EDGE_SYMBOLS))]
        spans = {(h + core + t).replace("()", "0") for h in ("", head) for t in ("", tail)}
        if core.isalpha():
            doubles = [m.start() for m in DOUBLE.finditer(core)]
            if not doubles:
                spans.discard(core)
            else:
                out.add(DOUBLE.sub(r"\1", core))
                out.update(core[:i] + core[i + 1 :] for i in doubles)
        return out.union(*map(self.decoded, spans))

    def decoded(self, span: str) -> tuple[str, ...]:
        out = self.known.get(span)
        if out is None:
            out = tuple(w for i in range(0, len(span), self.PIECE) for w in viterbi(span[i : i + self.PIECE], self.log_p).split())
            if len(span) <= self.SHORT:
                if len(self.known) >= self.memory:
                    self.known.clear()
                self.known[span] = out
        return out

    def spaced(self, text: str, tokens: list[str] | None = None) -> list[str]:
        """Words restored from runs of single characters with spaces between; a run may
        begin with a word of one letter, so it is read with and without its first."""
        if not three_singles(text.split() if tokens is None else tokens):
            return []
        spans = [" ".join(m[0].lower().split()) for m in SPACED.finditer(text) if any(map(str.isalpha, m[0]))]
        return [w for s in spans for part in (s, s[2:]) for w in self.decoded(part)]


def features(word: str) -> list[str]:
    return ["=" + word, *[word[:n] for n in PREFIXES if len(word) >= n]]


def _evidence(sample: DataFrame, restorer_of, wanted=None) -> DataFrame:
    """``feature, hits, n``: documents that have the feature, toxic and all. With
    ``wanted`` (a broadcast set of features) instead: for a word the distinct words
    that stand before it, so that copies of one document count once; for a prefix
    the distinct words that it begins, so that one word does not speak for others."""

    def run(batches) -> Iterator:
        import pyarrow as pa

        def rows(seen: Counter):
            keys = list(seen)
            return pa.RecordBatch.from_arrays([
                pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()),
                pa.array([k[2] for k in keys], pa.string()), pa.array([seen[k] for k in keys], pa.int64())],
                names=["feature", "label", "context", "n"])

        restorer, seen = restorer_of(), Counter()
        for batch in batches:
            for text, label in zip(batch.column(0), batch.column(1).to_pylist()):
                tokens = text.as_py().split()
                if wanted is None:
                    words = {w for t in set(tokens) for w in restorer.words(t)} | set(restorer.spaced(text.as_py()))
                    seen.update((f, label, "") for f in {f for w in words for f in features(w)})
                else:
                    before = ""
                    for w in [w for t in tokens for w in restorer.words(t)] + restorer.spaced(text.as_py()):
                        for f in features(w):
                            if f in wanted.value:
                                seen[f, label, before if f[0] == "=" else w] = 1
                        before = w
                if len(seen) > 150_000:  # partial sums; Spark adds them up
                    yield rows(seen)
                    seen.clear()
        yield rows(seen)

    found = sample.select("text", "label").mapInArrow(run, "feature string, label int, context string, n long")
    if wanted is not None:
        found = found.select("feature", "label", "context", F.lit(1).alias("n")).distinct()
    return found.groupBy("feature").agg(
        F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("hits"), F.sum("n").alias("n"))


class Reader:
    """Reads a text's evidence: a few numbers from the bounds of its restored words.

    Tokens and runs of fragments are decoded only if their skeletons reach a feature. What is
    remembered is bounded: tokens of 64 characters at most, 300,000 of them.
    """

    MEMORY = 300_000

    def __init__(self, log_p, share: dict[str, float]):
        self.restorer, self.share, self.skeletons = Restorer(log_p), share, Skeletons(share)
        self.forget()

    def forget(self) -> None:
        self.known: set[str] = set()
        self.evident: dict[str, float] = {}  # known tokens with evidence
        self.starts: dict[str, str] = {}     # skeletons of tokens that a broken word may begin with
        self.heads: dict[str, bool] = {}     # whether plain words of these first letters may have evidence
        self.letters: dict[str, str] = {}    # what skeletons of tokens with these first characters begin with
        self.fragments: dict[str, str] = {}  # skeletons of tokens that came after one of ``starts``

    def _best(self, words) -> float:
        best, share = 0.0, self.share
        for w in words:
            best = max(best, share.get("=" + w, 0.0))
            for n in PREFIXES:
                if len(w) >= n and (v := share.get(w[:n], 0.0)) > best:
                    best = v
        return best

    def reading(self, token: str) -> tuple[float, tuple[str, ...]]:
        """The words that a token stands for, and their best bound: of all its readings the
        one with the most evidence, and without evidence the likeliest."""
        low = token.lower()
        if not self.skeletons.reached(low.replace("()", "0")):
            return 0.0, self.restorer.words(token)
        value, word = max(((self._best((w,)), w) for w in self.restorer.readings(token)), default=(0.0, ""))
        words = self.restorer.words(token)
        return value, words if not value or word in words else (word,)

    @staticmethod
    def plain(token: str) -> str | None:
        """A token's word, if the channel can have changed nothing but its case and doubled letters."""
        core = token.strip(EDGES)
        if not core.isalpha():
            return None
        return core if len(core) == len(token) or NO_SYMBOL_IN(token.replace(core, "", 1)) else None

    def value(self, token: str) -> float:
        """The bound of ``reading``, found without decoding where nothing asks for it."""
        core = self.plain(token)
        return self._value(token, core if core is None else core.lower())

    def _value(self, token: str, low: str | None) -> float:
        """``value``, given the lower-case plain word, if the token is one."""
        return self._best((low,)) if low is not None and not DOUBLE.search(low) else self.reading(token)[0]

    def fragment(self, token: str) -> str:
        """The skeleton of a token that may be a part of a broken word, or ''."""
        core = token.lower().strip(EDGES).replace("()", "0")
        if len(core) > Restorer.SHORT:
            return ""
        return skeleton(core) if core.isalpha() or all(c.isalpha() or c in FOLDED for c in core) else ""

    def learn(self, tokens: set[str]) -> list[str]:
        """Remembers what new tokens stand for; returns those that are too long for that."""
        if len(self.known) > self.MEMORY:
            self.forget()
        heads, known, opened, size, longer = self.heads, self.known, self.skeletons.opened, self.skeletons.HEAD, []
        for t in tokens.difference(known):
            if len(t) > Restorer.SHORT:
                longer.append(t)
                continue
            known.add(t)
            core = t if t.isalpha() else self.plain(t)
            low = None
            if core is not None:  # most tokens end here
                low = core.lower()
                head = low[:size]
                if (may := heads.get(head)) is None:
                    may = heads[head] = opened(head)
                if not may:
                    continue
            if value := self._value(t, low):
                self.evident[t] = value
            elif (s := skeleton(low) if low is not None else self.fragment(t)) in self.skeletons.parts and s not in self.skeletons.whole:
                self.starts[t] = s
        return longer

    def letter(self, c: str) -> str:
        """The first letter of the skeletons of tokens that begin with ``c``, '' if it takes more to tell."""
        if (out := self.letters.get(c)) is None:
            out = self.letters[c] = skeleton(c.lower())[:1] if c.isalpha() else ""
        return out

    def runs(self, tokens: list[str]) -> list[tuple[int, int, str]]:
        """``first, end, word`` of runs of tokens that are fragments of one word with evidence,
        if the character model reads them as one rather than apart."""
        out, parts, whole, starts, fragments = [], self.skeletons.parts, self.skeletons.whole, self.starts, self.fragments
        follows, letters = self.skeletons.follows, self.letters
        for i in [i for i, t in enumerate(tokens[:-1]) if t in starts]:
            seen, c = starts[tokens[i]], tokens[i + 1][0]
            if (first := letters[c] if c in letters else self.letter(c)) and first not in follows[seen]:
                continue  # most end here
            for j in range(i + 1, len(tokens)):
                s = fragments.get(tokens[j])
                if s is None:
                    s = self.fragment(tokens[j])
                    if s or len(tokens[j]) <= Restorer.SHORT:
                        fragments[tokens[j]] = s
                if not s:
                    break
                seen += s[1:] if seen[-1] == s[0] else s
                if seen not in parts:
                    break
                if seen in whole:
                    span = " ".join(t.lower().strip(EDGES).replace("()", "0") for t in tokens[i : j + 1])
                    words = self.restorer.decoded(span)
                    if len(words) == 1 and "=" + words[0] in self.share:
                        out.append((i, j + 1, words[0]))
        return out

    def numbers(self, text: str) -> list[float]:
        """The three best bounds of different tokens, the sum of all, the sum per token, the
        logarithm of the number of tokens."""
        tokens = text.split()
        own = set(tokens)
        longer = self.learn(own)
        found = [self.evident[t] for t in self.evident.keys() & own]
        found += [v for t in longer if (v := self.value(t)) > 0]  # long ones are not remembered
        found += [v for w in {*self.restorer.spaced(text, tokens), *[w for _, _, w in self.runs(tokens)]} if (v := self._best((w,))) > 0]
        found.sort(reverse=True)
        best = (found + [0.0, 0.0, 0.0])[:3]
        n = len(tokens)
        return [*best, min(sum(found), 10.0), sum(found) / (n + 20) * 100, math.log1p(n)]

    def text(self, text: str) -> str:
        """The whole text as it is read for its score, its white space made single spaces."""
        decoded = self.restorer.decoded
        text = SPACED.sub(lambda m: " ".join(decoded(" ".join(m[0].lower().split()))) if any(map(str.isalpha, m[0])) else m[0], text)
        tokens = text.split()
        self.learn(set(tokens))
        ends = {i: (end, word) for i, end, word in self.runs(tokens)}
        out, i = [], 0
        while i < len(tokens):
            if i in ends:
                i, word = ends[i]
                out.append(word)
            else:
                out += self.reading(tokens[i])[1]
                i += 1
        return " ".join(out)


def regression(x, y, ridge: float = 3.0, steps: int = 50):
    """Logistic regression by Newton's method: least and greatest value, mean, scale and
    weight of the columns; the weights are those of the standardised columns."""
    import numpy as np

    mean, scale = x.mean(0), np.maximum(x.std(0), 1e-3)
    z = np.column_stack([(x - mean) / scale, np.ones(len(x))])
    w = np.zeros(z.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        hessian = (z * (p * (1 - p))[:, None]).T @ z + ridge * np.eye(len(w))
        step = np.linalg.solve(hessian, z.T @ (y - p) - ridge * w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return x.min(0), x.max(0), mean, scale, w


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), *, label_col: str = "toxic",
        id_col: str = "doc_id", text_col: str = "text") -> dict:
    """The character model of all documents; lower bounds of the share of toxic contexts
    for the features that matter; and a regression that weighs a document's bounds.
    Without labels of both kinds there is no regression."""
    import numpy as np

    spark = docs.sparkSession
    log_p = character_model([(r[0], r[1]) for r in trigram_counts(docs, text_col).collect()], settings.model_strength)
    sent = spark.sparkContext.broadcast(log_p)

    def restorer_of():
        return Restorer(sent.value)

    sample = cut(labelled_sample(docs, labels, label_col, settings.sample_docs, id_col=id_col, text_col=text_col), "toxicity-sample")

    def bounded(found: DataFrame) -> dict[str, float]:
        z = F.lit(settings.z)
        p, n = F.col("hits") / F.col("n"), F.col("n")
        low = (p + z * z / (2 * n) - z * F.sqrt((p * (1 - p) + z * z / (4 * n)) / n)) / (1 + z * z / n)
        return {r[0]: r[1] for r in found.withColumn("low", low).where(F.col("low") >= settings.least_share).select("feature", "low").collect()}

    first = bounded(_evidence(sample, restorer_of))
    wanted = spark.sparkContext.broadcast(frozenset(first))
    share = bounded(_evidence(sample, restorer_of, wanted))
    known = spark.sparkContext.broadcast(share)

    def read(batches) -> Iterator:
        import pyarrow as pa

        reader = Reader(sent.value, known.value)
        for batch in batches:
            rows = [reader.numbers(t.as_py()) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64())), batch.column(1)], names=["x", "label"])

    rows = sample.select("text", "label").mapInArrow(read, "x array<double>, label int").collect()  # at most sample_docs
    y = np.array([float(r["label"] > 0) for r in rows])
    both = len(y) and 0 < y.sum() < len(y)
    return {"log_p": log_p, "share": share, "weights": regression(np.array([r["x"] for r in rows]), y) if both else None}


def score(docs: DataFrame, model: dict, *, text_col: str = "text", keep: tuple[str, ...] | None = None,
          score_col: str = "score") -> DataFrame:
    """The columns ``keep`` of ``docs`` (all by default) and a score in [0, 1] from the
    evidence in a text's restored words. One narrow pass."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    names = list(docs.columns if keep is None else keep)
    given = docs.select(*[F.col(c) for c in names], F.col(text_col).cast("string").alias("__text__"))

    def run(batches) -> Iterator:
        import numpy as np
        import pyarrow as pa

        reader = Reader(sent.value["log_p"], sent.value["share"])
        weights = sent.value["weights"]
        for batch in batches:
            x = np.array([reader.numbers(t.as_py() or "") for t in batch.column(len(names))]).reshape(-1, 6)
            if weights is None:
                out = x[:, 0]
            else:
                low, high, mean, scale, w = weights  # no extrapolation to longer texts than were learned from
                z = np.column_stack([(np.clip(x, low, high) - mean) / scale, np.ones(len(x))]) @ w
                out = np.maximum(1 / (1 + np.exp(-np.clip(z, -30, 30))), x[:, 0] ** ALONE)
                out = np.where(x[:, 0] > 0, out, np.minimum(out, NO_EVIDENCE))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(out, pa.float64())], names=[*names, score_col])

    return given.mapInArrow(run, T.StructType([*given.schema.fields[:-1], T.StructField(score_col, T.DoubleType())]))


def restored(docs: DataFrame, model: dict, *, text_col: str = "text", out_col: str = "restored") -> DataFrame:
    """``docs`` with the text that the score was read from, the channel's noise taken away: lower-case
    words, single spaces; '' for null and empty texts. A column of that name is replaced."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in docs.columns if c != out_col]
    given = docs.select(*kept, F.col(text_col).cast("string").alias("__text__"))

    def run(batches) -> Iterator:
        import pyarrow as pa

        reader = Reader(sent.value["log_p"], sent.value["share"])
        for batch in batches:
            texts = [reader.text(t.as_py() or "") for t in batch.column(len(kept))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())], names=[*kept, out_col])

    return given.mapInArrow(run, T.StructType([*given.schema.fields[:-1], T.StructField(out_col, T.StringType())]))


def toxicity(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), *, id_col: str = "doc_id",
             text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """``doc_id, held_out, score, predicted`` per row of ``docs``.

    Null and empty texts have no evidence and score lowest; null ids are scored and not
    held out; repeated rows score alike; labels without document, null labels and
    repeated labels (the greatest counts) do no harm; without any toxic label all scores
    are 0; other columns are not read; an empty table gives an empty result.
    """
    model = fit(docs, labels, settings, id_col=id_col, text_col=text_col)
    scored = score(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), model, keep=("doc_id",))
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
