"""Toxicity scores of texts restored from obfuscation by a noisy-channel decoder.

1. Folding. Text is case-folded, accents are stripped (NFKD), Cyrillic and Greek
   letters that look like Latin ones become those in words that hold a Latin letter,
   and what is left outside ASCII is dropped, so the alphabet is a-z, digits and ASCII symbols.
2. Character language model. Trigram counts over a-z and the word boundary of
   *all* documents, summed by Spark (27**3 numbers at most), smoothed by
   interpolation with bigrams and unigrams.
3. Noisy channel. Spans that look written around a filter (letters mixed with
   digits or symbols, single letters set apart, letters repeated three or more
   times) become lattices: each character may have been sent as one of the
   letters it resembles, a repeated letter may have been sent once, and a
   separator inside a span may have been sent as nothing or as a word boundary.
   Viterbi finds the likeliest sent string under the language model plus channel
   costs; that string replaces the span. Symbols and digits at a span's edge may be
   punctuation: the span is also decoded without them, the reading of the higher mean
   likelihood is the restored one, and the score takes the evidence of both. Other
   text passes through unchanged.
4. Score. Every distinct word of the restored text gets the evidence of its
   boundary-anchored character n-grams, the log-odds learnt from labelled rows; a
   logistic model on the strongest words gives the score. It does not dilute with
   length: one insult counts the same in a short and in a long text.

Labels come from a sample of at most ``SAMPLE_PER_CLASS`` labelled ids per class
(smallest hashes of the id); text repeated in it counts once. Everything else
covers all rows.

Defined results: a null, empty or letterless text scores as a text without
evidence; with no labels, or of one class only, every score is the share of that
class (0.0 without labels). Conflicting labels of one id count as toxic.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SAMPLE_PER_CLASS = 8000
BUCKETS = 1 << 22
MIN_TEXTS = 4  # distinct toxic texts an n-gram must be seen in
PRIOR = 2.0
CACHE_WORDS = 600_000

# What a character may stand for besides itself.
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "<": "c", "&": "a", "#": "h",
}
SEPARATORS = " \n\r\t.-_*~'/,:;`^\""
# Cyrillic and Greek letters (folded) and the Latin ones they look like.
HOMOGLYPHS = str.maketrans("\u0430\u0435\u043e\u0440\u0441\u0445\u0443\u0456\u0455\u0458\u04bb\u043a\u0442\u043c\u0432\u043d\u0501\u051b\u051d"
                           "\u03b1\u03bf\u03c1\u03bd\u03b9\u03ba\u03c4\u03c5\u03c7\u03b5", "aeopcxyisjhktmbhdqwaopvikt" "uxe")
# Channel costs in nats.
LOOKALIKE_COST, DROP_LOOKALIKE_COST, DROP_SYMBOL_COST, REPEAT_COST = 0.7, 12.0, 4.0, 0.4
DROP_SEPARATOR_COST, KEEP_SEPARATOR_COST = 0.3, 1.0

_LEET = re.escape("".join(LOOKALIKES))
_SEP = re.escape(SEPARATORS.strip())
# Inside one token: a run of letters, look-alikes and separators.
RUN = re.compile(r"[a-z" + _LEET + _SEP + r"]+")
DOUBLED = re.compile(r"([a-z])\1")
# Across tokens: three or more single characters set apart; looked for in the text's shape first.
SPACED = re.compile(r"(?<![^\s.,;:!?\"(])[a-z0-9@$](?:[ \n\r\t.\-_*~'/,:;]{1,3}[a-z0-9@$!|](?![a-z0-9@$])){2,}")
EDGE = "0123456789" + "".join(c for c in LOOKALIKES if not c.isdigit())
WORD = re.compile(r"[a-z]+")
MIXED = re.compile(r"(?=[^\W\d_]*[a-z])[^\W\d_]*[\u0370-\u052f][^\W\d_]*")
BEYOND = re.compile(r"[\u0370-\u052f]")
_SHAPE = bytes(97 if 97 <= c <= 122 or 48 <= c <= 57 or c in b"@$!|" else 32 for c in range(256))
_APART = (b" a a a ", b" a  a  a ", b" a   a   a ")


def fold(text: str | None) -> str:
    """Case-folded ASCII form; sharp s and ligatures become their letters."""
    x = (text or "").casefold()
    if not x.isascii():
        x = unicodedata.normalize("NFKD", x)
        if BEYOND.search(x):
            x = MIXED.sub(lambda m: m.group().translate(HOMOGLYPHS), x)
    return x.encode("ascii", "ignore").decode("ascii")


# --- character language model -------------------------------------------------

_CODES = bytes((c - 96) if 97 <= c <= 122 else 0 for c in range(256))


def char_counts(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Trigram counts (27, 27, 27) of all texts; code 0 is the word boundary."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(27 ** 3, np.int64)
        for batch in batches:
            for value in batch.column(0):
                codes = np.frombuffer((" " + fold(value.as_py()) + " ").encode().translate(_CODES), np.uint8)
                codes = codes[np.concatenate(([True], (codes[1:] != 0) | (codes[:-1] != 0)))].astype(np.int32)
                if len(codes) > 2:
                    total += np.bincount(codes[:-2] * 729 + codes[1:-1] * 27 + codes[2:], minlength=27 ** 3)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], ["gram", "n"])

    rows = (docs.select(F.col(text).alias("text")).mapInArrow(count, "gram bigint, n bigint")
            .groupBy("gram").agg(F.sum("n").alias("n")).collect())  # 19,683 rows at most
    counts = np.zeros(27 ** 3, np.float64)
    for r in rows:
        counts[r["gram"]] = r["n"]
    return counts.reshape(27, 27, 27)


def language_model(counts: np.ndarray) -> np.ndarray:
    """Log-probabilities of the third symbol given the two before, interpolated with shorter contexts."""
    uni = counts.sum((0, 1)) + 1.0
    uni /= uni.sum()
    bi = counts.sum(0)
    bi = (bi + 5.0 * uni) / (bi.sum(1, keepdims=True) + 5.0)
    return np.log((counts + 10.0 * bi[None]) / (counts.sum(2, keepdims=True) + 10.0))


# --- noisy channel -------------------------------------------------------------

def lattice(span: str) -> list[list[tuple[str, float]]]:
    """For each position the (sent string, channel cost) choices; '' is nothing, ' ' a word boundary."""
    out = []
    for i, c in enumerate(span):
        if "a" <= c <= "z":
            choices = [(c, 0.0)]
            if i and span[i - 1] == c:
                choices.append(("", REPEAT_COST))
        elif c in LOOKALIKES:
            choices = [(x, LOOKALIKE_COST) for x in LOOKALIKES[c]]
            choices.append(("", REPEAT_COST if i and span[i - 1] == c else DROP_LOOKALIKE_COST))
        elif c in SEPARATORS and i and span[i - 1] == c and c == " ":
            choices = [(" ", 0.0)]  # a wider gap than between the letters: a word ends
        elif c in SEPARATORS:
            choices = [("", DROP_SEPARATOR_COST), (" ", KEEP_SEPARATOR_COST)]
        else:
            choices = [("", DROP_SYMBOL_COST), (" ", KEEP_SEPARATOR_COST)]
        out.append(choices)
    return out


def decode(span: str, model: np.ndarray) -> str:
    """Likeliest sent string of ``span``: Viterbi over its lattice, the last two sent symbols as state."""
    steps: list[dict[tuple[int, int], tuple[float, tuple[int, int], str]]] = []
    states = {(0, 0): 0.0}
    for choices in lattice(span):
        new: dict[tuple[int, int], tuple[float, tuple[int, int], str]] = {}
        for (a, b), score in states.items():
            for sent, cost in choices:
                if not sent or (sent == " " and b == 0):
                    to, s = (a, b), score - cost
                else:
                    c = 0 if sent == " " else ord(sent) - 96
                    to, s = (b, c), score - cost + model[a, b, c]
                if to not in new or s > new[to][0]:
                    new[to] = (s, (a, b), sent if to != (a, b) or sent not in ("", " ") else "")
        steps.append(new)
        states = {k: v[0] for k, v in new.items()}
    if not steps:
        return ""
    at = max(states, key=lambda k: (states[k] + (model[k[0], k[1], 0] if k[1] else 0.0), k))
    sent = []
    for step in reversed(steps):
        _, before, c = step[at]
        sent.append(c)
        at = before
    return "".join(reversed(sent))


def _decoded(core: str, model: np.ndarray) -> str:
    return core if core.isalpha() and not _stretched(core) else decode(core, model)


def _readings(run: str, model: np.ndarray) -> list[str]:
    """What a run may stand for: with its edge symbols as letters, and as punctuation."""
    core = run.strip(SEPARATORS).rstrip("!|")
    end = core.rstrip("".join(c for c in LOOKALIKES if not c.isdigit()) + SEPARATORS)
    if len(core) - len(end) > 2:  # a tail of symbols is decoration
        core = end
    if len(core) < 3 or not any(map(str.isalpha, core)) or core.isalpha() and not _stretched(core):
        return [run]
    out = []
    for one in dict.fromkeys((core, core.strip(EDGE + SEPARATORS))):
        if len(one) > 2 or one is core:
            before, _, after = run.partition(one)
            out.append(before + _decoded(one, model) + after)
    return out


def likelihood(text: str, model: np.ndarray) -> float:
    """Mean log-probability of the letters and word boundaries of ``text``."""
    codes = [0, 0, *(ord(c) - 96 for c in "`".join(WORD.findall(text))), 0]
    return float(np.mean([model[a, b, c] for a, b, c in zip(codes, codes[1:], codes[2:])]))


def _restore_run(run: str, model: np.ndarray) -> str:
    found = _readings(run, model)
    return found[0] if len(found) == 1 else max(found, key=lambda x: likelihood(x, model))


def _stretched(word: str) -> bool:
    return any(c * 3 in word for c in set(word)) or len(DOUBLED.findall(word)) > 2


def restore_token(token: str, model: np.ndarray) -> str:
    """One token with its suspicious spans decoded; time grows with its length."""
    if token.isalpha():
        return decode(token, model) if _stretched(token) else token
    return RUN.sub(lambda m: _restore_run(m.group(), model), token)


def token_words(token: str, model: np.ndarray) -> list[str]:
    """Words of all readings of a token."""
    if token.isalpha():
        return WORD.findall(restore_token(token, model))
    return [w for m in RUN.finditer(token) for x in _readings(m.group(), model) for w in WORD.findall(x)]


def join_spaced(text: str, model: np.ndarray) -> str:
    """Folded text with letters that were set apart decoded to words."""
    shape = b" " + text.encode().translate(_SHAPE) + b" "
    if not any(p in shape for p in _APART):
        return text
    return SPACED.sub(lambda m: decode(m.group(), model), text)


def restore(text: str | None, model: np.ndarray) -> str:
    """Folded text with every suspicious span replaced by its decoding."""
    return re.sub(r"\S+", lambda m: restore_token(m.group(), model), join_spaced(fold(text), model))


# --- evidence --------------------------------------------------------------------

def gram_buckets(word: str) -> list[int]:
    """Buckets of the whole word, its starts of 4 to 6 letters and its inner 5-letter pieces."""
    w, n = f"^{word}$", len(word)
    pieces = [w, *[w[:k + 1] for k in ({3} if n == 3 else (4, 5, 6)) if k <= n], *[w[i:i + 5] for i in range(2, n - 3)]]
    return [crc32(p.encode()) % BUCKETS for p in pieces] if n > 2 else []


class Scorer:
    """Scores texts: n-gram evidence of each restored word, logistic model on the strongest words."""

    def __init__(self, model: np.ndarray, evidence: dict[int, float], head: np.ndarray):
        self.model, self.evidence, self.head = model, evidence, head
        self.tokens: dict[str, float] = {}

    def token(self, t: str) -> float:
        """Strongest word of a token. A word counts by its second strongest piece, so one chance hit is none."""
        best, get = 0.0, self.evidence.get
        for word in [t] if t.isalpha() and not DOUBLED.search(t) else token_words(t, self.model):
            found = sorted([get(b, 0.0) for b in gram_buckets(word)])
            if len(found) > 1 and found[-2] > best:
                best = found[-2]
        if len(self.tokens) >= CACHE_WORDS:
            self.tokens.clear()
        self.tokens[t] = best
        return best

    def features(self, text: str | None) -> np.ndarray:
        seen, known = set(join_spaced(fold(text), self.model).split()), self.tokens
        first = second = 0.0
        for t in seen:
            x = known.get(t)
            if x is None:
                x = self.token(t)
            if x > second:
                first, second = (x, first) if x > first else (first, x)
        return np.array([1.0, first, 0.3 * second])

    def score(self, text: str | None) -> float:
        return float(1 / (1 + math.exp(-max(-30.0, min(30.0, float(self.features(text) @ self.head))))))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Newton's method for logistic regression; column 0 is the intercept and is not shrunk."""
    w, penalty = np.zeros(x.shape[1]), ridge * np.eye(x.shape[1])
    penalty[0, 0] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ w)
        w = w + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return w


def labelled_sample(labels: DataFrame, keep: Column, doc_id: str = "doc_id", label: str = "toxic",
                    per_class: int = SAMPLE_PER_CLASS) -> list[tuple]:
    """(id, label) of at most ``per_class`` ids of each class for which ``keep`` holds."""
    known = (labels.filter(keep & F.col(label).isNotNull() & F.col(doc_id).isNotNull())
             .groupBy(F.col(doc_id).alias("id")).agg(F.max((F.col(label) > 0).cast("int")).alias("y")))
    return [(r["id"], y) for y in (0, 1) for r in
            known.filter(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(per_class).collect()]


def fit(docs: DataFrame, labels: DataFrame, keep: Column, doc_id: str = "doc_id", text: str = "text",
        label: str = "toxic", per_class: int = SAMPLE_PER_CLASS) -> Scorer:
    """Language model from all ``docs``; evidence and head from the sampled labelled rows that ``keep`` admits."""
    spark = docs.sparkSession
    model = language_model(char_counts(docs, text))
    sample = labelled_sample(labels, keep, doc_id, label, per_class)
    certain = lambda y: Scorer(model, {}, np.array([30.0 if y else -30.0, 0.0, 0.0]))
    if len({y for _, y in sample}) < 2:
        return certain(bool(sample) and sample[0][1])
    kind = docs.schema[doc_id].dataType
    chosen = spark.createDataFrame(sample, T.StructType([T.StructField("id", kind), T.StructField("y", T.IntegerType())]))
    texts = (docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
             .join(F.broadcast(chosen), "id")  # 2 * per_class ids
             .groupBy(F.xxhash64("text").alias("h"))  # a text that repeats counts once
             .agg(F.max("y").alias("y"), F.first("text").alias("text")).select("y", "text"))

    def gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, memo = np.zeros((2, BUCKETS), np.int32), {}
        for batch in batches:
            for y, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                seen: set[int] = set()
                for token in set(join_spaced(fold(t.as_py()), model).split()):
                    if (got := memo.get(token)) is None:
                        if len(memo) >= CACHE_WORDS:
                            memo.clear()
                        got = memo[token] = [b for w in token_words(token, model) for b in gram_buckets(w)]
                    seen.update(got)
                n[y, np.fromiter(seen, np.int64, len(seen))] += 1
        at = np.flatnonzero(n.sum(0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(at, pa.int64()), pa.array(n[0, at], pa.int64()), pa.array(n[1, at], pa.int64())], ["b", "c", "t"])

    sizes = {r["y"]: r["count"] for r in texts.groupBy("y").count().collect()}
    if len(sizes) < 2:  # the other labelled ids have no document
        return certain(sizes.get(1, 0))
    clean, toxic = sizes[0], sizes[1]
    found = (texts.mapInArrow(gram_counts, "b bigint, c bigint, t bigint").groupBy("b")
             .agg(F.sum("c").alias("c"), F.sum("t").alias("t"))
             .withColumn("w", F.log((F.col("t") + F.lit(PRIOR) * toxic / (toxic + clean)) / toxic)
                         - F.log((F.col("c") + F.lit(PRIOR) * clean / (toxic + clean)) / clean))
             .filter((F.col("t") >= MIN_TEXTS) & (F.col("w") > 1.0)).select("b", "w", "t").collect())  # BUCKETS at most
    # evidence held back by how few texts it rests on
    evidence = {r["b"]: r["w"] * (1 - math.exp(-r["t"] / (3.0 + 0.02 * toxic))) for r in found}
    start = Scorer(model, evidence, np.zeros(3))

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(
                [start.features(t.as_py()).tolist() for t in batch.column(1)], pa.list_(pa.float64()))], ["y", "f"])

    rows = texts.mapInArrow(featured, "y int, f array<double>").collect()  # 2 * per_class short rows
    x, y = np.array([r["f"] for r in rows]), np.array([r["y"] for r in rows], float)
    return Scorer(model, evidence, fit_logistic(x, y))


def scored(text: str | Column, scorer: Scorer) -> Column:
    """Score column for a text column."""
    model, evidence, head = scorer.model, scorer.evidence, scorer.head

    @F.arrow_udf("double")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = Scorer(model, evidence, head)
        for texts in batches:
            yield pa.array([own.score(t.as_py()) for t in texts], pa.float64())

    return of(text)


def restored(text: str | Column, model: np.ndarray) -> Column:
    """The restored (folded) text of a text column."""

    @F.arrow_udf("string")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([restore(t.as_py(), model) for t in texts], pa.string())

    return of(text)
