"""Benchmark decontamination with spaced seeds.

Texts become lower-case word sequences; in scripts written without spaces every
letter is a word. A document leaks an item if, on one
alignment, some ``WINDOW`` (13) consecutive words of both agree in all but
``MAX_SUBSTITUTIONS`` (2) places. A shorter item must occur whole: from
``TOLERANT_WORDS`` (8) words on one word may differ, below that none. Items of any
length count, one word included.

Seeds. ``MASKS`` select 7 of the words of a short stretch and ignore the others.
Wherever two substitutions fall in 13 words, one of the masks fits between them
(a test tries all placings), so seeding loses no overlap. Over an item of 8 to 12
words lie two masks, its even and its odd places: one substitution spares one of
them. The selected words of every place in a document are hashed and joined with
the hashes of the benchmark; around each hit the alignment is then verified word
by word, and overlapping verified windows are merged to spans.

The benchmark is the build side of the join. It is taken in blocks of about
``BLOCK_CHARS`` characters, one after the other: a block is joined with all
documents in one pass over them, its result is stored, and only then the next
block is built. Only words of the benchmark get a number, so most places of a
clean document are dismissed without hashing.

Defined results: null or empty texts and items match nothing; equal items are all
reported; repeated documents are reported each.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from snapweave.llm.common import stored

WINDOW = 13
MAX_SUBSTITUTIONS = 2
TOLERANT_WORDS = 8
BLOCK_CHARS = 16_000_000
MASKS = ((0, 1, 2, 3, 5, 7, 8), (0, 1, 4, 7, 8, 9, 10), (0, 1, 2, 3, 5, 6, 7))
BATCH_WORDS = 200_000
GAP = -2  # stands between documents; 0 is a document's word that no item has
CACHE_WORDS = 300_000
# Scripts written without spaces: Thai and Lao, Myanmar, Khmer, kana (without sound marks), Han and their extensions.
UNSPACED = ("\u0e01-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3041-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff"
            "\uf900-\ufaff\uff66-\uff9d\U00020000-\U0003ffff")
WORD = re.compile(rf"(?=\w)[{UNSPACED}]|[^\W{UNSPACED}]+")


class Numbers(dict):
    """White-space token -> numbers of its words; 0 for words outside the benchmark."""

    def __init__(self, vocabulary: dict[str, int]):
        super().__init__()
        self.vocabulary = vocabulary

    def __missing__(self, token: str) -> tuple[int, ...]:
        if len(self) >= CACHE_WORDS:
            self.clear()
        got = self[token] = tuple(self.vocabulary.get(w, 0) for w in WORD.findall(token.lower()))
        return got


def tolerance(n: int) -> int:
    """Words that may differ in a window over an item of ``n`` words."""
    return MAX_SUBSTITUTIONS if n >= WINDOW else int(n >= TOLERANT_WORDS)


def _hash(words: np.ndarray, at: np.ndarray, mask: tuple[int, ...], salt: int) -> np.ndarray:
    h = np.full(len(at), salt + 1, np.uint64)
    for o in mask:
        h = (h ^ words[at + o].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h


class Seeds:
    """Seed table of one block of items: sorted hashes with the places they come from."""

    def __init__(self, items: list[tuple[int, str | None]]):
        """items: (index, text)."""
        texts = [(i, WORD.findall((t or "").lower())) for i, t in items]
        self.vocabulary = {w: n + 1 for n, w in enumerate(sorted({w for _, ws in texts for w in ws}))}
        words, self.starts, self.lengths, self.index = [], [], [], []
        for i, ws in texts:
            if ws:
                self.starts.append(len(words))
                self.lengths.append(len(ws))
                self.index.append(i)
                words += [self.vocabulary[w] for w in ws] + [-1] * WINDOW
        self.words = np.array(words + [-1] * WINDOW, np.int64)
        self.owner = np.full(len(self.words), -1, np.int64)
        for k, (s, n) in enumerate(zip(self.starts, self.lengths)):
            self.owner[s:s + n] = k
        # (mask, 0) lies anywhere in a long item, (mask, n) over a whole item of n words
        self.masks = [(m, 0) for m in MASKS]
        for n in sorted({n for n in self.lengths if n < WINDOW}):
            self.masks += [(tuple(range(part, n, 1 + tolerance(n))), n) for part in range(1 + tolerance(n))]
        self.tables = []
        for salt, (mask, whole) in enumerate(self.masks):
            span = whole or mask[-1] + 1
            places = [np.arange(s, s + n - span + 1) for s, n in zip(self.starts, self.lengths)
                      if (n == whole if whole else n >= WINDOW)]
            at = np.concatenate(places) if places else np.zeros(0, np.int64)
            h = _hash(self.words, at, mask, salt)
            order = np.argsort(h, kind="stable")
            self.tables.append((h[order], at[order]))

    def hits(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document place, item place, the item's words if it must occur whole, else 0) of all seeds that join."""
        known = words > 0
        out = []
        for salt, ((mask, whole), (table, places)) in enumerate(zip(self.masks, self.tables)):
            n = len(words) - (whole or mask[-1] + 1) + 1
            if n <= 0 or not len(table):
                continue
            fit = known[mask[0]:mask[0] + n].copy()
            for o in mask[1:]:
                fit &= known[o:o + n]
            at = np.flatnonzero(fit)
            h = _hash(words, at, mask, salt)
            lo, hi = np.searchsorted(table, h, "left"), np.searchsorted(table, h, "right")
            count = hi - lo
            if count.any():
                d = np.repeat(at, count)
                first = np.repeat(lo - np.concatenate(([0], np.cumsum(count)[:-1])), count)
                out.append((d, places[first + np.arange(len(d))], np.full(len(d), whole)))
        if not out:
            z = np.zeros(0, np.int64)
            return z, z, z
        return tuple(np.concatenate(x) for x in zip(*out))

    def spans(self, words: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """(item index, document start, document end, item start, words that agree) of verified overlaps.

        ``words`` needs WINDOW times GAP before and after each document. A span lies inside one document.
        """
        d, q, whole = self.hits(words)
        if not len(d):
            return []
        # one row for each alignment and place, however many masks hit it
        key = np.unique(np.stack([q - d, d, q, whole], 1), axis=0)
        diagonal, d, q, whole = key.T
        found = []
        short = whole > 0
        for n in np.unique(whole[short]).tolist():
            x, y = d[whole == n], q[whole == n]
            w = words[x[:, None] + np.arange(n)]
            other = (w != self.words[y[:, None] + np.arange(n)]).sum(1)
            good = (other <= tolerance(n)) & (w != GAP).all(1)
            found += [(int(b - a), int(a), n) for a, b in zip(x[good], y[good])]
        d, q, diagonal = d[~short], q[~short], diagonal[~short]
        if len(d):
            reach = np.arange(-(WINDOW - 1), WINDOW)
            w = words[d[:, None] + reach]
            i = q[:, None] + reach
            inside = (i >= 0) & (i < len(self.words))
            other = self.words[np.where(inside, i, 0)]
            both = inside & (self.owner[np.where(inside, i, 0)] == self.owner[q][:, None]) & (w != GAP)
            agree = np.cumsum(np.pad((w == other) & both, ((0, 0), (1, 0))), 1)
            within = np.cumsum(np.pad(both, ((0, 0), (1, 0))), 1)
            good = ((agree[:, WINDOW:] - agree[:, :-WINDOW] >= WINDOW - MAX_SUBSTITUTIONS)
                    & (within[:, WINDOW:] - within[:, :-WINDOW] == WINDOW))
            row, k = np.nonzero(good)
            windows = np.unique(np.stack([diagonal[row], d[row] + reach[k]], 1), axis=0)
            found += [(int(a), int(b), WINDOW) for a, b in windows]
        found.sort()
        merged: list[list[int]] = []
        for diag, start, n in found:
            if merged and merged[-1][0] == diag and start <= merged[-1][2] and \
                    self.owner[start + diag] == self.owner[merged[-1][1] + diag]:
                merged[-1][2] = max(merged[-1][2], start + n)
            else:
                merged.append([diag, start, start + n])
        out = []
        for diag, a, b in merged:
            k = int(self.owner[a + diag])
            out.append((self.index[k], a, b, a + diag - self.starts[k],
                        int((words[a:b] == self.words[a + diag:b + diag]).sum())))
        return out


def _numbered(texts: pa.Array, numbers: Numbers) -> Iterator[tuple[list[int], list[int], np.ndarray]]:
    """Groups of rows: (row numbers, their first word's place, all words with gaps)."""
    gap = (GAP,) * WINDOW
    rows, starts, words = [], [], list(gap)
    for i, t in enumerate(texts):
        rows.append(i)
        starts.append(len(words))
        words.extend(chain.from_iterable(map(numbers.__getitem__, (t.as_py() or "").split())))
        words.extend(gap)
        if len(words) >= BATCH_WORDS:
            yield rows, starts, np.array(words, np.int64)
            rows, starts, words = [], [], list(gap)
    if rows:
        yield rows, starts, np.array(words, np.int64)


def blocks(benchmark: DataFrame, item_id: str = "item_id", text: str = "text",
           block_chars: int = BLOCK_CHARS) -> Iterator[tuple[list, Seeds, bool]]:
    """(item ids, seed table, whether it is the last) of each block of the benchmark."""
    b = benchmark.select(F.col(item_id).alias("item_id"), F.col(text).alias("text")).filter("text is not null")
    chars = b.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, -(-chars // block_chars))
    for k in range(n):
        rows = sorted(b.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).collect(),
                      key=lambda r: (r["item_id"] is None, r["item_id"], r["text"]))
        yield [r["item_id"] for r in rows], Seeds(list(enumerate(r["text"] for r in rows))), k == n - 1


def overlaps(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
             item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """Verified overlaps: doc_id, item_id, doc_start, doc_end, item_start (words), agreeing, span."""
    d = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kinds = d.schema["doc_id"].dataType, benchmark.schema[item_id].dataType
    fields = [T.StructField("doc_id", kinds[0]), T.StructField("item_id", kinds[1])]
    names = ["doc_start", "doc_end", "item_start", "agreeing"]
    schema = T.StructType(fields + [T.StructField(n, T.LongType()) for n in names])
    item_type = to_arrow_type(kinds[1])

    def finder(ids: list, seeds: Seeds):
        def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            numbers = Numbers(seeds.vocabulary)
            for batch in batches:
                out: list[tuple] = []
                for rows, starts, words in _numbered(batch.column(1), numbers):
                    at = np.array(starts)
                    for item, a, b, i, agree in seeds.spans(words):
                        k = int(np.searchsorted(at, a, "right")) - 1
                        out.append((rows[k], ids[item], a - starts[k], b - starts[k], i, agree))
                cols = list(zip(*out)) or [()] * 6
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(cols[0], pa.int64())), pa.array(cols[1], item_type),
                     *[pa.array(c, pa.int64()) for c in cols[2:]]], schema.names)
        return find

    result = None
    for ids, seeds, last in blocks(benchmark, item_id, item_text):
        part = d.mapInArrow(finder(ids, seeds), schema)
        part = part if last and result is None else stored(part, "overlaps")
        result = part if result is None else result.unionByName(part)
    return result


def _flag(text: str | Column, seeds: Seeds) -> Column:
    @F.arrow_udf("boolean")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        numbers = Numbers(seeds.vocabulary)
        for texts in batches:
            hit = np.zeros(len(texts), bool)
            for rows, starts, words in _numbered(texts, numbers):
                for span in seeds.spans(words):
                    hit[rows[int(np.searchsorted(starts, span[1], "right")) - 1]] = True
            yield pa.array(hit)
    return of(text)


def without_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
                  item_text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text leaks no item of the benchmark."""
    for _, seeds, last in blocks(benchmark, item_id, item_text):
        docs = docs.filter(~_flag(text, seeds))
        if not last:
            docs = stored(docs, "without-leaks")
    return docs
