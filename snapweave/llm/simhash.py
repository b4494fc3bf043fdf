"""SimHash near-duplicates through a segment-popcount embedding.

A 64-bit fingerprint is mapped to 32 numbers, the counts of set bits (0, 1 or 2)
in its two-bit segments. One flipped bit moves one count by one, so the
Manhattan distance of two such vectors never exceeds the Hamming distance: it is
a lower bound and may be used to discard pairs. The vector is kept as one long in
unary code (count 0, 1, 2 as 00, 01, 11), where Manhattan distance is the number
of differing bits and stays inside generated code.

Grid range join: the 32 axes form six blocks. Two vectors at distance 2 or less
differ in two blocks at most, so they agree on four whole blocks; each vector
enters the 15 grid cells named by four of its blocks, and every pair within the
radius meets in a cell. In a cell the Manhattan bound is tested first, then the
exact Hamming distance.

Cells hold distinct fingerprints only (copies are folded before). A cell with
more than ``CELL_MAX`` of them is not paired up: each of its fingerprints names
the 65 values within one bit of it, and fingerprints that name the same value are
linked to the smallest of them. Two fingerprints differ in 2 bits or fewer exactly
if they share such a value, so this finds the same components in rows linear in
the cell's size, whatever its size.

Defined results: a null or blank text has fingerprint zero and is linked like any
other; rows repeat in the result as in the input; a null id never becomes a
component id unless every id of the component is null.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapweave.llm.common import fresh, stored

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
CELL_MAX = 64
SALTS = 16
BLOCKS = (6, 6, 5, 5, 5, 5)  # two-bit segments per block, 32 in all
EVEN = 0x5555555555555555

_UPPER_TO_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def text_fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """Unsigned SimHash of one text: majority bits over the XXH64 of its word shingles."""
    words = (text or "").encode().translate(_UPPER_TO_LOWER).split()  # ASCII white space only
    if not words:
        return 0
    joined, n = b" ".join(words), len(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(shingle_words, n)
    digest = xxhash.xxh64_intdigest
    m = n - k + 1
    votes = np.zeros(64, np.int64)
    for a in range(0, m, 8192):  # very long texts in slices: 64 bytes of bits per shingle
        b = min(a + 8192, m)
        h = np.array([digest(joined[s:e], SEED) for s, e in
                      zip(starts[a:b].tolist(), ends[a + k - 1:b + k - 1].tolist())], np.uint64)
        votes += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(votes * 2 > m, bitorder="little")
    return int(bits.view(np.uint64)[0])


def fingerprint(text: str | Column, shingle_words: int = SHINGLE_WORDS) -> Column:
    """Fingerprint of a text column as a BIGINT (the same 64 bits, signed)."""

    @F.arrow_udf("bigint")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([_signed(text_fingerprint(t.as_py(), shingle_words)) for t in texts], pa.int64())

    return of(text)


def hex16(fp: str | Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def embed(fp: Column) -> Column:
    """Two-bit segment counts in unary code, as one BIGINT."""
    half = F.shiftrightunsigned(fp, 1)
    even = F.lit(EVEN)
    some = fp.bitwiseOR(half).bitwiseAND(even)
    both = fp.bitwiseAND(half).bitwiseAND(even)
    return some.bitwiseOR(F.shiftleft(both, 1))


def cell_masks(max_bits: int = MAX_BITS) -> list[int]:
    """Bit masks of the grid cells: all ways to keep all but ``max_bits`` blocks."""
    masks, at = [], 0
    for segments in BLOCKS:
        masks.append(((1 << 2 * segments) - 1) << at)
        at += 2 * segments
    keep = len(BLOCKS) - max_bits
    return [reduce(int.__or__, some) for some in combinations(masks, keep)]


def _links(distinct: DataFrame, max_bits: int) -> DataFrame:
    """Links (a, b), a > b, that span every component of fingerprints within ``max_bits``."""
    masks = cell_masks(max_bits)
    most = len(masks) * distinct.count()  # of a stored table, so from its files' footers
    cells = distinct.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("grid"), embed(F.col("fp")).bitwiseAND(F.lit(_signed(m))).alias("cell"))
        for i, m in enumerate(masks)])).alias("k")).select("fp", "k.grid", "k.cell")
    full = cells.groupBy("grid", "cell").agg(F.count("*").alias("n")).filter("n > 1")
    members = stored(cells.join(full, ["grid", "cell"]), "simhash-cells", most)

    def near(x: Column, y: Column) -> Column:
        bound = F.bit_count(embed(x).bitwiseXOR(embed(y))) <= max_bits
        return (x > y) & bound & (F.bit_count(x.bitwiseXOR(y)) <= max_bits)

    paired = (members.filter(F.col("n") <= CELL_MAX).groupBy("grid", "cell")
              .agg(F.collect_list("fp").alias("fps"))
              .select(F.explode(F.flatten(F.transform("fps", lambda x: F.transform(
                  F.filter("fps", lambda y: near(x, y)), lambda y: F.struct(x.alias("a"), y.alias("b")))))).alias("p"))
              .select("p.a", "p.b").distinct())
    if max_bits != 2:  # the shared-value form below is for two bits
        raise ValueError("the crowded-cell form is defined for two bits")
    crowded = members.filter(F.col("n") > CELL_MAX).select("fp").distinct()
    named = crowded.select("fp", F.explode(F.concat(F.array("fp"), F.transform(
        F.sequence(F.lit(0), F.lit(63)),
        lambda i: F.col("fp").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), i))))).alias("value"))
    first = named.groupBy("value").agg(F.min("fp").alias("b"), F.count("*").alias("n")).filter("n > 1").drop("n")
    shared = named.join(first, "value").filter("fp > b").select(F.col("fp").alias("a"), "b").distinct()
    return paired.unionByName(shared).distinct()


def components(links: DataFrame, name: str = "components", rows: int | None = None) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b): root is the smallest node of its component.

    Alternating large-star and small-star steps: each round hooks every node to
    the smallest neighbour, halving paths, so rounds grow with the logarithm of
    the longest chain. Each round is written to the shared folder, in files sized by the
    edges of the round before, which it never exceeds; ``rows``: about how many links there are.
    """
    edges = stored(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                   .filter("a <> b").distinct(), f"{name}-0", rows)
    mark = lambda e: e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    before, step = mark(edges), 0
    while before[0]:
        step += 1
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = (both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .filter("a <> b").distinct())
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a").select(
            F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        hooked = down.select("a", F.col("m").alias("b"))
        edges = stored(small.unionByName(hooked).filter("a <> b").distinct(), f"{name}-{step}", before[0])
        after = mark(edges)
        if after == before:
            break
        before = after
    top = edges.select(F.col("b").alias("node"), F.col("b").alias("root"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(top).distinct()


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per row of ``docs``: doc_id, row_hash (of id and text), fp (BIGINT), root (smallest
    fingerprint of the component) and component_id (its smallest id)."""
    keyed = stored(docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(doc_id, text).alias("row_hash"),
                               fingerprint(F.col(text), shingle_words).alias("fp")), "simhash-fp")
    distinct = stored(keyed.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-distinct", keyed.count())
    links = _links(distinct, max_bits)
    roots = components(links, "simhash-cc", distinct.count()).select(F.col("node").alias("fp"), "root")
    linked = distinct.join(roots, "fp")
    ids = linked.groupBy("root").agg(F.min("first_id").alias("component_id"))
    moved = linked.join(ids, "root").select("fp", "root", "component_id")  # only fingerprints that have a link
    of_fp = distinct.join(moved, "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"),
        F.when(F.col("root").isNull(), F.col("first_id")).otherwise(F.col("component_id")).alias("component_id"))
    # a fingerprint may belong to a third of all rows: its rows are dealt over SALTS keys
    salted = of_fp.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return (keyed.withColumn("salt", F.pmod(F.xxhash64("doc_id", "row_hash"), F.lit(SALTS)).cast("int"))
            .join(salted, ["fp", "salt"]).select("doc_id", "row_hash", "fp", "root", "component_id"))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each component: smallest id (nulls last), then smallest row hash.

    Rows with the same id and text are the same document: of those the one with the
    smallest hash over all columns stays (equal rows are interchangeable).
    """
    found = near_duplicates(docs, doc_id, text)
    kept = found.groupBy("root").agg(F.min(F.struct(
        F.col("doc_id").isNull(), "doc_id", "row_hash")).alias("r")).select(
        F.col("r.doc_id").alias("kept_id"), F.col("r.row_hash").alias("kept_hash"))
    mark, place = fresh(docs, "row_hash"), fresh(docs, "row_place")
    marked = docs.withColumn(mark, F.xxhash64(doc_id, text))
    same = (marked[mark] == kept["kept_hash"]) & marked[f"`{doc_id}`"].eqNullSafe(kept["kept_id"])
    every = [F.col(f"`{c}`") for c in docs.columns if "map" not in docs.schema[c].dataType.simpleString()]
    first = F.row_number().over(Window.partitionBy(mark, F.col(f"`{doc_id}`")).orderBy(F.xxhash64(*every), F.hash(*every)))
    return (marked.join(kept, same, "left_semi").withColumn(place, first).filter(F.col(place) == 1)
            .select(*[F.col(f"`{c}`") for c in docs.columns]))
