"""Benchmark decontamination of documents.

Method: SimHash of item-sized windows.  For every benchmark item, the windows
of a document with as many words as the item (the whole document if it is
shorter) are compared with it: 64-bit SimHashes over word shingles, found
within ``RADIUS`` bits by multi-index Hamming blocks (eight blocks of eight
bits; two fingerprints within the radius agree in some block up to
RADIUS // 8 bits, and items are listed under all such block values), then
verified by the exact weighted similarity of the shingle multisets.

At a similarity of 0.8 fingerprints differ in about 10 of 64 bits, so blocks
alone select little.  A window and an item therefore meet under a block value
only together with one of ``MINIMA`` minima: the smallest of their shingles
under one of as many hash orders.  Items with a repeated shingle, whose sets may
agree less than their multisets do, are listed without a minimum as well, and
so are the windows of their size.

Which windows get a fingerprint: a window can only reach the similarity if at
least ``percent`` % of the item's shingles are in it.  Two bit sets of fixed
maximal size hold the item shingles, alone and together with the item's size;
they may let more windows through, never fewer.

Scale: documents are read once, without a shuffle, against at most 32 MB of
bit sets.  Fingerprints and minima of neighbouring windows come from running
bit counts and running minima over stretches of bounded length; a window is a
row of fixed size (no shingles), whatever the item's length.  Windows and items
meet in a join on (size, minimum, block, value).  Texts with a candidate are
read again, once per text, and their windows are verified in order of their
start by exchanging one shingle at a time, so the work follows the text's length
times the number of items it may hold.  A passage that very many documents share
is a hot key on the window side only.

Recall: at similarity 0.8 fingerprints differ in 9.6 bits on average with
deviation 2.9; the radius of 23 leaves out fewer than 1 in 100,000.  All
``MINIMA`` minima differ with probability 0.2^8 = 2.6e-6.

Defined cases: null or empty text and items without words are never matched;
an item of fewer than five words is one shingle; rows with a null id are
judged by their own text; rows are neither dropped nor repeated, equal rows
are judged alike; of equally similar windows the first counts; very long texts
and items take memory in proportion to their length; empty tables give empty or
uncontaminated results; extra columns aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnspark.llm.bloom import bloom_filter, with_possible
from churnspark.llm.common import map_arrow, ship, text_of
from churnspark.llm.tokens import U64, chunks, grams, mix, word_hashes
from churnspark.session import materialize

SHINGLE, PERCENT = 5, 80
RADIUS, BLOCKS = 23, 8
#: Hash orders of the minima.
MINIMA = 8
#: Window starts whose bit counts are held at once.
STRETCH = 4096
#: Bits of a shingle set: 4096 per shingle, at most 2^27 (16 MB).
BITS_PER_SHINGLE, MAX_BITS = 4096, 1 << 27

_NEAR = [sum(1 << b for b in c) for k in range(RADIUS // BLOCKS + 1) for c in combinations(range(8), k)]
_LOOK = np.arange(64, dtype=np.uint64)
_ORDERS = np.random.Generator(np.random.PCG64(20240611)).integers(1, 1 << 63, MINIMA, dtype=np.uint64)


def simhash(shingles: np.ndarray) -> int:
    """Majority of every bit over the shingles, each as often as it occurs."""
    bits = (mix(shingles)[:, None] >> _LOOK) & U64(1)
    return int(((2 * bits.sum(0) > len(shingles)).astype(U64) << _LOOK).sum(dtype=U64).view(np.int64))


def running_simhash(shingles: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    """``simhash`` of the windows of ``width`` shingles at the given starts
    (in order), from running bit counts over one stretch at a time."""
    out = np.zeros(len(starts), U64)
    i = 0
    while i < len(starts):
        a = int(starts[i])
        j = int(np.searchsorted(starts, a + STRETCH))
        own = mix(shingles[a:int(starts[j - 1]) + width])
        at = starts[i:j] - a
        for b in range(64):
            count = np.concatenate([[0], np.cumsum((own >> U64(b)) & U64(1), dtype=np.int64)])
            out[i:j] |= (2 * (count[at + width] - count[at]) > width).astype(U64) << U64(b)
        i = j
    return out.view(np.int64)


def running_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of every ``width`` neighbours (blocks of ``width``: the rest of
    one block and the beginning of the next)."""
    n = len(values) - width + 1
    if width == 1:
        return values
    size = -(-len(values) // width) * width
    padded = np.full(size, np.iinfo(values.dtype).max, values.dtype)
    padded[:len(values)] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1:width - 1 + n])


def minima(shingles: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    """Smallest shingle under every hash order, a column for each order."""
    out = np.zeros((len(starts), MINIMA), np.int64)
    i = 0
    while i < len(starts):  # stretches of neighbouring starts
        a = int(starts[i])
        j = int(np.searchsorted(starts, a + max(STRETCH, width)))
        own = shingles[a:int(starts[j - 1]) + width]
        for k, order in enumerate(_ORDERS):
            # the order's number is part of the key
            out[i:j, k] = mix(running_minimum(mix(own ^ order), width)[starts[i:j] - a] ^ order).view(np.int64)
        i = j
    return out


def items_table(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """item_id, size (words), shingles, fp, minima, repeats (whether a shingle
    occurs twice); items without words are left out."""
    src = benchmark.select(F.col(id_col).alias("item_id"), F.col(text_col).cast("string").alias("text"))
    kind = src.schema["item_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, at in chunks(batch.column(1)):
                h, wa = word_hashes(data, at)
                size = np.diff(wa)
                sh = [grams(h[a:b], np.array([0, b - a]), min(SHINGLE, b - a))[0] if b > a else h[:0] for a, b in zip(wa[:-1], wa[1:])]
                keep = pa.array(size > 0)
                out = [batch.column(0).slice(i, j - i), pa.array(size.astype(np.int32)),
                       pa.array([s.view(np.int64) for s in sh], pa.list_(pa.int64())),
                       pa.array([simhash(s) if len(s) else 0 for s in sh], pa.int64()),
                       pa.array([minima(s, np.zeros(1, np.int64), len(s))[0] if len(s) else [] for s in sh], pa.list_(pa.int64())),
                       pa.array([len(np.unique(s)) < len(s) for s in sh])]
                yield pa.RecordBatch.from_arrays([x.filter(keep) for x in out],
                                                 names=["item_id", "size", "shingles", "fp", "minima", "repeats"])

    return map_arrow(src, run, f"item_id {kind}, size int, shingles array<long>, fp long, minima array<long>, repeats boolean")


class BitSet:
    """Bits of hashed keys, in one array of fixed size."""

    def __init__(self, words: np.ndarray):
        self.words = words

    def holds(self, keys: np.ndarray) -> np.ndarray:
        at = keys & U64(64 * len(self.words) - 1)
        return (self.words[(at >> U64(6)).astype(np.int64)] >> (at & U64(63))) & U64(1) > 0

    @classmethod
    def of(cls, keys: DataFrame, n_bits: int) -> BitSet:
        """From a column ``key`` of hashes; at most n_bits / 64 longs travel."""
        at = F.col("key").bitwiseAND(F.lit(n_bits - 1))
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), at.bitwiseAND(F.lit(63)).cast("int"))
        got = keys.groupBy(F.shiftright(at, 6).alias("w")).agg(F.bit_or(bit).alias("m")).toArrow()
        words = np.zeros(n_bits // 64, np.int64)
        words[got.column("w").to_numpy().astype(np.int64)] = got.column("m").to_numpy()
        return cls(words.view(U64))


def _sized(shingles: np.ndarray, size: int) -> np.ndarray:
    return mix(shingles ^ U64(size))


def _sized_keys(items: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [np.zeros(0, U64)] + [_sized(np.array(s, np.int64).view(U64), n)
                                         for n, s in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64))], names=["key"])

    return map_arrow(items.select("size", "shingles"), run, "key long")


def windows(docs: DataFrame, sizes: list[int], alone: BitSet, sized: BitSet, percent: int) -> DataFrame:
    """doc_id, text_hash, size, start, fp, minima of the windows that hold
    enough item shingles.  ``docs`` is (doc_id, text_hash, text)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    least = {n: ceil(percent * (n - min(SHINGLE, n) + 1) / 100) for n in sizes}
    by_k: dict[int, list[int]] = {}
    for n in sizes:
        by_k.setdefault(min(SHINGLE, n), []).append(n)

    def found(g: np.ndarray, n_words: int, k: int) -> Iterator[tuple[int, np.ndarray, int]]:
        """(size, starts, shingles in a window) in one text with shingles ``g``."""
        hit = np.flatnonzero(alone.holds(g))
        for n in by_k[k]:
            if len(hit) < least[n]:
                continue
            own = np.zeros(len(g) + 1, np.int32)
            own[hit[sized.holds(_sized(g[hit], n))] + 1] = 1
            own = np.cumsum(own)
            width = min(n, n_words) - k + 1
            starts = np.flatnonzero(own[width:] - own[:len(own) - width] >= least[n])
            if len(starts):
                yield n, starts, width

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, _, data, at in chunks(batch.column(2)):
                h, wa = word_hashes(data, at)
                for k in by_k:
                    g, ga = grams(h, wa, k)
                    # texts with too few hits for any item are passed over at once
                    hits = np.diff(np.concatenate([[0], np.cumsum(alone.holds(g))])[ga])
                    for d in np.flatnonzero(hits >= min(least[n] for n in by_k[k])):
                        own = g[ga[d]:ga[d + 1]]
                        for n, starts, width in found(own, int(wa[d + 1] - wa[d]), k):
                            for part in np.split(starts, range(STRETCH, len(starts), STRETCH)):
                                m = len(part)
                                take = pa.array(np.full(m, i + d))
                                low = minima(own, part, width)
                                yield pa.RecordBatch.from_arrays(
                                    [batch.column(0).take(take), batch.column(1).take(take), pa.array(np.full(m, n, np.int32)),
                                     pa.array(part.astype(np.int64)), pa.array(running_simhash(own, part, width)),
                                     pa.ListArray.from_arrays(pa.array(np.arange(0, MINIMA * m + 1, MINIMA, dtype=np.int32)),
                                                              pa.array(low.ravel()))],
                                    names=["doc_id", "text_hash", "size", "start", "fp", "minima"])

    return map_arrow(docs, run, f"doc_id {kind}, text_hash long, size int, start long, fp long, minima array<long>")


def _block(fp, k: int):
    return F.call_function("shiftrightunsigned", fp, F.lit(8 * k)).bitwiseAND(F.lit(255))


def listings(found: DataFrame, items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Windows and items under the keys (size, minimum, block, value)."""
    fp, block = F.col("fp"), lambda k, v: F.struct(F.lit(k).alias("block"), v.alias("value"))
    own = F.transform("minima", lambda m: m)
    with_none = F.when(F.col("repeats"), F.concat("minima", F.array(F.lit(None).cast("long")))).otherwise(own)
    listed = items.select("item_id", "size", F.col("fp").alias("i_fp"), F.explode(with_none).alias("low")).select(
        "*", F.explode(F.array(*[block(k, _block(F.col("i_fp"), k)) for k in range(BLOCKS)])).alias("b")).select(
        "*", F.explode(F.array(*map(F.lit, _NEAR))).alias("m")).withColumn(
        "e", F.struct("b.block", F.col("b.value").bitwiseXOR(F.col("m")).alias("value")))
    # sizes of items with a repeated shingle: their windows are listed without a minimum, too
    loose = items.where("repeats").select("size").distinct().withColumn("repeats", F.lit(True))
    probes = (found.join(loose, "size", "left").withColumn("repeats", F.coalesce("repeats", F.lit(False)))
              .select("doc_id", "text_hash", "size", "start", "fp", F.explode(with_none).alias("low"))
              .select("*", F.explode(F.array(*[block(k, _block(fp, k)) for k in range(BLOCKS)])).alias("e")))
    key = ["size", F.coalesce("low", F.lit(0)).alias("low"), "e.block", "e.value"]
    return (probes.select("doc_id", "text_hash", "start", "fp", *key), listed.select("item_id", "i_fp", *key))


def candidates(found: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, text_hash, item_id, size, start) of windows and items of their
    size with a minimum in common and fingerprints within the radius."""
    probes, listed = listings(found, items)
    # the listing is far larger than the items it is made from, so its size is no
    # reason to broadcast it; hot keys of a merge join are split
    return (probes.join(listed.hint("merge"), ["size", "low", "block", "value"])
            .where(F.bit_count(F.col("fp").bitwiseXOR(F.col("i_fp"))) <= RADIUS)
            .select("doc_id", "text_hash", "item_id", "size", "start").distinct())


def best_window(doc: np.ndarray, item: np.ndarray, starts: np.ndarray, width: int) -> tuple[int, int, int]:
    """(shared, united, start) of the first best window of ``width`` shingles
    of a text at the given starts, by exchanging one shingle at a time."""
    values, want = np.unique(item, return_counts=True)
    at = np.searchsorted(values, doc)
    at[at == len(values)] = 0
    known = np.where(values[at] == doc, at, -1).tolist()
    want, have = want.tolist(), [0] * len(values)
    shared, now, best = 0, None, (0, 1, -1)
    for s in starts.tolist():
        if now is None or s >= now + width:
            have, shared, now = [0] * len(values), 0, s
            fresh, gone = known[s:s + width], ()
        else:
            fresh, gone = known[now + width:s + width], known[now:s]
            now = s
        for v in fresh:
            if v >= 0:
                shared += have[v] < want[v]
                have[v] += 1
        for v in gone:
            if v >= 0:
                have[v] -= 1
                shared -= have[v] < want[v]
        united = len(item) + width - shared
        if shared * best[1] > best[0] * united:
            best = (shared, united, s)
    return best


def verified(pairs: DataFrame, items: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """doc_id, text_hash, item_id, similarity, start of the texts whose best
    window reaches the exact weighted similarity (shared over united shingle
    counts).  Each text is read once, with the items it may hold."""
    doc, item = pairs.schema["doc_id"].dataType.simpleString(), pairs.schema["item_id"].dataType.simpleString()
    key = ["doc_id", "text_hash"]
    held = (pairs.select(*key, "item_id", "size").distinct().join(items.select("item_id", "size", "shingles"), ["item_id", "size"])
            .select(*key, "item_id", "size", F.lit(-1).cast("long").alias("start"), "shingles"))
    asked = held.unionByName(pairs.withColumn("shingles", F.lit(None).cast("array<long>")))
    hit = materialize(pairs.select("text_hash").distinct(), "hit_texts")
    texts = (with_possible(docs, F.col("text_hash"), *bloom_filter(hit, "text_hash")).where("possible").drop("possible")
             .join(hit, "text_hash", "left_semi").groupBy(*key).agg(F.min("text").alias("text")))
    # a null id is a key like any other
    def with_key(df):
        return df.withColumn("k", F.struct(*key))

    def run(asked: pa.Table, texts: pa.Table) -> pa.Table:
        rows: dict = {}
        shingles, sizes, starts = {}, {}, {}
        if texts.num_rows and asked.num_rows:
            for n, i, s, at in zip(asked["size"].to_pylist(), asked["item_id"].to_pylist(), asked["shingles"], asked["start"].to_pylist()):
                sizes[i] = n
                if s.is_valid:
                    shingles[i] = np.array(s.values.to_numpy(zero_copy_only=False), np.int64)
                else:
                    starts.setdefault(i, []).append(at)
            (_, _, data, at), = chunks(texts["text"].combine_chunks().slice(0, 1))
            h, wa = word_hashes(data, at)
            for i, s in starts.items():
                k = min(SHINGLE, sizes[i])
                g = grams(h, wa, k)[0].view(np.int64)
                shared, united, start = best_window(g, shingles[i], np.array(sorted(s)), min(sizes[i], int(wa[1])) - k + 1)
                if 100 * shared >= percent * united:
                    rows[i] = (shared / united, start)
        n = len(rows)
        first = [asked[c].combine_chunks().take(pa.array(np.zeros(n, np.int64))) if asked.num_rows else asked[c].combine_chunks() for c in key]
        return pa.Table.from_arrays([*first, pa.array(list(rows), asked.schema.field("item_id").type),
                                     pa.array([v for v, _ in rows.values()], pa.float64()),
                                     pa.array([s for _, s in rows.values()], pa.int64())],
                                    names=[*key, "item_id", "similarity", "start"])

    ship(docs.sparkSession)
    met = with_key(asked).groupBy("k").cogroup(with_key(texts).groupBy("k"))
    return met.applyInArrow(run, f"doc_id {doc}, text_hash long, item_id {item}, similarity double, start long")


def matches(docs: DataFrame, benchmark: DataFrame, percent: int = PERCENT, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """doc_id, text_hash, item_id, similarity (best), start (of the first best
    window), one row per text and item that match."""
    items = materialize(items_table(benchmark), "items")
    flat = items.select(F.explode("shingles").alias("key"))
    n_bits = 1 << 16
    count = flat.count()
    while n_bits < min(MAX_BITS, count * BITS_PER_SHINGLE):
        n_bits *= 2
    # one row per distinct item size
    sizes = sorted(r["size"] for r in items.select("size").distinct().collect())
    src = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_of(text_col)).alias("text_hash"),
                      text_of(text_col).cast("string").alias("text"))
    found = materialize(windows(src, sizes, BitSet.of(flat, n_bits), BitSet.of(_sized_keys(items), n_bits), percent), "windows")
    return verified(materialize(candidates(found, items), "candidates"), items, src, percent)


def decontaminate(docs: DataFrame, benchmark: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row per input row: doc_id, contaminated, kept, items (ids in
    order), similarity (best, null without a match)."""
    hit = materialize(matches(docs, benchmark, percent), "matches").groupBy("doc_id", "text_hash").agg(
        F.array_sort(F.collect_set("item_id")).alias("items"), F.max("similarity").alias("similarity"))
    hit = hit.select(F.col("doc_id").alias("h_id"), F.col("text_hash").alias("h_hash"), "items", "similarity")
    src = docs.select("doc_id", F.xxhash64(text_of()).alias("text_hash"))
    joined = src.join(hit, src["doc_id"].eqNullSafe(hit["h_id"]) & (src["text_hash"] == hit["h_hash"]), "left")
    return joined.select("doc_id", F.col("items").isNotNull().alias("contaminated"), F.col("items").isNull().alias("kept"),
                         F.coalesce("items", F.array().cast(joined.schema["items"].dataType)).alias("items"), "similarity")
