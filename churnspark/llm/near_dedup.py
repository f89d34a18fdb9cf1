"""Near-duplicate documents by MinHash.

Method: many universal hash minima per document, banded; documents that share
a band are candidates, checked by signature and confirmed on their full
shingle sets; connected components by large-star and small-star.

Documents with equal shingle sets are one class (128-bit set hash), so exact
copies never meet as pairs.  Within a band bucket no pairs are enumerated:
every round picks hubs (1, then 16, 256, ... per bucket), compares the members
of *other* components with them, merges what is confirmed, and retires the
hubs.  A bucket is done once the members that were never hubs lie in one
component: every pair in it has then been compared or is already connected,
so no link between components is lost and a bucket of near copies takes one
or two rounds, with as many comparisons as members.  After the first round the
shingles that a text shares with no other one left are counted: they bound its
similarity with any of them from above, which settles texts that lie just
outside the threshold of a large group without comparing them pair by pair.

Recall: a pair at the threshold misses all bands with probability
(1 - 0.85^6)^24 = 1.2e-5 at 0.85 (24 bands of 6 minima) and (1 - 0.8^5)^32 =
3.0e-6 at 0.8 (32 bands of 5).  The signature check only leaves out pairs whose
128 signature bits differ in more than 30 (at 0.85, 9.6 are expected with
deviation 3.0: 4.5e-9) or 34 (at 0.8, 12.8 with deviation 3.4: 2.5e-8).
Thresholds below 0.8 are refused, as no bands are chosen for them.

Defined cases: text null or without words has an empty set and is linked with
nothing; a null id has a null component and is kept; rows with one id are one
document (the classes of all its texts, and its rows without words, are
connected through the id before any text is compared); equal rows count once and
are all returned; ties of the threshold are links; very long texts are read
whole, in chunks of one text at least; an empty table gives an empty table;
extra columns aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnspark.llm.bloom import bloom_filter, with_possible
from churnspark.llm.common import map_arrow
from churnspark.llm.components import components
from churnspark.llm.tokens import U64, chunks, mix, shingle_sets, word_hashes
from churnspark.session import materialize

#: Bits of the signature check.
SKETCH_BITS = 128
#: Threshold in percent from which a choice holds: bands, minima of each, and
#: the most signature bits that may differ.
CHOICES = {85: (24, 6, 30), 80: (32, 5, 34)}
MINIMA = max(bands * rows for bands, rows, _ in CHOICES.values())
HUB_GROWTH = 16

_rng = np.random.Generator(np.random.PCG64(20240607))
_A = (_rng.integers(0, 1 << 31, MINIMA, dtype=np.uint32) << np.uint32(1)) | np.uint32(1)
_B = _rng.integers(0, 1 << 32, MINIMA, dtype=np.uint32)
_SALT = _rng.integers(1, 1 << 63, 4, dtype=np.uint64)


def choice(percent: int) -> tuple[int, int, int]:
    """Bands, minima of each and differing signature bits for a threshold."""
    fit = [k for k in CHOICES if k <= percent]
    if not fit:
        raise ValueError(f"no bands are chosen for a similarity of {percent} percent")
    return CHOICES[max(fit)]


def minima(shingles: np.ndarray, n: int = MINIMA) -> np.ndarray:
    """The first ``n`` universal hash minima of a set (a x + b modulo 2^32)."""
    x, a, b = (shingles >> U64(32)).astype(np.uint32), _A[:n, None], _B[:n, None]
    out = np.full(n, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), 1024):
        np.minimum(out, (a * x[None, i:i + 1024] + b).min(axis=1), out=out)
    return out


def _signed(x) -> np.ndarray:
    return np.asarray(x, U64).view(np.int64)


def signatures(docs: DataFrame, percent: int = 85, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, set hash (f1, f2), band keys, sketch (s1, s2)."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    id_type = src.schema["doc_id"].dataType.simpleString()
    n_bands, n_rows, _ = choice(percent)
    number = (np.arange(n_bands, dtype=np.uint64) + U64(1)) * _SALT[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for i, j, data, at in chunks(batch.column(1)):
                sets = shingle_sets(*word_hashes(data, at))
                n = np.array([len(s) for s in sets], np.int64)
                set_hash = [_signed([(mix(s ^ salt)).sum(dtype=U64) for s in sets]) for salt in _SALT[1:3]]
                bands, sketch = [], np.zeros((len(sets), 2), U64)
                for k, s in enumerate(sets):
                    if not len(s):
                        bands.append(None)
                        continue
                    m = minima(s, n_bands * n_rows).astype(U64)
                    rows = m.reshape(n_bands, n_rows)
                    key = number.copy()
                    for r in range(n_rows):
                        key = mix(key ^ rows[:, r])
                    bands.append(_signed(key))
                    bits = (mix(m[:SKETCH_BITS] ^ _SALT[3]) & U64(1)).astype(np.uint8)
                    sketch[k] = np.packbits(bits).view(U64)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(i, j - i), pa.array(n), pa.array(set_hash[0]), pa.array(set_hash[1]),
                     pa.array(bands, pa.list_(pa.int64())), pa.array(_signed(sketch[:, 0].copy())),
                     pa.array(_signed(sketch[:, 1].copy()))],
                    names=["doc_id", "n_shingles", "f1", "f2", "bands", "s1", "s2"])

    return map_arrow(src, run, f"doc_id {id_type}, n_shingles long, f1 long, f2 long, bands array<long>, s1 long, s2 long")


def confirm(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose full shingle sets meet the threshold.  ``texts`` is
    (rep, text).  The hub ``b`` is the hot side: its rows follow each other
    within a partition, so its set is made once per run of rows."""
    one = texts.select(F.col("rep").alias("a"), F.col("text").alias("text_a"))
    two = texts.select(F.col("rep").alias("b"), F.col("text").alias("text_b"), F.xxhash64("text").alias("hash_b"))
    met = pairs.join(one, "a").join(two, "b").select("a", "b", "text_a", "text_b", "hash_b")
    kind = met.schema["a"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, hub = None, None
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            b_text = batch.column(3)
            b_ids = list(zip(batch.column(1).to_pylist(), batch.column(4).to_pylist()))  # an id may have several texts
            for i, j, data, at in chunks(batch.column(2)):
                for k, s in enumerate(shingle_sets(*word_hashes(data, at)), i):
                    if hub is None or b_ids[k] != last:
                        last = b_ids[k]
                        (_, _, d, o), = chunks(b_text.slice(k, 1))
                        hub = shingle_sets(*word_hashes(d, o))[0]
                    both = len(np.intersect1d(s, hub, assume_unique=True))
                    keep[k] = 100 * both >= percent * (len(s) + len(hub) - both)
            mask = pa.array(keep)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], names=["u", "v"])

    return map_arrow(met, run, f"u {kind}, v {kind}")


def private_shingles(texts: DataFrame) -> DataFrame:
    """(rep, private): shingles that no other of these texts has.  ``texts`` is
    (rep, text, several); ids with several texts get no row, which only weakens
    the bound (a row too many per id would hide shingles that the id has alone)."""
    kind = texts.schema["rep"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, at in chunks(batch.column(1)):
                sets = [s.view(np.int64) for s in shingle_sets(*word_hashes(data, at))]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(sets, pa.list_(pa.int64())),
                                                  batch.column(2).slice(i, j - i)], names=["rep", "shingles", "several"])

    each = map_arrow(texts, run, f"rep {kind}, shingles array<long>, several boolean").select(
        "rep", "several", F.explode("shingles").alias("s"))
    own = (each.groupBy("s").agg(F.count("*").alias("n"), F.min("rep").alias("rep"), F.max("several").alias("several"))
           .where("n = 1 AND NOT several"))
    return own.groupBy("rep").agg(F.count("*").alias("private"))


def _able(percent: int):
    """Whether a member may have a link to any text of its bucket: of its n
    shingles at most ``shared`` are in another text, so a partner of m shingles
    needs (100 + percent) shared >= percent (n + m); ``m`` is the bucket's
    smallest size."""
    return (100 + percent) * F.col("shared") >= percent * (F.col("n") + F.col("m"))


def _unresolved(members: DataFrame, filtered: bool) -> DataFrame:
    """Members of buckets with more than one component, with ``m``.  Where all
    rows are asked, a Bloom filter of fixed size keeps most of them out of the
    exact join's shuffle (``filtered``)."""
    open_ = materialize(members.groupBy("bucket").agg(F.min("n").alias("m"), F.min("comp").alias("lo"), F.max("comp").alias("hi"))
                        .where("lo <> hi").select("bucket", "m"), "open_buckets")
    if filtered:
        members = with_possible(members, F.col("bucket"), *bloom_filter(open_, "bucket")).where("possible").drop("possible")
    return members.join(open_, "bucket")


def _hubs(members: DataFrame, per_bucket: int) -> DataFrame:
    """One hub for each of ``per_bucket`` slots of a bucket: the member with
    the fewest private shingles, which lies closest to the others."""
    slot = F.pmod(F.xxhash64("rep", F.lit(per_bucket)), F.lit(per_bucket))
    first = F.struct((F.col("n") - F.col("shared")).alias("private"), F.xxhash64("rep", "bucket").alias("order"),
                     "rep", "comp", "n", "shared", "s1", "s2")
    return members.groupBy("bucket", slot.alias("slot")).agg(F.min(first).alias("hub")).select(
        "bucket", *[F.col(f"hub.{c}").alias(f"h_{c}") for c in ("rep", "comp", "n", "shared", "s1", "s2")])


def hub_pairs(members: DataFrame, hubs: DataFrame, percent: int) -> DataFrame:
    """(a, b): members and hubs of other components whose sizes, shared
    shingles and signatures allow a link.  A pair that shares several buckets
    meets in the smallest of those where ``b`` is a hub.  If the member is no
    longer in that bucket, the pair is settled: the member was a hub there and
    has been compared with ``b``, or can't be linked with any text of it.  Of
    two hubs of a bucket only the smaller one is taken as the member: the other
    way round they meet in a bucket where the larger one is a hub."""
    near = (F.bit_count(F.col("s1").bitwiseXOR(F.col("h_s1"))) + F.bit_count(F.col("s2").bitwiseXOR(F.col("h_s2")))
            <= choice(percent)[2])
    sizes = 100 * F.least("n", "h_n") >= percent * F.greatest("n", "h_n")
    shared = (100 + percent) * F.least("shared", "h_shared") >= percent * (F.col("n") + F.col("h_n"))
    first = F.array_min(F.array_intersect("bands", "h_in")) == F.col("bucket")
    # at most one bucket a band, so the sets are small
    each = (hubs.groupBy("h_rep", "h_comp", "h_n", "h_shared", "h_s1", "h_s2").agg(F.collect_set("bucket").alias("h_in"))
            .withColumn("bucket", F.explode("h_in")))
    own = hubs.select("bucket", F.col("h_rep").alias("rep")).distinct().withColumn("is_hub", F.lit(True))
    once = F.col("is_hub").isNull() | (F.col("rep") < F.col("h_rep"))
    return (members.join(own, ["bucket", "rep"], "left").join(each, "bucket")
            .where((F.col("comp") != F.col("h_comp")) & once & sizes & shared & near & first)
            .select(F.col("rep").alias("a"), F.col("h_rep").alias("b")))


_SET = ["n_shingles", "f1", "f2"]


def several_texts(signed: DataFrame) -> DataFrame:
    """doc_id of the ids that stand for more than one set (map-side combined)."""
    one = F.struct(*_SET)
    return (signed.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min(one).alias("lo"), F.max(one).alias("hi"))
            .where("lo <> hi").select("doc_id"))


def id_links(signed: DataFrame, classes: DataFrame, several: DataFrame) -> DataFrame:
    """(u, v): the representatives of the classes that meet in one id, each
    linked with the smallest of them."""
    own = (signed.where("n_shingles > 0").join(several, "doc_id").select("doc_id", *_SET).distinct()
           .join(classes.select("rep", F.col("n").alias("n_shingles"), "f1", "f2"), _SET).select("doc_id", "rep"))
    least = own.groupBy("doc_id").agg(F.min("rep").alias("v"))
    return own.join(least, "doc_id").where("rep <> v").select(F.col("rep").alias("u"), "v").distinct()


def linked_classes(docs: DataFrame, classes: DataFrame, percent: int, id_col: str, text_col: str,
                   several: DataFrame, component: DataFrame) -> DataFrame:
    """(node, component) of the classes that are connected to a smaller one;
    ``component`` has those that are connected from the start, ``several`` the
    ids with more than one text."""
    fresh = (classes.join(component, classes["rep"] == component["node"], "left")
             .select("rep", F.coalesce("component", "rep").alias("comp"), "n", F.col("n").alias("shared"), "s1", "s2",
                     F.explode("bands").alias("bucket")))
    found = materialize(_unresolved(fresh, True), "found")
    # only texts that may have a candidate (Bloom filters of fixed size: a text too many
    # meets no pair, and one taken for several only gets no bound)
    blocks, n_blocks = bloom_filter(materialize(found.select("rep").distinct(), "wanted"), "rep")
    # the bands join the few rows that are left instead of travelling with every bucket
    own_bands = with_possible(classes.select("rep", "n", "s1", "s2", "bands"), F.col("rep"), blocks, n_blocks)
    members = materialize(found.join(own_bands.where("possible").drop("possible").distinct(), ["rep", "n", "s1", "s2"]), "members")
    text = docs.select(F.col(id_col).alias("rep"), F.col(text_col).alias("text")).where("rep IS NOT NULL")
    possible = with_possible(text, F.col("rep"), blocks, n_blocks).where("possible").select("rep", "text")
    texts = materialize(with_possible(possible, F.col("rep"), *bloom_filter(several, "doc_id"), name="several").distinct(), "texts")
    per_bucket = 1
    while members.take(1):
        hubs = materialize(_hubs(members, per_bucket), "hubs")
        links = materialize(confirm(hub_pairs(members, hubs, percent), texts, percent), "links")
        if links.take(1):
            stars = component.select(F.col("node").alias("u"), F.col("component").alias("v"))
            component = components(stars.unionByName(links))
        retired = hubs.select("bucket", *[F.col(f"h_{c}").alias(c) for c in ("rep", "n", "s1", "s2")])
        left = (members.join(retired, retired.columns, "left_anti").select("bucket", "rep", "n", "s1", "s2", "bands")
                .join(component.select(F.col("node").alias("rep"), F.col("component").alias("comp")), "rep", "left")
                .withColumn("comp", F.coalesce("comp", "rep")))
        left = materialize(_unresolved(materialize(left, "left"), False), "unresolved")
        # what is shared among the texts that are left: fewer every round, so the bound gets tighter
        own = private_shingles(texts.join(left.select("rep").distinct(), "rep", "left_semi"))
        members = materialize(left.join(own, "rep", "left").withColumn("shared", F.col("n") - F.coalesce("private", F.lit(0)))
                              .drop("private").where(_able(percent)), "members")
        per_bucket *= HUB_GROWTH
    return component


def near_dedup(docs: DataFrame, percent: int = 85, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept."""
    signed = materialize(signatures(docs, percent, id_col, text_col), "signatures")
    usable = signed.where("doc_id IS NOT NULL AND n_shingles > 0")
    classes = materialize(usable.groupBy("n_shingles", "f1", "f2").agg(
        F.min("doc_id").alias("rep"), *[F.first(c).alias(c) for c in ("bands", "s1", "s2")])
        .withColumnRenamed("n_shingles", "n"), "classes")
    several = materialize(several_texts(signed), "several")
    component = docs.sparkSession.createDataFrame(
        [], classes.select(F.col("rep").alias("node"), F.col("rep").alias("component")).schema)
    repeated = bool(several.take(1))
    if repeated:
        component = materialize(components(id_links(signed, classes, several)), "id_components")
    component = linked_classes(docs, classes, percent, id_col, text_col, several, component)
    named = (classes.join(component, classes["rep"] == component["node"], "left")
             .select(F.col("n").alias("n_shingles"), "f1", "f2", F.coalesce("component", "rep").alias("component_id")))
    out = (signed.select("doc_id", *_SET).join(named, _SET, "left")
           .select("doc_id", "n_shingles",
                   F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id")))
    if repeated:  # rows without words go with the other texts of their id
        met = materialize(out, "met")
        least = (met.where("n_shingles > 0").join(several, "doc_id").groupBy("doc_id")
                 .agg(F.min("component_id").alias("of_id")))
        out = met.join(least, "doc_id", "left").select("doc_id", "n_shingles", F.coalesce("of_id", "component_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
