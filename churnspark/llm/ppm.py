"""Language-model scores: prediction by partial matching over bytes.

Method: a byte-context trie of order 5, pretrained on the training texts.  A
byte is predicted from its longest context; a byte not seen there escapes to
the next shorter context, where the bytes of the longer one are excluded; below
order 0 all bytes left are equally likely.  Half a count of every byte seen in
a context is left for the escape (probability distinct / (2 * total)), and a
shorter context counts the longer contexts that a byte followed, not its
occurrences: it is asked only where they fail.  A text's score is the log10 probability of its
lower-cased bytes and of its end.  A word unigram with add-one counts is the
base score.

Scale: n-gram and word counts cover all training texts and are all kept; both
are summed inside the tasks first and then by Spark.  The trie is a set of
tables, one per order, and the probability of every n-gram that some text has
is computed by joins on them (tables of at most 65,536 rows by their keys are
broadcast; a key of the others meets at most 256 rows).  At most ``MAX_NODES``
of the most used n-grams (16 MB) and the ``HOT_WORDS`` most frequent words travel to
the tasks with their values; rarer ones meet theirs in a join, where no key is
hot.  One text is never in more than one row of the pass that scores it.  Both
passes over the texts sort the n-grams of a chunk, with the text or its fold in
the free bits, and look up each distinct one once.

Defined cases: a null text is empty and has the end alone; a very long text is
one row of one task, whole, in arrays of eight bytes for each of its own;
n-grams used equally often all travel or are all joined, with the same values; a null id is in no
fold, so its row is learned from and scored; repeated rows are scored alike
and all returned; with no training text every word is unknown and every byte
equally likely; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnspark.llm.common import fold, map_arrow, text_of
from churnspark.llm.tokens import LOWER, U64, chunks, word_hashes
from churnspark.session import materialize

ORDER = 5
#: N-grams and words whose values travel to the tasks; the others are joined.
MAX_NODES = 1_000_000
HOT_WORDS = 50_000
#: Counts of a task that wait at least before they are merged.
MERGE_AT = 1_000_000
#: Left beside a packed n-gram in 64 bits, for the number of a text.
TEXT_BITS = 8 * (7 - ORDER)
#: Before and after a text; no UTF-8 text has this byte.
EDGE = 255


def byte_grams(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed (context of ORDER bytes, byte) of every byte and of the end of
    each text, and their offsets per text."""
    n = len(at) - 1
    # each text is preceded by ORDER edges and followed by one
    first = at[:-1] + np.arange(n) * (ORDER + 1)
    inside = np.ones(len(data) + n * (ORDER + 1), bool)
    for k in range(ORDER):
        inside[first + k] = False
    own = inside.copy()
    own[first + ORDER + np.diff(at)] = False
    padded = np.full(8 + len(inside), EDGE, np.uint8)
    padded[8:][own] = LOWER[data]
    # the eight bytes up to each one, the last one lowest
    packed = np.ndarray(len(inside), ">u8", padded, offset=1, strides=(1,)).astype(U64)
    packed &= U64((1 << (8 * (ORDER + 1))) - 1)
    return packed[inside], np.concatenate([[0], np.cumsum(np.diff(at) + 1)])


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first positions, lengths) of the runs of equal ones of the sorted ``keys``."""
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])[:len(keys)])
    return first, np.diff(np.append(first, len(keys)))


def by_text(ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs of an id (of at most ORDER + 1 bytes) and one of at most
    2^TEXT_BITS texts that has it, sorted: ids, texts and times."""
    pairs = ids << U64(TEXT_BITS) | np.repeat(np.arange(len(at) - 1, dtype=U64), np.diff(at))
    pairs.sort()
    first, times = _runs(pairs)
    pairs = pairs[first]
    return pairs >> U64(TEXT_BITS), (pairs & U64((1 << TEXT_BITS) - 1)).astype(np.int64), times


def gram_pairs(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct n-grams of some texts; per n-gram and text that has it the
    position of the n-gram, the text and the times."""
    ids, text, times = by_text(*byte_grams(data, at))
    first, size = _runs(ids)
    return ids[first], np.repeat(np.arange(len(first)), size), text, times


def word_pairs(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The same for hashes of words."""
    h, wa = word_hashes(data, at)
    keys, ids = np.unique(h, return_inverse=True)
    ids, text, times = by_text(ids.astype(U64), wa)
    return keys, ids.astype(np.int64), text, times


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions, found) of ``wanted`` in the sorted ``keys``."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    k = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return k, keys[k] == wanted


def sums_and_rest(keys: np.ndarray, ids: np.ndarray, text: np.ndarray, times: np.ndarray, n_texts: int,
                  hot: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, pa.Array, pa.Array]:
    """Per text, from what ``gram_pairs`` and ``word_pairs`` return: how many are
    ``hot`` (sorted), the sum of their values, and the others with their times."""
    k, found = _find(hot, keys)
    worth, known = np.where(found, value[k] if len(value) else 0.0, 0.0)[ids], found[ids]
    order = np.flatnonzero(~known)
    order = order[np.argsort(text[order], kind="stable")]
    ends = pa.array(np.concatenate([[0], np.cumsum(np.bincount(text[order], minlength=n_texts))]).astype(np.int32))
    return (np.bincount(text, times * known, n_texts), np.bincount(text, times * worth, n_texts),
            pa.ListArray.from_arrays(ends, pa.array(keys[ids[order]].view(np.int64))),
            pa.ListArray.from_arrays(ends, pa.array(times[order].astype(np.int32))))


@dataclass
class Level:
    """Nodes of one order: n-grams with counts (below the highest order, of the
    longer n-grams that end in them); per context its total, its number of
    distinct bytes, and the counts those bytes have one order lower (left out
    there when this context is escaped from)."""

    grams: np.ndarray
    counts: np.ndarray
    contexts: np.ndarray
    total: np.ndarray
    distinct: np.ndarray
    lower: np.ndarray


@dataclass
class Trie:
    """All orders in one process: what ``gram_scores`` computes with tables."""

    levels: list[Level]

    @classmethod
    def of(cls, grams: np.ndarray, counts: np.ndarray) -> Trie:
        """From packed n-grams of the highest order."""
        levels: list[Level] = []
        for order in range(ORDER, -1, -1):
            mask = U64((1 << (8 * (order + 1))) - 1)
            g, inv = np.unique(grams & mask, return_inverse=True)
            n = np.bincount(inv, counts, len(g))
            grams, counts = g, np.ones(len(g))
            c, ci = np.unique(g >> U64(8), return_inverse=True)
            levels.insert(0, Level(g, n, c, np.bincount(ci, n, len(c)), np.bincount(ci, minlength=len(c)).astype(float),
                                   np.zeros(len(c))))
        for order in range(1, ORDER + 1):
            here, below = levels[order], levels[order - 1]
            k, _ = _find(below.grams, here.grams & U64((1 << (8 * order)) - 1))
            if len(k):
                ci = np.searchsorted(here.contexts, here.grams >> U64(8))
                here.lower = np.bincount(ci, below.counts[k], len(here.contexts))
        return cls(levels)

    def log10p(self, grams: np.ndarray) -> np.ndarray:
        """log10 probability of each packed n-gram's last byte."""
        out = np.zeros(len(grams))
        left = np.arange(len(grams))
        gone_n, gone_d = np.zeros(len(grams)), np.zeros(len(grams))  # counts and bytes excluded
        for order in range(ORDER, -1, -1):
            lv = self.levels[order]
            g = grams[left] & U64((1 << (8 * (order + 1))) - 1)
            c, has = _find(lv.contexts, g >> U64(8))
            k, seen = _find(lv.grams, g)
            if not len(lv.contexts):
                continue
            total = np.where(has, lv.total[c] - gone_n[left], 0.0)
            distinct = np.where(has, lv.distinct[c] - gone_d[left], 0.0)
            some = distinct > 0
            whole = np.where(some, total, 1.0)
            out[left[seen]] += np.log10((lv.counts[k[seen]] - 0.5) / whole[seen])
            escapes = ~seen
            out[left[escapes & some]] += np.log10((0.5 * distinct / whole)[escapes & some])
            gone_n[left] = np.where(has, lv.lower[c], 0.0)
            gone_d[left] = np.where(has, lv.distinct[c], 0.0)
            left = left[escapes]
        out[left] -= np.log10(np.maximum(256 - gone_d[left], 1))
        return out

    def scores(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        """log10 probability of each text."""
        grams, ga = byte_grams(data, at)
        u, inv = np.unique(grams, return_inverse=True)
        return np.diff(np.concatenate([[0.0], np.cumsum(self.log10p(u)[inv])])[ga])


class Counts:
    """Sums of counts by key.  What is added waits until it is twice the sums'
    size and is merged then, so memory follows the distinct keys."""

    def __init__(self) -> None:
        self.parts = [(np.zeros(0, U64), np.zeros(0, np.int64))]
        self.waiting = 0

    def add(self, keys: np.ndarray, n: np.ndarray) -> None:
        self.parts.append((keys, n))
        self.waiting += len(keys)
        if self.waiting > max(2 * len(self.parts[0][0]), MERGE_AT):
            self.merged()

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        """Sorted keys and their sums."""
        keys = np.concatenate([k for k, _ in self.parts])
        n = np.concatenate([n for _, n in self.parts])
        self.parts, self.waiting = [], 0
        order = np.argsort(keys)
        keys, n = keys[order], n[order]
        first, _ = _runs(keys)
        self.parts = [(keys[first], np.add.reduceat(n, first))]
        return self.parts[0]


def corpus_counts(texts: DataFrame) -> DataFrame:
    """(kind, key, n, uses): kind 0 packed byte n-grams, 1 word hashes, 2 texts;
    ``n`` counts training texts, ``uses`` all.  ``texts`` is (text, held_out).
    Counts are summed per batch before they leave the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            learned = ~batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            grams, words = Counts(), Counts()
            for i, j, data, at in chunks(batch.column(0)):
                g, ga = byte_grams(data, at)
                g = g << U64(1) | np.repeat(learned[i:j], np.diff(ga)).astype(U64)
                g.sort()
                first, n = _runs(g)
                grams.add(g[first], n)
                h, wa = word_hashes(data, at)
                words.add(*np.unique(h[np.repeat(learned[i:j], np.diff(wa))], return_counts=True))
            marked, n = grams.merged()
            first, _ = _runs(marked >> U64(1))
            g, uses = marked[first] >> U64(1), np.add.reduceat(n, first)
            gn = np.add.reduceat(n * (marked & U64(1)).astype(np.int64), first)
            w, wn = words.merged()
            kind = np.concatenate([np.zeros(len(g)), np.ones(len(w)), [2]]).astype(np.int32)
            key = np.concatenate([g.astype(np.int64), w.view(np.int64), [0]])
            n_texts = [int(learned.sum())]
            yield pa.RecordBatch.from_arrays([pa.array(kind), pa.array(key), pa.array(np.concatenate([gn, wn, n_texts])),
                                              pa.array(np.concatenate([uses, wn, n_texts]))], names=["kind", "key", "n", "uses"])

    return map_arrow(texts, run, "kind int, key long, n long, uses long").groupBy("kind", "key").agg(
        F.sum("n").alias("n"), F.sum("uses").alias("uses"))


def _suffix(col: str, order: int) -> Column:
    """The n-gram of a lower order at the end of a packed one."""
    return F.col(col).bitwiseAND(F.lit((1 << (8 * (order + 1))) - 1))


def _bounded(table: DataFrame, n_bytes: int) -> DataFrame:
    """Broadcast a table whose key has at most two bytes (65,536 rows)."""
    return F.broadcast(table) if n_bytes <= 2 else table


def gram_levels(grams: DataFrame) -> tuple[list[DataFrame], list[DataFrame]]:
    """Per order, the table (g, c) of n-grams and counts and the table (context,
    total, bytes, lower) of what ``Level`` has per context."""
    levels = [grams.where("n > 0").select(F.col("key").alias("g"), F.col("n").cast("double").alias("c"))]
    for order in range(ORDER - 1, -1, -1):
        level = levels[0].groupBy(_suffix("g", order).alias("g")).agg(F.count("*").cast("double").alias("c"))
        levels.insert(0, materialize(level, f"grams_{order}"))
    contexts = []
    for order, level in enumerate(levels):
        below = F.lit(0.0).alias("below")
        if order:
            lower = levels[order - 1].select(F.col("g").alias("end"), F.col("c").alias("below"))
            level, below = level.join(_bounded(lower, order), _suffix("g", order - 1) == F.col("end")), F.col("below")
        contexts.append(level.select(F.shiftright("g", 8).alias("context"), "c", below).groupBy("context").agg(
            F.sum("c").alias("total"), F.count("*").cast("double").alias("bytes"), F.sum("below").alias("lower")))
    return levels, contexts


def gram_scores(grams: DataFrame) -> DataFrame:
    """(key, uses, p): log10 probability of the last byte of every n-gram of
    the highest order, like ``Trie.log10p``.  ``grams`` is (key, n, uses)."""
    levels, contexts = gram_levels(grams)
    found, zero = F.col("c").isNotNull(), F.lit(0.0)
    total, distinct = F.col("total") - F.col("gone_n"), F.col("bytes") - F.col("gone_d")
    step = (F.when(found, F.log10((F.col("c") - 0.5) / total))
            .when(distinct > 0, F.log10(0.5 * distinct / total)).otherwise(zero))

    def predicted(rows: DataFrame, order: int) -> DataFrame:
        met = rows.join(_bounded(contexts[order], order), F.shiftright(_suffix("key", order), 8) == F.col("context"), "left")
        return met.select("key", "uses", (F.col("p") + step).alias("p"), found.alias("found"),
                          F.coalesce("lower", zero).alias("gone_n"), F.coalesce("bytes", zero).alias("gone_d"))

    start = grams.select("key", "uses", F.when(F.col("n") > 0, F.col("n").cast("double")).alias("c"),
                         zero.alias("p"), zero.alias("gone_n"), zero.alias("gone_d"))
    rows = materialize(predicted(start, ORDER), "grams_seen")
    out = rows.where("found").select("key", "uses", "p")
    for order in range(ORDER - 1, -1, -1):
        left = rows.where("NOT found").drop("found")
        rows = materialize(predicted(left.join(_bounded(levels[order], order + 1), _suffix("key", order) == F.col("g"), "left"),
                                     order), f"grams_escaped_{order}")
        out = out.unionByName(rows.where("found").select("key", "uses", "p"))
    new = F.col("p") - F.log10(F.greatest(256 - F.col("gone_d"), F.lit(1.0)))
    return out.unionByName(rows.where("NOT found").select("key", "uses", new.alias("p")))


def most_used(grams: DataFrame, at_most: int) -> DataFrame:
    """The n-grams with the highest ``uses``, in whole classes of ``uses`` (a
    sixteenth of a power of two wide), as many classes as hold ``at_most`` rows;
    two aggregates and a filter, no sort of all n-grams."""
    kind = F.floor(F.log2("uses") * 16)
    classes = grams.groupBy(kind.alias("kind")).count().orderBy(F.desc("kind")).collect()  # at most 1,008 rows
    held = np.cumsum([r["count"] for r in classes]) <= at_most
    return grams.where(kind >= classes[held.sum() - 1]["kind"]) if held.any() else grams.limit(0)


def score(docs: DataFrame, held_out: int = 2, mod: int = 7, max_nodes: int = MAX_NODES,
          hot_words: int = HOT_WORDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    rows = docs.select("doc_id", F.xxhash64(text_of()).alias("text_hash"), text_of().cast("string").alias("text"),
                       (fold(mod) == held_out).alias("held_out"))
    counts = materialize(corpus_counts(rows.select("text", "held_out")), "corpus_counts")
    grams = materialize(gram_scores(counts.where("kind = 0")), "gram_scores")
    nodes = most_used(grams, max_nodes).select("key", "p").toArrow()
    by_key = np.argsort(nodes.column("key").to_numpy())
    hot_gram, hot_p = nodes.column("key").to_numpy()[by_key].astype(U64), nodes.column("p").to_numpy()[by_key]
    words = counts.where("kind = 1").select(F.col("key").alias("word"), F.col("n").alias("c"))
    hot = words.orderBy(F.desc("c"), "word").limit(hot_words).toArrow()
    w, c = hot.column("word").to_numpy().astype(np.int64).view(U64), hot.column("c").to_numpy().astype(np.int64)
    order = np.argsort(w)
    hot_word, hot_count = w[order], c[order]
    n_words, distinct, n_docs = counts.agg(F.sum(F.when(F.col("kind") == 1, F.col("n"))),
                                           F.sum(F.when(F.col("kind") == 1, 1)),
                                           F.sum(F.when(F.col("kind") == 2, F.col("n")))).first()
    n_docs = n_docs or 0
    total = (n_words or 0) + n_docs
    floor = np.log10(total + (distinct or 0) + (1 if n_docs else 0) + 1)
    end = float(np.log10(n_docs + 1) - floor)
    hot_value = np.log10(hot_count + 1.0) - floor
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = (whole.slice(k, 1 << TEXT_BITS) for whole in batches for k in range(0, whole.num_rows, 1 << TEXT_BITS))
        for batch in parts:
            for i, j, data, at in chunks(batch.column(2)):
                by_word, by_gram = word_pairs(data, at), gram_pairs(data, at)
                known, known_score, rare, times = sums_and_rest(*by_word, j - i, hot_word, hot_value)
                _, gram_score, rare_grams, gram_times = sums_and_rest(*by_gram, j - i, hot_gram, hot_p)
                own = [batch.column(k).slice(i, j - i) for k in (0, 1, 3)]
                yield pa.RecordBatch.from_arrays(
                    [*own, pa.array(np.bincount(by_word[2], by_word[3], j - i).astype(np.int64)), pa.array(known.astype(np.int64)),
                     pa.array(known_score), pa.array(gram_score), rare, times, rare_grams, gram_times],
                    names=["doc_id", "text_hash", "held_out", "words", "hot", "hot_score", "score", "rare", "times",
                           "rare_grams", "gram_times"])

    passed = map_arrow(
        rows.select("doc_id", "text_hash", "text", "held_out"), run, f"doc_id {kind}, text_hash long, held_out boolean, words long, hot long, hot_score double, score double, "
             "rare array<long>, times array<int>, rare_grams array<long>, gram_times array<int>")
    # one pass over the texts writes the sums and the rare words of each text
    passed = materialize(passed, "scored")
    keys = ["doc_id", "text_hash"]
    # equal rows are one key here and are dealt out again at the end
    own = ("held_out", "words", "hot", "hot_score", "score")
    per_key = passed.groupBy(*keys).agg(F.count("*").alias("copies"), *[F.max(c).alias(c) for c in own])
    item = lambda kind, key, times: F.transform(F.arrays_zip(key, times), lambda e: F.struct(
        F.lit(kind).alias("kind"), e[key].alias("key"), e[times].alias("times")))
    rare = passed.select(*keys, F.explode(F.concat(item(1, "rare", "times"), item(0, "rare_grams", "gram_times"))).alias("e"))
    values = (words.select(F.lit(1).alias("kind"), F.col("word").alias("key"), F.log10(F.col("c") + 1).alias("value"))
              .unionByName(grams.select(F.lit(0).alias("kind"), "key", F.col("p").alias("value"))))
    is_word, times = F.col("kind") == 1, F.col("times")
    met = (rare.select(*keys, "e.*").join(values, ["kind", "key"], "left").groupBy(*keys).agg(
        F.sum(F.when(is_word, times * (F.coalesce("value", F.lit(0.0)) - float(floor))).otherwise(0.0)).alias("rare_score"),
        F.sum(F.when(is_word & F.col("value").isNotNull(), times).otherwise(0)).alias("rare_known"),
        F.sum(F.when(is_word, 0.0).otherwise(times * F.col("value"))).alias("gram_score")))
    met = met.select(*[F.col(k).alias(f"r_{k}") for k in keys], "rare_score", "rare_known", "gram_score")
    joined = per_key.join(met, per_key["doc_id"].eqNullSafe(met["r_doc_id"])
                          & (per_key["text_hash"] == met["r_text_hash"]), "left")
    zero = lambda col: F.coalesce(F.col(col) / F.col("copies"), F.lit(0))
    return joined.select(
        "doc_id", "held_out", (F.col("words") + 1).alias("n_tokens"),
        (F.col("hot") + zero("rare_known") + (1 if n_docs else 0)).cast("long").alias("n_known"),
        F.lit(int(total)).cast("long").alias("train_tokens"),
        (F.col("hot_score") + zero("rare_score") + end).alias("base_score"),
        (F.col("score") + zero("gram_score")).alias("score"),
        F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).drop("copy")
