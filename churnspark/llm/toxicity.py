"""Toxicity by a classifier chain.

Method: categories are predicted one after the other by linear models over the
presence of words and word beginnings; each later model also gets the earlier categories'
probabilities.  In training those are out-of-fold predictions, so a later model
sees them as uncertain as they are on new documents.

The given labels mark low quality and toxicity, so the chain is ``junk``,
``toxic``, ``toxic_junk`` (both); other label columns and orders are a
parameter.

Scale: the models learn from at most ``max_train`` labelled documents (those
with the smallest id hash).  Their words are counted by Spark; only the
``max_words`` most telling words of each category become inputs.  The matrix
the driver fits on has at most max_train x 3 max_words entries, in practice
a few per document.  Scoring is one pass over whole texts without a shuffle.

Defined cases: null or empty text has no word and gets the models' base rate;
null labels and null ids aren't learned from, an id with several labels counts
with the largest; without labels, or with one class only, a category's
probability is its base rate; rows are neither dropped nor repeated.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from churnspark.llm.common import map_arrow, packed
from churnspark.llm.tokens import LOWER, U64, chunks, span_hashes, spans
from churnspark.session import materialize

MAX_TRAIN, MAX_WORDS, FOLDS = 20_000, 500, 3
MIN_DOCS = 3
#: Bytes of the word beginnings that are inputs besides whole words.
PREFIXES = (5, 7)

#: Space 0; letters, digits and all bytes of other scripts 1; signs 2: "idiot!!"
#: is the word "idiot" and the sign run "!!".
_CLASSES = np.full(256, 2, np.uint8)
_CLASSES[[0x20, 9, 10, 11, 12, 13]] = 0
_CLASSES[48:58] = _CLASSES[65:91] = _CLASSES[97:123] = _CLASSES[128:] = 1


def categories() -> dict[str, Column]:
    """The chain: name to condition on the columns of ``labels``."""
    low, toxic = F.col("quality") == 0, F.col("toxic") == 1
    return {"junk": low, "toxic": toxic, "toxic_junk": low & toxic}


def _runs(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, ra = spans(data, at, _CLASSES)
    low = LOWER[data]
    # each run as a whole, and its first bytes (inflected forms share them)
    hashes = [span_hashes(low, starts, ends)]
    hashes += [span_hashes(low, starts, np.minimum(ends, starts + k)) ^ U64(k) for k in PREFIXES]
    return np.column_stack(hashes).ravel(), ra * len(hashes)


@dataclass
class Linear:
    """Weights of the words, of the earlier categories, and the bias."""

    words: np.ndarray
    earlier: np.ndarray
    bias: float

    def probability(self, doc: np.ndarray, word: np.ndarray, n: int, before: np.ndarray) -> np.ndarray:
        z = self.bias + np.bincount(doc, self.words[word], n) + _logit(before) @ self.earlier
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def fit_linear(doc: np.ndarray, word: np.ndarray, n: int, d: int, before: np.ndarray, y: np.ndarray, use: np.ndarray,
               steps: int = 300, rate: float = 0.1, ridge: float = 1e-4) -> Linear:
    """Logistic regression on the rows ``use`` by full-batch Adam."""
    m, k = int(use.sum()), before.shape[1]
    bias = float(np.log((y[use].sum() + 1) / ((1 - y[use]).sum() + 1)))
    model = Linear(np.zeros(d), np.zeros(k), bias)
    if not m or y[use].min() == y[use].max():
        return model
    entry = use[doc]
    doc, word, z = doc[entry], word[entry], _logit(before)
    w, m1, m2 = np.zeros(d + k + 1), np.zeros(d + k + 1), np.zeros(d + k + 1)
    w[-1] = bias
    for t in range(1, steps + 1):
        margin = w[-1] + np.bincount(doc, w[word], n) + z @ w[d:d + k]
        err = np.where(use, 1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y, 0.0)
        g = np.concatenate([np.bincount(word, err[doc], d), err @ z, [err.sum()]]) / m
        g[:-1] += ridge * w[:-1]
        m1, m2 = 0.9 * m1 + 0.1 * g, 0.999 * m2 + 0.001 * g * g
        w -= rate * (m1 / (1 - 0.9 ** t)) / (np.sqrt(m2 / (1 - 0.999 ** t)) + 1e-8)
    return Linear(w[:d], w[d:d + k], float(w[-1]))


@dataclass
class Chain:
    """Sorted word hashes, and one linear model per category."""

    names: list[str]
    words: np.ndarray
    models: list[Linear]

    def probabilities(self, column) -> np.ndarray:
        """(texts, categories) of a string column."""
        out = []
        for i, j, data, at in chunks(column):
            h, ra = _runs(data, at)
            n, before = j - i, np.zeros((j - i, 0))
            doc = np.repeat(np.arange(n), np.diff(ra))
            if len(self.words):
                k = np.minimum(np.searchsorted(self.words, h), len(self.words) - 1)
                known = self.words[k] == h
                pairs = np.unique(doc[known] * len(self.words) + k[known])
                doc, word = pairs // len(self.words), pairs % len(self.words)
            else:
                doc, word = np.zeros(0, np.int64), np.zeros(0, np.int64)
            for m in self.models:
                before = np.column_stack([before, m.probability(doc, word, n, before)])
            out.append(before)
        return np.concatenate(out) if out else np.zeros((0, len(self.models)))


def train(docs: DataFrame, labels: DataFrame, chain: dict[str, Column] | None = None, usable: Column | None = None,
          max_train: int = MAX_TRAIN, max_words: int = MAX_WORDS) -> Chain:
    """Fit the chain on ``docs`` (doc_id, text) and ``labels``."""
    chain = chain or categories()
    names = list(chain)
    marks = labels.where(F.col("doc_id").isNotNull())
    if usable is not None:
        marks = marks.where(usable)
    order = F.xxhash64(F.col("doc_id").cast("string"))
    marks = marks.groupBy("doc_id").agg(*[F.max(c.cast("int")).alias(f"y{k}") for k, c in enumerate(chain.values())])
    marks = marks.where(" AND ".join(f"y{k} IS NOT NULL" for k in range(len(names)))).orderBy(order, "doc_id").limit(max_train)
    # at most max_train rows: a proven bound for the broadcast
    marks = materialize(marks.withColumn("fold", F.pmod(order, F.lit(FOLDS)).cast("int")), "toxic_marks")
    chosen = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(marks.select("doc_id")), "doc_id")
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, at in chunks(batch.column(1)):
                h, ra = _runs(data, at)
                sets = [np.unique(h[ra[k]:ra[k + 1]]).view(np.int64) for k in range(j - i)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(sets, pa.list_(pa.int64()))],
                                                 names=["doc_id", "words"])

    seen = materialize(map_arrow(chosen, run, f"doc_id {kind}, words array<long>").select("doc_id", F.explode("words").alias("word"))
                       .distinct().join(F.broadcast(marks), "doc_id"), "toxic_words")
    rows = marks.orderBy("doc_id").toArrow()
    n = rows.num_rows
    y = np.column_stack([rows.column(f"y{k}").to_numpy() for k in range(len(names))]).astype(float) if n else np.zeros((0, len(names)))
    fold = rows.column("fold").to_numpy() if n else np.zeros(0, int)
    counts = seen.groupBy("word").agg(F.count("*").alias("df"), *[F.sum(f"y{k}").alias(f"p{k}") for k in range(len(names))]) \
        .where(F.col("df") >= MIN_DOCS)
    best = None
    for k in range(len(names)):
        pos = float(y[:, k].sum())
        a, df = F.col(f"p{k}"), F.col("df")
        # chi-square of word and category, for words that speak for the category
        lift = a * n - df * pos
        chi = F.when(lift > 0, lift * lift / (df * (n - df + 1e-9) * (pos * (n - pos) + 1e-9)))
        top = counts.withColumn("chi", chi).where("chi IS NOT NULL").orderBy(F.desc("chi"), "word").limit(max_words).select("word")
        best = top if best is None else best.unionByName(top)
    words = np.sort(np.array([r["word"] for r in best.distinct().collect()], np.int64).view(np.uint64))
    index = docs.sparkSession.createDataFrame(
        [(int(w), k) for k, w in enumerate(words.view(np.int64))], "word long, k int")
    # at most max_words rows per category
    hits = seen.join(F.broadcast(index), "word").groupBy("doc_id").agg(F.sort_array(F.collect_list("k")).alias("ks")).toArrow()
    row_of = {v: k for k, v in enumerate(rows.column("doc_id").to_pylist())}
    ks = hits.column("ks").to_pylist()
    doc = np.repeat([row_of[v] for v in hits.column("doc_id").to_pylist()], [len(v) for v in ks]).astype(np.int64)
    word = np.array([x for v in ks for x in v], np.int64)
    before, models = np.zeros((n, 0)), []
    for k in range(len(names)):
        fit = lambda use: fit_linear(doc, word, n, len(words), before, y[:, k], use)  # noqa: B023, E731
        models.append(fit(np.ones(n, bool)))
        unseen = np.zeros(n)
        for f in range(FOLDS):
            held = fold == f
            unseen[held] = fit(~held).probability(doc, word, n, before)[held]
        before = np.column_stack([before, unseen])
    return Chain(names, words, models)


def with_probabilities(docs: DataFrame, model: Chain, text_col: str = "text") -> DataFrame:
    """``docs`` as struct ``row``, with ``p`` (one probability per category)."""
    rows = packed(docs)
    schema = StructType([rows.schema["row"], StructField("p", ArrayType(DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row = batch.column(0)
            text = row.field(row.type.get_field_index(text_col))
            p = list(model.probabilities(text))
            yield pa.RecordBatch.from_arrays([row, pa.array(p, pa.list_(pa.float64()))], names=["row", "p"])

    return map_arrow(rows, run, schema)


def predict(docs: DataFrame, labels: DataFrame, threshold: float = 0.4, usable: Column | None = None) -> DataFrame:
    """doc_id, p_<category>..., toxic (p_toxic at least ``threshold``), kept."""
    model = train(docs, labels, usable=usable)
    scored = with_probabilities(docs.select("doc_id", "text"), model)
    toxic = F.col("p")[model.names.index("toxic")] >= threshold
    return scored.select("row.doc_id", *[F.col("p")[k].alias(f"p_{c}") for k, c in enumerate(model.names)],
                         toxic.alias("toxic"), (~toxic).alias("kept"))
