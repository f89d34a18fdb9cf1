"""Quality classifier: histogram gradient-boosted trees over document
statistics, flattened into arrays for vectorised numpy traversal.

Statistics and scores are made in Arrow batches, text by text, over whole
texts; nothing is shuffled but the narrow training rows (id and statistics of
labelled documents).  The trees are fitted on the driver from at most
``max_train`` labelled rows (those with the smallest id hash), a few MB by
that bound.  The fitted arrays are a few tens of KB and travel in the closure.

Defined cases: null or empty text has all statistics 0 and gets a score like
any other; labels that are null, or whose id is null, aren't learned from; an
id with several labels counts with the smallest; without labels every score is
0.5; rows are neither dropped nor repeated; extra columns travel in a struct.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from churnspark.llm import gbdt
from churnspark.llm.common import fold, map_arrow, packed
from churnspark.llm.tokens import SPACE_CLASS, chunks, grams, span_hashes, spans
from churnspark.session import materialize

FEATURES = ("words", "bytes", "word_length", "word_length_dev", "symbols", "upper", "digits", "marks", "stops",
            "other_signs", "not_ascii", "distinct", "repeated", "top_word", "lines", "line_words", "dup_lines")
MAX_TRAIN = 20_000

_LINE_CLASS = np.ones(256, np.uint8)
_LINE_CLASS[10] = 0


def _bytes_of(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars.encode())] = True
    return out


_RANGE = np.arange(256)
_KINDS = {"symbols": _bytes_of("#*$%&|<>"), "upper": (_RANGE >= 65) & (_RANGE <= 90), "digits": (_RANGE >= 48) & (_RANGE <= 57),
          "marks": _bytes_of("!?"), "stops": _bytes_of(".,;:"), "other_signs": _bytes_of("@\\^_`~/()[]{}+=\"'-"),
          "not_ascii": _RANGE >= 128}


def statistics(column) -> np.ndarray:
    """(texts, features) of a string column."""
    out = []
    for _, _, data, at in chunks(column):
        starts, ends, wa = spans(data, at)
        h = span_hashes(data, starts, ends)
        lengths = (ends - starts).astype(np.float64)
        summed = lambda v, o: np.diff(np.concatenate([[0], np.cumsum(v)])[o])
        n = np.diff(wa).astype(np.float64)
        some = np.maximum(n, 1)
        solid = summed(lengths, wa)
        mean = solid / some
        dev = np.sqrt(np.maximum(summed(lengths ** 2, wa) / some - mean ** 2, 0))
        share = {k: summed(m[data], at) / np.maximum(solid, 1) for k, m in _KINDS.items()}
        eight, ea = grams(h, wa, 8)
        ls, le, la = spans(data, at, _LINE_CLASS)
        line = span_hashes(data, ls, le)
        per = np.zeros((4, len(n)))
        for i in range(len(n)):
            _, c = np.unique(h[wa[i]:wa[i + 1]], return_counts=True)
            if len(c):
                per[0, i], per[1, i] = len(c), c.max()
            if ea[i + 1] > ea[i]:
                per[2, i] = 1 - len(np.unique(eight[ea[i]:ea[i + 1]])) / (ea[i + 1] - ea[i])
            if la[i + 1] > la[i]:
                per[3, i] = 1 - len(np.unique(line[la[i]:la[i + 1]])) / (la[i + 1] - la[i])
        lines = np.diff(la).astype(np.float64)
        out.append(np.column_stack([n, solid, mean, dev, *[share[k] for k in _KINDS], per[0] / some, per[2], per[1] / some,
                                    lines, n / np.maximum(lines, 1), per[3]]))
    return np.concatenate(out) if out else np.zeros((0, len(FEATURES)))


def train(docs: DataFrame, labels: DataFrame, usable: Column | None = None, max_train: int = MAX_TRAIN,
          id_col: str = "doc_id", text_col: str = "text", **settings) -> gbdt.Trees:
    """Trees for ``labels`` (doc_id, quality), from the rows where ``usable``
    (a condition on ``doc_id``) holds."""
    marks = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
    if usable is not None:
        marks = marks.where(usable)
    order = F.xxhash64(F.col("doc_id").cast("string"))
    # at most max_train ids of 16 bytes: a proven bound for the broadcast
    marks = materialize(marks.groupBy("doc_id").agg(F.min("quality").alias("quality")).orderBy(order, "doc_id")
                        .limit(max_train), "quality_marks")
    chosen = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).join(
        F.broadcast(marks), "doc_id").select("doc_id", "quality", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = statistics(batch.column(2))
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.string()), batch.column(1).cast(pa.int64()),
                                              pa.array(list(x), pa.list_(pa.float64()))], names=["doc_id", "y", "x"])

    # repeated rows of an id could exceed the bound, so it holds for the rows too
    rows = map_arrow(chosen, run, "doc_id string, y long, x array<double>").orderBy("doc_id", "x").limit(max_train).toArrow()
    x = np.array(rows.column("x").to_pylist(), np.float64).reshape(-1, len(FEATURES))
    return gbdt.fit(x, np.array(rows.column("y").to_pylist(), np.float64), **settings)


def with_score(docs: DataFrame, model: gbdt.Trees, text_col: str = "text") -> DataFrame:
    """``docs`` as struct ``row``, with ``score``."""
    rows = packed(docs)
    schema = StructType([rows.schema["row"], StructField("score", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row = batch.column(0)
            text = row.field(row.type.get_field_index(text_col))
            yield pa.RecordBatch.from_arrays([row, pa.array(model.probability(statistics(text)))], names=["row", "score"])

    return map_arrow(rows, run, schema)


def predict(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, max_train: int = MAX_TRAIN) -> DataFrame:
    """doc_id, held_out (a fifth of the ids, never learned from), score,
    predicted."""
    model = train(docs, labels, fold(5) != 0, max_train)
    scored = with_score(docs.select("doc_id", "text"), model)
    return scored.select("row.doc_id", "score").select(
        "doc_id", (fold(5) == 0).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
