"""Language of documents and of the spans within them.

Method: the script ranges of a word narrow its candidate languages; each
candidate gets a score for the word (log likelihood of its letter bigrams and
trigrams, with word edges); Viterbi with a penalty for switching labels the
words, so runs of one language become spans.  A document's language is the one
with most letters, its score that language's share of the letters.

Scale: about ``max_docs`` documents of each language are learned from (chosen
by id hash); n-gram counts are hashed to ``BUCKETS`` cells and summed by Spark,
so the model has languages x BUCKETS numbers.  Prediction is one pass over
whole texts without a shuffle; Viterbi runs over many documents at once, one
word position per step.  Very long texts are cut into pieces that are stepped
together and joined exactly, so a text of a million words takes a few thousand
steps.

Defined cases: null text and text without letters is ``und`` with score 0 and
no span; null languages and null ids aren't learned from; a script that no
learned language uses narrows nothing; without any training row everything is
``und``; ties go to the language first by code point; rows are neither dropped
nor repeated.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StringType, StructField, StructType

from churnspark.llm.common import fold, map_arrow, packed
from churnspark.llm.tokens import U64, mix, text_bytes
from churnspark.session import materialize

MAX_DOCS = 5_000
BUCKETS = 1 << 16
#: Log likelihood lost by changing the language between two words.
SWITCH = 12.0
#: A script counts as a language's if it has this share of its letters.
MIN_SCRIPT = 0.001
CHUNK_CHARS = 1 << 20
VITERBI_WORDS = 1_000_000
#: Words of a piece; longer texts are cut into pieces that are stepped together.
SEGMENT = 1024
UNDETERMINED = "und"

#: First and last code point of the script ranges told apart (Unicode blocks).
SCRIPTS = {
    "latin": [(0x41, 0x24F), (0x1E00, 0x1EFF)], "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F)], "armenian": [(0x530, 0x58F)], "hebrew": [(0x590, 0x5FF)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F)], "devanagari": [(0x900, 0x97F)], "bengali": [(0x980, 0x9FF)],
    "tamil": [(0xB80, 0xBFF)], "thai": [(0xE00, 0xE7F)], "georgian": [(0x10A0, 0x10FF)],
    "hangul": [(0x1100, 0x11FF), (0xAC00, 0xD7AF)], "kana": [(0x3040, 0x30FF)],
    "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0x20000, 0x2FA1F)],
}


@cache
def _letters() -> tuple[np.ndarray, np.ndarray]:
    """Per code point: its lower case (0 if it is no letter), its script."""
    lower, script = np.zeros(0x110000, np.uint32), np.full(0x110000, len(SCRIPTS), np.uint8)
    for c in range(0x110000):
        if (ch := chr(c)).isalpha():
            low = ch.lower()
            lower[c] = ord(low) if len(low) == 1 else c
    for k, ranges in enumerate(SCRIPTS.values()):
        for a, b in ranges:
            script[a:b + 1] = k
    return lower, script


@dataclass
class Words:
    """Words of a chunk of texts: word offsets per text, letters, script, and
    the n-gram cells with their offsets per word."""

    at: np.ndarray
    letters: np.ndarray
    script: np.ndarray
    cells: np.ndarray
    cell_at: np.ndarray


def split_words(texts: list[str]) -> Words:
    lower, scripts = _letters()
    joined = "\0".join(texts) + "\0"
    code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    text_at = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
    low = lower[code]
    is_letter = low > 0
    before = np.concatenate([[False], is_letter[:-1]])
    keep = np.flatnonzero(is_letter | before)  # each word and one edge after it
    seq = low[keep].astype(U64)
    first = np.flatnonzero(is_letter & ~before)
    c1 = np.concatenate([[0], seq[:-1]]).astype(U64)
    c2 = np.where(c1 == 0, U64(0), np.concatenate([[0, 0], seq[:-2]])[:len(seq)].astype(U64))
    cells = np.empty((len(seq), 2), np.int64)
    cells[:, 0] = mix(seq | (c1 << U64(21))) & U64(BUCKETS - 1)
    cells[:, 1] = mix(seq | (c1 << U64(21)) | (c2 << U64(42)) | U64(1 << 63)) & U64(BUCKETS - 1)
    word_cell = np.searchsorted(keep, first)
    cell_at = np.append(word_cell, len(seq))
    return Words(np.searchsorted(first, text_at), np.diff(cell_at) - 1, scripts[code[first]], cells, cell_at)


def text_chunks(column) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) in chunks of bounded size."""
    _, at = text_bytes(column)
    i, n = 0, len(at) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + CHUNK_CHARS, "right")) - 1)
        yield i, [t or "" for t in column.slice(i, j - i).to_pylist()]
        i = j


@dataclass
class Model:
    """Languages by code point, log likelihood of each cell, and which scripts
    each language uses."""

    names: list[str]
    logp: np.ndarray
    scripts: np.ndarray

    def scores(self, w: Words) -> np.ndarray:
        """(words, languages)."""
        out = np.empty((len(w.letters), len(self.names)), np.float32)
        for k in range(len(self.names)):
            total = np.concatenate([[0.0], np.cumsum(self.logp[k][w.cells[:, 0]] + self.logp[k][w.cells[:, 1]])])
            out[:, k] = total[w.cell_at[1:]] - total[w.cell_at[:-1]]
        fits = self.scripts[:, w.script].T
        fits[~fits.any(1)] = True
        out -= out.max(1, keepdims=True) if len(out) else 0
        out[~fits] = -1e4
        return out


def _steps(size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pieces by size, longest first, and how many have a word at each step."""
    order = np.argsort(-size, kind="stable")
    steps = int(size[order[0]]) if len(size) else 0
    return order, np.searchsorted(-size[order], -np.arange(steps), "left")


def _forward(emit: np.ndarray, start: np.ndarray, size: np.ndarray, entry: np.ndarray, penalty: float,
             moved: np.ndarray | None = None, source: np.ndarray | None = None) -> np.ndarray:
    """Best score of each language after the last word of pieces entered with
    ``entry``; notes where a word's best way comes from another language."""
    order, active = _steps(size)
    start, score = start[order], entry[order]
    for t, k in enumerate(active):
        at_t, s = start[:k] + t, score[:k]
        best = s.argmax(1)
        switched = s[np.arange(k), best] - penalty
        if moved is not None:
            moved[at_t] = switched[:, None] > s
            source[at_t] = best
        np.maximum(s, switched[:, None], out=s)
        s += emit[at_t]
    out = np.empty_like(score)
    out[order] = score
    return out


def _backward(start: np.ndarray, size: np.ndarray, last: np.ndarray, moved: np.ndarray, source: np.ndarray,
              path: np.ndarray | None = None) -> np.ndarray:
    """Language before the first word of pieces that end in ``last``."""
    order, active = _steps(size)
    start, state = start[order], last[order]
    for t in range(len(active) - 1, -1, -1):
        k = active[t]
        at_t = start[:k] + t
        if path is not None:
            path[at_t] = state[:k]
        state[:k] = np.where(moved[at_t, state[:k]], source[at_t], state[:k])
    out = np.empty_like(state)
    out[order] = state
    return out


def viterbi(emit: np.ndarray, at: np.ndarray, penalty: float = SWITCH, segment: int = SEGMENT) -> np.ndarray:
    """Best language of every word: all texts at once, one position a step.

    A text of more than ``segment`` words is cut into pieces that step side by
    side.  The scores that enter a piece are the max-plus product of those
    that enter the one before with that piece's matrix (its best score from
    each language to each), so path and ties are those of the uncut text."""
    size, langs = np.diff(at), emit.shape[1]
    pieces = np.maximum(-(-size // segment), 1)
    text = np.repeat(np.arange(len(size)), pieces)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    start = at[:-1][text] + nth * segment
    size = np.minimum(at[1:][text] - start, segment)
    left = np.flatnonzero(nth + 1 < pieces[text])  # pieces that another one follows
    entry = np.zeros((len(text), langs))
    if len(left):
        from_each = np.tile(np.where(np.eye(langs, dtype=bool), 0.0, -np.inf), (len(left), 1))
        through = _forward(emit, np.repeat(start[left], langs), np.repeat(size[left], langs), from_each, penalty)
        for k, matrix in zip(left, through.reshape(len(left), langs, langs)):
            entry[k + 1] = (entry[k][:, None] + matrix).max(0)
    moved, source = np.zeros(emit.shape, bool), np.zeros(len(emit), np.int16)
    last = _forward(emit, start, size, entry, penalty, moved, source).argmax(1).astype(np.int16)
    if len(left):
        ends = np.tile(np.arange(langs, dtype=np.int16), len(left))
        before = _backward(np.repeat(start[left + 1], langs), np.repeat(size[left + 1], langs), ends, moved, source)
        for k, back in zip(left[::-1], before.reshape(len(left), langs)[::-1]):
            last[k] = back[last[k + 1]]
    path = np.zeros(len(emit), np.int16)
    _backward(start, size, last, moved, source, path)
    return path


def _labelled(path: np.ndarray, w_at: np.ndarray, letters: np.ndarray, names: list[str]) -> tuple[list, list, list]:
    """Language, share and spans (language, first word, words) per text."""
    langs, shares, spans = [], [], []
    for i in range(len(w_at) - 1):
        a, b = w_at[i], w_at[i + 1]
        if a == b or not names:
            langs.append(UNDETERMINED), shares.append(0.0), spans.append([])
            continue
        run = path[a:b]
        mass = np.bincount(run, letters[a:b], len(names))
        k = int(mass.argmax())
        cut = np.concatenate([[0], np.flatnonzero(np.diff(run)) + 1, [b - a]])
        langs.append(names[k]), shares.append(float(mass[k] / mass.sum()))
        spans.append([{"lang": names[run[x]], "first": int(x), "words": int(y - x)} for x, y in zip(cut[:-1], cut[1:])])
    return langs, shares, spans


def train(docs: DataFrame, usable: Column | None = None, max_docs: int = MAX_DOCS) -> Model:
    """Counts of ``docs`` (doc_id, lang, text) by language."""
    known = docs.select("doc_id", F.col("lang").cast("string").alias("lang")).where("doc_id IS NOT NULL AND lang IS NOT NULL")
    if usable is not None:
        known = known.where(usable)
    # one row per language; each keeps the ids whose hash is below max_docs / its documents
    share = known.groupBy("lang").agg((F.lit(float(max_docs)) / F.count("*")).alias("share"))
    share = materialize(share, "languages")
    text = docs.select("doc_id", F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    if usable is not None:
        text = text.where(usable)
    place = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1 << 30)) / float(1 << 30)
    chosen = text.where("doc_id IS NOT NULL").join(share, "lang").where(place < F.col("share")).select("lang", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), object)
            for lang in sorted(set(langs)):
                count, script = np.zeros(BUCKETS, np.int64), np.zeros(len(SCRIPTS) + 1, np.int64)
                for _, texts in text_chunks(batch.column(1).filter(pa.array(langs == lang))):
                    w = split_words(texts)
                    count += np.bincount(w.cells.ravel(), minlength=BUCKETS)
                    script += np.bincount(w.script, w.letters, len(script)).astype(np.int64)
                cell = np.concatenate([np.flatnonzero(count), -1 - np.flatnonzero(script)])
                n = np.concatenate([count[count > 0], script[script > 0]])
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(n), pa.string()), pa.array(cell), pa.array(n)],
                                                 names=["lang", "cell", "n"])

    # at most (BUCKETS + scripts) rows a language
    rows = map_arrow(chosen, run, "lang string, cell long, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n")).toArrow()
    names = sorted(r for r in set(rows.column("lang").to_pylist()))
    of = np.array([names.index(x) for x in rows.column("lang").to_pylist()], np.int64)
    cell, n = rows.column("cell").to_numpy().astype(np.int64), rows.column("n").to_numpy()
    counts, scripts = np.zeros((len(names), BUCKETS)), np.zeros((len(names), len(SCRIPTS) + 1))
    counts[of[cell >= 0], cell[cell >= 0]] = n[cell >= 0]
    scripts[of[cell < 0], -1 - cell[cell < 0]] = n[cell < 0]
    logp = np.log((counts + 0.5) / (counts.sum(1, keepdims=True) + 0.5 * BUCKETS))
    return Model(names, logp, scripts > MIN_SCRIPT * np.maximum(scripts.sum(1, keepdims=True), 1))


def with_language(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` as struct ``row``, with ``lang_pred``, ``score``, ``spans``."""
    rows = packed(docs)
    span = StructType([StructField("lang", StringType()), StructField("first", IntegerType()), StructField("words", IntegerType())])
    schema = StructType([rows.schema["row"], StructField("lang_pred", StringType()), StructField("score", DoubleType()),
                         StructField("spans", ArrayType(span))])
    arrow_span = pa.list_(pa.struct([("lang", pa.string()), ("first", pa.int32()), ("words", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, done = batch.column(0), 0
            waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

            def flush(upto: int):
                nonlocal done, waiting
                shift = np.cumsum([0] + [len(e) for e, _, _ in waiting])
                at = np.concatenate([[0]] + [a[1:] + s for (_, a, _), s in zip(waiting, shift)])
                emit = np.concatenate([e for e, _, _ in waiting])
                path = viterbi(emit, at) if model.names else np.zeros(len(emit), np.int16)
                langs, shares, spans = _labelled(path, at, np.concatenate([x for _, _, x in waiting]), model.names)
                out = pa.RecordBatch.from_arrays([row.slice(done, upto - done), pa.array(langs, pa.string()),
                                                  pa.array(shares, pa.float64()), pa.array(spans, arrow_span)],
                                                 names=["row", "lang_pred", "score", "spans"])
                done, waiting = upto, []
                return out

            text = row.field(row.type.get_field_index(text_col))
            for i, texts in text_chunks(text):
                w = split_words(texts)
                waiting.append((model.scores(w) if model.names else np.zeros((len(w.letters), 0), np.float32), w.at, w.letters))
                if sum(len(e) for e, _, _ in waiting) >= VITERBI_WORDS:
                    yield flush(i + len(texts))
            if waiting:
                yield flush(len(row))

    return map_arrow(rows, run, schema)


def predict(docs: DataFrame) -> DataFrame:
    """doc_id, held_out (a quarter of the ids, never learned from), lang_pred,
    score, n_spans."""
    model = train(docs.select("doc_id", "lang", "text"), fold(4) != 2)
    out = with_language(docs.select("doc_id", "text"), model)
    return out.select("row.doc_id", "lang_pred", "score", F.size("spans").alias("n_spans")).select(
        "doc_id", (fold(4) == 2).alias("held_out"), "lang_pred", "score", "n_spans")
