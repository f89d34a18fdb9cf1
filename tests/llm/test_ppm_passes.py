"""The numpy passes of the n-gram model: same counts as plain loops, one look-up a distinct n-gram."""

import time
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from churnspark.llm import ppm, tokens

DATA = "/root/testdata/sf0.1"


def test_pairs_and_sums_equal_plain_loops():
    texts = [b"The cat the CAT", b"", b"cat", b"zzzzzzzzz zz", b"the cat the cat", b" ", "äöü the".encode()]
    data, at = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0] + [len(t) for t in texts])
    for pairs, whole in ((ppm.gram_pairs, ppm.byte_grams), (ppm.word_pairs, tokens.word_hashes)):
        flat, ends = whole(data, at)
        want = [Counter(flat[a:b].tolist()) for a, b in zip(ends, ends[1:])]
        keys, ids, text, times = pairs(data, at)
        assert (np.diff(keys.astype(object)) > 0).all() and set(keys.tolist()) == set(flat.tolist())
        assert sorted(zip(keys[ids].tolist(), text.tolist(), times.tolist())) == sorted(
            (k, t, n) for t, c in enumerate(want) for k, n in c.items())
        for hot in (keys[:0], keys[::2], keys):
            value = np.arange(len(hot)) + 0.5
            worth = dict(zip(hot.tolist(), value))
            known, total, rest, rest_times = ppm.sums_and_rest(keys, ids, text, times, len(texts), hot, value)
            assert known.tolist() == [sum(n for k, n in c.items() if k in worth) for c in want]
            assert np.allclose(total, [sum(n * worth.get(k, 0) for k, n in c.items()) for c in want])
            left = [{int(np.uint64(k)): n for k, n in zip(np.array(ks, np.int64).view(np.uint64), ns)}
                    for ks, ns in zip(rest.to_pylist(), rest_times.to_pylist())]
            assert left == [{k: n for k, n in c.items() if k not in worth} for c in want]


def test_a_distinct_gram_of_a_chunk_is_looked_up_once():
    """Less than half the CPU time of one look-up a byte in a table of the size that travels."""
    column = pq.read_table(f"{DATA}/documents.parquet", columns=["text"])["text"].slice(0, 800)
    _, _, data, at = next(tokens.chunks(column))
    grams, _ = ppm.byte_grams(data, at)
    rng = np.random.default_rng(1)
    hot = np.unique(np.concatenate([grams, rng.integers(0, 1 << 48, ppm.MAX_NODES, dtype=np.uint64)]))
    value = np.full(len(hot), -1.0)

    def least(f) -> float:
        took = []
        for _ in range(5):
            began = time.process_time()
            f()
            took.append(time.process_time() - began)
        return min(took)

    looked_up = least(lambda: np.searchsorted(hot, grams))
    assert least(lambda: ppm.sums_and_rest(*ppm.gram_pairs(data, at), len(at) - 1, hot, value)) < 0.5 * looked_up


def test_equal_texts_have_equal_scores_wherever_they_stand(spark):
    text = "the quick brown fox jumps over the lazy dog and runs"
    rows = [(i, text if i % 3 == 0 else f"filler {i * i} of some kind {i}" * (i % 5 + 1)) for i in range(300)]
    scored = ppm.score(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).where("doc_id % 3 = 0")
    assert scored.select("base_score", "score").distinct().count() == 1


def test_more_texts_in_a_batch_than_numbers_beside_a_gram(spark):
    n = (1 << ppm.TEXT_BITS) + 4_000
    was = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(2 * n))
    try:
        docs = spark.range(0, n, 1, 1).select(F.col("id").alias("doc_id"), F.concat(F.lit("w"), F.col("id") % 3).alias("text"))
        got = ppm.score(docs).groupBy(F.col("doc_id") % 3).agg(
            F.count("*").alias("n"), F.min("n_tokens").alias("a"), F.max("n_tokens").alias("b"), F.min("n_known").alias("k"),
            F.min("score").alias("least"), F.max("score").alias("most")).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", was)
    assert sum(r.n for r in got) == n and len(got) == 3
    assert all(r.a == r.b == r.k == 2 and r.least == r.most for r in got)


def test_counts_are_merged_as_they_come(monkeypatch):
    """What waits is bounded by the distinct keys, not by the texts of a batch."""
    monkeypatch.setattr(ppm, "MERGE_AT", 10)
    rng, want, counts = np.random.default_rng(2), Counter(), ppm.Counts()
    assert [len(x) for x in counts.merged()] == [0, 0]
    for size in rng.integers(0, 40, 60):
        keys, n = np.unique(rng.integers(0, 50, size).astype(np.uint64), return_counts=True)
        counts.add(keys, n)
        want.update(dict(zip(keys.tolist(), n.tolist())))
        assert sum(len(k) for k, _ in counts.parts) <= 3 * 50 + 10
    keys, n = counts.merged()
    assert (np.diff(keys.astype(int)) > 0).all() and dict(zip(keys.tolist(), n.tolist())) == want
