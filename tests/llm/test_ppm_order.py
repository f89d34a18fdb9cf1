"""Order 5 of the n-gram tables: against plain loops, and better than the base."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnspark.llm import ppm

DATA = "/root/testdata/sf0.1"


def plain_score(learn: list[bytes], text: bytes) -> float:
    """PPM by dictionaries: half a count a seen byte for the escape, shorter
    contexts count the longer n-grams that end in theirs, exclusion of the bytes
    of the context escaped from."""
    edge = bytes([ppm.EDGE])
    ends = lambda t: [(edge * ppm.ORDER + t + edge)[i:i + ppm.ORDER + 1] for i in range(len(t) + 1)]
    counts = {ppm.ORDER: Counter(g for t in learn for g in ends(t.lower()))}
    for order in range(ppm.ORDER - 1, -1, -1):
        counts[order] = Counter(g[1:] for g in counts[order + 1])
    total = 0.0
    for gram in ends(text.lower()):
        excluded: set[int] = set()
        for order in range(ppm.ORDER, -1, -1):
            own = gram[ppm.ORDER - order:]
            seen = {g[-1]: n for g, n in counts[order].items() if g[:-1] == own[:-1]}
            left = {b: n for b, n in seen.items() if b not in excluded}
            if own[-1] in left:
                total += math.log10((left[own[-1]] - 0.5) / sum(left.values()))
                break
            if left:
                total += math.log10(0.5 * len(left) / sum(left.values()))
            excluded = set(seen)
        else:
            total -= math.log10(256 - len(excluded))
    return total


@pytest.mark.parametrize("max_nodes", [0, 30, 10_000])
def test_scores_equal_plain_loops(spark, max_nodes):
    texts = ["the cat sat on the mat", "The cat the cat", "a dog sat on a log", "", None, "äöü the mat", "zzzzzz zz", "the the the dog",
             "cat on a hot roof", "THE MAT", "sat sat sat", "one cat two cats"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, "the log"), (None, "null id"), (1, "The cat the cat")]
    learn = [(t or "").encode() for i, t in rows if i is None or zlib.crc32(str(i).encode()) % 7 != 2]
    got = ppm.score(spark.createDataFrame(rows, "doc_id long, text string"), max_nodes=max_nodes).collect()
    want = sorted((str(i), round(plain_score(learn, (t or "").encode()), 6)) for i, t in rows)
    assert [i for i, _ in want] == sorted(str(r.doc_id) for r in got)
    assert np.allclose([s for _, s in want], [s for _, s in sorted((str(r.doc_id), round(r.score, 6)) for r in got)], rtol=0, atol=2e-6)


def test_most_used_keeps_whole_classes(spark):
    grams = spark.range(1, 200).select(F.col("id").alias("key"), F.floor(F.lit(200) / F.col("id")).alias("uses"))
    for at_most in (0, 1, 3, 50, 1000):
        kept = {r.key: r.uses for r in ppm.most_used(grams, at_most).collect()}
        assert len(kept) <= at_most and set(kept) == set(range(1, len(kept) + 1))
    assert ppm.most_used(grams.limit(0), 10).count() == 0


def test_held_out_texts_score_above_the_base(spark):
    """Code length of the held-out seventh of a larger table against its unigram."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    base, score, better = ppm.score(docs).where("held_out").agg(
        F.sum("base_score"), F.sum("score"), F.avg((F.col("score") > F.col("base_score")).cast("double"))).first()
    assert score > 0.98 * base and better > 0.75
