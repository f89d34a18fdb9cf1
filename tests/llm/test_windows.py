"""Windows of decontamination: running fingerprints and minima, selective
candidates, long items, repeated shingles, recall on the given tables."""

import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from churnspark.llm import decontaminate as D
from test_operators import AZ, prose, words


def similarity(w, iw):
    k, m = min(5, len(iw)), min(len(iw), len(w))
    grams = lambda x: Counter(tuple(x[i:i + k]) for i in range(len(x) - k + 1))
    a, best = grams(iw), 0.0
    for s in range(len(w) - m + 1):
        b = grams(w[s:s + m])
        best = max(best, (a & b).total() / max(1, (a | b).total()))
    return best if m >= k else 0.0


def test_running_values_equal_those_of_each_window():
    rng = np.random.default_rng(3)
    g = rng.integers(0, 1 << 63, 9000, dtype=np.uint64)
    g[100:200] = g[50]
    for width, starts in ((1, [0, 5, 8999]), (37, [0, 1, 2, 90, 5000, 8963]), (4500, [0, 3, 4200, 4500]), (9000, [0])):
        at = np.array(starts)
        assert D.running_simhash(g, at, width).tolist() == [D.simhash(g[s:s + width]) for s in starts]
        low = D.minima(g, at, width)
        for k, order in enumerate(D._ORDERS):
            assert low[:, k].tolist() == [D.mix(D.mix(g[s:s + width] ^ order).min(keepdims=True) ^ order).view(np.int64)[0] for s in starts]


def test_best_window_equals_plain_counting():
    rng = random.Random(8)
    for _ in range(40):
        doc, item = ([rng.randrange(9) for _ in range(n)] for n in (rng.randrange(12, 80), 12))
        starts = sorted(rng.sample(range(len(doc) - 11), rng.randrange(1, len(doc) - 10)))
        values = []
        for s in starts:
            a, b = Counter(doc[s:s + 12]), Counter(item)
            values.append(((a & b).total(), (a | b).total(), s))
        best = max(values, key=lambda v: (v[0] / v[1], -v[2]))
        got = D.best_window(np.array(doc), np.array(item), np.array(starts), 12)
        assert got == best or (got[0] == best[0] == 0)


def test_blocks_and_minima_select(spark):
    """400 items and 400 unrelated windows of one size: few meet."""
    rng = random.Random(5)
    items = D.items_table(spark.createDataFrame([(i, prose(rng, 40)) for i in range(400)], "item_id long, text string"))
    other = D.items_table(spark.createDataFrame([(i, prose(rng, 40)) for i in range(400)], "item_id long, text string"))
    found = other.select(F.col("item_id").alias("doc_id"), F.lit(0).cast("long").alias("text_hash"), "size", F.lit(0).cast("long").alias("start"),
                         "fp", "minima")
    probes, listed = D.listings(found, items)
    assert probes.join(listed, ["size", "low", "block", "value"]).count() <= 400 * 400 // 100
    again = items.select(F.col("item_id").alias("doc_id"), F.lit(0).cast("long").alias("text_hash"), "size", F.lit(0).cast("long").alias("start"),
                         "fp", "minima")
    assert {(r.doc_id, r.item_id) for r in D.candidates(again, items).collect()} >= {(i, i) for i in range(400)}


def test_items_of_five_thousand_words_and_of_repeated_phrases(spark):
    rng = random.Random(12)
    long_ = prose(rng, 5000).split()
    changed = list(long_)
    for i in rng.sample(range(5000), 150):
        changed[i] = "other"
    song = "la la la la la la la la la la the end of the song is near now"
    items = [(0, " ".join(long_)), (1, song), (2, "one phrase again " * 40)]
    texts = [prose(rng, 3000) + " " + " ".join(changed) + " " + prose(rng, 500), f"x {song.upper()} y", "so " + "one phrase again " * 60,
             "la la la la la la la la la la and then nothing of the kind", prose(rng, 6000), " ".join(long_[:4200])]
    df = spark.createDataFrame(list(enumerate(texts)) + [(None, texts[1]), (1, texts[1])], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = sorted(((r.doc_id, r.items, round(r.similarity or 0, 9)) for r in D.decontaminate(df, bench).collect()), key=str)
    value = {(d, i): similarity(words(t.translate(AZ)), words(x.translate(AZ)))
             for d, t in enumerate(texts) for i, x in items if (d, i) in ((1, 1), (2, 2), (3, 1), (5, 0))}
    assert value[1, 1] == value[2, 2] == 1 and value[3, 1] < 0.8 <= value[5, 0]
    a, b = (Counter(tuple(w[i:i + 5]) for i in range(4996)) for w in (long_, changed))
    value[0, 0] = (a & b).total() / (a | b).total()
    hit = {0: 0 if value[0, 0] >= 0.8 else None, 1: 1, 2: 2, 5: 0}
    hit = {d: i for d, i in hit.items() if i is not None}
    want = [(d, [hit[d]] if d in hit else [], round(value[d, hit[d]], 9) if d in hit else 0)
            for d in range(len(texts))] + [(None, [1], 1.0), (1, [1], 1.0)]
    assert got == sorted(want, key=str)


def test_recall_on_the_given_tables(spark):
    """Ids divisible by 100 against all items, by exact similarity."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("doc_id % 100 = 0")
    bench = spark.read.parquet("/root/testdata/sf0.1/benchmark.parquet")
    items = [(r.item_id, words((r.text or "").translate(AZ))) for r in bench.collect()]
    got = {(r.doc_id, i) for r in D.decontaminate(docs, bench).collect() for i in r.items}
    want = set()
    for r in docs.collect():
        w = words((r.text or "").translate(AZ))
        have = {tuple(w[i:i + 5]) for i in range(len(w) - 4)}
        for i, iw in items:
            if len(iw) >= 5 and 10 * len({tuple(iw[j:j + 5]) for j in range(len(iw) - 4)} & have) >= 4 * (len(iw) - 4):
                if similarity(w, iw) >= 0.8:
                    want.add((r.doc_id, i))
    assert {p for p in got if len(dict(items)[p[1]]) >= 5} == want
