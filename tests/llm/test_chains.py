"""Classifier chain against a plain one; paths of cut texts against uncut."""

import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnspark.llm import language_id, toxicity


def plain_fit(x, z, y, steps=300, rate=0.1, ridge=1e-4):
    """Weights of dense columns, the earlier categories and the bias."""
    x = np.hstack([x, z])
    w, bias = np.zeros(x.shape[1]), np.log((y.sum() + 1) / ((1 - y).sum() + 1))
    if len(set(y)) < 2:
        return w, bias
    w = np.append(w, bias)
    x1 = np.hstack([x, np.ones((len(x), 1))])
    mean, square = np.zeros(len(w)), np.zeros(len(w))
    for t in range(1, steps + 1):
        g = x1.T @ (1 / (1 + np.exp(-x1 @ w)) - y) / len(y)
        g[:-1] += ridge * w[:-1]
        mean, square = 0.9 * mean + 0.1 * g, 0.999 * square + 0.001 * g * g
        w = w - rate * (mean / (1 - 0.9 ** t)) / (np.sqrt(square / (1 - 0.999 ** t)) + 1e-8)
    return w[:-1], w[-1]


def plain_inputs(text):
    runs = re.findall(r"[0-9A-Za-z\x80-￿]+|[^0-9A-Za-z\x80-￿ \t-\r]+", (text or "").lower())
    return {(None, r) for r in runs} | {(k, r[:k]) for r in runs for k in toxicity.PREFIXES}


def logit(p):
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def test_chain_equals_a_plain_one(spark):
    rng = np.random.default_rng(5)
    names = ["fine", "good words", "idiot!!", "trash?", "Idiotic", "plain text", "buy now", "$$$ win", "moderate", "river"]
    texts = {i: " ".join(rng.choice(names, 6)) for i in range(90)} | {90: None, 91: "", 92: "unknown " * 2000}
    marks = {i: (int("buy" not in texts[i]), int("diot" in texts[i])) for i in range(70)}
    docs = spark.createDataFrame([(i, t, "extra") for i, t in texts.items()] + [(3, texts[4], "repeated id")],
                                 "doc_id long, text string, p string")
    docs_once = docs.where("p = 'extra'")
    labels = spark.createDataFrame([(i, *m) for i, m in marks.items()], "doc_id long, quality int, toxic int")
    folds = {r.doc_id: r.f for r in docs_once.select(
        "doc_id", F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(toxicity.FOLDS)).alias("f")).collect()}

    y = {i: (int(q == 0), t, int(q == 0 and t == 1)) for i, (q, t) in marks.items()}
    ids, inputs = sorted(marks), {i: plain_inputs(t) for i, t in texts.items()}
    n, chosen = len(ids), set()
    for word in set().union(*(inputs[i] for i in ids)):
        have = [i for i in ids if word in inputs[i]]
        if len(have) >= toxicity.MIN_DOCS and any(
                sum(y[i][c] for i in have) * n > len(have) * sum(v[c] for v in y.values()) for c in range(3)):
            chosen.add(word)
    chosen = sorted(chosen, key=str)
    dense = lambda who: np.array([[float(w in inputs[i]) for w in chosen] for i in who])
    x, everyone = dense(ids), sorted(texts)
    all_x, fold = dense(everyone), np.array([folds[i] for i in ids])
    unseen, scored = np.zeros((n, 0)), np.zeros((len(everyone), 0))
    probability = lambda x, p, w, b: 1 / (1 + np.exp(-(np.hstack([x, logit(p)]) @ w + b)))
    for c in range(3):
        target = np.array([float(y[i][c]) for i in ids])
        column = np.zeros(n)
        for f in range(toxicity.FOLDS):
            held = fold == f
            column[held] = probability(x[held], unseen[held], *plain_fit(x[~held], logit(unseen[~held]), target[~held]))
        scored = np.column_stack([scored, probability(all_x, scored, *plain_fit(x, logit(unseen), target))])
        unseen = np.column_stack([unseen, column])

    assert len(chosen) > 10
    got = {r.doc_id: (r.p_junk, r.p_toxic, r.p_toxic_junk) for r in toxicity.predict(docs_once, labels).collect()}
    assert sorted(got) == everyone
    np.testing.assert_allclose([got[i] for i in everyone], scored, atol=1e-6)
    # a repeated id with another text is scored by its own text
    assert toxicity.predict(docs, labels).count() == len(texts) + 1


@pytest.mark.parametrize("segment", [1, 2, 3, 7, 50])
def test_cut_texts_have_the_path_of_uncut_ones(segment):
    rng = np.random.default_rng(segment)
    at = np.cumsum([0, 40, 0, 1, 3, 7, 100, 0, 14])
    for langs in (1, 2, 4):
        for penalty in (0.0, 1.0, 3.0):  # whole numbers: many ties
            emit = -rng.integers(0, 4, (at[-1], langs)).astype(np.float32)
            whole = language_id.viterbi(emit, at, penalty, segment=1000)
            np.testing.assert_array_equal(language_id.viterbi(emit, at, penalty, segment), whole)


def test_a_text_of_a_million_words():
    rng = np.random.default_rng(1)
    emit = -rng.random((1_000_000, 4)).astype(np.float32)
    emit[np.arange(len(emit)), np.arange(len(emit)) // 2500 % 4] += 2  # a run of 2,500 words each
    begin = time.perf_counter()
    path = language_id.viterbi(emit, np.array([0, len(emit)]))
    assert time.perf_counter() - begin < 20
    assert (path == np.arange(len(emit)) // 2500 % 4).mean() > 0.99
