"""Text operators against brute force on small tables with nulls, empty and
long texts, ties, repeated rows and clashing extra columns."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnspark.llm import (components, decontaminate, gbdt, language_id, line_dedup, mixing, near_dedup, ppm,
                            quality_classifier, quality_rules, tokens, toxicity, url_filter)

DOCS = "doc_id long, text string, lang string, source string, n_chars int, size int, h1 string, row string, `block` int"
AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(7)
    texts = [prose(rng, rng.randrange(20, 90)) for _ in range(40)]
    base = prose(rng, 80).split()
    for k in range(12):  # near copies of one text
        copy = list(base)
        for i in rng.sample(range(80), k % 4):
            copy[i] = f"edit{k}x{i}"
        texts.append(" ".join(copy))
    shared = "This line stands in many documents, word for word."
    texts += [f"{prose(rng, 30)}\n{shared}\n{prose(rng, 25)}" for _ in range(6)]
    texts += [f"own {k}\n  THIS line stands in many documents, word for word.\t\nend {k}" for k in range(4)]
    texts += [texts[0], texts[0].upper(), None, "", " \t\n", "one two", "two words\n\n", "é È 日本 word x\u0085y", prose(rng, 3000)]
    out = [(i, t, ("en", "fr", None)[i % 3], (None, "a", "b", "é", "B")[i % 5], 0, 1, "x", "y", 3) for i, t in enumerate(texts)]
    return out + [out[5], (None, texts[1], None, None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def labels(spark, rows):
    marks = [(r[0], int(r[0] % 7 != 0), int(r[0] % 5 == 0)) for r in rows if r[0] is not None]
    return spark.createDataFrame(marks + [(None, 0, 1), (1, None, None)], "doc_id long, quality int, toxic int")


def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")


# -- op 1 -------------------------------------------------------------------
def counts(text):
    w, ls = words(text), [x for x in (text or "").split("\n") if words(x)]
    windows = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    hit = {i + j for i in range(len(w) - 7) if windows[tuple(w[i:i + 8])] > 1 for j in range(8)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(ls) - len(set(ls)), len(hit))


def test_rule_statistics_match_brute_force(spark):
    rng = random.Random(3)
    texts = [None, "", " ", "a b", "x # y|z <b>\nq\nq\n \n \n", "é 日 " * 9, "\n".join(["same line"] * 5)]
    texts += [" ".join(rng.choice("abc") for _ in range(rng.randrange(1, 60))) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r[0]: tuple(r[1:]) for r in quality_rules.statistics(df).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect()}
    assert got == {i: counts(t) for i, t in enumerate(texts)}


def test_rules_learn_a_threshold_and_survive_no_labels(spark, docs, empty):
    rng = random.Random(1)
    made = [(i, prose(rng, 40) + (" #&|" * 20 if i % 4 == 0 else "")) for i in range(120)]
    df = spark.createDataFrame(made, "doc_id long, text string")
    marks = spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(120)], "doc_id long, quality int, toxic int")
    out = quality_rules.quality_rules(df, marks).collect()
    assert all(r.kept == (r.doc_id % 4 > 0) for r in out) and len(out) == 120
    plain = quality_rules.quality_rules(docs, no_labels(spark)).collect()
    assert len(plain) == docs.count() and all(r.kept != r.base_failed for r in plain)
    assert quality_rules.quality_rules(empty, no_labels(spark)).count() == 0


# -- op 2, 4, 8 -------------------------------------------------------------
def test_toxicity_chain_on_held_out(spark, docs, empty):
    rng = random.Random(5)
    made = [(i, prose(rng, 40) + (" you IDIOT!" if i % 5 == 0 else "")) for i in range(300)]
    df = spark.createDataFrame(made, "doc_id long, text string")
    marks = spark.createDataFrame([(i, 1, int(i % 5 == 0)) for i in range(300)], "doc_id long, quality int, toxic int")
    out = toxicity.predict(df, marks, usable=F.col("doc_id") % 3 != 0).collect()
    assert all(r.toxic == (r.doc_id % 5 == 0) and r.kept != r.toxic for r in out)
    plain = toxicity.predict(docs, no_labels(spark)).collect()
    assert len(plain) == docs.count() and all(0 <= r.p_toxic <= 1 for r in plain)
    assert toxicity.predict(empty, marks).count() == 0


def test_trees_match_a_walk_and_learn():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(800, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 2] > 0.5)).astype(float)
    t = gbdt.fit(x[:600], y[:600], n_trees=30)
    p = t.probability(x)
    assert ((p[600:] > 0.5) == y[600:]).mean() > 0.9

    def walk(v):
        s = t.base
        for f, c, leaf in zip(t.feature, t.threshold, t.leaf):
            at = 0
            while at < len(f):
                at = 2 * at + (2 if v[f[at]] > c[at] else 1)
            s += leaf[at - len(f)]
        return 1 / (1 + math.exp(-s))
    assert np.allclose(p[:50], [walk(v) for v in x[:50]])


def test_quality_scores(spark, docs, empty, labels):
    out = quality_classifier.predict(docs, labels).collect()
    assert len(out) == docs.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in out)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out)
    assert {r.score for r in quality_classifier.predict(docs, no_labels(spark)).collect()} == {0.5}
    assert quality_classifier.predict(empty, labels).count() == 0


def test_languages_and_spans(spark, docs, empty):
    rng = random.Random(4)
    vocab = {"en": ["the", "house", "water", "with", "which"], "fr": ["être", "maison", "avec", "où", "eau"],
             "el": ["σπίτι", "νερό", "και", "είναι", "μαζί"]}
    say = lambda l, n: " ".join(rng.choice(vocab[l]) for _ in range(n))  # noqa: E731, E741
    made = [(i, say(l, 30), l) for i, l in enumerate(["en", "fr", "el"] * 60)]
    made += [(500, say("en", 40) + " " + say("fr", 20), None), (501, "123 !", "en"), (502, None, "fr"), (503, "και", None)]
    df = spark.createDataFrame(made, "doc_id long, text string, lang string")
    out = {r.doc_id: r for r in language_id.predict(df).collect()}
    assert all(out[i].lang_pred == l and out[i].n_spans == 1 for i, _, l in made[:180])
    assert (out[500].lang_pred, out[500].n_spans) == ("en", 2) and 0.5 < out[500].score < 0.9
    assert out[501].lang_pred == out[502].lang_pred == "und" and out[503].lang_pred == "el"
    assert language_id.predict(docs).count() == docs.count() and language_id.predict(empty).count() == 0


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(1)
    emit, at = rng.normal(size=(15, 2)).astype(np.float32), np.array([0, 6, 6, 7, 15])
    got = language_id.viterbi(emit, at, penalty=1.0)
    for a, b in zip(at[:-1], at[1:]):
        def value(path, a=a):
            return sum(emit[a + i, s] for i, s in enumerate(path)) - sum(x != y for x, y in zip(path, path[1:]))
        best = max(value([(m >> i) & 1 for i in range(b - a)]) for m in range(1 << (b - a)))
        assert abs(value(list(got[a:b])) - best) < 1e-4


# -- op 3 -------------------------------------------------------------------
def test_mix_meets_targets(spark, docs, rows, empty):
    out = mixing.mix(docs).collect()
    assert len(out) == len(rows)
    sizes, weights = Counter(), {}
    for r in rows:
        sizes[r[3]] += len(words(r[1]))
    for k, s in enumerate(sorted(sizes, key=lambda s: (s is None, (s or "").encode()))):
        weights[s] = (5, 2, 1)[k % 3]
    target, left = {}, 1.5 * sum(sizes.values())
    open_ = set(sizes)
    while True:  # reshare until no source is above its cap
        level = left / sum(weights[s] for s in open_)
        over = {s for s in open_ if level * weights[s] > 2 * sizes[s]}
        if not over:
            break
        for s in over:
            target[s] = 2.0 * sizes[s]
        left -= sum(target[s] for s in over)
        open_ -= over
    target |= {s: level * weights[s] for s in open_}
    taken = Counter()
    for r in out:
        assert r.taken <= 2 * r.size and r.source_size == sizes[r.source] and abs(r.target - target[r.source]) < 1e-6
        taken[r.source] += r.taken
    assert all(taken[s] == math.floor(target[s] + 1e-9) for s in sizes)
    assert sorted(map(str, mixing.mix(docs.repartition(5)).collect())) == sorted(map(str, out))
    assert mixing.mix(empty).count() == 0


def test_mix_gives_tiny_sources_their_quota(spark):
    rows = [(i, f"w{i}", f"tiny{i}") for i in range(300)] + [(1000 + i, "word " * 50, "large") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.mix(df, block_words=1).groupBy("source").agg(F.first("target").alias("target"), F.sum("taken").alias("taken")).collect()
    assert len(out) == 301 and all(r.taken == math.floor(r.target + 1e-9) for r in out)


# -- op 5 -------------------------------------------------------------------
def test_urls(spark):
    urls = ["http://A.Example.org/es/1?x", "https://www.org/y", "http://x.com/fr/2.html", "ftp://x.com/de/#a", None, "no scheme",
            "http://spam-farm.net/en/9/", "http://www.spam-farm.net/en/9?utm=1", "http://ok.net", "//x", "http://org", "http://"]
    pages = spark.createDataFrame([(i, u, "") for i, u in enumerate(urls)], "page_id long, url string, html string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(pages, url_filter.blocked_list(pages)).collect()}
    assert got[0] == ("a.example.org", "/es/1", "example.org/es/", "block") and got[1] == ("www.org", "/y", "org/", "allow")
    assert got[2][2:] == ("com/fr/", "allow") and got[3][2:] == ("com/de/", "block")
    assert got[4] == got[5] == got[9] == ("", "", None, "allow")
    assert got[6][3] == got[7][3] == "block" and got[8] == ("ok.net", "", None, "allow") and got[10] == ("org", "", None, "allow")
    assert url_filter.judge(pages.limit(0), pages.limit(0).select(F.col("url").alias("canonical"))).count() == 0


# -- op 6 -------------------------------------------------------------------
def test_ppm_is_a_distribution_and_base_score(docs, rows, empty):
    data = np.frombuffer(b"abracadabra banana", np.uint8)
    g, _ = ppm.byte_grams(data, np.array([0, len(data)]))
    trie = ppm.Trie.of(*[x.astype(t) for x, t in zip(np.unique(g, return_counts=True), (np.uint32, float))])
    for context in (b"abr", b"zzz", b"\xff\xff\xff", b"xab", b"ana"):
        packed = np.uint32(int.from_bytes(context, "big") << 8) | np.arange(256, dtype=np.uint32)
        assert abs((10 ** trie.log10p(packed)).sum() - 1) < 1e-9
    learn = [r for r in rows if r[0] is None or zlib.crc32(str(r[0]).encode()) % 7 != 2]
    token = lambda t: words((t or "").translate(AZ)) + [None]
    c = Counter(w for r in learn for w in token(r[1]))
    total, distinct = sum(c.values()), len(c)
    got = sorted((str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in ppm.score(docs, hot_words=5).collect())
    assert got == sorted((str(r[0]), len(token(r[1])), sum(c[w] > 0 for w in token(r[1])), total,
                          round(sum(math.log10((c[w] + 1) / (total + distinct + 1)) for w in token(r[1])), 6)) for r in rows)
    assert ppm.score(empty).count() == 0


@pytest.mark.parametrize("max_nodes", [0, 40, 500_000])
def test_ppm_scores_with_all_grams(docs, rows, max_nodes):
    def grams(texts):
        data = [(t or "").encode() for t in texts]
        return ppm.byte_grams(np.frombuffer(b"".join(data), np.uint8), np.cumsum([0] + [len(d) for d in data]))
    learn = [r[1] for r in rows if r[0] is None or zlib.crc32(str(r[0]).encode()) % 7 != 2]
    g, n = np.unique(grams(learn)[0], return_counts=True)
    p, at = ppm.Trie.of(g, n.astype(float)).log10p(grams([r[1] for r in rows])[0]), grams([r[1] for r in rows])[1]
    want = sorted((str(r[0]), round(p[a:b].sum(), 6)) for r, a, b in zip(rows, at, at[1:]))
    got = sorted((str(r.doc_id), round(r.score, 6)) for r in ppm.score(docs, max_nodes=max_nodes).collect())
    assert [i for i, _ in got] == [i for i, _ in want]
    assert np.allclose([s for _, s in got], [s for _, s in want], rtol=0, atol=2e-6)


# -- op 7 -------------------------------------------------------------------
def shingles(text):
    w = words((text or "").translate(AZ))
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def linked(sets):
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in sets:
        for j in sets:
            if i < j and sets[i] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in sets}


def test_near_dedup_matches_brute_force(docs, rows, empty):
    sets = {r[0]: shingles(r[1]) for r in rows if r[0] is not None}
    want = linked(sets)
    for r in near_dedup.near_dedup(docs).collect():
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), want[r.doc_id], want[r.doc_id] == r.doc_id)
    assert near_dedup.near_dedup(empty).count() == 0


def test_near_dedup_large_group_at_the_threshold(spark):
    rng = random.Random(9)
    base = prose(rng, 150).split()
    texts = []
    for k in range(150):  # similarities on both sides of the threshold
        copy = list(base)
        for i in rng.sample(range(150), rng.randrange(0, 7)):
            copy[i] = f"e{k}x{i}"
        texts.append(" ".join(copy))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = linked({i: shingles(t) for i, t in enumerate(texts)})
    assert {r.doc_id: r.component_id for r in near_dedup.near_dedup(df).collect()} == want


def test_components(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 7), (200, 201), (202, 201), (5, 5)]
    got = dict(components.components(spark.createDataFrame(edges, "u long, v long")).collect())
    assert got == {**{i: 0 for i in range(1, 31)}, 100: 0, 201: 200, 202: 200}


# -- op 9 -------------------------------------------------------------------
def test_line_dedup_matches_brute_force(docs, rows, empty):
    key = lambda line: line.strip(" \t\n\x0b\f\r").translate(AZ)
    holders = {}
    for r in rows:
        for line in (r[1] or "").split("\n") if r[0] is not None else []:
            holders.setdefault(key(line), set()).add(r[0])
    want = []
    for r in rows:
        ls = (r[1] or "").split("\n")
        kept = [x for x in ls if r[0] is None or len(key(x)) < 10 or len(holders[key(x)]) < 2 or min(holders[key(x)]) == r[0]]
        want.append((str(r[0]), len(ls), len(ls) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    got = line_dedup.line_dedup(docs).select(F.col("row.doc_id").alias("i"), "n_lines", "n_dropped", F.sha2("clean_text", 256).alias("s"))
    assert sorted((str(r.i), r.n_lines, r.n_dropped, r.s) for r in got.collect()) == sorted(want)
    assert line_dedup.line_dedup(empty).count() == 0


# -- op 10 ------------------------------------------------------------------
def test_decontamination_matches_brute_force(spark, docs, empty):
    rng = random.Random(11)
    items = [prose(rng, n) for n in (3, 15, 15, 30, 40, 57)] + [None, ""]
    cut = items[4].split()
    texts = [f"{prose(rng, 50)} {items[1].upper()} {prose(rng, 20)}", items[5] + " tail", " ".join(cut[:38] + ["new"] + cut[39:]),
             " ".join(cut[:20] + ["new"] + cut[21:]), prose(rng, 200), f"x {items[0]} y", " ".join(items[3].split()[:28]), None, ""]
    df = spark.createDataFrame(list(enumerate(texts)) + [(None, texts[0]), (None, texts[4])], "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")

    def grams(w, k):
        return Counter(tuple(w[i:i + k]) for i in range(len(w) - k + 1))

    def hits(text):
        w, out = words((text or "").translate(AZ)), []
        for i, t in enumerate(items):
            iw = words((t or "").translate(AZ))
            k = min(5, len(iw))
            m = min(len(iw), len(w))
            if not iw or m < k:
                continue
            a = grams(iw, k)
            if any(100 * (a & b).total() >= 80 * (a | b).total() for s in range(len(w) - m + 1) for b in [grams(w[s:s + m], k)]):
                out.append(i)
        return out
    got = decontaminate.decontaminate(df, bench).collect()
    assert sorted((str(r.doc_id), r.items, r.kept) for r in got) == sorted(
        (str(i), hits(t), not hits(t)) for i, t in [*enumerate(texts), (None, texts[0]), (None, texts[4])])
    assert decontaminate.decontaminate(docs, bench.limit(0)).where("contaminated").count() == 0
    assert decontaminate.decontaminate(empty, bench).count() == 0


def test_word_hashes_and_chunks():
    import pyarrow as pa
    texts = ["A b  a", None, "", "a", "x" * 50 + " b", "\té\n"]
    seen = {}
    for i, j, data, at in tokens.chunks(pa.array(texts), max_bytes=8):
        h, wa = tokens.word_hashes(data, at)
        for k in range(j - i):
            for w, v in zip(words((texts[i + k] or "").translate(AZ)), h[wa[k]:wa[k + 1]], strict=True):
                assert seen.setdefault(w, v) == v
    assert len(set(seen.values())) == len(seen) == 4
