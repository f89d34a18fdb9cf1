"""HTML extraction, hard negatives and spelling variants against brute force."""

import html
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnspark.llm import hard_negatives, html_extract, spelling

PAGES = "page_id long, url string, html string, text string, n_chars string, row int"
VECTORS = "vec_id long, embedding array<float>, label int, id string, vector int, score int, rb int"
DOCS = "doc_id long, text string, word string, n int, prefix int, form string"


# -- op 11 ------------------------------------------------------------------
NOISE = {
    "menu": '<nav><ul><li><a href="/a">Home</a><li><a href="/b">All news of the day</a></ul></nav>',
    "header": "<header><h1>The Daily Site</h1><p>Welcome to a site with a long motto, every day.</p></header>",
    "advert": '<div class="ad">Buy this now, it is very cheap. <p>Really, buy this now!</p></div>',
    "notice": '<div id="cookie-notice"><p>We use cookies to make this site better for all of you.</p></div>',
    "sidebar": '<aside><h3>Recent</h3><p>A teaser of another text, which is of some length too.</p></aside>',
    "sidebar2": '<div class="sidebar left"><p>A second teaser of another text, of some length too.</p></div>',
    "form": '<form action="/x">Write to us <input name="a"><textarea>nothing &lt;p&gt;</textarea><button>Send</button></form>',
    "script": '<script>if (a < b) { write("<p>never</p>"); }</script><style>p > b {}</style><noscript>off</noscript>',
    "comments": '<section class="comments"><article class="comment"><p>I like this text a lot, thanks for writing it.</p></article></section>',
    "footer": "<footer><p>&copy; 2024 The Daily Site, all rights reserved, as always.</p></footer>",
    "remark": "<!-- <p>a remark > with markup</p> -->",
}


def paragraph(rng, n):
    return " ".join(rng.choice(["word", "Text,", "a", "R&D", "x<y", "été", "\"so\""]) for _ in range(n)) + "."


def page(rng, blocks, wrap):
    text = []
    for k, b in enumerate(blocks):
        shown = html.escape(b).replace(" ", rng.choice([" ", "\n  ", "&nbsp;", " <b>", "<i> </i>"]), 1)
        text.append(f"<h2>{shown}</h2>" if k == 0 else f"<p class=x title='a > b'>{shown}{rng.choice(['</p>', '', '<br>'])}")
        if k and rng.random() < 0.3:
            text.append(NOISE[rng.choice(["advert", "script", "remark", "sidebar", "form"])])
    before = "".join(NOISE[k] for k in ("script", "remark", "header", "menu", "notice") if rng.random() < 0.7)
    after = "".join(NOISE[k] for k in ("comments", "sidebar2", "advert", "footer") if rng.random() < 0.7)
    return f"<!DOCTYPE html><html><head><title>no</title></head><body>{before}{wrap[0]}{''.join(text)}{wrap[1]}{after}</body></html>"


@pytest.mark.parametrize("wrap", [("<article>", "</article>"), ("<main>", "</main>"), ('<div role="main">', "</div>"),
                                  ('<div class="post-content">', "</div>"), ("<div>", "</div>"), ("", "")])
def test_text_of_a_page_and_nothing_else(wrap):
    rng = random.Random(str(wrap))
    for _ in range(60):
        blocks = ["A heading of the text"] + [paragraph(rng, rng.randrange(1, 40)) for _ in range(rng.randrange(1, 12))] + [paragraph(rng, 15)]
        text, n = html_extract.main_text(page(rng, blocks, wrap))
        assert text == "\n".join(" ".join(b.split()) for b in blocks) and n == len(blocks)


def test_given_pages_match_a_plain_reading(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r.page_id: (r.text, r.n_chars) for r in html_extract.extract(pages).collect()}
    want = {}
    for r in pages.collect():
        inner = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<b>|<br>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
        text = "\n".join(b for b in blocks if b)
        want[r.page_id] = (text, len(text))
    assert got == want


def test_pages_of_every_kind(spark):
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<p>x"), (4, "u", "plain"), (4, "u", "plain"), (5, "u", "<script>no"),
            (6, "u", "<article><p>" + "long words " * 40_000 + "</article>"), (7, "u", "<p>a &amp b &#x41; &am &#128512;"),
            (8, "u", "<!-- open <p>Text after a remark."), (9, "u", "<a href=\"never closed>Text.</a><p>more."),
            (10, "u", '<ul><li><a href="x">Only</a><li><a href="y">links</a></ul>'), (11, "u", '<div class="ad">only an advert</div>'),
            (12, "u", '<div id="banner">' + "One sentence of a page. " * 60 + "</div>")]
    df = spark.createDataFrame([(*r, "clash", "x", 1) for r in rows], PAGES)
    got = [(r.page_id, r.url, r.text, r.n_chars) for r in html_extract.extract(df).collect()]
    want = {1: "", 2: "", None: "x", 4: "plain", 5: "", 6: ("long words " * 40_000).strip(), 7: "a & b A &am 😀", 8: "Text after a remark.",
            9: "more.", 10: "", 11: "", 12: ("One sentence of a page. " * 60).strip()}
    assert sorted(got, key=str) == sorted(((i, u, want[i], len(want[i])) for i, u, _ in rows), key=str)
    assert html_extract.extract(df.limit(0)).count() == 0


@pytest.mark.parametrize("unit", ["<", "<!--", "<a b=\"", "<b>", "<div>", "<script>", "<title>", "</p>", "<p><a href=x>", "<a x='\">", "&am", "<li><b>x"])
def test_scanning_time_is_linear(unit):
    html_extract.main_text(unit * 30_000)  # a quadratic scan wouldn't end


def test_surge_and_dive():
    assert html_extract.spans([]) == html_extract.spans([0, 0]) == []
    assert html_extract.spans([0, 5, 0, 0, 7, 0, 0, 0, 2]) == [(1, 5), (8, 9)]
    assert html_extract.spans([50, 60, 0, 0, 0, 3, 0, 0, 0, 40]) == [(0, 2), (9, 10)]


# -- op 12 ------------------------------------------------------------------
def mined(rows, positives=5, negatives=10, low=30, high=90):
    """anchor, positive, rank, negative, scores over plain lists (id, label, vector)."""
    width = max((len(v) for _, _, v in rows), default=0)
    whole = [(i, lab, [math.floor(256 * x) for x in v] + [0] * (width - len(v))) for i, lab, v in rows]
    out = []
    for i, lab, v in whole:
        if i % 100:
            continue
        ranked = sorted(((-sum(a * b for a, b in zip(v, w)), j, m) for j, m, w in whole if j != i))
        for s, j, _ in [x for x in ranked if x[2] == lab][:positives]:
            fit = [(t, k) for t, k, m in ranked if m != lab and low * -s <= 100 * -t <= high * -s][:negatives]
            out += [(i, j, r, k, -s, -t) for r, (t, k) in enumerate(fit, 1)]
    return sorted(out)


def results(df):
    return sorted((r.anchor_id, r.positive_id, r.rank, r.negative_id, r.positive_score, r.negative_score) for r in df.collect())


@pytest.mark.parametrize("kind", ["random", "copies", "lengths", "integers"])
def test_hard_negatives_match_a_search_of_all_pairs(spark, kind):
    rng = np.random.default_rng(len(kind))
    n, dims = 900, 12
    v = rng.normal(size=(n, dims)).astype(np.float32) * 0.3
    if kind == "copies":  # a third of all rows is one vector, so that ties decide
        v[::3] = v[0]
    elif kind == "lengths":
        v *= np.exp(rng.normal(size=(n, 1)) * 2).astype(np.float32)
        v[::11] = 0
    elif kind == "integers":
        v = rng.integers(-1, 2, size=(n, dims)).astype(np.float32)
    label = rng.integers(0, 4, n)
    rows = [(i, int(label[i]), [float(x) for x in v[i]]) for i in range(n)]
    df = spark.createDataFrame([(i, x, m, "clash", 1, 2, 3) for i, m, x in rows], VECTORS).repartition(5)
    assert results(hard_negatives.mine(df, F.col("id") % 100 == 0)) == mined(rows)


def test_hard_negatives_of_every_kind(spark):
    good = [(0, 1, [0.5, 0.25]), (1, 1, [0.5, 0.5]), (2, 2, [0.25, 0.25]), (3, 2, []), (4, 2, [0.375]), (100, 7, [0.0, 0.0]), (101, 7, [1.0]),
            (200, 9, [1.0, 1.0]), (300, 1, [-1.0, 0.1]), (5, 2, [0.25, 0.25, 0.5])]
    bad = [(6, [float("nan"), 1.0], 1), (7, [None, 1.0], 1), (8, None, 1), (9, [1.0], None), (None, [1.0], 1), (10, [float("inf")], 2)]
    rows = [(i, v, m) for i, m, v in good] + bad + [(1, [0.5, 0.5], 1), (1, [0.5, 0.5], 1)]
    df = spark.createDataFrame([(*r, "clash", 1, 2, 3) for r in rows], VECTORS)
    assert results(hard_negatives.mine(df, F.col("id") % 100 == 0)) == mined(good)
    assert hard_negatives.mine(df.limit(0), F.col("id") % 100 == 0).count() == 0
    assert hard_negatives.mine(df, F.col("id") < 0).count() == 0
    large = [(0, 1, [1e6, 2e6]), (1, 1, [3e6, 1e6]), (2, 2, [1e6, 1e6])]  # sums beyond 2^53
    df = spark.createDataFrame([(i, v, m, "", 1, 2, 3) for i, m, v in large], VECTORS.replace("float", "double"))
    assert results(hard_negatives.mine(df, F.col("id") % 100 == 0)) == mined(large)


def test_coordinate_ranges_lose_nothing_and_prune():
    rng = np.random.default_rng(5)
    v = rng.normal(size=(400, 6))
    v[:40] = np.eye(6)[rng.integers(0, 6, 40)] * 2  # rows along an axis
    length = np.sqrt((v ** 2).sum(axis=1))
    bucket = hard_negatives.LengthBucket(np.arange(400), v, length)
    pruned = 0
    for q in [*rng.normal(size=(30, 6)), *np.eye(6)]:
        unit = q / np.sqrt((q ** 2).sum())
        cosine = v @ unit / length
        for bound in (0.2, 0.7, 0.95, float(cosine.max())):
            found = bucket.candidates(unit, np.argsort(-np.abs(unit))[:3], bound)
            assert set(np.flatnonzero(cosine >= bound)) <= set(found)
            pruned += 400 - len(found)
    assert pruned > 0.6 * 36 * 4 * 400


# -- op 13 ------------------------------------------------------------------
AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def word_counts(docs):
    n = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(AZ)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 7:
                n[run] += 1
    return {w: c for w, c in n.items() if c >= 2}


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def variants(n):
    form, out = {}, []
    for w in n:
        others = [x for x in n if near(w, x)]
        best = min(others, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 10 * n[w] else None
        out.append((w, len(others)))
    rows = []
    for w, k in out:
        root = w
        while form[root]:
            root = form[root]
        rows.append((w, form[w], root, n[w], k, n.get(form[w])))
    return sorted(rows, key=str)


def found(df):
    return sorted(((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()), key=str)


def test_spelling_variants_match_brute_force(spark):
    rng = random.Random(8)
    stems = ["analyse", "banana", "aaaaaaa", "straße", "Éclair×÷", "recommend", "Occurrence"]

    def edit(w):
        k, c = rng.randrange(len(w) + 1), rng.choice("abÀÿz")
        return rng.choice([w[:k] + c + w[k:], w[:k] + w[k + 1:], w[:k] + c + w[k + 1:]])
    vocab = [s + "ing" for s in stems for _ in range(40)]
    vocab += [edit(w) for w in vocab] + [edit(edit(w)) for w in vocab]
    texts = [" ".join(rng.choice(vocab) for _ in range(rng.randrange(200))) for _ in range(120)]
    texts += [None, "", "1234 short", "a" * 7 + "_" + "A" * 8 + " " + "a" * 9, "long " * 5000 + "x" * 300, "x" * 300 + " " + "x" * 299 + "y",
              "x" * 300 + "," + "x" * 299 + "y " + "q" * 200, "q" * 200, " ".join(["frequent"] * 3000 + ["frequant"] * 20), "日本" + "b" * 7, "𝒜" + "b" * 7]
    docs = list(enumerate(texts)) + [(None, texts[0]), (None, texts[1]), (3, texts[3]), (3, texts[3])]
    df = spark.createDataFrame([(i, t, "clash", 1, 2, "") for i, t in docs], DOCS).repartition(4)
    n = word_counts(docs)
    assert len(n) > 300 and any(len(w) > 250 for w in n)
    got = found(spelling.variants(spelling.counted_words(df)))
    assert got == variants(n)
    assert any(r[1] and r[1] != r[2] for r in got) or any(r[1] for r in got)
    assert spelling.variants(spelling.counted_words(df.limit(0))).count() == 0


def test_roots_follow_long_chains(spark):
    n = {"abcdefg" + "h" * k: 10 ** (9 - k) for k in range(9)} | {"zzzzzzz": 5, "zzzzzzy": 5, "zzzzzyy": 50}
    words = spark.createDataFrame(list(n.items()), "word string, n long")
    got = found(spelling.variants(words))
    assert got == variants(n) and sum(r[2] == "abcdefg" for r in got) == 9


def test_groups_of_rotations_hold_one_alphabet(spark):
    rng = random.Random(3)
    words = {"".join(rng.choice("abc") for _ in range(7)) for _ in range(1500)}
    df = spark.createDataFrame([(w, 1) for w in words], "word string, n long")
    largest = spelling.rotations(df).groupBy("prefix").count().agg(F.max("count")).collect()[0][0]
    assert largest <= 3 + 1
