"""The corpus pipeline on a small table with planted cases."""

import random

import corpus_pipeline

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(n))


def test_stages_take_effect(spark, tmp_path):
    rng = random.Random(2)
    item = prose(rng, 20)
    clean = [prose(rng, 60) for _ in range(40)]
    near = clean[3].replace(clean[3].split()[-1], "changed")
    texts = clean + [near, f"{prose(rng, 40)} {item}"] + [prose(rng, 20) + " #|&%" * 40 for _ in range(20)] + [None, ""]
    rows = [(i, t, "en", f"s{i % 4}", len(t or ""), "extra") for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int, target string").write.parquet(
        f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(not 42 <= i < 62), 0) for i in range(62)], "doc_id long, quality int, toxic int").write.parquet(
        f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = corpus_pipeline.materialize(stage(spark, docs, str(tmp_path)), "stage")
        if k < 4:
            assert out.columns == docs.columns
        docs = out
        kept.append({r.doc_id for r in docs.collect()})
    assert not kept[0] & set(range(42, 62)) and set(range(42)) <= kept[0]
    assert kept[1] == kept[0] and 40 not in kept[2] and set(range(40)) <= kept[2]
    assert 41 not in kept[3] and set(range(40)) <= kept[3] and kept[4] <= kept[3]
    assert sum(r.taken for r in docs.collect()) > 0
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == len(kept[4])


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars int").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_near_stage_keeps_one_of_a_pair_at_four_fifths(spark):
    def shingles(text):
        w = text.split()
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}

    rng = random.Random(21)
    texts, gone = [], set()
    for k in range(30):  # pairs from 0.79 to 0.85 and some far apart
        base = prose(rng, 100 + k).split()
        copy = list(base)
        copy[40], copy[60] = f"x{k}", f"y{k}"
        copy = copy[:len(copy) - k % 4]
        a, b = shingles(" ".join(base)), shingles(" ".join(copy))
        if 100 * len(a & b) >= 80 * len(a | b):
            gone.add(len(texts) + 1)
        texts += [" ".join(base), " ".join(copy)]
    similarity = [len(a & b) / len(a | b) for a, b in ((shingles(x), shingles(y)) for x, y in zip(texts[::2], texts[1::2]))]
    assert any(0.8 <= s < 0.8 + 0.05 for s in similarity) and any(s < 0.8 for s in similarity)
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)],
                                 "doc_id long, text string, lang string, source string, n_chars int")
    kept = {r.doc_id for r in corpus_pipeline.near(spark, docs, "").collect()}
    assert kept == set(range(len(texts))) - gone


def test_no_text_is_lost_under_a_repeated_id(spark):
    rng = random.Random(3)
    a, b, c = (prose(rng, 40) for _ in range(3))
    rows = [(5, a), (7, a), (5, b), (3, b), (3, c), (3, c), (None, a), (None, a), (9, None), (9, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars int")
    kept = sorted(((r.doc_id, r.text) for r in corpus_pipeline.near(spark, docs, "").collect()), key=str)
    assert [x for x in kept if x[0] is None] == [(None, a)] * 2
    assert [x for x in kept if x[0] in (3, 5, 7)] == sorted([(5, a), (3, b), (3, c)], key=str)
    assert [i for i, _ in kept].count(9) == 1


def test_near_stage_catches_planted_copies_of_many_lines(spark):
    """Ten texts of twenty lines and a copy of each with a word changed."""
    rng = random.Random(6)
    texts = ["\n".join(prose(rng, 12) for _ in range(20)) for _ in range(10)]
    copies = [t.replace(t.split()[100], "changed", 1) for t in texts]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts + copies)],
                                 "doc_id long, text string, lang string, source string, n_chars int")
    assert {r.doc_id for r in corpus_pipeline.near(spark, docs, "").collect()} == set(range(10))


def test_columns_that_clash_are_kept(spark):
    docs = spark.createDataFrame([(1, "some words of a text", "en", "s", 3, "t", 4, "x", None)],
                                 "doc_id long, text string, lang string, source string, n_chars int, Target string, taken int, "
                                 "target_given string, `row` string")
    out = corpus_pipeline.mix(spark, docs, "")
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "Target_given_", "taken_given", "target_given", "row",
                           "target", "taken", "first_slot"]
    assert [tuple(r)[5:8] for r in out.collect()] == [("t", 4, "x")]
