"""The learned decision list against plain sequential covering."""

from math import log2

from pyspark.sql import functions as F

from churnspark.llm import quality_rules as qr

BANDS = 26


def plain_list(rows, cuts, min_precision=0.8, min_cover=5):
    """Rules as tuples of (feature, threshold, above); ``rows`` are (values,
    bad, prune)."""
    holds = lambda rule, v: all((v[f] > t) == above for f, t, above in rule)
    count = lambda rs: (sum(b for _, b, _ in rs), sum(1 - b for _, b, _ in rs))
    found, left = [], rows
    while True:
        rule, inside = (), [r for r in left if not r[2]]
        while True:
            p0, q0 = count(inside)
            if not p0 or not q0:
                break
            best = (0.0, None)
            for f, ts in cuts.items():
                for t in ts:
                    for above in (False, True):
                        p, q = count([r for r in inside if (r[0][f] > t) == above])
                        if p >= min_cover and (gain := p * (log2(p / (p + q)) - log2(p0 / (p0 + q0)))) > best[0] + 1e-9:
                            best = (gain, (f, t, above))
            if best[1] is None:
                break
            rule += (best[1],)
            inside = [r for r in inside if holds(rule, r[0])]
        if len(rule) > 1:
            parts = [count([r for r in left if r[2] and holds(rule[:k], r[0])]) for k in range(1, len(rule) + 1)]
            value = [(p - q) / max(1, p + q) for p, q in parts]
            rule = rule[:value.index(max(value)) + 1]
        bad, good = count([r for r in left if holds(rule, r[0])])
        if not rule or bad < min_cover or bad < min_precision * (bad + good):
            return found
        found.append(rule)
        left = [r for r in left if not holds(rule, r[0])]


def test_list_equals_plain_covering_and_has_as_many_rules_as_needed(spark):
    # bad and good documents take turns in bands of word counts, with some noise
    rows = [(i, 20 + 10 * (i % BANDS) + i // BANDS % 7, int(i % BANDS % 2 if i % 41 else 1 - i % BANDS % 2), i % 5) for i in range(BANDS * 40)]
    stats = spark.createDataFrame(rows, "doc_id long, n_words long, quality long, n_marks long").select(
        "doc_id", "quality", "n_words", "n_marks", *[F.lit(v).cast("long").alias(c) for c, v in
        (("n_repeat_words", 0), ("n_distinct", 9), ("n_lines", 1), ("n_dup_lines", 0), ("word_chars", 100), ("n_symbols", 0), ("n_upper", 0))])
    labels = stats.select("doc_id", "quality")
    feats = qr.features()
    data = stats.select(*[c.alias(n) for n, c in feats.items()], (F.col("quality") == 0).cast("int").alias("y"),
                        (F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0).alias("prune"))
    cuts = qr.thresholds(data, list(feats), 32)
    got = [tuple((c.feature, c.threshold, c.above) for c in rule) for rule in qr.learn(stats.drop("quality"), labels, n_bins=32)]
    assert got == plain_list([(r.asDict(), r.y, r.prune) for r in data.collect()], cuts)
    assert len(got) > 8
    assert max(map(len, got)) > 1
