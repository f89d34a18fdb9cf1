"""Quality rules learned as a decision list, on DataFrame functions only.

Method: sequential covering.  Statistics of every document are Spark
expressions.  From the labelled ones, a rule (a conjunction of thresholds that
says "bad") grows one threshold at a time by FOIL gain on a growing part, is
pruned back to its best prefix on a pruning part, and is kept if it is precise
enough; the rows it covers leave, and the next rule is learned.  The list
becomes one ordered CASE expression.

Scale: documents are read once (statistics are written as a narrow table);
learning sees counts only: labelled rows are binned and pre-aggregated, and a
growing step is one aggregate of at most features x bins rows.  The driver
holds thresholds and those counts, both bounded by the number of bins, and the
rules found so far.

Defined cases: null or empty text has all counts 0 and fails the base rule; a
very long text is counted whole, in one row's arrays of its words and lines;
of thresholds that gain the same, the first feature's lowest is taken; a
null or repeated id meets every label of its id, rows are neither dropped nor
repeated (labels of an id are first reduced to the smallest); no labels, or no
bad label, give the empty list, which keeps everything.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnspark.llm.common import NON_SPACE, SPACE_RUN, let, text_of, words
from churnspark.session import materialize

WINDOW = 8
SYMBOLS = "[#*$%&|<>]"


def repeated_words(ws: Column, window: int = WINDOW) -> Column:
    """Words that lie in a window of ``window`` words found twice or more in
    the same array.  Windows are compared as 64-bit hashes; texts without a
    repeated window (the usual case) skip the sort."""
    def covered(hashes: Column) -> Column:
        tagged = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def twice(s: Column) -> Column:
            same = lambda e, other: F.coalesce(F.get(s, other)["h"] == e["h"], F.lit(False))
            hit = F.filter(s, lambda e, k: same(e, k - 1) | same(e, k + 1))
            return F.array_sort(F.transform(hit, lambda e: e["i"]))

        def span(p: Column) -> Column:
            new = F.transform(p, lambda x, k: F.least(F.lit(window), F.coalesce(F.get(p, k + 1) - x, F.lit(window))))
            return F.aggregate(new, F.lit(0), lambda a, b: a + b)

        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(
            let(let(tagged, twice), span))

    hashes = F.transform(F.sequence(F.lit(1), F.size(ws) - window + 1), lambda i: F.xxhash64(F.slice(ws, i, window)))
    return F.when(F.size(ws) < window, F.lit(0)).otherwise(let(hashes, covered)).cast("long")


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Narrow table of counts per document."""
    t = F.col("t")
    base = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("t"))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(NON_SPACE))
    per_words = lambda ws: F.struct(F.size(ws).cast("long").alias("n_words"),
                                    repeated_words(ws).alias("n_repeat_words"),
                                    F.size(F.array_distinct(ws)).cast("long").alias("n_distinct"))
    per_lines = lambda ls: F.struct(F.size(ls).cast("long").alias("n_lines"),
                                    (F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("n_dup_lines"))
    return base.select(
        "doc_id", let(words(t), per_words).alias("w"), let(lines, per_lines).alias("l"),
        F.char_length(F.regexp_replace(t, SPACE_RUN, "")).cast("long").alias("word_chars"),
        F.regexp_count(t, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.regexp_count(t, F.lit("[A-Z]")).cast("long").alias("n_upper"),
        F.regexp_count(t, F.lit("[!?]")).cast("long").alias("n_marks"),
    ).select("doc_id", "w.*", "l.*", "word_chars", "n_symbols", "n_upper", "n_marks")


def features() -> dict[str, Column]:
    """Interpretable ratios of the counts, as doubles."""
    per = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))
    return {"n_words": F.col("n_words").cast("double"), "word_length": per("word_chars", "n_words"),
            "symbol_share": per("n_symbols", "word_chars"), "repeat_share": per("n_repeat_words", "n_words"),
            "dup_line_share": per("n_dup_lines", "n_lines"), "upper_share": per("n_upper", "word_chars"),
            "mark_share": per("n_marks", "word_chars"), "distinct_share": per("n_distinct", "n_words"),
            "line_words": per("n_words", "n_lines")}


@dataclass(frozen=True)
class Condition:
    """``feature > threshold`` if ``above``, else ``feature <= threshold``."""

    feature: str
    threshold: float
    above: bool
    bin: int

    def on(self, value: Column) -> Column:
        return value > self.threshold if self.above else value <= self.threshold

    def on_bin(self) -> Column:
        b = F.col(f"b_{self.feature}")
        return b > self.bin if self.above else b <= self.bin


Rule = tuple[Condition, ...]


def _all(parts: list[Column]) -> Column:
    out = F.lit(True)
    for p in parts:
        out = out & p
    return out


def thresholds(train: DataFrame, names: list[str], n_bins: int) -> dict[str, list[float]]:
    """Candidate cuts: quantiles of each class (one aggregate)."""
    at = [(i + 1) / (n_bins + 1) for i in range(n_bins)]
    cut = lambda c, y: F.percentile_approx(F.when(F.col("y") == y, F.col(c)), at, 10000)
    row = train.agg(*[cut(c, y).alias(f"{c}_{y}") for c in names for y in (0, 1)]).first()
    return {c: sorted({float(v) for y in (0, 1) for v in (row[f"{c}_{y}"] or [])}) for c in names}


def learn(stats: DataFrame, labels: DataFrame, n_bins: int = 16, min_precision: float = 0.8,
          min_cover: int = 5) -> list[Rule]:
    """Decision list for label 0 from ``labels`` (doc_id, quality).  It ends
    with the first rule that covers fewer than ``min_cover`` bad documents or
    is less precise than ``min_precision``; a rule ends where no threshold
    gains.  Every rule takes its bad documents with it, so both ends are met."""
    feats = features()
    names = list(feats)
    marks = (labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
             .groupBy("doc_id").agg(F.min("quality").alias("quality")))
    train = materialize(stats.join(marks, "doc_id").select(
        *[c.alias(n) for n, c in feats.items()], (F.col("quality") == 0).cast("int").alias("y"),
        (F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0).alias("prune")), "rule_train")
    cuts = thresholds(train, names, n_bins)
    names = [n for n in names if cuts[n]]
    if not names:
        return []
    binned = [F.aggregate(F.array(*[(F.col(n) > t).cast("int") for t in cuts[n]]), F.lit(0), lambda a, b: a + b)
              .alias(f"b_{n}") for n in names]
    cells = materialize(train.select(*binned, "y", "prune").groupBy(*[f"b_{n}" for n in names], "y", "prune")
                        .agg(F.count("*").alias("n")), "rule_cells")
    rules: list[Rule] = []
    left = cells
    while True:
        rule = _prune(left, _grow(left, names, cuts, min_cover))
        if not rule:
            break
        hit = _all([c.on_bin() for c in rule])
        bad, good = left.where(hit).agg(F.sum(F.col("n") * F.col("y")), F.sum(F.col("n") * (1 - F.col("y")))).first()
        if (bad or 0) < min_cover or bad < min_precision * (bad + good):
            break
        rules.append(rule)
        left = left.where(~hit)
    return rules


def _grow(cells: DataFrame, names: list[str], cuts: dict, min_cover: int) -> Rule:
    rule: Rule = ()
    while True:
        inside = cells.where(~F.col("prune") & _all([c.on_bin() for c in rule]))
        pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("f"), F.col(f"b_{n}").alias("b")) for n in names]))
        rows = (inside.select(pairs.alias("p"), "y", "n").groupBy("p.f", "p.b")
                .agg(F.sum(F.col("n") * F.col("y")).alias("bad"), F.sum(F.col("n") * (1 - F.col("y"))).alias("good"))
                .collect())
        counts: dict[str, list[tuple[int, int, int]]] = {}
        for r in rows:
            counts.setdefault(r["f"], []).append((r["b"], r["bad"], r["good"]))
        if not counts:
            break
        one = next(iter(counts.values()))
        all_bad, all_good = sum(x[1] for x in one), sum(x[2] for x in one)
        if not all_bad or not all_good:
            break
        base, best = log2(all_bad / (all_bad + all_good)), (0.0, None)
        for f in names:
            bad = good = 0
            at = {b: (p, q) for b, p, q in counts.get(f, [])}
            for j, cut in enumerate(cuts[f]):
                bad, good = bad + at.get(j, (0, 0))[0], good + at.get(j, (0, 0))[1]
                for above, p, q in ((False, bad, good), (True, all_bad - bad, all_good - good)):
                    if p >= min_cover and (gain := p * (log2(p / (p + q)) - base)) > best[0] + 1e-9:
                        best = (gain, Condition(f, cut, above, j))
        if best[1] is None:
            break
        rule += (best[1],)
    return rule


def _prune(cells: DataFrame, rule: Rule) -> Rule:
    """The prefix with the best (bad - good) / (bad + good) on the pruning part."""
    if len(rule) < 2:
        return rule
    heads = [_all([c.on_bin() for c in rule[:k]]) for k in range(1, len(rule) + 1)]
    row = cells.where("prune").agg(*[F.sum(F.when(h & (F.col("y") == y), F.col("n")).otherwise(0))
                                     for h in heads for y in (1, 0)]).first()
    value = [((row[2 * k] or 0) - (row[2 * k + 1] or 0)) / max(1, (row[2 * k] or 0) + (row[2 * k + 1] or 0))
             for k in range(len(heads))]
    return rule[:value.index(max(value)) + 1]


def verdict(rules: list[Rule], feats: dict[str, Column] | None = None) -> tuple[Column, Column]:
    """(kept, rule number or null) as ordered conditional expressions."""
    feats = feats or features()
    kept, number = None, None
    for k, rule in enumerate(rules):
        hit = _all([c.on(feats[c.feature]) for c in rule])
        kept = F.when(hit, F.lit(False)) if kept is None else kept.when(hit, F.lit(False))
        number = F.when(hit, F.lit(k)) if number is None else number.when(hit, F.lit(k))
    return (F.lit(True) if kept is None else kept.otherwise(F.lit(True)),
            F.lit(None).cast("int") if number is None else number)


def quality_rules(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """Counts per document with ``base_failed``, ``kept`` and ``rule`` (number
    of the rule that fired)."""
    stats = materialize(statistics(docs), "statistics")
    kept, number = verdict(learn(stats, labels, **settings))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return stats.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                        failed.alias("base_failed"), (~failed & kept).alias("kept"), number.alias("rule"))
