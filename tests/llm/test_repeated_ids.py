"""Near dedup where rows share an id: no text is lost, no link is missed."""

import random

import pytest

from churnspark.llm import near_dedup
from test_operators import prose, shingles



def smallest(rows, percent):
    """Component of every id: ids are linked if any of their texts are."""
    ids = sorted({i for i, _ in rows if i is not None})
    parent = {i: i for i in ids}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


def test_classes_of_one_id_are_linked(spark):
    rng = random.Random(1)
    a, b = prose(rng, 40), prose(rng, 40)
    got = near_dedup.near_dedup(frame(spark, [(5, a), (7, a), (5, b), (3, b), (5, ""), (9, ""), (5, a)])).collect()
    assert {(r.doc_id, r.component_id) for r in got} == {(5, 3), (7, 3), (3, 3), (9, 9)} and len(got) == 7
    assert {r.doc_id for r in got if r.kept} == {3, 9}


@pytest.mark.parametrize("seed,percent", [(0, 80), (1, 85)])
def test_repeated_ids_match_brute_force(spark, seed, percent):
    rng = random.Random(seed)
    bases = [prose(rng, rng.randrange(30, 70)) for _ in range(12)]
    rows = []
    for k in range(90):
        w = rng.choice(bases).split()
        for i in rng.sample(range(len(w)), rng.randrange(0, 3)):
            w[i] = f"edit{k}x{i}"
        rows.append((rng.randrange(45), " ".join(w)))  # most ids stand for several texts
    rows += [(i, None) for i in (1, 2, 60)] + [(2, "two words"), (61, "two words"), (None, bases[0]), (None, None)] + rows[:5]
    want = smallest(rows, percent)
    got = near_dedup.near_dedup(frame(spark, rows), percent).collect()
    assert len(got) == len(rows)
    assert all(r.kept if r.doc_id is None else (r.component_id, r.kept) == (want[r.doc_id], want[r.doc_id] == r.doc_id) for r in got)
    assert sorted((str(r.doc_id), r.n_shingles) for r in got) == sorted((str(i), len(shingles(t))) for i, t in rows)


def test_recall_on_planted_copies_against_all_rows(spark):
    """Ids divisible by 100 against all rows: the links found and those there are."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    got = {r.doc_id: r.component_id for r in near_dedup.near_dedup(docs).collect()}
    sets = {r.doc_id: shingles(r.text) for r in docs.collect()}
    pairs = [(i, j) for i in sets if i % 100 == 0 for j in sets if i != j and sets[i]
             and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])]
    assert all(got[i] == got[j] for i, j in pairs)
