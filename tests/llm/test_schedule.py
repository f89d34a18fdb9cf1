"""The schedule of the mix: its order reaches the documents, and every stretch
from its start on keeps the sources' shares."""

import math
import random
from collections import Counter


from churnspark.llm import mixing
from test_operators import prose


def test_first_slots_are_those_of_the_drawn_blocks(spark):
    rng = random.Random(4)
    rows = [(i, prose(rng, rng.randrange(0, 60)), rng.choice(["a", "b", "c", None])) for i in range(400)] + [(None, "x y", "a"), (5, None, "b")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    sized = df.select("doc_id", "source",
                      mixing.n_words(mixing.text_of("text")).alias("size"))
    sources = {r.k: r for r in mixing.source_targets(sized, (5, 2, 1), 1.5, 2.0, 4096, 64).collect()}
    slots = [(r.slot, r.k, r.rank) for r in mixing.schedule(mixing.materialize(
        mixing.source_targets(sized, (5, 2, 1), 1.5, 2.0, 4096, 64), "s")).collect()]
    assert len({s for s, _, _ in slots}) == len(slots)
    for k, s in sources.items():
        assert sorted(r for _, j, r in slots if j == k) == list(range(s.slots))
    # words of every slot, in a stream that is dealt out by hand
    out = mixing.mix(df).collect()
    streams = {}
    import hashlib
    key = lambda r: "" if r.doc_id is None else str(r.doc_id)
    for k, s in sources.items():
        own = sorted((r for r in out if r.source == s.source), key=lambda r: (hashlib.md5(key(r).encode()).hexdigest(), key(r), r.size))
        streams[k] = [(n, i) for n, r in enumerate(own) for i in range(r.size)], own
    first, taken = {}, Counter()
    for slot, k, rank in sorted(slots):
        s, (stream, own) = sources[k], streams[k]
        a = rank % s.n_blocks * s.block
        b = min(a + s.block, s.source_size, s.quota - rank // s.n_blocks * s.source_size)
        for n, _ in stream[a:max(a, b)]:
            first.setdefault((k, n), slot)
            taken[k, n] += 1
    for k, (_, own) in streams.items():
        for n, r in enumerate(own):
            assert (r.taken, r.first_slot) == (taken[k, n], first.get((k, n)))


def test_every_prefix_keeps_the_shares(spark):
    need = [3000, 1000, 400, 90, 7]
    total, rows, at = sum(need), [], 0
    for k, n in enumerate(need):
        rows.append((k, n, total, at / total, (at + n) / total))
        at += n
    drawn = mixing.schedule(spark.createDataFrame(rows, "k int, slots long, all_slots long, lo double, hi double"))
    got, seen = [r.k for r in drawn.orderBy("slot").collect()], Counter()
    for i, k in enumerate(got[:total - total // 8], 1):
        seen[k] += 1
        assert all(abs(seen[j] - i * n / total) <= 1 + math.log(i + 1) for j, n in enumerate(need))
    assert Counter(got) == dict(enumerate(need))
