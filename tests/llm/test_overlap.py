import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from loomgraph.llm import overlap

INTS = st.lists(st.integers(-60, 60), max_size=60).map(lambda x: np.unique(np.array(x, np.int64)))


@settings(max_examples=300, deadline=None)
@given(INTS, INTS)
def test_counts_of_runs(a, b):
    wanted = len(set(a.tolist()) & set(b.tolist()))
    assert overlap.merge_count(a, b) == overlap.gallop_count(a, b) == overlap.gallop_count(b, a) == overlap.shared_count(a, b) == wanted


def brute(rows, least, share):
    sets = {}
    for s, m in rows:
        if s is not None and m is not None:
            sets.setdefault(s, set()).add(m)
    sets = {k: v for k, v in sets.items() if len(v) >= least}
    out = set()
    for a in sets:
        for b in sets:
            n = len(sets[a] & sets[b])
            if a < b and n > 0 and n >= share * min(len(sets[a]), len(sets[b])):
                out.add((a, b, len(sets[a]), len(sets[b]), n))
    return out


def test_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(overlap, "RUN_LENGTH", 16)  # many identifier ranges
    monkeypatch.setattr(overlap, "PARTNERS", 3)  # several groups of partners
    monkeypatch.setattr(overlap, "SETS_OF_MEMBER", 2)  # members spread over several groups
    monkeypatch.setattr(overlap, "BROADCAST_ROWS", 10)
    rng = random.Random(1)
    for share in (0.5, 0.2, 1.0):
        rows = []
        for s in range(40):
            base = rng.randint(0, 300)
            for _ in range(rng.randint(5, 80)):
                rows.append((f"s{s}", f"m{rng.randint(base, base + 120)}"))
        rows += [("hot", f"m{i}") for i in range(400)] + [("twin1", f"m{i}") for i in range(30)] + [("twin2", f"m{i}") for i in range(30)]
        rows += rows[:50] + [(None, "m1"), ("s1", None)]
        df = spark.createDataFrame([(*r, 1) for r in rows], "set_id string, member string, n int")
        got = {tuple(r) for r in overlap.overlaps(df, 10, share).collect()}
        assert got == brute(rows, 10, share), share


def test_a_member_of_every_set(spark):
    rows = [(f"s{i}", f"{i}-{j}") for i in range(60) for j in range(10)] + [(f"s{i}", "everywhere") for i in range(60)]
    df = spark.createDataFrame(rows, "set_id string, member string")
    assert overlap.overlaps(df, 5, 0.5).count() == 0
    assert overlap.overlaps(df.limit(0), 5, 0.5).count() == 0
