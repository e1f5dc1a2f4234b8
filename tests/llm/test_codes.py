"""Product codes against plain loops over all entries."""

import hashlib
import math
import random

import numpy as np
import pytest

from gridcast.llm import codes
from gridcast.llm.common import load

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<double>, label int, code string, error long, v int"


def brute(rows, parts=16, entries=64, rounds=2, scale=256):
    """rows: (id, vector, label) of equal lengths; rows of the result."""
    kept = [(i, [math.floor(x * scale) for x in v], y) for i, v, y in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0], r[1]))
    n = len(kept[0][1])
    cut = [(p * n // parts, (p + 1) * n // parts) for p in range(parts)]
    books = [[r[1][a:b] for r in kept[:entries]] for a, b in cut]
    far = lambda x, y: sum((s - t) ** 2 for s, t in zip(x, y, strict=True))
    near = lambda p, x: min((far(x, e), k) for k, e in enumerate(books[p]))
    for _ in range(rounds):
        for p, (a, b) in enumerate(cut):
            own = {}
            for _, v, _ in kept:
                own.setdefault(near(p, v[a:b])[1], []).append(v[a:b])
            for k, xs in own.items():
                books[p][k] = [sum(c) // len(xs) for c in zip(*xs, strict=True)]
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out, by = [], {}
    for i, v, y in kept:
        best = [near(p, v[a:b]) for p, (a, b) in enumerate(cut)]
        error = sum(d for d, _ in best)
        by[y] = by.get(y, 0) + error
        out.append((i, "".join(f"{k:02x}" for _, k in best), error, y))
    return sorted(((i, c, e, by[y], sha) for i, c, e, y in out), key=repr)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, v, y, "c", 1, 2) for i, v, y in rows], SCHEMA)
    return sorted(map(tuple, codes.compress(df, **kw).collect()), key=repr)


@pytest.mark.parametrize("spread,n,k", [(3, 64, 4), (3, 200, 1), (10**6, 64, 4), (2**27, 100, 3), (1, 17, 2)])
def test_gnat_finds_the_nearest_entry_and_the_lower_of_ties(spread, n, k):
    r = np.random.default_rng(n * k)
    entries, queries = r.integers(-spread, spread + 1, (n, k)), r.integers(-spread, spread + 1, (500, k))
    queries[:n] = entries[: len(queries[:n])]
    tree = codes.Gnat(entries)
    index, square = tree.nearest(queries)
    all_ = ((queries[:, None] - entries) ** 2).sum(axis=2)
    assert (index == all_.argmin(axis=1)).all() and (square == all_.min(axis=1)).all()


def test_gnat_tries_fewer_entries_than_there_are():
    r = np.random.default_rng(5)
    entries = (r.normal(size=(64, 2)) * 1000).astype(np.int64)
    tree = codes.Gnat(entries)
    tree.nearest(entries[r.integers(0, 64, 1000)] + r.integers(-20, 21, (1000, 2)))
    assert tree.tried < 64 * 1000 / 2


def test_given_table(spark):
    df = load(spark, SF, "embeddings")
    rows = [(r.vec_id, r.embedding, r.label) for r in df.collect()]
    assert sorted(map(tuple, codes.compress(df).collect()), key=repr) == brute(rows)


def test_odd_rows(spark):
    r = random.Random(3)
    v = lambda n=32: [r.choice((-1.5, -0.001, 0.0, 0.25, 0.7)) for _ in range(n)]
    rows = [(i, v(), i % 3 or None) for i in range(150)]
    rows += [rows[7], (7, v(), 1), (None, v(), 2), (None, v(), None)]
    bad = [(900, None, 1), (901, [], 1), (902, [None] * 32, 1), (903, [float("nan")] + v(31), 1), (904, [float("inf")] + v(31), 2), (905, v(31), 2)]
    assert run(spark, rows + bad) == brute(rows)
    assert run(spark, rows[:5]) == brute(rows[:5])
    assert run(spark, [(i, v(18), 1) for i in range(9)], entries=4, rounds=3) != []
    few = [(i, v(18), 1) for i in range(70)]
    assert run(spark, few, entries=9, rounds=3) == brute(few, entries=9, rounds=3)
    assert run(spark, []) == [] and run(spark, bad[:1] + bad[2:3]) == []
    assert [x[1:3] for x in run(spark, [(1, [], 4), (2, [], 4)])] == [("00" * 16, 0)] * 2


def test_huge_components_saturate(spark):
    got = run(spark, [(i, [1e300 * (-1) ** i] * 16, 0) for i in range(80)])
    assert len(got) == 80 and all(x[2] == 0 for x in got)
    with pytest.raises(ValueError):
        run(spark, [(1, [0.5] * 16, 0)], entries=300)
