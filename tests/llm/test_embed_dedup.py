"""Operator 1 against all cosines, and its components against plain union-find."""

import math
import random

import numpy as np
import pytest

from tessera.llm import embed_dedup
from tessera.llm.components import connected_components

SCHEMA = "vec_id long, embedding array<double>, label int, rep string, component_id long"


def brute(rows, threshold=0.98):
    ok = [r for r in rows if r[0] is not None and r[2] is not None and r[1] and None not in r[1]
          and all(map(math.isfinite, r[1])) and any(r[1])]
    links = {id(r): 0 for r in rows}
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for i, a in enumerate(ok):
        for b in ok[:i]:
            if a[2] == b[2] and len(a[1]) == len(b[1]):
                x, y = np.array(a[1]), np.array(b[1])
                x, y = x / np.abs(x).max(), y / np.abs(y).max()
                if x @ y / math.sqrt(x @ x * (y @ y)) >= threshold:
                    links[id(a)] += 1
                    links[id(b)] += 1
                    p, q = find(id(a)), find(id(b))
                    parent[p] = q
    least = {}
    for r in ok:
        p = find(id(r))
        least[p] = min(least.get(p, r[0]), r[0])
    usable = {id(r) for r in ok}
    out = []
    for r in rows:
        component = least[find(id(r))] if id(r) in usable else r[0]
        out.append((r[0], links[id(r)], component, r[0] == component))
    return sorted(out, key=str)


def check(spark, rows):
    df = spark.createDataFrame([(*r, "clash", 5) for r in rows], SCHEMA)
    got = embed_dedup.near_vectors(df)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


def noisy(rng, base, size):
    return [x + rng.gauss(0, size) for x in base]


def test_copies_near_copies_and_odd_vectors(spark):
    rng = random.Random(3)
    rows = []
    for k in range(40):
        base = [rng.gauss(0, 1) for _ in range(16)]
        for j in range(rng.randint(1, 8)):
            rows.append((len(rows), noisy(rng, base, rng.choice([0, .05, .12, .2])), k % 3))
    rows += [(len(rows) + i, rows[5][1], 2) for i in range(30)]
    rows += [(1000, None, 1), (1001, [], 1), (1002, [0.0] * 16, 1), (1003, [None] + [1.0] * 15, 1),
             (1004, [float("nan")] * 16, 1), (1005, [float("inf")] * 16, 1), (1006, rows[0][1], None),
             (None, rows[0][1], 0), (1007, [1.0, 2.0], 0), (1008, [2.0, 4.0], 0), (1009, [1e200, 2e200], 0),
             (1010, [-0.0, 1.0], 0), (1011, [0.0, 1.0], 0), (1012, [1e-200, 2e-200], 0)]
    rows += [(5, rows[5][1], rows[5][2]), (5, rows[9][1], 0)]        # an id again
    check(spark, rows)


def test_large_bucket_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(embed_dedup, "BLOCK", 16)
    rng = random.Random(4)
    base = [rng.gauss(0, 1) for _ in range(12)]
    rows = [(i, noisy(rng, base, 0.1), 1) for i in range(150)]
    rows += [(200 + i, [rng.gauss(0, 1) for _ in range(12)], 1) for i in range(60)]
    check(spark, rows)


def test_empty_table(spark):
    assert embed_dedup.near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("edges", [
    [], [(1, 1)], [(None, 2)], [(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 300)],
    [(random.Random(1).randint(0, 99), j) for j in range(100)]])
def test_components(spark, edges):
    got = {r.node: r.component for r in connected_components(
        spark.createDataFrame(edges, "a long, b long")).collect()}
    near = {}
    for a, b in edges:
        if a is not None and b is not None and a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    want = {}
    for n in sorted(near):
        if n not in want:
            todo = [n]
            while todo:
                x = todo.pop()
                if x not in want:
                    want[x] = n
                    todo.extend(near[x])
    assert got == want
