"""Operator 12 against a trie built in memory."""

import hashlib
import random
import zlib

import pytest

from tessera.llm import prefix_trie as pt

SCHEMA = "conv_id long, turn long, role string, text string, depth long, node long, k0 long"


def brute(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            body = hashlib.sha256(text.encode()).hexdigest()
            convs.setdefault(c, []).append(((turn is not None, turn or 0, role.encode(), body), (role, text)))
    convs = {c: [t for _, t in sorted(turns)] for c, turns in convs.items()}
    members, ends = {}, {}
    for c in convs:
        h = zlib.crc32(str(c).encode()) % 6
        donor = c - (c % 100 if c >= 0 else -(-c % 100))
        turns = tuple(convs.get(donor, [])[:h] + convs[c][h:])
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
        ends.setdefault(turns, []).append(c)
    children, leaves, saved = {}, dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for path in members:
        if path:
            children[path[:-1]] = children.get(path[:-1], 0) + 1
    for path, of in members.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += path not in children
            saved[path[:d]] += (len(of) - 1) * len(path[-1][1]) if path else 0
    return sorted((min(of), len(p), min(members[p[:-1]]) if p else None, len(of), children.get(p, 0), leaves[p], saved[p],
                   hashlib.sha256(",".join(map(str, sorted(ends.get(p, [])))).encode()).hexdigest())
                  for p, of in members.items())


def check(spark, rows, parts=3):
    df = spark.createDataFrame([(*r, 7, 8, 9) for r in rows], SCHEMA).repartition(parts)
    got = pt.rebuilt_trie(df)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                           "ends_sha256"]
    assert sorted(map(tuple, got.collect())) == brute(rows)


def conversations(rng, ids, longest):
    said = [("user", "hello"), ("assistant", "hi \U0001f600"), ("user", "more"), ("assistant", "")]
    return [(c, t, *said[rng.randrange(4)]) for c in ids for t in range(rng.randint(1, longest))]


def test_generated_conversations(spark):
    rng = random.Random(1)
    rows = conversations(rng, range(230), 7)
    rows += [(c, t, "user", f"same {t}") for c in range(300, 400) for t in range(4)]      # a group of copies
    check(spark, rows)


@pytest.mark.parametrize("band, block", [(2, 3), (3, 2), (16, 256)])
def test_deep_paths_cross_bands_and_blocks(spark, monkeypatch, band, block):
    monkeypatch.setattr(pt, "BAND", band)
    monkeypatch.setattr(pt, "BLOCK", block)
    monkeypatch.setattr(pt, "PIECE", 4)
    rng = random.Random(band)
    rows = conversations(rng, [*range(20), 100, 101, 205], 6)
    for c, n in [(30, 45), (31, 45), (32, 60), (33, 33)]:                      # long shared prefixes that part
        rows += [(c, t, "user", f"t{t}" if t < 40 - c % 3 else f"{c} {t}") for t in range(n)]
    check(spark, rows, 5)


def test_edges(spark):
    a, b = ("user", "a"), ("assistant", "b")
    rows = [(0, 0, *a), (0, 1, *b), (0, 1, *a), (0, 1, *a),                    # ties and repeated rows
            (1, None, *b), (1, None, None, None), (1, -5, "", ""), (1, 2, *a), (1, 3, *a), (1, 4, *b), (1, 5, *b), (1, 6, *a),
            (None, 0, *a), (None, None, None, None),                            # no conversation
            (205, 0, *a), (-7, 0, *a), (-7, 1, *b), (-107, 3, *a), (-100, 0, *b), (-200, 0, *b),
            (7, 0, "user", "long " * 50_000), (10**18 + 1, 0, *a), (150, 0, "ab", "c"), (160, 0, "a", "bc")]
    rows += [(c, 0, *a) for c in range(210, 240)]                               # some are turnless: their donor is absent
    check(spark, rows)
    check(spark, [r for r in rows if r[0] == 7])
    check(spark, [(None, 0, *a)])


def test_empty_table(spark):
    check(spark, [])
