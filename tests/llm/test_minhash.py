"""Operator 5 against all pairs of full shingle sets."""

import random
import re

import numpy as np

from tessera.llm import minhash

SCHEMA = "doc_id long, text string, node long, component_id long"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return set()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))}


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    group = list(range(len(rows)))

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if rows[i][0] is not None and rows[j][0] is not None and sets[i] and sets[j]:
                if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                    group[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(least.get(find(i), r[0]), r[0])
    return sorted(((r[0], len(sets[i]), least.get(find(i)) if r[0] is not None else None,
                    r[0] is None or least[find(i)] == r[0]) for i, r in enumerate(rows)), key=str)


def check(spark, rows):
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA)
    got = minhash.near_documents(df).drop("same").collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)
    return df


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
    return " ".join(words)


def corpus(rng, families, size):
    rows = []
    for f in range(families):
        base = [f"w{rng.randrange(5000)}" for _ in range(rng.randint(20, 200))]
        for _ in range(rng.randint(1, size)):
            rows.append((len(rows) * 3 + 1, edited(rng, base, rng.choice([0, 0, 1, 1, 2, 3, 5]))))
    return rows


def test_families_and_edges(spark):
    rng = random.Random(8)
    rows = corpus(rng, 40, 6)
    passage = " ".join(f"p{i}" for i in range(60))
    rows += [(2000 + i, passage + " " + " ".join(f"q{i}x{j}" for j in range(i * 7))) for i in range(15)]
    rows += [(3000, None), (3001, ""), (3002, " \n\t"), (3003, "one two"), (3004, "ONE\ttwo"), (3005, "two one"),
             (3006, "a b c d e"), (3007, "A b  c d e"), (3008, "É b c d e"), (3009, "é b c d e"),
             (None, rows[0][1]), (1, rows[0][1]), (1, "another text of this id"), (3010, "a b c d e f\x85g h")]
    rows += [(4000 + i, rows[7][1]) for i in range(40)]
    df = check(spark, rows)
    out = minhash.deduplicated(df)
    assert out.columns == df.columns
    kept = {r[0] for r in brute(rows) if r[3]}
    assert {r.doc_id for r in out.collect()} == kept


def test_near_copies_that_miss_the_pivot(spark, monkeypatch):
    """Chains and blocks: members link with each other but not with the bucket's least member."""
    monkeypatch.setattr(minhash, "BLOCK", 8)
    rng = random.Random(9)
    base = [f"w{i}" for i in range(120)]
    rows, words = [], list(base)
    for i in range(50):
        words = edited(rng, words, 1).split()
        rows.append((i, " ".join(words)))
    rows += [(100 + i, edited(rng, base, 4)) for i in range(60)]
    rng.shuffle(rows)
    check(spark, rows)


def test_long_text_in_pieces(monkeypatch):
    text = " ".join(f"Word{i % 977}" for i in range(5000)) + "\n"
    whole = minhash.shingle_set(text)
    monkeypatch.setattr(minhash, "PIECE", 100)
    assert np.array_equal(whole, minhash.shingle_set(text))
    assert len(whole) == len(shingles(text))


def test_signature_estimates_similarity():
    rng = np.random.default_rng(1)
    errors = []
    for share in (0.2, 0.5, 0.75, 0.9):
        for _ in range(20):
            common = rng.integers(0, 2**63, int(400 * share)).astype(np.uint64)
            a, b = (np.concatenate([common, rng.integers(0, 2**63, (400 - len(common)) // 2).astype(np.uint64)])
                    for _ in range(2))
            same = (minhash.signature(a, 1024) == minhash.signature(b, 1024)).mean()
            errors.append(same - len(common) / (2 * len(a) - len(common)))
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.03


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert minhash.near_documents(df).count() == 0
    assert minhash.deduplicated(df).count() == 0
