"""Operator 13 against scoring every document for every item."""

import math
import random
import re
from collections import Counter

from tessera.llm import lexical_search as ls

DOCS, ITEMS = "doc_id long, text string, key long, n long, item int", "item_id long, text string, rank int, score long"
PATTERN = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return PATTERN.findall((text or "").translate(LOWER))


def brute(docs, items, k=10):
    counts = [(d, Counter(terms(t))) for d, t in docs]
    counts = [(d, c) for d, c in counts if c]
    n_docs, n_terms = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in {i for i in items if i[1] is not None}:
        scored = []
        for d, c in counts:
            m = 100 - 75 + 75 * sum(c.values()) * n_docs // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                    for t in terms(text) if t in c)
            if s > 0:
                scored.append((-s, d is None, d or 0, d))
        out += [(item, r, x[3], -x[0]) for r, x in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def check(spark, docs, items, parts=3, **more):
    df = spark.createDataFrame([(*d, 1, 2, 3) for d in docs], DOCS).repartition(parts)
    got = ls.search(df, spark.createDataFrame([(*i, 4, 5) for i in items], ITEMS), **more)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs, items, more.get("k", 10))


def prose(rng, n, words=400):
    return " ".join(f"w{int(words * rng.random() ** 3)}" for _ in range(n))


def test_generated_corpus_with_copies(spark):
    rng = random.Random(3)
    docs = [(i, prose(rng, rng.choice([1, 5, 40, 300]))) for i in range(500)]
    docs += [(1000 + i, docs[7][1]) for i in range(150)]                        # a group of copies: ties by id
    items = [(i, prose(rng, 30)) for i in range(12)] + [(50, docs[7][1]), (51, docs[30][1] + " " + docs[31][1])]
    check(spark, docs, items, parts=7)
    check(spark, docs, items, k=1)


def test_thresholds_from_few_first_documents_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(ls, "FIRST", 2)
    monkeypatch.setattr(ls, "BLOCK_BYTES", 300)                               # several blocks of items
    monkeypatch.setattr(ls, "HELD_TERMS", 20)                                 # counts handed on in parts
    rng = random.Random(4)
    docs = [(i, prose(rng, rng.randint(1, 60), 60)) for i in range(120)]
    check(spark, docs, [(i, prose(rng, 20, 60)) for i in range(9)])


def test_edges(spark):
    docs = [(None, "one two"), (None, None), (1, None), (2, ""), (3, " .,;!  "), (4, "One TWO two"), (4, "One TWO two"),
            (5, "ÀB àb ÀB é"), (6, "x" * 100_000), (7, "long " * 200_000), (8, "two" + "\x00" + "one"), (-9, "a_b-c9")]
    items = [(1, "one two two"), (1, "one two two"), (1, "ÀB É àb"), (2, None), (3, ""), (4, "absent"), (None, "long two"),
             (6, "x" * 100_000 + " B c9"), (7, "TWO " * 3_000)]
    check(spark, docs, items)


def test_empty_tables(spark):
    check(spark, [], [(1, "one")])
    check(spark, [(1, "one")], [])
    check(spark, [(1, None)], [(1, "one")])


def test_a_bound_is_never_below_the_score():
    rng = random.Random(5)
    texts = [prose(rng, rng.choice([1, 3, 50, 2000]), 300).encode() for _ in range(60)] + [b"w1 " * 700, b"w1 " * 513]
    counts = [Counter(ls.terms_of(t)) for t in texts]
    df = Counter(t for c in counts for t in c)
    block = ls.Block([prose(rng, 25, 300).encode() for _ in range(10)] + [b"absent"], df, len(texts),
                     sum(sum(c.values()) for c in counts))
    for c in counts:
        n = sum(c.values())
        bounds = block.bounds(n, ls.sketch_of(c))
        assert all(b >= block.score(i, n, c) for i, b in zip(block.filled, bounds))
