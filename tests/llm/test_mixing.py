"""Operator 9 against a plain water level, exact totals and the distribution of its draws."""

import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tessera.llm import mixing

SCHEMA = "doc_id long, source string, text string, lang string"


def level_targets(sizes, weights=mixing.WEIGHTS):
    """Targets by resharing the excess again and again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, free, target = 1.5 * sum(sizes.values()), set(order), {}
    while free:
        total = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / total > 2 * sizes[s] + 1e-9]
        if not over:
            return target | {s: left * weight[s] / total for s in free}
        for s in over:
            target[s] = 2.0 * sizes[s]
        left -= sum(target[s] for s in over)
        free -= set(over)
    return target


def make(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def drawn(docs):
    return mixing.mix(mixing.with_size(docs)).select("doc_id", "source", "size", "source_size", "target",
                                                     "taken", "whole", "drawn")


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [(i, "abcdefg"[min(i % 11, 6)], " ".join(f"w{j}" for j in range((i * 37) % 300)), "x")
            for i in range(900)]
    rows += [(5000 + i, None, "null source words here " * 20, None) for i in range(40)]
    rows += [(None, "a", "no id", "x"), (7, "a", None, "x"), (8, "b", "", "x"), (9, "b", " \n\t", "x")]
    rows += [(77, "c", "the same row again and again " * 9, "x")] * 30
    rows += [(99999, "g", "long " * 60_000, "x")]
    return make(spark, rows)


def test_targets_totals_and_limits(corpus):
    got = drawn(corpus).collect()
    assert len(got) == corpus.count()
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for r in got:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert 0 <= r.taken <= 2 * r.size
        assert r.taken - r.whole * r.size == sum(x["n"] for x in r.drawn or [])
        assert all(0 <= x["from"] and x["n"] > 0 and x["from"] + x["n"] <= r.size for x in r.drawn or [])
    want = level_targets(sizes)
    for s in sizes:
        assert target[s] == pytest.approx(want[s])
        assert abs(taken[s] - target[s]) <= max(2 * mixing.BLOCK_WORDS, 0.02 * target[s])


def test_sizes(corpus):
    for r in mixing.with_size(corpus).select("text", "size").collect():
        assert r.size == len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))


def test_rerun_and_layout_agree(corpus):
    once = drawn(corpus).drop("drawn").collect()
    again = drawn(corpus.repartition(7)).drop("drawn").collect()
    key = lambda rows: sorted(map(str, rows))
    assert key(once) == key(again)


def test_tree_keeps_quotas(spark):
    cells = spark.range(700).select(F.lit("s").alias("source"), F.col("id").alias("shard"),
                                    (F.col("id") % 40 + 1).alias("n_blocks"))
    total = cells.agg(F.sum("n_blocks")).first()[0]
    quotas = spark.createDataFrame([("s", total // 3)], "source string, quota long")
    got = mixing.cell_quotas(cells, quotas, 3).join(cells, ["source", "shard"]).collect()
    assert sum(r.quota for r in got) == total // 3
    assert all(0 <= r.quota <= r.n_blocks for r in got)


@pytest.mark.parametrize("good,bad,draws", [(30, 70, 20), (5, 3, 6), (1, 0, 1), (0, 9, 4), (4000, 6000, 2000),
                                            (4_000_000, 6_000_000, 3_000_000)])
def test_hypergeometric_moments(spark, good, bad, draws):
    x = mixing.hypergeometric(F.lit(good), F.lit(bad), F.lit(draws), mixing._uniform(F.col("id"), F.lit(1)))
    n = good + bad
    row = spark.range(4000).select(x.alias("x")).agg(F.avg("x"), F.var_pop("x"), F.min("x"), F.max("x")).first()
    mean = draws * good / n
    var = mean * (bad / n) * (n - draws) / max(1, n - 1)
    assert abs(row[0] - mean) <= 5 * (var / 4000) ** 0.5 + 1e-9
    assert abs(row[1] - var) <= 0.15 * var + 1e-9
    assert row[2] >= max(0, draws - bad) and row[3] <= min(good, draws)


def test_mixed_documents(corpus):
    out = mixing.mixed_documents(corpus)
    assert out.columns == corpus.columns
    words = {(r.doc_id, r.source): r.n for r in out.groupBy("doc_id", "source").agg(
        F.sum(F.regexp_count("text", F.lit(mixing.WORD))).alias("n")).collect()}
    taken = {(r.doc_id, r.source): r.n for r in drawn(corpus).groupBy("doc_id", "source").agg(
        F.sum("taken").alias("n")).collect()}
    assert words == {k: n for k, n in taken.items() if n}


def test_large_draws_follow_the_exact_distribution(spark):
    """Beyond the deviation (400) up to which a normal was once told apart: the draw at each quantile."""
    import math

    good, bad, draws = 3_000_000, 5_000_000, 2_000_000
    logs = lambda n, k: math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)
    mean = draws * good // (good + bad)
    over = range(mean - 6000, mean + 6001)
    mass = [math.exp(logs(good, x) + logs(bad, draws - x) - logs(good + bad, draws)) for x in over]
    total = sum(mass)
    at = (F.col("id") + 0.5) / 40
    got = [r.x for r in spark.range(40).select(mixing.hypergeometric(
        F.lit(good), F.lit(bad), F.lit(draws), at).alias("x")).collect()]
    assert total == pytest.approx(1, abs=1e-3) and len(set(got)) == 40
    # the draw is by mass around the mode: each u takes a value of its own, and each value its share
    share = {x: m / total for x, m in zip(over, mass)}
    mode = max(share, key=share.get)
    above = sorted(x for x in got if x >= mode)
    below = sorted(x for x in got if x < mode)
    assert abs(len(above) / 40 - sum(m for x, m in share.items() if x >= mode)) < 0.05
    for i, x in enumerate(above):
        assert abs(sum(share[y] for y in range(mode, x + 1)) - (i + 0.5) / 40) < 0.02
    for i, x in enumerate(reversed(below)):
        assert abs(sum(share[y] for y in range(x, mode)) - (i + 0.5) / 40) < 0.05


def test_parts_stand_in_their_texts(spark):
    rows = [(i, "abc"[i % 3], "  " + "".join(f"w{j}" + (" ", "\n", " \t", "\n\n")[j % 4] for j in range(900)), "x") for i in range(60)]
    docs = make(spark, rows)
    out = mixing.mixed_documents(docs).collect()
    text = {r[0]: r[2] for r in rows}
    parts = [r for r in out if r.text != text[r.doc_id]]
    assert parts
    for r in parts:
        assert r.text in text[r.doc_id] and r.text.strip() == r.text
    runs = {r.doc_id: r.drawn for r in drawn(docs).collect()}
    for runs_of in runs.values():
        assert all(a["from"] + a["n"] < b["from"] for a, b in zip(runs_of or [], (runs_of or [])[1:]))


def test_rows_of_one_id_and_size_stand_by_their_text(spark):
    rows = [(5, "a", " ".join(f"{k}{j}" for j in range(700)), "x") for k in "pqrstuv"] + [(6, "b", "one " * 5000, "x")]
    texts = [sorted(r.text for r in mixing.mixed_documents(make(spark, rows).repartition(n)).collect()) for n in (1, 5)]
    assert texts[0] == texts[1]


def test_empty_table(spark):
    assert drawn(make(spark, [])).count() == 0
    assert mixing.mixed_documents(make(spark, [])).count() == 0


def test_no_words(spark):
    got = drawn(make(spark, [(1, "a", None, "x"), (2, "b", "", "x")])).collect()
    assert [(r.taken, r.target) for r in got] == [(0, 0.0), (0, 0.0)]
