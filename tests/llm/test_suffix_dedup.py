"""Operator 11 against every window of every document."""

import hashlib
import random

import numpy as np
import pytest

from tessera.llm import suffix_dedup as sd

SCHEMA = "doc_id long, text string, chunk long, ids int, n_bytes int"


def brute(rows):
    seen, out = set(), []
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, sd.xxhash.xxh32_intdigest((r[1] or "").encode()))):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for s in range(len(raw) - 99):
            window = raw[s:s + 100]
            if window in seen:
                gone[s:s + 100] = b"\1" * 100
            seen.add(window)
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((doc, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def check(spark, rows, parts=3):
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], SCHEMA).repartition(parts)
    got = sd.removed_digests(df)
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


def words(rng, n):
    return " ".join("".join(rng.choice("abcdeé ñ中") for _ in range(rng.randint(1, 9))) for _ in range(n))


def corpus(rng, n):
    line, passage = words(rng, 22), words(rng, 80)
    rows = [(3 * i, words(rng, rng.randint(0, 120))) for i in range(n)]
    for i in range(0, n, 3):                                                  # a common line in many places
        rows[i] = (rows[i][0], rows[i][1][:40] + line + rows[i][1][40:])
    for i in range(1, n, 7):
        rows[i] = (rows[i][0], rows[i][1] + passage[rng.randrange(60):] + passage)
    for i in range(n // 4):                                                   # copies, some with an edit
        text = rows[rng.randrange(n)][1]
        rows.append((1000 + i, text if i % 2 else text[:50] + "#" + text[51:]))
    return rows


def test_generated_corpus(spark):
    check(spark, corpus(random.Random(2), 90))


def test_hot_hashes_small_pieces_and_many_groups(spark, monkeypatch):
    for name, value in [("HOT", 3), ("PIECE", 64), ("MOST_WINDOWS", 5), ("CHUNK", 3000), ("GROUP_BYTES", 500), ("RANGE_BYTES", 1000)]:
        monkeypatch.setattr(sd, name, value)
    check(spark, corpus(random.Random(3), 40))


def test_edges(spark):
    line = "".join(random.Random(5).choice("xyz ") for _ in range(99))
    rows = [(None, None), (1, None), (2, ""), (3, line), (4, line), (5, line + "!"), (6, line + "!"), (7, "?" + line + "!"),
            (8, "a" * 2000), (9, "ab" * 700), (10, "b" + "a" * 99), (11, "é" * 120), (12, "x" + "é" * 120),
            (13, "q" * 99), (13, line + "!"), (13, "other " * 40), (None, line + "! null comes first"), (-5, "other " * 30),
            (20, "unit \x00" * 60), (20, "unit \x00" * 60)]
    check(spark, rows)
    check(spark, [(1, "one")])
    check(spark, [(1, "long text " * 30_000), (0, "long text " * 11)])


def test_short_repeats_within_one_text(spark):
    """A period shorter than a window, in runs that are one segment, and at every length round a window's."""
    rng = random.Random(9)
    rows = []
    for period in (1, 2, 5, 15, 16, 17, 40, 84, 85, 86, 99, 100, 101, 130):
        unit = "".join(rng.choices("abcdefgh .", k=period))
        for n in (99, 100, 101, period + 99, period + 100, period + 101, 2 * period + 120, 400):
            rows.append((len(rows), words(rng, 5) + (unit * 500)[:n] + words(rng, 5) if n % 2 else (unit * 500)[:n]))
    for parts in (1, 7):
        check(spark, rows, parts)
    for row in rows[::9]:                                                     # alone in the table
        check(spark, [row])


def test_empty_table(spark):
    assert sd.removed_digests(spark.createDataFrame([], SCHEMA)).collect() == []


def test_spans_and_kept_bytes(spark):
    text = words(random.Random(6), 60)
    df = spark.createDataFrame([(1, text, 0, 0, 0), (2, "new " + text + " end", 0, 0, 0)], SCHEMA)
    first, second = sd.deduplicated(df).orderBy("doc_id").collect()
    assert (bytes(first.kept), first.spans) == (text.encode(), [])
    assert [tuple(s) for s in second.spans] == [(4, len(text.encode()))]
    assert bytes(second.kept) == b"new  end"


@pytest.mark.parametrize("seed", range(4))
def test_classes_are_those_of_the_first_bytes(seed):
    rng = random.Random(seed)
    base = [bytes(rng.choices(b"ab c", k=rng.randint(100, 160))) for _ in range(6)] + [b"a" * 300, b"ab" * 120]
    text = b"\xff".join(base + [base[0][10:] + b"b" * 20, b"c" + base[1]]) + b"\xff"
    order, kind = sd.repeat_classes(np.frombuffer(text, np.uint8))
    of, seen = {}, {}
    for suffix, k in zip(order.tolist(), kind.tolist()):
        window = text[suffix:suffix + 100]
        if len(window) == 100 and b"\xff" not in window:
            assert of.setdefault(window, k) == k
            assert seen.setdefault(k, window) == window
