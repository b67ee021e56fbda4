"""Operator 4 against a plain loop over the sorted documents."""

import hashlib
import random

import pytest

from tessera.llm import fingerprint as fp

SCHEMA = "doc_id long, text string, part int"


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_edit_distance():
    rng = random.Random(1)
    for _ in range(400):
        a, b = ("".join(rng.choices("abcd", k=rng.randint(0, 70))) for _ in range(2))
        assert fp.edit_distance(a, b) == plain_distance(a, b)


def plain_fingerprint(text):
    """Byte by byte."""
    raw = text.encode()

    def rolled(i):
        h = sum(raw[i - j] * fp._POWERS[j] for j in range(fp.WINDOW) if i >= j) % 2**32
        h ^= h >> 15
        h = h * 0x2C1B3C6D % 2**32
        return h ^ h >> 13

    def signature(size):
        cuts = [0] + [i + 1 for i in range(len(raw)) if rolled(i) % size == 0]
        if cuts[-1] != len(raw):
            cuts.append(len(raw))
        return "".join(fp.ALPHABET[fp.xxhash.xxh32_intdigest(raw[a:z]) & 63] for a, z in zip(cuts, cuts[1:]))

    size = 1
    while len(signature(size)) > fp.PIECES:
        size *= 2
    return f"{size}:{signature(size)}:{signature(2 * size)}"


def prose(rng, n):
    return " ".join("".join(rng.choices("abcdefghiéß", k=rng.randint(1, 9))) for _ in range(n))


def test_fingerprint_is_the_plain_one(monkeypatch):
    rng = random.Random(2)
    texts = ["", "a", "short", "a" * 500, "ab" * 700, "🙂 é", *(prose(rng, n) for n in (5, 9, 11, 40, 300, 900))]
    want = [plain_fingerprint(t) for t in texts]
    assert [fp.fingerprint(t) for t in texts] == want
    monkeypatch.setattr(fp, "SEGMENT", 64)
    assert [fp.fingerprint(t) for t in texts] == want


def test_likeness_parts_edits_from_strangers():
    rng = random.Random(3)
    for n in (12, 60, 500, 3000):
        for _ in range(10):
            a, b = prose(rng, n), prose(rng, n)
            edited = a[:len(a) - len(a) // 4] + b[:len(a) // 4]
            assert fp.likeness(fp.fingerprint(a), fp.fingerprint(edited)) > 0.5
            assert fp.likeness(fp.fingerprint(a), fp.fingerprint(b)) < 0.3
            assert fp.likeness(fp.fingerprint(a), fp.fingerprint(a)) == 1.0


def plain(rows):
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    out = []
    for i, (doc_id, text) in enumerate(rows):
        text, after = text or "", rows[(i + 1) % len(rows)][1] or ""
        k = len(text) // 4
        edited = text[:len(text) - k] + after[:k]
        a, e, b = (fp.fingerprint(t) for t in (text, edited, after))
        out.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), a, e,
                    pytest.approx(fp.likeness(a, e)), pytest.approx(fp.likeness(a, b))))
    return out


def check(spark, rows, parts):
    df = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA).repartition(parts)
    got = fp.neighbours(df).collect()
    key = lambda r: (r[0] is None, r[0] or 0)
    assert [tuple(r) for r in sorted(got, key=key)] == plain(rows)


def test_neighbours(spark):
    rng = random.Random(4)
    rows = [(rng.randrange(10**9), prose(rng, rng.randint(0, 300))) for _ in range(120)]
    rows += [(-5, None), (-4, ""), (-3, "x"), (-2, prose(rng, 30_000)), (None, "without an id"), (10**12, None)]
    rows += [(10**10 + i, rows[0][1]) for i in range(20)]
    check(spark, rows, 3)


@pytest.mark.parametrize("rows", [[], [(1, "only one document, its own next one")], [(1, "abcdefgh"), (2, None)]])
def test_few_documents(spark, rows):
    check(spark, rows, 2)


def test_rows_of_one_id(spark):
    df = spark.createDataFrame([(7, t, 0) for t in ["a b", "c d", None, "a b", ""]], SCHEMA)
    got = fp.neighbours(df).collect()
    assert len(got) == 5 and {r.doc_id for r in got} == {7}
    assert len({r.fingerprint for r in got}) == 3
