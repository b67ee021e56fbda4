"""Operator 4: document fingerprints by context-triggered piecewise hashing.

A rolling hash of the last ``WINDOW`` bytes decides where a piece ends: at
block size 2^k where the hash's k low bits are zero.  The block size is the
least one with at most ``PIECES`` pieces.  Each piece's hash is one symbol;
the fingerprint is "block size:signature:signature at twice the block size".
A change in a text changes the pieces it touches and no others.

Two fingerprints are compared at compatible block sizes (equal, or one twice
the other) by the edit distance of their signatures, if these share a run of
symbols; else their likeness is 0.

``neighbours`` pairs every document with the next one in order: documents are
range-partitioned and sorted by id (rows of one id by a hash of the text), each
task streams its range holding one row back, and the ranges' first and last
rows, two a task, are joined afterwards.  No global sort in one task, no
window over the corpus.

Defined results: null text is the empty text; the empty text has fingerprint
"1::", like 1.0 only to itself; documents without an id stand last; a single
document is its own next one.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

#: Bytes that a boundary depends on, most pieces of a signature, shortest run that counts as shared.
WINDOW, PIECES, SHARED = 7, 64, 7
#: Bytes hashed at once.
SEGMENT = 1 << 20
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
_POWERS = [pow(0x9E3779B1, i, 2**32) for i in range(WINDOW)]


def _boundaries(data: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """(end, hash) of the pieces at block size 2^level, without the text's end."""
    ends, hashes = [], []
    low = np.uint32((1 << level) - 1)
    for at in range(0, len(data), SEGMENT):
        start = max(0, at - WINDOW + 1)
        part = data[start:at + SEGMENT].astype(np.uint32)
        rolled = part * np.uint32(_POWERS[0])
        for i in range(1, min(WINDOW, len(part))):
            rolled[i:] += part[:-i] * np.uint32(_POWERS[i])
        rolled = rolled[at - start:]
        rolled ^= rolled >> np.uint32(15)
        rolled *= np.uint32(0x2C1B3C6D)
        rolled ^= rolled >> np.uint32(13)
        hit = np.flatnonzero((rolled & low) == 0)
        ends.append(hit + at + 1)
        hashes.append(rolled[hit])
    return (np.concatenate(ends), np.concatenate(hashes)) if ends else (np.zeros(0, int), np.zeros(0, np.uint32))


def fingerprint(text: str | None) -> str:
    raw = (text or "").encode()
    data = np.frombuffer(raw, np.uint8)
    n = len(data)
    level = max(0, (n // PIECES).bit_length() - 2)
    ends, hashes = _boundaries(data, level)

    def pieces(found):
        return len(found) + (not len(found) or found[-1] != n)

    while level and pieces(ends) <= PIECES:         # a text of few boundaries
        level -= 1
        ends, hashes = _boundaries(data, level)
    while pieces(ends) > PIECES:
        level += 1
        more = (hashes & np.uint32((1 << level) - 1)) == 0
        ends, hashes = ends[more], hashes[more]

    def signature(found):
        cuts = [0, *found.tolist()]
        if cuts[-1] != n:
            cuts.append(n)
        return "".join(ALPHABET[xxhash.xxh32_intdigest(raw[a:z]) & 63] for a, z in zip(cuts, cuts[1:]))

    twice = (hashes & np.uint32((2 << level) - 1)) == 0
    return f"{1 << level}:{signature(ends)}:{signature(ends[twice])}"


def edit_distance(a: str, b: str) -> int:
    """Levenshtein distance, a row of bits at a time."""
    if not a or not b:
        return len(a) + len(b)
    full, last = (1 << len(a)) - 1, 1 << (len(a) - 1)
    at: dict[str, int] = {}
    for i, c in enumerate(a):
        at[c] = at.get(c, 0) | 1 << i
    up, down, distance = full, 0, len(a)
    for c in b:
        match = at.get(c, 0)
        same = match | down
        zero = (((match & up) + up) ^ up) | same
        more, less = down | (full & ~(zero | up)), up & zero
        if more & last:
            distance += 1
        elif less & last:
            distance -= 1
        more = (more << 1 | 1) & full
        up = ((less << 1) & full) | (full & ~(zero | more))
        down = more & zero
    return distance


def _alike(a: str, b: str) -> float:
    if a == b:
        return 1.0
    run = min(SHARED, min(len(a), len(b)) // 2 + 1)
    runs = {a[i:i + run] for i in range(len(a) - run + 1)}
    if not any(b[i:i + run] in runs for i in range(len(b) - run + 1)):
        return 0.0
    return 1 - edit_distance(a, b) / max(len(a), len(b))


def likeness(a: str, b: str) -> float:
    """0 to 1; 1 for equal fingerprints, 0 where the block sizes are not compatible."""
    if a == b:
        return 1.0
    (m, a1, a2), (n, b1, b2) = a.split(":"), b.split(":")
    if m == n:
        return max(_alike(a1, b1), _alike(a2, b2) if a2 and b2 else 0.0)
    if int(m) == 2 * int(n):
        return _alike(a1, b2)
    return _alike(a2, b1) if 2 * int(m) == int(n) else 0.0


def _facts(text: str, mark: str, following: str, next_mark: str) -> tuple:
    """n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    n = len(text)
    edited = text[:n - n // 4] + following[:n // 4]
    edited_mark = fingerprint(edited)
    return (n, hashlib.sha256(edited.encode()).hexdigest(), mark, edited_mark,
            likeness(mark, edited_mark), likeness(mark, next_mark))


_FACTS = pa.schema([("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
                    ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])
_FACT_DDL = ("n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
             "near_edited double, near_next double")
DONE, FIRST, LAST = 0, 1, 2


def _fact_columns(rows: list[tuple | None]) -> list[pa.Array]:
    return [pa.array([None if r is None else r[k] for r in rows], f.type) for k, f in enumerate(_FACTS)]


def _stream(batches):
    """Settled rows of a sorted range, and its first and last row with their texts."""
    part = TaskContext.get().partitionId()
    held = None                                      # id, text, fingerprint

    def out(kinds, ids, texts, facts):
        return pa.RecordBatch.from_arrays(
            [pa.array(kinds, pa.int32()), pa.array([part] * len(kinds), pa.int64()), pa.array(ids, pa.int64()),
             pa.array(texts, pa.string()), *_fact_columns(facts)], names=["kind", "part", "doc_id", "text", *_FACTS.names])

    for batch in batches:
        kinds, ids, texts, facts = [], [], [], []
        for doc_id, text in zip(batch.column(0), batch.column(1)):
            row = doc_id.as_py(), text.as_py() or ""
            row = (*row, fingerprint(row[1]))
            if held is None:
                kinds.append(FIRST)
                ids.append(row[0])
                texts.append(row[1])
                facts.append((0, "", row[2], "", 0.0, 0.0))
            else:
                kinds.append(DONE)
                ids.append(held[0])
                texts.append(None)
                facts.append(_facts(held[1], held[2], row[1], row[2]))
            held = row
        if kinds:
            yield out(kinds, ids, texts, facts)
    if held is not None:
        yield out([LAST], [held[0]], [held[1]], [(0, "", held[2], "", 0.0, 0.0)])


def _settle(batches):
    """The ranges' last rows with their next rows."""
    for batch in batches:
        facts = [_facts(*(c[i].as_py() for c in batch.columns[1:])) for i in range(len(batch))]
        yield pa.RecordBatch.from_arrays([batch.column(0), *_fact_columns(facts)], names=["doc_id", *_FACTS.names])


def neighbours(docs: DataFrame) -> DataFrame:
    """For each row of ``docs`` (doc_id, text): doc_id, its text's and edited text's fingerprints, and
    how like its fingerprint is to the edited text's and the next document's."""
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text")]
    ranges = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
              .repartitionByRange(*order).sortWithinPartitions(*order, "text"))
    rows = written(ranges.mapInArrow(_stream, f"kind int, part bigint, doc_id bigint, text string, {_FACT_DDL}"),
                   "fingerprints")
    first = rows.where(F.col("kind") == FIRST).select(F.col("part").alias("at"), F.col("text").alias("following"),
                                                      F.col("fingerprint").alias("next_mark"))
    # one row per range: in order, and round from the last to the first
    around = Window.orderBy("at")
    parts = first.select("at", F.coalesce(F.lead("at").over(around), F.min("at").over(around)).alias("next_at"))
    last = (rows.where(F.col("kind") == LAST).join(parts, F.col("part") == F.col("at")).drop("at")
            .join(first, F.col("next_at") == F.col("at"))
            .select("doc_id", "text", "fingerprint", "following", "next_mark"))
    settled = last.mapInArrow(_settle, f"doc_id bigint, {_FACT_DDL}")
    done = rows.where(F.col("kind") == DONE).select("doc_id", *_FACTS.names)
    return done.unionByName(settled)
