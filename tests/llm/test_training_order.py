"""Operator 10: the permutation is a bijection, and reading the shards back gives every document."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import training_order as order
from tessera.llm.common import written

SCHEMA = "doc_id long, text string, slot long, ids string"


@pytest.mark.parametrize("n", [1, 2, 3, 5, 64, 1000, 4097])
def test_permutation(n):
    got = order.permute(np.arange(n), n)
    assert sorted(got.tolist()) == list(range(n))
    assert (order.permute(np.arange(n), n) == got).all()
    if n >= 1000:
        assert (order.permute(np.arange(n), n, key=2) != got).mean() > 0.9
        assert abs(np.corrcoef(np.arange(n), got)[0, 1]) < 0.1


def make(spark, rows, name="documents"):
    return written(spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(3), f"test/{name}")


def documents_of(folder, found, total):
    """Documents in the partitions' order, put together from the shards alone."""
    read = list(order.read_from(folder))
    assert len(read) == total
    at = order.permute(np.arange(total), total)
    stream = np.concatenate([read[s][read[s] != order.PAD] for s in at]).tobytes() if total else b""
    return stream.split(bytes([order.END]))[:-1]


def check(spark, rows, name="documents"):
    folder = order.fresh_folder(spark)
    found = order.document_order(make(spark, rows, name), folder).orderBy("slot").collect()
    assert [r.slot for r in found] == list(range(len(found)))
    texts = documents_of(folder, found, len(found))
    assert sorted(texts) == sorted((t or "").encode() for _, t in rows)
    for r, ids in zip(found, order.read_from(folder)):
        assert r.sha256 == hashlib.sha256(ids.tobytes()).hexdigest()
        assert r.shard == r.slot // order.SHARD and r.byte_offset == r.slot % order.SHARD * order.LENGTH
        assert r.n_tokens == (ids != order.PAD).sum()
    ids_of = {d for r in found for d in r.doc_ids}
    assert ids_of == {d for d, _ in rows if d is not None}
    return folder, found


def test_round_trip_and_resume(spark, monkeypatch):
    monkeypatch.setattr(order, "SHARD", 7)
    rng = random.Random(1)
    rows = [(i, "é" * rng.randint(0, 300) + "w " * rng.randint(0, 900)) for i in range(150)]
    rows += [(1000, None), (1001, ""), (None, "without an id"), (1002, "long " * 20_000), (3, rows[3][1])]
    folder, found = check(spark, rows)
    whole = [x.tobytes() for x in order.read_from(folder)]
    for slot in (0, 6, 7, 20, len(found) - 1, len(found)):
        assert [x.tobytes() for x in order.read_from(folder, slot)] == whole[slot:]


def test_reruns_agree(spark):
    rows = [(i, f"text {i} " * 100) for i in range(60)]
    docs = make(spark, rows, "again")
    a, b = (order.document_order(docs, order.fresh_folder(spark)) for _ in range(2))
    assert a.exceptAll(b).count() == 0 and a.count() == b.count()


def test_wider_ids(spark, monkeypatch):
    ids = [[1, 2, 70], list(range(300)), [], [65_000] * 20]
    rows = written(spark.createDataFrame([(i, np.array(x, "<u2").tobytes()) for i, x in enumerate(ids)],
                                         "doc_id long, ids binary").coalesce(1), "test/wide")
    folder = order.fresh_folder(spark)
    found = order.write_order(rows, folder, width=2, length=16, end=65_001, pad=65_002)
    total = found.count()
    read = list(order.read_from(folder))
    stream = np.concatenate([read[s] for s in order.permute(np.arange(total), total)])
    ends = np.flatnonzero(stream == 65_001)
    got = [stream[a + 1:z].tolist() for a, z in zip([-1, *ends], ends)]
    assert got == ids and all(len(x) == 16 for x in read)


def test_changed_input_fails(spark):
    rows = make(spark, [(i, "x" * i) for i in range(20)]).select("doc_id", F.encode("text", "UTF-8").alias("ids"))
    with pytest.raises(Exception, match="its input changed"):
        order._sequences(rows.coalesce(1), {0: (0, 7)}, 1, 1, 8, order.END, order.PAD).collect()


def test_empty_table(spark):
    folder = order.fresh_folder(spark)
    assert order.document_order(make(spark, [], "none"), folder).count() == 0
    assert list(order.read_from(folder)) == []
