"""Operator 7: exact base scores and counts; coding as a probability; held-out gain."""

import math
import os
import random
import re
import time
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tessera.llm import context_mixing as cm

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
SCHEMA = "doc_id long, text string, chunk long, c long"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER)) + ["\n"]


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 10 == 0


def make(spark, rows):
    return spark.createDataFrame([(*r, 1, 1) for r in rows], SCHEMA).repartition(3)


def check(spark, rows):
    got = cm.score_documents(make(spark, rows)).collect()
    assert len(got) == len(rows)
    count = Counter(t for d, text in rows if d is not None and not held(d) for t in plain_tokens(text))
    n, v = sum(count.values()), len(count)
    want = sorted(((d, held(d), len(plain_tokens(t)), sum(count[x] > 0 for x in plain_tokens(t)), n,
                    sum(math.log10((count[x] + 0.1) / (n + 0.1 * (v + 1))) for x in plain_tokens(t)))
                   for d, t in rows), key=str)
    key = lambda r: str((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)))
    for r, w in zip(sorted(got, key=key), sorted(want, key=lambda w: str((*w[:5], round(w[5], 6))))):
        assert tuple(r)[:5] == w[:5] and r.base_score == pytest.approx(w[5])
        assert r.score < 0 and r.bits_per_byte > 0
    return got


def prose(rng, n, alphabet="abcdefghij"):
    stock = ["".join(rng.choices(alphabet, k=rng.randint(2, 8))) for _ in range(300)]
    return lambda: " ".join(rng.choices(stock, weights=[1 / (i + 1) for i in range(300)], k=rng.randint(1, n)))


def test_counts_base_and_edges(spark, monkeypatch):
    monkeypatch.setattr(cm, "CHUNK_WORDS", 200)
    monkeypatch.setattr(cm, "SLICE", 70)
    rng = random.Random(1)
    say = prose(rng, 60)
    rows = [(i, say()) for i in range(250)]
    rows += [(1000, None), (1001, ""), (1002, " \t\n"), (1003, "x" * 5000), (1004, "A a É é\x85b \x1c"),
             (1005, "word " * 30_000), (None, "no id here"), (7, "again"), (7, "again"), (1006, "日本語 テスト 日本語")]
    check(spark, rows)


def test_held_out_text_is_coded_better(spark):
    rng = random.Random(2)
    english, german = prose(rng, 200), prose(rng, 200, "klmnopßü")
    rows = [(i, (german if i % 3 == 0 else english)()) for i in range(900)]
    got = [r for r in check(spark, rows) if r.held_out]
    assert len(got) > 50
    assert sum(r.score for r in got) > sum(r.base_score for r in got)
    assert sum(r.score > r.base_score for r in got) > 0.8 * len(got)


def test_reruns_agree(spark):
    rng = random.Random(3)
    say = prose(rng, 40)
    rows = [(i, say()) for i in range(80)]
    docs = make(spark, rows)
    a, b = ({r.doc_id: r.score for r in cm.score_documents(docs).collect()} for _ in range(2))
    assert a == pytest.approx(b)


def test_nothing_to_learn_from(spark):
    rows = [(i, f"held {i}") for i in range(200) if held(i)] + [(None, "not learnt")]
    for r in cm.score_documents(make(spark, rows)).collect():
        assert r.train_tokens == 0 and r.n_known == 0
        assert r.bits_per_byte == pytest.approx(8, rel=0.02)


def test_empty_table(spark):
    assert cm.score_documents(spark.createDataFrame([], SCHEMA)).count() == 0


def test_shared_beginnings_change_nothing():
    rng = random.Random(4)
    tokens = sorted({"".join(rng.choices("ab", k=rng.randint(1, 50))).encode() for _ in range(300)} | {cm.END})
    edges, single = cm.Edges(tokens), [cm.Edges([t]) for t in tokens]
    value = lambda e: sum(s * (i + 1) for i, s in enumerate(e.slots)) % 1009 + e.bit
    assert np.allclose(edges.of_tokens(value(edges).astype(float)), [value(e).sum() for e in single])
    counts = np.array([rng.randint(0, 5) for _ in tokens])
    weight = edges.of_edges(counts)
    assert (weight * value(edges)).sum() == sum(c * value(e).sum() for c, e in zip(counts, single))


def test_coding_is_a_probability():
    """Of all continuations of a byte string the coded probabilities add up to one."""
    rng = np.random.default_rng(5)
    zeros, ones = rng.integers(0, 9, (2, cm._OFFSETS[-1])).astype(np.float32)
    weights = cm._start() + rng.normal(0, 0.1, (cm.GATES, cm.INPUTS))
    tokens = sorted(bytes([97, b]) for b in range(256) if b != 0x0A)
    edges = cm.Edges(tokens)
    x, gate = cm._inputs(edges, zeros, ones)
    p = cm._squash(np.einsum("ij,ij->i", x, weights[gate]))
    logs = np.log(np.where(edges.bit == 1, p, 1 - p)).reshape(-1, 8).sum(axis=1)
    total = 0.0
    for i, t in enumerate(tokens):                   # the edge of the second byte
        at = edges.first[i] + (1 - edges.shared[i])
        total += math.exp(logs[at]) if edges.shared[i] <= 1 else 0.0
    assert 0.9 < total <= 1.0 + 1e-6


def test_shuffled_words_are_coded_worse(spark):
    """The order of a text's words counts: contexts reach across tokens."""
    rng = random.Random(6)
    stock = ["".join(rng.choices("abcdefghij", k=rng.randint(3, 8))) for _ in range(200)]
    after = {w: rng.sample(stock, 3) for w in stock}

    def chain(n):
        out = [rng.choice(stock)]
        while len(out) < n:
            out.append(rng.choice(after[out[-1]]))
        return out

    rows, mixed = [], {}
    for i in range(0, 1200, 2):
        words = chain(60)
        rows.append((i, " ".join(words)))
        if held(i):
            rng.shuffle(words)
            number = next(n for n in range(100_000 + 1000 * i, 101_000 + 1000 * i) if held(n))
            mixed[i] = number
            rows.append((number, " ".join(words)))
    got = {r.doc_id: r for r in cm.score_documents(make(spark, rows)).collect()}
    assert len(mixed) > 40
    for i, j in mixed.items():
        assert got[i].base_score == pytest.approx(got[j].base_score)
        assert got[i].score > got[j].score + 5


def test_stream_tables_are_sent_compressed(spark, monkeypatch):
    """Every executor keeps what is broadcast on its disk: the stream's tables go as compressed blocks."""
    sizes = []
    broadcast = type(spark.sparkContext).broadcast

    def noted(self, value):
        sizes.append(len(value) if isinstance(value, bytes) else sum(
            x.nbytes for x in (value if isinstance(value, tuple) else (value,)) if hasattr(x, "nbytes")))
        return broadcast(self, value)

    monkeypatch.setattr(type(spark.sparkContext), "broadcast", noted)
    # two tables of the vocabulary's bits, sent twice, of this size
    fixed = 2 * 4 * int(cm._OFFSETS[-1])
    rng = random.Random(4)
    docs = spark.createDataFrame([(i, " ".join(rng.choices("the of and to in is".split(), k=30))) for i in range(40)],
                                 "doc_id long, text string")
    monkeypatch.setattr(cm, "table_bits", lambda n_bytes: 18)
    assert cm.score_documents(docs).where("score < 0").count() == 40
    whole = cm.PREDICTORS * (2 << 18) * 2
    assert len([s for s in sizes if s >= fixed]) == 2 and all(s < whole / 4 for s in sizes if s < fixed)


def stream_of(texts):
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    return [batch], next(iter(cm._streams([batch], 1 << 30)))


def test_half_bytes_are_counted_and_give_every_bit():
    """A task counts half bytes, 16 counts a context; the tables of bits that they give are those of
    counting each bit of every predictor."""
    rng = random.Random(3)
    texts = ["".join(rng.choices("aab ż本e\t", k=rng.randint(0, 400))) for _ in range(30)] + [None, ""] + ["the cat "] * 40
    batches, stream = stream_of(texts)
    bits = 16
    blocks = [(block, data) for b in cm._count_stream(bits)(batches) for block, data in zip(*b.to_pydict().values())]
    assert sum(cm._unpacked(data).size for _, data in blocks) <= cm.PREDICTORS << bits
    assert sum(int(cm._unpacked(data).sum()) for _, data in blocks) == 2 * cm.PREDICTORS * len(stream.data)
    plain = np.zeros((cm.PREDICTORS, 1 << bits, 2), np.int64)
    for table, slots in zip(plain, stream.slots(0, len(stream.data), bits)):
        np.add.at(table, (slots, stream.bits(0, len(stream.data))), 1)
    assert (cm._stream_tables(blocks, bits) == plain).all()


def test_counts_beyond_16_bits_keep_their_proportion():
    counts = np.zeros(cm.BLOCK, np.uint32)
    counts[16 + 3], counts[16 + 12] = 300_000, 100_000          # half bytes 0011 and 1100 of one context
    table = cm._stream_tables([(0, cm._packed(counts))], 16)[0]
    assert table[16 + 1].tolist() == [65_535, 21_845]
    assert table[16 + 2].tolist() == [65_535, 0] and table[16 + 3].tolist() == [0, 65_535]
    assert table[:16].sum() == 0 and table[32:].sum() == 0


def test_mixer_is_the_plain_one():
    """Windows of bits, one bit and one weight at a time."""
    rng = np.random.default_rng(5)
    n, width = 300, cm.PREDICTORS + 1
    x = rng.normal(0, 2, (n, width)).astype(np.float32)
    gate, bit = rng.integers(0, cm.STREAM_GATES, n), rng.integers(0, 2, n).astype(np.uint8)
    mixer = cm.Mixer()
    got = np.concatenate([mixer.code(x[i:i + 100], gate[i:i + 100], bit[i:i + 100]) for i in range(0, n, 100)])
    weights, sure, plain = np.full((cm.STREAM_GATES, width), 0.2), np.full((cm.STREAM_GATES, width), 200.0), []
    for i in range(0, n, 100):
        push = np.zeros_like(weights)
        for t in range(i, i + 100):
            row = [float(v) for v in x[t]]
            p = 1 / (1 + np.exp(-min(18, max(-18, sum(v * w for v, w in zip(row, weights[gate[t]]))))))
            plain.append(p)
            for j in range(width):
                push[gate[t], j] += (bit[t] - p) * row[j]
                sure[gate[t], j] += max(p * (1 - p), 1e-3) * sum(map(abs, row)) * abs(row[j])
        weights += push / sure
    assert np.allclose(got, plain, rtol=1e-9) and np.allclose(mixer.weights, weights, rtol=1e-9)


def test_learning_holds_no_slot_of_every_bit():
    """A half byte's slots are fetched together: a piece takes 112 bytes a bit, 148 with nine slots a bit."""
    rng = random.Random(7)
    batches, stream = stream_of(["".join(rng.choices("abcdefgh ", k=cm.LEARNT_BYTES))])
    tables = cm._stream_tables([(block, data) for b in cm._count_stream(16)(batches)
                                for block, data in zip(*b.to_pydict().values())], 16)
    sent = type("Sent", (), {"value": tables})
    n = 8 * cm.LEARNT_BYTES
    tracemalloc.start()
    try:
        assert len(list(cm._learn_stream(sent, 16)(batches))) == 1
        assert tracemalloc.get_traced_memory()[1] < 128 * n
    finally:
        tracemalloc.stop()


def test_inputs_are_the_plain_ones():
    """Counts of each bit's own slots, with and without the bit itself; gates of the contexts seen."""
    rng = random.Random(8)
    batches, stream = stream_of(["".join(rng.choices("aab be\t", k=300)) for _ in range(20)])
    tables = cm._stream_tables([(block, data) for b in cm._count_stream(16)(batches)
                                for block, data in zip(*b.to_pydict().values())], 16)
    _, other = stream_of(["a new text, be bab " * 9])
    for of, without in ((stream, 1), (stream, 0), (other, 0)):
        a, z = 5, len(of.data) - 3
        bit, x, gate = cm._stream_inputs(tables, of, a, z, 16, without)
        assert (bit == of.bits(a, z)).all() and (x[:, -1] == np.float32(0.3)).all()
        seen = []
        for i, slots in enumerate(of.slots(a, z, 16)):
            n = tables[i][slots].astype(int)
            n[np.arange(len(bit)), bit] -= without
            assert n.min() >= 0 and np.allclose(x[:, i], np.log((n[:, 1] + 0.2) / (n[:, 0] + 0.2)), atol=1e-5)
            seen.append(n.sum(axis=1))
        far, words = np.array(seen[:6]), np.array(seen[6:])
        assert (gate == (far > 0).sum(axis=0) * 7 + (words > 0).sum(axis=0) + (words > 20).sum(axis=0)).all()


def test_ended_steps_leave_no_shuffle_files(spark, monkeypatch):
    """Disk: what the vocabulary and the stream's counts were shuffled through goes as each step ends, not
    when the driver collects its garbage."""
    def files():
        every = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles().mkString("\n")
        return {f for f in every.split("\n") if f.endswith(".data") and os.path.exists(f)}

    made, write = {}, cm.written

    def noted(df, purpose):
        had = files()
        out = write(df, purpose)
        made[purpose] = files() - had
        return out

    monkeypatch.setattr(cm, "written", noted)
    setting, say = spark.conf.get(CLEANUP, "false"), prose(random.Random(9), 40)
    scored = cm.score_documents(make(spark, [(i, say()) for i in range(60)]))
    assert spark.conf.get(CLEANUP, "false") == setting
    stay = lambda: [f for step in ("vocabulary", "blocks") for f in made.get(f"lm/{step}", ()) if os.path.exists(f)]
    for _ in range(100):                             # Spark removes them on another thread
        if not stay():
            break
        time.sleep(0.1)
    assert not stay() and {"lm/vocabulary", "lm/blocks"} <= set(made)
    assert scored.where("score < 0").count() == 60   # and nothing that is needed went


def test_a_worker_keeps_no_blocks_beside_the_tables(spark):
    """Memory: the compressed blocks are let go once a worker has unpacked them."""
    counts = np.zeros(cm.BLOCK, np.uint32)
    counts[5] = 7
    sent = cm.ship(spark, [(0, cm._packed(counts))])
    tables = cm._Tables(sent, 16)
    assert tables.value is tables.value and tables.value.sum() == 4 * 7
    assert "_value" not in vars(sent)
