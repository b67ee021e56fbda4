"""Operator 10: token-ID / binary output in training order.

Documents' token ids, an end id after each, are cut into sequences of
``LENGTH`` ids.  Every sequence has a number 0..N-1 (its partition's offset and
its place there); a keyed Feistel permutation with cycle-walking turns the
number into its global slot in training order.  Slots are range-partitioned
into shards; a shard's task writes its sequences, sorted by slot, as one raw
file of fixed stride.  Sequence ``slot`` is therefore at byte (slot mod
shard size) * stride of shard slot / shard size: training reads files from
front to back and resumes at any slot by a seek (``read_from``).

The order needs no sort of random keys, no index and no second copy of the
ids: one shuffle.  Partition counts (one row each) are counted in a first pass
and checked by the second, which fails if the input's partitions changed
between them; the input must be a frame read from files.  A shard is written
under a name of its own and then renamed, so a task that runs again after a
lost executor leaves the same file.

Ids here are the bytes of the text (UTF-8 never has the bytes 0xFE and 0xFF:
they are end and padding); ``write_order`` takes any packed ids.

Defined results: null text is the empty text, an end id alone; an empty table
writes no shard; rows without an id are written, their id is left out of
``doc_ids``.
"""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

#: Ids of a sequence, sequences of a shard, rounds and key of the permutation.
LENGTH, SHARD, ROUNDS, KEY = 2048, 16_384, 6, 0x5EED
END, PAD = 0xFE, 0xFF


def permute(numbers: np.ndarray, n: int, key: int = KEY) -> np.ndarray:
    """A keyed bijection of 0..n-1: balanced Feistel rounds on the next even number of bits,
    walked again while the result is not below n."""
    half = max(1, ((max(n, 2) - 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    keys = np.random.default_rng(key).integers(1, 2**63, ROUNDS, dtype=np.int64).astype(np.uint64)

    def once(x):
        left, right = x >> np.uint64(half), x & mask
        for k in keys:
            mixed = (right ^ k) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
            mixed *= np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ (mixed >> np.uint64(32)) & mask
        return left << np.uint64(half) | right

    out = once(numbers.astype(np.uint64))
    while len(outside := np.flatnonzero(out >= n)):
        out[outside] = once(out[outside])
    return out.astype(np.int64)


def filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


def _shard_path(folder: str, shard: int) -> str:
    return f"{folder}/shard-{shard:08d}.bin"


def _sequences(rows: DataFrame, parts: dict[int, tuple[int, int]], total: int, width: int, length: int,
               end: int, pad: int) -> DataFrame:
    """(slot, shard, n_tokens, doc_ids, ids) of ``rows`` (doc_id, packed ids); the ids zlib-compressed."""
    sent = rows.sparkSession.sparkContext.broadcast(parts)
    stride, mark, filler = length * width, end.to_bytes(width, "little"), pad.to_bytes(width, "little")

    def run(batches):
        part = TaskContext.get().partitionId()
        number, tokens = sent.value.get(part, (0, 0))
        seen, held, docs = 0, bytearray(), []        # docs: (id, its first byte after the held ids)
        for batch in batches:
            out, ids_of, sizes = [], [], []
            for doc_id, ids in zip(batch.column(0).to_pylist(), batch.column(1)):
                docs.append(doc_id)
                held += ids.as_buffer() or b""
                held += mark
                at = 0
                while len(held) - at >= stride:
                    out.append(bytes(held[at:at + stride]))
                    ids_of.append([d for d in docs if d is not None])
                    sizes.append(length)
                    at += stride
                    docs = [doc_id] if len(held) > at else []
                del held[:at]
                seen += len(ids.as_buffer() or b"") // width + 1
            yield _numbered(out, ids_of, sizes, number, total)
            number += len(out)
        if held:
            yield _numbered([bytes(held) + filler * ((stride - len(held)) // width)],
                            [[d for d in docs if d is not None]], [len(held) // width], number, total)
        if seen != tokens:
            raise RuntimeError(f"partition {part} has {seen} ids, counted as {tokens}: its input changed; "
                               "write it as a table first")

    return rows.mapInArrow(run, "slot bigint, shard bigint, n_tokens bigint, doc_ids array<bigint>, ids binary")


def _numbered(out, ids_of, sizes, number, total):
    if number + len(out) > total:
        raise RuntimeError("there are more sequences than were counted: its input changed")
    slots = permute(np.arange(number, number + len(out)), total) if out else np.zeros(0, np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array(slots), pa.array(slots // SHARD), pa.array(sizes, pa.int64()),
         pa.array(ids_of, pa.list_(pa.int64())), pa.array([zlib.compress(x, 1) for x in out], pa.binary())],
        names=["slot", "shard", "n_tokens", "doc_ids", "ids"])


def _write_shards(rows: DataFrame, folder: str, stride: int) -> DataFrame:
    """Writes the sorted slots of each shard; returns where each sequence stands."""
    def run(batches):
        system, root = filesystem(folder)
        open_shard, stream, temporary = None, None, ""

        def close():
            if stream is not None:
                stream.close()
                system.move(temporary, _shard_path(root, open_shard))

        for batch in batches:
            offsets, digests = [], []
            for slot, shard, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(4)):
                if shard != open_shard:
                    close()
                    open_shard = shard
                    temporary = f"{root}/.{uuid.uuid4().hex}"
                    stream = system.open_output_stream(temporary)
                data = zlib.decompress(ids.as_py())
                if len(data) != stride:
                    raise RuntimeError(f"sequence {slot} has {len(data)} bytes")
                offsets.append(slot % SHARD * stride)
                digests.append(hashlib.sha256(data).hexdigest())
                stream.write(data)
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(offsets, pa.int64()), pa.array(digests, pa.string())],
                                             names=["slot", "shard", "n_tokens", "doc_ids", "byte_offset", "sha256"])
        close()

    return rows.mapInArrow(run, "slot bigint, shard bigint, n_tokens bigint, doc_ids array<bigint>, "
                                "byte_offset bigint, sha256 string")


def write_order(rows: DataFrame, folder: str, width: int = 1, length: int = LENGTH, end: int = END,
                pad: int = PAD) -> DataFrame:
    """Writes ``rows`` (doc_id, packed little-endian ids of ``width`` bytes) in training order under
    ``folder``; returns slot, shard, n_tokens, doc_ids, byte_offset, sha256 of each sequence."""
    spark = rows.sparkSession
    key, ids = rows.columns
    held = spark.conf.get("spark.sql.files.minPartitionNum", None)
    # the splits of the two passes must not follow a change in the number of executors
    spark.conf.set("spark.sql.files.minPartitionNum", held or str(spark.sparkContext.defaultParallelism))
    try:
        size = F.coalesce(F.octet_length(ids), F.lit(0)).cast("long") / width
        counts = (rows.select(F.spark_partition_id().alias("part"), (size.cast("long") + 1).alias("n"))
                  .groupBy("part").agg(F.sum("n").alias("n")).collect())      # one row per partition
        parts, total = {}, 0
        for r in sorted(counts):
            parts[r.part] = total, r.n
            total += -(-r.n // length)
        system, root = filesystem(folder)
        system.create_dir(root, recursive=True)
        with system.open_output_stream(f"{root}/order.json") as out:
            out.write(json.dumps({"sequences": total, "length": length, "width": width, "end": end, "pad": pad,
                                  "shard": SHARD, "key": KEY}).encode())
        placed = _sequences(rows.select(F.col(key).cast("long"), F.col(ids)), parts, total, width, length, end, pad)
        shards = max(1, -(-total // SHARD))
        ordered = placed.repartitionById(shards, F.col("shard").cast("int")).sortWithinPartitions("slot")
        found = _write_shards(ordered, folder, length * width)
        at = scratch_path(spark, "training-order-index")
        found.write.parquet(at)                      # the shards are written here, once
    finally:
        if held is None:
            spark.conf.unset("spark.sql.files.minPartitionNum")
    return spark.read.parquet(at)


def read_from(folder: str, slot: int = 0) -> Iterator[np.ndarray]:
    """The sequences from ``slot`` on, in training order: one seek, then sequential reads."""
    system, root = filesystem(folder)
    with system.open_input_file(f"{root}/order.json") as file:
        order = json.loads(file.read())
    stride = order["length"] * order["width"]
    while slot < order["sequences"]:
        with system.open_input_file(_shard_path(root, slot // order["shard"])) as file:
            file.seek(slot % order["shard"] * stride)
            while data := file.read(stride):
                yield np.frombuffer(data, f"<u{order['width']}")
                slot += 1


def document_order(docs: DataFrame, folder: str) -> DataFrame:
    """``docs`` (doc_id, text) as byte ids in training order."""
    return write_order(docs.select("doc_id", F.encode("text", "UTF-8").alias("ids")), folder)


def fresh_folder(spark: SparkSession) -> str:
    return scratch_path(spark, "training-order")
