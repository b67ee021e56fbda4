"""Operator 11: repeated passages by threshold-bounded interval expansion on a Burrows-Wheeler transform.

A byte of a document goes if a string of ``LENGTH`` bytes that covers it also
starts earlier: in a document of a smaller ``doc_id``, or earlier in the same
document.  Suffixes are dealt out so that equal windows (strings of ``LENGTH``
bytes) meet, and each group derives its common prefixes from its transform.

* Chunks.  Documents are packed into compressed chunks, written once as a table bucketed by chunk, so that what
  later steps send back to a chunk moves, and the texts do not.
* Dealing.  A window belongs to the least hash of its ``GRAM``-byte strings; windows next to each other with
  one hash are one segment.  Equal windows have equal hashes.  A chunk sends its distinct hashes to their ranges and
  learns, a few bits each, which of them other chunks hold too; a hash that stands once, in its segment too,
  repeats nothing.
* Groups.  Segments of repeated hashes go to the range of their hash; equal segments become one, at their first
  place, before any sorting.  A hash with more than ``HOT`` segments is dealt by whole windows instead.
* Expansion (``repeat_classes``).  Breadth first: the empty string's interval of the transform is extended
  backward by every byte, each new interval border of length l gives borders of length l + 1, and so common
  prefixes come out by increasing value.  It stops at ``LENGTH``: suffixes without a border between them share
  that many bytes.
* Return.  A segment's first place learns which of its windows start earlier elsewhere.  At every other place
  each window of the segment starts earlier, so these need no answer.

Defined results: null and empty texts have no bytes and lose none; matches
never cross documents; a null ``doc_id`` stands before all others, documents of
one ``doc_id`` by a hash of their text, equal rows in any order; other columns
are ignored; an empty table gives no rows; a text of any length is cut whole.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import whole_groups, written

#: Fixed value: bytes of a window.
LENGTH = 100
#: Parameter: bytes of the strings whose least hash a window belongs to (a power of two).
GRAM = 16
#: Parameter: bytes of text in a chunk; a longer document is a chunk of its own.
CHUNK = 2 << 20
#: Parameter: bytes of text hashed at once, and windows of a segment at most.
PIECE, MOST_WINDOWS = 1 << 18, 256
#: Parameter: bytes of text for each range of hashes, and for each group of segments.
RANGE_BYTES, GROUP_BYTES = 64 << 20, 1 << 17
#: Parameter: segments of one hash that may stand in one group; segments whose answers a task sorts by chunk at once.
HOT, ANSWERS = 1 << 15, 1 << 17

#: A byte that UTF-8 text never holds, behind every segment.
END = 0xFF
PLACE = np.dtype([("known", "u1"), ("id", ">u8"), ("tie", ">u4"), ("chunk", ">u8"), ("doc", ">u4"), ("at", ">u8")])
ANSWER = np.dtype([("doc", "<u4"), ("at", "<u8"), ("n", "<u2")])


# ---------------------------------------------------------------- segments of a chunk

def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def _gram_hashes(text: np.ndarray) -> np.ndarray:
    """A hash of every ``GRAM`` consecutive bytes, by doubling."""
    h, width = (text.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15), 1
    while width < GRAM:
        h = h[:-width] * np.uint64(0xD6E8FEB86659FD93) + (h[width:] ^ (h[width:] >> np.uint64(32)))
        h ^= h >> np.uint64(29)
        width *= 2
    return _mix(h)


def _least(h: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values: of the end of one block and the start of the next."""
    n = len(h)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = h
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, 1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(behind[:n - width + 1], ahead[width - 1:n])


def _again(grams: np.ndarray, least: np.ndarray, cut: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether a segment's least hash stands in it more than once: first in its first window, last in its last one."""
    width = np.arange(LENGTH - GRAM + 1)
    first = np.argmax(grams[cut[:, None] + width] == least[cut][:, None], axis=1)
    end = cut + size - 1 + width[-1]
    last = np.argmax(grams[end[:, None] - width] == least[cut][:, None], axis=1)
    return cut + first != end - last


def segments(text: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """(hash, start, windows, sides, again) of the segments of documents that end at ``ends``; ``sides`` tells segments
    of one hash apart, up to chance; ``again``: its windows may repeat within the segment."""
    inside = np.zeros(len(text) + 1, np.int32)                   # windows that cross a document's end are outside
    np.add.at(inside, np.maximum(ends - (LENGTH - 1), np.concatenate([[0], ends[:-1]])), 1)
    np.add.at(inside, ends, -1)
    inside = np.cumsum(inside[:-1]) == 0
    out: list[tuple] = []
    for at in range(0, len(text) - LENGTH + 1, PIECE):
        piece = text[at:at + PIECE + LENGTH - 1]
        grams = _gram_hashes(piece)
        least = _least(grams, LENGTH - GRAM + 1)
        valid = inside[at:at + len(least)]
        cut = np.flatnonzero(np.concatenate([[True], (least[1:] != least[:-1]) | (valid[1:] != valid[:-1])]))
        size = np.diff(np.append(cut, len(least)))
        cut, size = cut[valid[cut]], size[valid[cut]]
        parts = -(-size // MOST_WINDOWS)                         # a long run of one hash is several segments
        nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        cut = np.repeat(cut, parts) + nth * MOST_WINDOWS
        size = np.minimum(np.repeat(size, parts) - nth * MOST_WINDOWS, MOST_WINDOWS)
        sides = grams[cut] * np.uint64(3) + grams[cut + size + LENGTH - 1 - GRAM] + size.astype(np.uint64)
        out.append((_mix(least[cut]), cut + at, size, sides, _again(grams, least, cut, size)))
    if not out:
        return tuple(np.empty(0, kind) for kind in (np.uint64, np.int64, np.int64, np.uint64, bool))
    return tuple(np.concatenate(c) for c in zip(*out))


def _range(h: np.ndarray, n: int) -> np.ndarray:
    """Range of a hash among ``n``; increasing with the hash."""
    return ((h >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


class Chunk:
    """A chunk's documents, in order, and its segments."""

    def __init__(self, number: int, ids: list, sizes: list, body: bytes):
        self.number, self.ids = number, ids
        self.text = np.frombuffer(zstandard.decompress(body, max_output_size=sum(sizes)) if sum(sizes) else b"", np.uint8)
        self.ends = np.cumsum(np.array(sizes, np.int64))
        self.starts = self.ends - np.array(sizes, np.int64)
        self.hash, self.start, self.size, self.sides, self.again = segments(self.text, self.ends)
        self.distinct, self.of = np.unique(self.hash, return_inverse=True)

    def counts(self) -> np.ndarray:
        """Different segments of each distinct hash."""
        _, one_of_each = np.unique(_mix(self.hash ^ self.sides), return_index=True)
        return np.bincount(self.of[one_of_each], minlength=len(self.distinct))

    def dealt(self, marks: list, n_ranges: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hash, start, windows) of the segments that take part: those of a hash that stands elsewhere too, or again
        in the segment; those of a hot hash as single windows."""
        per_range = np.bincount(_range(self.distinct, n_ranges), minlength=n_ranges)
        found = sorted((m["range"], m["bits"]) for m in marks or [])
        bits = [np.unpackbits(np.frombuffer(b, np.uint8), count=2 * per_range[r]).reshape(-1, 2) for r, b in found]
        marked = np.concatenate(bits) if bits else np.zeros((0, 2), np.uint8)
        if len(marked) != len(self.distinct):
            raise RuntimeError(f"chunk {self.number}: {len(marked)} marks for {len(self.distinct)} hashes")
        repeated = (marked[:, 0] | (np.bincount(self.of, minlength=len(self.distinct)) > 1)).astype(bool)[self.of] | self.again
        hot = marked[:, 1].astype(bool)[self.of]
        plain = repeated & ~hot
        single = np.repeat(self.start[hot], self.size[hot])
        single += np.arange(len(single)) - np.repeat(np.cumsum(self.size[hot]) - self.size[hot], self.size[hot])
        of_windows = np.fromiter((xxhash.xxh3_64_intdigest(self.text[s:s + LENGTH]) for s in single), np.uint64, len(single))
        return (np.concatenate([self.hash[plain], of_windows]), np.concatenate([self.start[plain], single]),
                np.concatenate([self.size[plain], np.ones(len(single), np.int64)]))

    def first_of_equals(self, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether a segment is the first of its content in this chunk."""
        seen: set[bytes] = set()
        text, first = self.text.tobytes(), np.zeros(len(start), bool)
        for i in np.argsort(start, kind="stable").tolist():
            content = text[start[i]:start[i] + size[i] + LENGTH - 1]
            if content not in seen:
                seen.add(content)
                first[i] = True
        return first

    def places(self, start: np.ndarray) -> np.ndarray:
        """Sortable places of segments: earlier ones sort first, over all chunks."""
        doc = np.searchsorted(self.ends, start, side="right")
        some, of = np.unique(doc, return_inverse=True)
        out = np.empty(len(some), PLACE)
        for row, d in zip(out, some.tolist()):
            tie = xxhash.xxh32_intdigest(self.text[self.starts[d]:self.ends[d]])
            row["known"], row["id"], row["tie"] = self.ids[d] is not None, (self.ids[d] or 0) + (1 << 63), tie
        out = out[of]
        out["chunk"], out["doc"], out["at"] = self.number, doc, start - self.starts[doc]
        return out


# ---------------------------------------------------------------- suffixes of a group

def _suffix_order(text: np.ndarray) -> np.ndarray:
    """Suffixes by their first 128 bytes: sorted by eight bytes, then ties by doubling."""
    n = len(text)
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    key = np.zeros(n, np.uint64)
    for k in range(8):
        key = key << np.uint64(8) | padded[k:k + n]
    order = np.argsort(key).astype(np.int32)                     # a group has far fewer bytes than 2**31
    key = key[order]
    first = np.concatenate([[True], key[1:] != key[:-1]])
    rank = np.empty(n + 1, np.int32)
    rank[n] = -1
    at = np.flatnonzero(first).astype(np.int32)
    rank[order] = np.repeat(at, np.diff(np.append(at, n)))
    width, tied = 8, np.flatnonzero(~(first & np.append(first[1:], True))).astype(np.int32)
    while width < LENGTH and len(tied):
        suffix = order[tied]
        key = rank[suffix].astype(np.int64) << 32 | rank[np.minimum(suffix + width, n)] + 1
        by = np.argsort(key)
        suffix, key = suffix[by], key[by]
        order[tied] = suffix
        first = np.concatenate([[True], key[1:] != key[:-1]])
        at = np.flatnonzero(first)
        rank[suffix] = np.repeat(tied[at], np.diff(np.append(at, len(tied))))
        tied = tied[~(first & np.append(first[1:], True))]
        width *= 2
    return order


def repeat_classes(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(suffixes in order, class of each): suffixes of one class share their first ``LENGTH`` bytes.

    ``text`` is segments, each followed by ``END``; classes of suffixes that reach an ``END`` mean nothing.  A border
    stands between neighbours that differ.  Two neighbours that start with c come from consecutive occurrences p < q of
    c in the transform; if a border of length l lies in (p, q], extending backward by c gives one of length l + 1.
    Where q follows p at once, the border at q alone decides, so later rounds touch little but the new borders."""
    order = _suffix_order(text)
    n = len(order)
    before = text[order - 1]                                     # the transform
    occurrence = np.argsort(before, kind="stable").astype(np.int32)
    same = (before[occurrence[1:]] == before[occurrence[:-1]]) & (before[occurrence[1:]] != END)
    border = np.ones(n, bool)
    border[1:] = ~same                                           # strings of one byte
    at = np.flatnonzero(same).astype(np.int32) + 1
    p, q = occurrence[at - 1], occurrence[at]
    near = q == p + 1
    extended = np.full(n, -1, np.int32)                          # where a border goes if the bytes beside it are equal
    extended[q[near]] = at[near]
    p, q, at = p[~near], q[~near], at[~near]
    new = np.flatnonzero(border)[1:].astype(np.int32)
    for _ in range(1, LENGTH):
        found = extended[new]
        found = found[found >= 0]
        if len(p):
            if 16 * len(p) > n:
                passed = np.zeros(n, np.int32)
                passed[new] = 1
                passed = np.cumsum(passed, dtype=np.int32)
                split = passed[q] > passed[p]
            else:
                new.sort()
                split = np.searchsorted(new, q, side="right") > np.searchsorted(new, p, side="right")
            found = np.concatenate([found, at[split]])
            p, q, at = p[~split], q[~split], at[~split]
        if not len(found):
            break
        border[found] = True
        new = found
    return order, np.cumsum(border, dtype=np.int32)


def _runs(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers of the runs, one after another."""
    return np.arange(size.sum()) + np.repeat(start - (np.cumsum(size) - size), size)


def starts_earlier(contents: list[bytes], places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(windows of each segment, which of them start earlier, here or in another one: all segments' one after another)."""
    size = np.array([len(c) + 1 for c in contents], np.int32)
    text = np.frombuffer(b"\xff".join(contents) + b"\xff", np.uint8)
    order, kind = repeat_classes(text)
    nth = np.empty(len(contents), np.int64)
    nth[np.argsort(places, kind="stable")] = np.arange(len(contents))
    begin = np.cumsum(size) - size
    offset = np.arange(len(text), dtype=np.int32) - np.repeat(begin.astype(np.int32), size)
    held = (offset + LENGTH < np.repeat(size, size))[order]      # windows, not the ends of segments
    place = np.repeat(nth * (MOST_WINDOWS + 1), size) + offset
    order, kind = order[held], kind[held]
    runs = np.flatnonzero(np.concatenate([[True], kind[1:] != kind[:-1]]))
    earliest = np.minimum.reduceat(place[order], runs)
    later = np.zeros(len(text), bool)
    later[order] = place[order] != np.repeat(earliest, np.diff(np.append(runs, len(order))))
    return size - LENGTH, later[_runs(begin, size - LENGTH)]


# ---------------------------------------------------------------- the job

def _chunks(docs: DataFrame) -> DataFrame:
    """(chunk, ids, sizes, body): documents packed by bytes, as a table bucketed by chunk."""
    spark = docs.sparkSession
    arrow = pa.schema([("chunk", pa.int64()), ("ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())),
                       ("body", pa.binary())])

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, size = TaskContext.get().partitionId() << 33, [], 0

        def packed() -> pa.RecordBatch:
            held.sort(key=lambda d: (d[0] is not None, d[0] or 0, xxhash.xxh32_intdigest(d[1])))
            body = zstandard.ZstdCompressor(level=3).compress(b"".join(t for _, t in held))
            return pa.RecordBatch.from_arrays([pa.array([number]), pa.array([[i for i, _ in held]], pa.list_(pa.int64())),
                                               pa.array([[len(t) for _, t in held]], pa.list_(pa.int64())),
                                               pa.array([body], pa.binary())], schema=arrow)

        for batch in batches:
            for number_of, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                doc = (number_of, text.as_py() or b"")
                if held and size + len(doc[1]) > CHUNK:
                    yield packed()
                    number, held, size = number + 1, [], 0
                held.append(doc)
                size += len(doc[1])
        if held:
            yield packed()

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"tessera_chunks_{uuid.uuid4().hex}"
    (rows.mapInArrow(pack, "chunk long, ids array<long>, sizes array<long>, body binary").repartition(n, "chunk")
     .write.bucketBy(n, "chunk").option("path", scratch_path(spark, "suffixes/chunks")).saveAsTable(name))
    chunks = spark.table(name)
    chunks.schema                                                # the frame keeps its files and buckets without the name
    spark.sql(f"DROP TABLE {name}")
    return chunks


def _opened(batch: pa.RecordBatch) -> Iterator[Chunk]:
    for row in range(len(batch)):
        yield Chunk(*(batch.column(c)[row].as_py() for c in ("chunk", "ids", "sizes", "body")))


def _marks(chunks: DataFrame, n_ranges: int) -> DataFrame:
    """(chunk, range, bits): for each distinct hash of the chunk, in order, whether another chunk holds it and whether
    it is hot."""
    hashes_schema = pa.schema([("chunk", pa.int64()), ("range", pa.int64()), ("hashes", pa.binary()), ("counts", pa.binary())])
    marks_schema = pa.schema([("chunk", pa.int64()), ("range", pa.int64()), ("bits", pa.binary())])

    def hashes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in _opened(batch):
                counts = np.minimum(chunk.counts(), np.iinfo(np.uint16).max).astype(np.uint16)
                at = _range(chunk.distinct, n_ranges)
                cuts = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]])) if len(at) else []
                parts = [(chunk.number, int(at[a]), chunk.distinct[a:b].tobytes(), counts[a:b].tobytes())
                         for a, b in zip(cuts, [*cuts[1:], len(at)])]
                if parts:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*parts), hashes_schema)],
                                                     schema=hashes_schema)

    def mark(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in whole_groups(batches, "range"):
            blobs = group.column("hashes").to_pylist()
            counts = np.frombuffer(b"".join(group.column("counts").to_pylist()), np.uint16).astype(np.int64)
            _, of, chunks_of = np.unique(np.frombuffer(b"".join(blobs), np.uint64), return_inverse=True, return_counts=True)
            hot = np.bincount(of, weights=counts) > HOT
            bits = np.stack([chunks_of[of] > 1, hot[of]], axis=1)
            ends = np.cumsum([len(b) // 8 for b in blobs])
            out = [np.packbits(bits[a:b]).tobytes() for a, b in zip([0, *ends[:-1]], ends)]
            yield pa.RecordBatch.from_arrays([group.column("chunk").combine_chunks(), group.column("range").combine_chunks(),
                                              pa.array(out, pa.binary())], schema=marks_schema)

    dealt = chunks.mapInArrow(hashes, "chunk long, range long, hashes binary, counts binary").repartition("range")
    return dealt.sortWithinPartitions("range").mapInArrow(mark, "chunk long, range long, bits binary")


def _met(chunks: DataFrame, rows: DataFrame, name: str, *cols: str) -> DataFrame:
    """Chunks with the list of the rows sent back to them; the texts stay in their buckets, unsorted."""
    lists = rows.groupBy("chunk").agg(F.collect_list(F.struct(*cols)).alias(name))
    return chunks.join(lists.hint("shuffle_hash"), "chunk", "left")


def _each(table: pa.Table, key: str) -> Iterator[pa.Table]:
    """The table's groups one by one."""
    keys = table.column(key).to_numpy()
    cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
    for a, b in zip(cuts, cuts[1:]):
        yield table.slice(a, b - a)


def _answers(marked: DataFrame, n_ranges: int, n_groups: int) -> DataFrame:
    """(chunk, at, bits): the first places of segments, and which of their windows start earlier elsewhere."""
    segment_schema = pa.schema([("group", pa.int64()), ("content", pa.binary()), ("place", pa.binary())])
    answer_schema = pa.schema([("chunk", pa.int64()), ("at", pa.binary()), ("bits", pa.binary())])

    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, chunk in enumerate(_opened(batch)):
                h, start, size = chunk.dealt(batch.column("marks")[row].as_py(), n_ranges)
                first = chunk.first_of_equals(start, size)
                h, start, size = h[first], start[first], size[first]
                text, places = chunk.text.tobytes(), chunk.places(start).tobytes()
                content = [text[s:e] for s, e in zip(start.tolist(), (start + size + LENGTH - 1).tolist())]
                place = [places[i:i + PLACE.itemsize] for i in range(0, len(places), PLACE.itemsize)]
                yield pa.RecordBatch.from_arrays([pa.array(_range(h, n_groups)), pa.array(content, pa.binary()),
                                                  pa.array(place, pa.binary())], schema=segment_schema)

    def by_chunk(held: list[tuple]) -> pa.RecordBatch:
        places, n, later = (np.concatenate(c) for c in zip(*held))
        start = np.cumsum(n) - n
        order = np.argsort(places["chunk"], kind="stable")
        chunk = places["chunk"][order]
        cuts = np.flatnonzero(np.concatenate([[True], chunk[1:] != chunk[:-1]])).tolist()
        out = []
        for a, b in zip(cuts, [*cuts[1:], len(chunk)]):
            some = order[a:b]
            at = np.empty(b - a, ANSWER)
            at["doc"], at["at"], at["n"] = places["doc"][some], places["at"][some], n[some]
            out.append((int(chunk[a]), at.tobytes(), np.packbits(later[_runs(start[some], n[some])]).tobytes()))
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), answer_schema)],
                                          schema=answer_schema)

    def expand(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for group in (one for table in whole_groups(batches, "group") for one in _each(table, "group")):
            places = np.frombuffer(b"".join(group.column("place").to_pylist()), PLACE)
            keys = np.frombuffer(places.tobytes(), f"S{PLACE.itemsize}")
            held.append((places, *starts_earlier(group.column("content").to_pylist(), keys)))
            if sum(len(h[0]) for h in held) >= ANSWERS:
                yield by_chunk(held)
                held = []
        if held:
            yield by_chunk(held)

    return (marked.mapInArrow(deal, "group long, content binary, place binary").repartition("group")
            .groupBy("group", "content").agg(F.min("place").alias("place")).sortWithinPartitions("group")
            .mapInArrow(expand, "chunk long, at binary, bits binary"))


def _removed(chunk: Chunk, marks: list, answers: list, n_ranges: int) -> np.ndarray:
    """Which bytes of the chunk go."""
    _, start, size = chunk.dealt(marks, n_ranges)
    flags = np.zeros(len(chunk.text) + 1, np.int64)
    np.add.at(flags, start, 1)
    np.add.at(flags, start + size, -1)
    later = np.cumsum(flags)[:-1] > 0                            # every window of a dealt segment, but for the answers
    for answer in answers or []:
        at = np.frombuffer(answer["at"], ANSWER)
        first, n = chunk.starts[at["doc"]] + at["at"].astype(np.int64), at["n"].astype(np.int64)
        where = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
        later[where] = np.unpackbits(np.frombuffer(answer["bits"], np.uint8), count=len(where))
    passed = np.concatenate([np.zeros(LENGTH, np.int64), np.cumsum(later)])
    return passed[LENGTH:] > passed[:-LENGTH]


def deduplicated(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, kept, spans): the bytes that stay (binary, for a cut may part a character) and the maximal
    removed runs (start, length)."""
    schema = "doc_id long, n_bytes long, kept binary, spans array<struct<start: long, length: long>>"
    span = pa.struct([("start", pa.int64()), ("length", pa.int64())])
    arrow = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("kept", pa.binary()), ("spans", pa.list_(span))])
    chunks = _chunks(docs)
    n_bytes = chunks.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] or 0
    n_ranges, n_groups = (1 + n_bytes // b for b in (RANGE_BYTES, GROUP_BYTES))
    n_ranges = max(n_ranges, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    marks = written(_marks(chunks, n_ranges), "suffixes/marks")
    marked = _met(chunks, marks, "marks", "range", "bits")
    answers = _answers(marked, n_ranges, n_groups)

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, chunk in enumerate(_opened(batch)):
                gone = _removed(chunk, *(batch.column(c)[row].as_py() for c in ("marks", "answers")), n_ranges)
                out = []
                for doc, a, b in zip(chunk.ids, chunk.starts.tolist(), chunk.ends.tolist()):
                    edges = np.flatnonzero(np.diff(np.concatenate([[0], gone[a:b].view(np.int8), [0]])))
                    out.append((doc, b - a, chunk.text[a:b][~gone[a:b]].tobytes(),
                                [{"start": int(s), "length": int(e - s)} for s, e in zip(edges[::2], edges[1::2])]))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), arrow)], schema=arrow)

    return _met(marked, answers, "answers", "at", "bits").mapInArrow(cut, schema)


def removed_digests(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every document."""
    return deduplicated(docs).select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


#: DuckDB SQL of the registered query, for a table without null or repeated ids: every window of every text.
REMOVED_SQL = """
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS raw FROM documents),
w AS (SELECT doc_id, unnest(range(octet_length(raw) - 99)) AS s, raw FROM d WHERE octet_length(raw) >= 100),
v AS (SELECT doc_id, s, row_number() OVER (PARTITION BY raw[s + 1 : s + 100] ORDER BY doc_id, s) > 1 AS later FROM w),
r AS (SELECT doc_id, s, s - coalesce(lag(s) OVER (PARTITION BY doc_id ORDER BY s), -200) > 100 AS fresh FROM v WHERE later),
n AS (SELECT doc_id, s, sum(fresh::INT) OVER (PARTITION BY doc_id ORDER BY s) AS run FROM r),
runs AS (SELECT doc_id, min(s) AS a, max(s) + 100 AS b, run FROM n GROUP BY doc_id, run),
cuts AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM runs),
g AS (SELECT doc_id, count(*) AS n_spans, sum(b - a)::BIGINT AS n_removed, max(b) AS last,
             list([before, a] ORDER BY a) AS parts FROM cuts GROUP BY doc_id)
SELECT d.doc_id, octet_length(raw)::BIGINT AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(array_to_string(list_transform(parts, lambda p: hex(raw[p[1] + 1 : p[2]])), ''), '')
              || hex(raw[coalesce(last, 0) + 1 : octet_length(raw)]))) AS kept_sha256
FROM d LEFT JOIN g USING (doc_id)
"""
