"""Operator 7: LM scoring by online logistic context mixing.

A text is its tokens: words (A-Z lower-cased), each ended by a space, and one
end token; its stream is the bytes of its tokens in order.  Predictors, each
with the hash of another context (the last 1 to 6 bytes across token borders,
and the word so far with none, one and two words before it), give the next
bit's probability from what all training texts have after the context.  Their
logits are combined by weights that a gate selects (how long the longest known
contexts are).  The weights are learnt online over the training texts, each bit
predicted without itself, and go on learning within each document, in order,
after every ``WINDOW`` bits.

A token's probability mixes this with a second one, by how well each has done
on the document's tokens before it.  The second is the token's discounted
count, overall and in each of ``KINDS`` kinds of documents (by their commonest
non-ASCII character); what is taken off goes to a coding of the token alone:
bits predicted from the last 0 to 4 bytes of the token and all of them so far,
learnt from the training vocabulary and refined.  A text is adaptively weighted
between the kinds.  The sum gives the text's log probability and bits per byte.

1. Documents are cut into chunks of at most ``CHUNK_WORDS`` distinct tokens (or
   one document).  A chunk keeps its token list with training counts, and each
   document's token numbers in order; both are written to the shared folder.
2. Token counts are summed over chunks: the vocabulary, with the counts of the
   base score.  It grows with the corpus and is never in one place.
3. Predictor tables of the vocabulary (``BITS``) and of the training texts'
   streams are counted by tasks (the stream's by half bytes, of which the bits'
   counts are sums), merged and broadcast.  The stream's tables grow with the
   training text up to 2 ** ``MOST_BITS`` slots a predictor; beyond, contexts
   share slots.  Weights are learnt in every partition over all its tokens and
   bits and joined by their certainty.
4. Every token is coded once; values go back to the chunks that hold the token,
   where each document's stream is put together and mixed in order.

Defined results: null text is the empty text, an end token alone; rows without
an id are scored, and not learnt from; if nothing is learnt from, the model
codes bits at even odds.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, ship, shipped, written

#: Log2 of the slots of each predictor: contexts of 0, 1, 2, 3, 4 bytes, and the whole token so far.
BITS = (16, 16, 18, 19, 19, 20)
#: Distinct tokens of a chunk; bytes of a text whose words are held at once.
CHUNK_WORDS, PIECE = 400_000, 4_000_000
#: Bytes of a token whose coding is shared with the token before; tokens coded at once.
SHARED, SLICE = 32, 25_000
#: Weight of the shorter context's prediction; bits of a step; certainty of the first weights; buckets
#: of the refinement; kinds of documents.
PRIOR, STEP, FIRM, BUCKETS, KINDS = 1.0, 8_192, 1_000.0, 33, 8
END = b"\n"
_OFFSETS = np.concatenate([[0], np.cumsum([1 << b for b in BITS])])
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_OTHER = re.compile(r"[^\x00-\x7f]")
GATES, INPUTS = 8 * 8, len(BITS) + 1
#: Of the stream: predictors, gates, most bits of a predictor's table; bytes counted and learnt at
#: once; bits of a document mixed before its weights move.
PREDICTORS, STREAM_GATES, MOST_BITS = 9, 49, 22
COUNTED_BYTES, LEARNT_BYTES, WINDOW = 400_000, 32_768, 2_048
#: Slots merged as one row.
BLOCK = 1 << 16


# --- documents to chunks ---------------------------------------------------------------------

def tokens_of(text: str | None):
    """Lists of the tokens of a text in order, piece by piece, and the end token (bytes.lower and
    bytes.split know ASCII only)."""
    data, at = (text or "").encode().lower(), 0
    while at < len(data):
        cut = _SPACE.search(data, at + PIECE) if len(data) - at > PIECE else None
        end = cut.start() if cut else len(data)
        yield data[at:end].split()
        at = end
    yield [END]


def kind_of(text: str | None) -> int:
    """0 without non-ASCII characters; else by the commonest of them."""
    found = Counter(_OTHER.findall(text or ""))
    if not found:
        return 0
    return 1 + zlib.crc32(max(found, key=lambda c: (found[c], c)).encode()) % (KINDS - 1)


_COUNTED = ("kind int, chunk bigint, doc_id bigint, held_out boolean, n_tokens bigint, n_bytes bigint, at binary, "
            "place bigint, token binary, " + ", ".join(f"c{k} bigint" for k in range(KINDS)))
_COUNTED_ARROW = pa.schema([("kind", pa.int32()), ("chunk", pa.int64()), ("doc_id", pa.int64()),
                            ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_bytes", pa.int64()),
                            ("at", pa.binary()), ("place", pa.int64()),
                            ("token", pa.binary()), *((f"c{k}", pa.int64()) for k in range(KINDS))])


def _rows(n: int, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in _COUNTED_ARROW],
        schema=_COUNTED_ARROW)


def _count_chunks(batches):
    """Rows of kind 0 for documents, and of kind 1 for the tokens of each chunk."""
    part, serial = TaskContext.get().partitionId(), 0
    places: dict[bytes, int] = {}
    trained = np.zeros((KINDS, 0), np.int64)

    def close():
        n = len(places)
        return _rows(n, kind=np.ones(n, np.int32), chunk=np.full(n, part << 24 | serial), place=np.arange(n),
                     token=list(places),
                     **{f"c{k}": trained[k, :n] for k in range(KINDS)})

    for batch in batches:
        rows: list[list] = [[] for _ in range(5)]

        def documents():
            n = len(rows[0])
            return _rows(n, kind=np.zeros(n, np.int32), chunk=np.full(n, part << 24 | serial), doc_id=rows[0],
                         held_out=rows[1], n_tokens=rows[2], n_bytes=rows[3], at=rows[4])

        for doc_id, text, held in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
            at = np.concatenate([np.array([places.setdefault(w, len(places)) for w in piece], np.int32)
                                 for piece in tokens_of(text.as_py())])
            if trained.shape[1] < len(places):
                more = len(places) + 65_536 - trained.shape[1]
                trained = np.concatenate([trained, np.zeros((KINDS, more), np.int64)], axis=1)
            if held is False:
                seen, times = np.unique(at, return_counts=True)
                trained[kind_of(text.as_py()), seen] += times
            letters = len((text.as_py() or "").encode().translate(None, SPACES))
            values = (doc_id, bool(held), len(at), letters + len(at), zlib.compress(at.tobytes(), 1))
            for column, value in zip(rows, values):
                column.append(value)
            if len(places) >= CHUNK_WORDS:
                yield documents()
                yield close()
                serial, places, rows = serial + 1, {}, [[] for _ in range(5)]
                trained = np.zeros((KINDS, 0), np.int64)
        if rows[0]:
            yield documents()
    if places:
        yield close()


# --- tokens to bits --------------------------------------------------------------------------

class Edges:
    """The bits of a sorted slice of tokens, those of common beginnings once.

    slots: for each bit and predictor; bit; word, length: of the token's edges; weights by bit."""

    def __init__(self, tokens: list[bytes]):
        whole = [t if t == END else t + b" " for t in tokens]
        lengths = np.array([len(t) for t in whole])
        data = np.frombuffer(b"".join(whole), np.uint8)
        starts = np.cumsum(lengths) - lengths
        n = len(whole)
        shared = np.zeros(n, np.int64)
        running = np.ones(max(0, n - 1), bool)
        for k in range(SHARED):                      # bytes in common with the token before
            both = running & (lengths[1:] > k) & (lengths[:-1] > k)
            at = np.flatnonzero(both)
            same = data[starts[1:][at] + k] == data[starts[:-1][at] + k]
            running = np.zeros_like(both)
            running[at[same]] = True
            shared[1:] += running
        own = lengths - shared
        self.n, self.lengths, self.shared = n, lengths, shared
        self.word = np.repeat(np.arange(n), own)
        first = np.cumsum(own) - own
        self.first, self.last = first, None
        position = np.arange(own.sum()) - np.repeat(first, own) + np.repeat(shared, own)
        at = np.repeat(starts, own) + position
        byte = data[at].astype(np.uint32)
        before = [np.where(position >= j, data[np.maximum(at - j, 0)], 0x20 if j == 1 else 0).astype(np.uint32)
                  for j in range(1, 5)]
        # the whole token so far: a sum of its bytes' codes, from the token's start
        codes = _mix32(data.astype(np.uint32) + np.uint32(256) * (
            (np.arange(len(data)) - np.repeat(starts, lengths)).astype(np.uint32) + np.uint32(1)))
        upto = np.concatenate([[0], np.cumsum(codes, dtype=np.uint32)]).astype(np.uint32)
        prefix = upto[at] - upto[np.repeat(starts, own)]
        c1, c2 = before[0], before[0] | before[1] << np.uint32(8)
        c3 = c2 | before[2] << np.uint32(16)
        c4 = c3 | before[3] << np.uint32(24)
        contexts = [np.zeros_like(c1), c1, c2, c3, c4, prefix]
        bits = np.arange(7, -1, -1, dtype=np.uint32)
        self.bit = ((byte[:, None] >> bits) & np.uint32(1)).astype(np.uint8).reshape(-1)
        node = (byte[:, None] | np.uint32(256)) >> (bits + np.uint32(1))
        self.after = np.repeat(c1.astype(np.int32), 8)
        self.slots = []
        for i, context in enumerate(contexts):
            if i < 2:                                # few contexts: no hash
                slot = context[:, None] << np.uint32(8) | node
            else:
                slot = _mix32(context[:, None] * np.uint32(0x9E3779B1) + node * np.uint32(0x85EBCA6B)
                              + np.uint32(i)) >> np.uint32(32 - BITS[i])
            self.slots.append(slot.reshape(-1).astype(np.int64) + _OFFSETS[i])

    def of_edges(self, by_token: np.ndarray) -> np.ndarray:
        """Sums over the tokens that use each edge, by bit."""
        upto = np.concatenate([[0.0], np.cumsum(by_token.astype(np.float64))])
        if self.last is None:
            # an edge serves its token and the following ones while these share more than its position
            size = self.lengths - self.shared
            position = np.arange(size.sum()) - np.repeat(self.first, size) + np.repeat(self.shared, size)
            stop = [self.n] * SHARED
            ends = np.empty((self.n, SHARED), np.int32)
            for i in range(self.n - 1, -1, -1):
                ends[i] = stop
                k = min(int(self.shared[i]), SHARED)
                stop[k:] = [i] * (SHARED - k)
            inside = position < SHARED
            self.last = self.word + 1
            self.last[inside] = ends[self.word[inside], position[inside]]
        return np.repeat(upto[self.last] - upto[self.word], 8)

    def of_tokens(self, by_bit: np.ndarray) -> np.ndarray:
        """Sums of the bits' values over all edges of each token, shared ones included."""
        by_edge = by_bit.reshape(-1, 8).sum(axis=1)
        own = np.add.reduceat(np.append(by_edge, 0.0), self.first) * (self.lengths > self.shared)
        total = np.empty(self.n)
        edges, sizes = by_edge.tolist(), (self.lengths - self.shared).tolist()
        shared, first = self.shared.tolist(), self.first.tolist()
        path = [0.0] * (SHARED + 1)                  # sums of the current token's beginnings
        for i in range(self.n):
            total[i] = path[shared[i]] + own[i]
            value = path[shared[i]]
            for k in range(min(sizes[i], SHARED - shared[i])):
                value += edges[first[i] + k]
                path[shared[i] + k + 1] = value
        return total


def _mix32(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint32(16))
    x *= np.uint32(0x7FEB352D)
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x846CA68B)
    x ^= x >> np.uint32(16)
    return x


def _slices(batches):
    """(tokens, counts) of at most SLICE sorted tokens."""
    for batch in batches:
        for at in range(0, len(batch), SLICE):
            part = batch.slice(at, SLICE)
            yield part.column(0).to_pylist(), part.column(1).to_numpy()


# --- predictors, mixer, refinement -----------------------------------------------------------

def _count_bits(batches):
    """Counts of zeros and ones in each slot; the last predictor leaves out each token's first time."""
    zeros, ones = np.zeros(_OFFSETS[-1]), np.zeros(_OFFSETS[-1])
    any_token = False
    for tokens, counts in _slices(batches):
        if not counts.any():
            continue
        any_token, edges = True, Edges(tokens)
        types = edges.of_edges(counts > 0)
        for i, slots in enumerate(edges.slots):
            low, size = _OFFSETS[i], 1 << BITS[i]
            for table, value in ((zeros, 0), (ones, 1)):
                mine = edges.bit == value
                table[low:low + size] += np.bincount(slots[mine] - low, types[mine], size)
    if any_token:
        both = np.stack([zeros, ones]).astype(np.float32)
        for at in range(0, _OFFSETS[-1], BLOCK):
            block = np.ascontiguousarray(both[:, at:at + BLOCK])
            if block.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([at // BLOCK], pa.int64()), pa.array([zlib.compress(block.tobytes(), 1)], pa.binary())],
                    names=["block", "counts"])


def _merge_blocks(batches):
    """Sum of the tasks' counts of each block, of rows sorted by block."""
    held, total = None, None

    def out():
        return pa.RecordBatch.from_arrays(
            [pa.array([held], pa.int64()), pa.array([zlib.compress(total.astype(np.float32).tobytes(), 1)], pa.binary())],
            names=["block", "counts"])

    for batch in batches:
        for block, data in zip(batch.column(0).to_pylist(), batch.column(1)):
            one = np.frombuffer(zlib.decompress(data.as_py()), np.float32).astype(np.float64)
            if block != held:
                if held is not None:
                    yield out()
                held, total = block, one
            else:
                total = total + one
    if held is not None:
        yield out()


def _tables(rows) -> tuple[np.ndarray, np.ndarray]:
    both = np.zeros((2, _OFFSETS[-1]), np.float32)
    for r in rows:
        part = both[:, r.block * BLOCK:(r.block + 1) * BLOCK]
        part[:] = np.frombuffer(zlib.decompress(bytes(r.counts)), np.float32).reshape(2, -1)
    return both[0], both[1]


def _gate(seen_whole: np.ndarray, seen_three: np.ndarray) -> np.ndarray:
    step = lambda n, by: np.minimum(7, np.log2(n + 1) / by).astype(np.int32)
    return step(np.maximum(seen_whole, 0), 1.7) * 8 + step(np.maximum(seen_three, 0), 2.0)


def _inputs(edges: Edges, zeros, ones, without: int = 0):
    """Logits (bits x INPUTS) and gates.  A predictor leans on the shorter context's prediction as far
    as it has seen little.  without: 1 leaves one token with the coded bit out of the counts."""
    out = np.empty((len(edges.bit), INPUTS), np.float32)
    p = q = 0.5                                      # of a one, of a zero
    seen = []
    for i, slots in enumerate(edges.slots):
        n0, n1 = zeros[slots], ones[slots]
        if without:
            n0, n1 = np.maximum(n0 - (edges.bit == 0), 0), np.maximum(n1 - (edges.bit == 1), 0)
        total = n0 + n1 + np.float32(PRIOR)
        p, q = (n1 + PRIOR * p) / total, (n0 + PRIOR * q) / total
        out[:, i] = np.log(p / q)
        seen.append(total)
    np.clip(out, -18, 18, out=out)
    out[:, -1] = 0.3
    return out, _gate(seen[-1], seen[3])


def _start() -> np.ndarray:
    """Weights before any learning: half the predictors of three and of four bytes."""
    weights = np.zeros((GATES, INPUTS))
    weights[:, 3:5] = 0.5
    return weights


def _squash(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -18, 18)))


def _bucket(logit: np.ndarray) -> np.ndarray:
    return np.rint((np.clip(logit, -8, 8) + 8) * ((BUCKETS - 1) / 16)).astype(np.int64)


def _learn(tables):
    """Online learning of the gated weights over a partition's tokens: (kind, place, total)."""
    def run(batches):
        zeros, ones = tables.value
        weights, sure = _start(), np.tile(np.eye(INPUTS) * FIRM, (GATES, 1, 1))
        first = sure.copy()
        refine = np.zeros((2, 256 * BUCKETS))
        rng = np.random.default_rng(1)
        for tokens, counts in _slices(batches):
            if not counts.any():
                continue
            edges = Edges(tokens)
            times = edges.of_edges(counts > 0)
            live = np.flatnonzero(times > 0)
            inputs, gates = _inputs(edges, zeros, ones, 1)
            rng.shuffle(live)
            for at in range(0, len(live), STEP):
                some = live[at:at + STEP]
                x, gate, bit, weight = inputs[some].astype(np.float64), gates[some], edges.bit[some], times[some]
                logit = np.einsum("ij,ij->i", x, weights[gate])
                p = _squash(logit)
                push = np.stack([np.bincount(gate, (bit - p) * weight * x[:, j], GATES) for j in range(INPUTS)], axis=1)
                curve = np.maximum(p * (1 - p), 1e-3) * weight
                for j in range(INPUTS):
                    for k in range(j, INPUTS):
                        more = np.bincount(gate, curve * x[:, j] * x[:, k], GATES)
                        sure[:, j, k] += more
                        if j != k:
                            sure[:, k, j] += more
                weights += np.linalg.solve(sure, push[:, :, None])[:, :, 0]
                cell = edges.after[some] * BUCKETS + _bucket(logit)
                refine[0] += np.bincount(cell, weight * bit, 256 * BUCKETS)
                refine[1] += np.bincount(cell, weight, 256 * BUCKETS)
        moved = np.einsum("gij,gj->gi", sure, weights) - np.einsum("gij,gj->gi", first, _start())
        parts = [moved.reshape(-1), (sure - first).reshape(-1), refine[0], refine[1]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(4, dtype=np.int32), [len(x) for x in parts])),
             pa.array(np.concatenate([np.arange(len(x)) for x in parts])), pa.array(np.concatenate(parts))],
            names=["kind", "place", "total"])
    return run


def _joined(rows) -> tuple[np.ndarray, np.ndarray]:
    """Weights and refinement of all partitions together."""
    parts = [np.zeros(n) for n in (GATES * INPUTS, GATES * INPUTS * INPUTS, 256 * BUCKETS, 256 * BUCKETS)]
    for r in rows:
        parts[r.kind][r.place] = r.total
    first = np.tile(np.eye(INPUTS) * FIRM, (GATES, 1, 1))
    moved = parts[0].reshape(GATES, INPUTS) + np.einsum("gij,gj->gi", first, _start())
    weights = np.linalg.solve(parts[1].reshape(GATES, INPUTS, INPUTS) + first, moved[:, :, None])[:, :, 0]
    middle = _squash(np.tile(np.arange(BUCKETS) * (16 / (BUCKETS - 1)) - 8, 256))
    return weights, (parts[2] + 4 * middle) / (parts[3] + 4)


def _code(model):
    """The vocabulary's rows and coded: log10 probability of the token's bits."""
    def run(batches):
        zeros, ones, weights, refined = model.value
        for batch in batches:
            for at in range(0, len(batch), SLICE):
                rows = batch.slice(at, SLICE)
                edges = Edges(rows.column(0).to_pylist())
                inputs, gates = _inputs(edges, zeros, ones)
                logit = np.einsum("ij,ij->i", inputs, weights[gates])
                p = 0.5 * (_squash(logit) + refined[edges.after * BUCKETS + _bucket(logit)])
                p = np.clip(p, 1e-7, 1 - 1e-7)
                coded = edges.of_tokens(np.log10(np.where(edges.bit == 1, p, 1 - p)))
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(coded)], names=[*rows.schema.names, "coded"])
    return run


# --- the byte stream of a document -----------------------------------------------------------

def whole_token(token: bytes) -> bytes:
    return token if token == END else token + b" "


#: Slots of the four bits of each half byte among its context's 16.
_NODES = np.array([[1, 2 | v >> 3, 4 | v >> 2, 8 | v >> 1] for v in range(16)], np.uint32)


class Stream:
    """Contexts of each byte of documents' streams (tokens in order, each ended by a space): the last
    1 to 6 bytes, and the word so far with none, one and two words before it."""

    def __init__(self, data: np.ndarray, begins: np.ndarray):
        n = len(data)
        self.data = data
        begin = np.repeat(begins, np.diff(np.append(begins, n)))
        position = np.arange(n) - begin
        known, self.contexts = np.zeros(n, np.uint32), []
        for j in range(1, 7):
            byte = np.zeros(n, np.uint32)
            byte[j:] = data[:n - j]
            byte += np.uint32(1)
            byte[position < j] = 0
            known = known * np.uint32(0x2F0B4C47) + byte
            self.contexts.append(_mix32(known))
        ends = np.flatnonzero((data == 0x20) | (data == 0x0A))
        starts = np.concatenate([[0], ends[:-1] + 1]).astype(np.int64)
        word = np.repeat(np.arange(len(ends)), ends + 1 - starts)
        codes = _mix32(data.astype(np.uint32) + np.uint32(256) * (
            (np.arange(n) - starts[word]).astype(np.uint32) + np.uint32(1)))
        upto = np.concatenate([[0], np.cumsum(codes, dtype=np.uint32)]).astype(np.uint32)
        prefix = upto[:-1] - upto[starts[word]]
        whole = _mix32(upto[ends] - upto[starts])
        nth = np.arange(len(ends)) - np.searchsorted(starts, begin[starts])      # of its document
        one, two = np.zeros_like(whole), np.zeros_like(whole)
        one[1:], two[2:] = whole[:-1], whole[:-2]
        one[nth < 1] = 0
        two[nth < 2] = 0
        pair = _mix32(one * np.uint32(0x9E3779B1) + two + np.uint32(7))
        self.contexts += [_mix32(prefix), _mix32(prefix + _mix32(one + np.uint32(3))[word]),
                          _mix32(prefix + pair[word])]
        self.word_starts = starts

    def halves(self, a: int, z: int) -> np.ndarray:
        """The half bytes of bytes a to z, the high one first."""
        byte = self.data[a:z]
        return np.stack([byte >> 4, byte & 15], axis=1).reshape(-1)

    def starts(self, a: int, z: int, bits: int) -> np.ndarray:
        """First slot of the 16 of each half byte of bytes a to z in each predictor's table
        (PREDICTORS x half bytes)."""
        high = (self.data[a:z] >> 4).astype(np.uint32)
        other = (high + np.uint32(1)) * np.uint32(0x85EBCA6B)
        out = np.empty((PREDICTORS, 2 * (z - a)), np.uint32)
        for i, context in enumerate(self.contexts):
            h = context[a:z] * np.uint32(0x9E3779B1) + np.uint32(i)
            out[i, 0::2], out[i, 1::2] = _mix32(h), _mix32(h + other)
        return out >> np.uint32(32 - bits + 4) << np.uint32(4)

    def slots(self, a: int, z: int, bits: int) -> np.ndarray:
        """Slots of the bits of bytes a to z in each predictor's table (PREDICTORS x bits); the four
        bits of a half byte stand side by side."""
        return (self.starts(a, z, bits)[:, :, None] | _NODES[self.halves(a, z)]).reshape(PREDICTORS, -1).astype(np.int64)

    def bits(self, a: int, z: int) -> np.ndarray:
        return np.unpackbits(self.data[a:z])


def _streams(batches, size: int):
    """Streams of about ``size`` bytes of whole documents from a column of texts."""
    held, total = [], 0

    def out():
        lengths = np.array([len(x) for x in held])
        return Stream(np.frombuffer(b"".join(held), np.uint8), np.cumsum(lengths) - lengths)

    for batch in batches:
        for text in batch.column(0):
            held.append(b"".join(whole_token(t) for piece in tokens_of(text.as_py()) for t in piece))
            total += len(held[-1])
            if total >= size:
                yield out()
                held, total = [], 0
    if held:
        yield out()


def table_bits(n_bytes: int) -> int:
    """Log2 of the slots of a predictor's table of the stream: it grows with the training text."""
    return min(MOST_BITS, max(16, int(n_bytes).bit_length() - 4))


def _count_stream(bits: int):
    """Counts of the 16 half bytes after each context over all occurrences in the training texts, as
    blocks: the zeros and ones of its four bits are sums of them (``_of_bits``)."""
    def run(batches):
        tables = np.zeros((PREDICTORS, 1 << bits), np.uint32)
        for stream in _streams(batches, COUNTED_BYTES):
            for a in range(0, len(stream.data), COUNTED_BYTES):
                z = min(a + COUNTED_BYTES, len(stream.data))
                half = stream.halves(a, z)
                for table, starts in zip(tables, stream.starts(a, z, bits)):
                    np.add.at(table, (starts | half).astype(np.int64), np.uint32(1))
        flat = tables.reshape(-1)
        for at in range(0, len(flat), BLOCK):
            if flat[at:at + BLOCK].any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([at // BLOCK], pa.int64()),
                     pa.array([_packed(flat[at:at + BLOCK])], pa.binary())], names=["block", "counts"])
    return run


def _packed(counts: np.ndarray) -> bytes:
    """Compressed counts, byte by byte of their size: most are small."""
    return zlib.compress(counts.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").reshape(-1)


def _merge_stream(batches):
    """Sum of the tasks' counts of each block, of rows sorted by block."""
    held, total = None, None

    def out():
        return pa.RecordBatch.from_arrays(
            [pa.array([held], pa.int64()), pa.array([_packed(np.minimum(total, 0xFFFFFFFF))], pa.binary())],
            names=["block", "counts"])

    for batch in batches:
        for block, data in zip(batch.column(0).to_pylist(), batch.column(1)):
            one = _unpacked(data.as_py()).astype(np.uint64)
            if block != held:
                if held is not None:
                    yield out()
                held, total = block, one
            else:
                total = total + one
    if held is not None:
        yield out()


def _of_bits(counts: np.ndarray) -> np.ndarray:
    """Slots x (zeros, ones) of counts of half bytes: a bit's are those of the half bytes below it."""
    out, below = np.zeros((len(counts) // 16, 16, 2), np.uint64), counts.astype(np.uint64)
    for nodes in (8, 4, 2, 1):
        pair = below.reshape(-1, nodes, 2)
        out[:, nodes:2 * nodes] = pair
        below = pair[:, :, 0] + pair[:, :, 1]
    return out.reshape(-1, 2)


def _stream_tables(rows, bits: int) -> np.ndarray:
    """PREDICTORS x slots x (zeros, ones), of 16 bits; greater pairs keep their proportion."""
    space = np.zeros((PREDICTORS << bits) + 16, np.uint32)
    first = -space.ctypes.data // 4 % 16             # the 16 slots of a half byte share a cache line
    out = space[first:first + (PREDICTORS << bits)].view(np.uint16).reshape(-1, 2)
    for block, counts in rows:
        pair = _of_bits(_unpacked(counts))
        if pair.max() > 65_535:
            scale = np.minimum(1, 65_535 / np.maximum(1, pair.max(axis=1)))
            pair = np.ceil(pair * scale[:, None])
        out[block * BLOCK:block * BLOCK + len(pair)] = pair
    return out.reshape(PREDICTORS, -1, 2)


def _stream_inputs(tables, stream: Stream, a: int, z: int, bits: int, without: int = 0):
    """Bits of bytes a to z, their logits (bits x PREDICTORS + 1, by columns) and gates: the longest contexts
    of bytes and of words seen.  A half byte's 16 slots are fetched at once, and its four bits' from these."""
    bit, half, starts = stream.bits(a, z), stream.halves(a, z), stream.starts(a, z, bits)
    pick = (np.arange(0, 16 * len(half), 16)[:, None] + _NODES[half]).reshape(-1)
    rows = tables.view("<u4").reshape(PREDICTORS, -1, 16)
    ones, zeros = bit.astype(np.int32), (bit ^ 1).astype(np.int32)
    x = np.empty((PREDICTORS + 1, len(bit)), np.float32)
    x[-1] = 0.3
    gate, words = np.zeros(len(bit), np.int8), np.zeros(len(bit), np.int8)
    for i in range(PREDICTORS):
        pair = rows[i].take(starts[i] >> np.uint32(4), axis=0).reshape(-1).take(pick)
        n1 = (pair >> np.uint32(16)).view(np.int32)                  # zeros below, ones above
        pair &= np.uint32(0xFFFF)
        n0 = pair.view(np.int32)
        if without:
            for n, own in ((n0, zeros), (n1, ones)):
                n -= own
                np.maximum(n, 0, out=n)
        seen = n0 + n1
        if i < 6:
            gate += seen > 0
        else:
            words += seen > 0
            words += seen > 20
        n0, n1 = n0.astype(np.float32), n1.astype(np.float32)
        n0 += np.float32(0.2)
        n1 += np.float32(0.2)
        np.log(np.divide(n1, n0, out=n1), out=x[i])
    return bit, x.T, gate * np.int8(7) + words


class Mixer:
    """Gated weights learnt online: each window of bits is predicted, then learnt from."""

    def __init__(self, weights=None, sure=None):
        self.weights = np.full((STREAM_GATES, PREDICTORS + 1), 0.2) if weights is None else weights.copy()
        self.sure = np.full((STREAM_GATES, PREDICTORS + 1), 200.0) if sure is None else sure.copy()

    def code(self, x, gate, bit) -> np.ndarray:
        """Probabilities of the bits' ones before learning from them."""
        order = np.argsort(gate, kind="stable")      # the bits of a gate side by side: sums of runs
        times = np.bincount(gate, minlength=STREAM_GATES)
        some = np.flatnonzero(times)
        first = np.cumsum(times[some]) - times[some]
        inputs = x.T.take(order, axis=1).astype(np.float64)
        size = np.repeat(self.weights.T[:, some], times[some], axis=1)
        size *= inputs
        p = _squash(size.sum(axis=0))
        np.abs(inputs, out=size)
        curve = np.maximum(p * (1 - p), 1e-3)
        curve *= size.sum(axis=0)
        size *= curve
        inputs *= bit.take(order) - p
        self.sure[some] += np.add.reduceat(size, first, axis=1).T
        self.weights[some] += np.add.reduceat(inputs, first, axis=1).T / self.sure[some]
        out = np.empty_like(p)
        out[order] = p
        return out


def _learn_stream(tables, bits: int):
    """Weights of a partition's training texts, each bit predicted without itself: (place, total, sure)."""
    def run(batches):
        mixer = Mixer()
        for stream in _streams(batches, LEARNT_BYTES):
            for a in range(0, len(stream.data), LEARNT_BYTES):
                z = min(a + LEARNT_BYTES, len(stream.data))
                bit, x, gate = _stream_inputs(tables.value, stream, a, z, bits, 1)
                for at in range(0, len(bit), STEP):
                    mixer.code(x[at:at + STEP], gate[at:at + STEP], bit[at:at + STEP])
        sure = mixer.sure.reshape(-1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(sure), dtype=np.int64)), pa.array(mixer.weights.reshape(-1) * sure), pa.array(sure)],
            names=["place", "total", "sure"])
    return run


def _stream_logs(data: bytes, model) -> np.ndarray:
    """log10 probability of each token of a document, its bits mixed in order."""
    tables, bits, weights = model
    stream = Stream(np.frombuffer(data, np.uint8), np.zeros(1, np.int64))
    mixer = Mixer(weights, np.full(weights.shape, FIRM))
    out = np.empty(len(data))
    for a in range(0, len(data), LEARNT_BYTES):
        z = min(a + LEARNT_BYTES, len(data))
        bit, x, gate = _stream_inputs(tables, stream, a, z, bits)
        p = np.concatenate([mixer.code(x[i:i + WINDOW], gate[i:i + WINDOW], bit[i:i + WINDOW])
                            for i in range(0, len(bit), WINDOW)])
        out[a:z] = np.log10(np.clip(np.where(bit == 1, p, 1 - p), 1e-7, 1)).reshape(-1, 8).sum(axis=1)
    return np.add.reduceat(out, stream.word_starts)


# --- documents' scores -----------------------------------------------------------------------

class Counts:
    """Training totals of the corpus or of a kind of documents: N, V, and the discount of counts."""

    def __init__(self, total, distinct, once, twice):
        self.total, self.distinct = int(total or 0), int(distinct)
        self.discount = min(0.95, max(0.1, once / (once + 2 * twice))) if once else 0.5

    def probability(self, c: np.ndarray, otherwise: np.ndarray) -> np.ndarray:
        """Discounted counts; what is taken off goes to ``otherwise``."""
        if not self.total:
            return otherwise
        return (np.maximum(c - self.discount, 0) + self.discount * self.distinct * otherwise) / self.total


def _sum_documents(all_counts: Counts, kinds: list[Counts], shares: np.ndarray, model):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        """Documents of a chunk (left) and the values of its tokens (right)."""
        place = np.argsort(right.column("place").to_numpy())
        by_kind = [right.column(f"c{k}").to_numpy()[place] for k in range(KINDS)]
        c = np.sum(by_kind, axis=0)
        base = np.log10((c + 0.1) / (all_counts.total + 0.1 * (all_counts.distinct + 1)))
        overall = all_counts.probability(c, 10.0 ** np.maximum(right.column("coded").to_numpy()[place], -280))
        live = np.flatnonzero(shares > 0)
        logs = np.stack([np.log10(np.maximum(kinds[k].probability(by_kind[k], overall), 1e-300)) for k in live]
                        or [np.log10(np.maximum(overall, 1e-300))], axis=1)
        start = np.log10(shares[live]) if len(live) else np.zeros(1)
        out = []
        tokens = [whole_token(t) for t in right.column("token").take(pa.array(place)).to_pylist()]
        for packed in left.column("at"):
            at = np.frombuffer(zlib.decompress(packed.as_py()), np.int32)
            stream = _stream_logs(b"".join([tokens[i] for i in at.tolist()]), model.value)
            # a token's probability mixes the stream's with its count's, by how well each did before it
            single = logs[at]
            lead = 1 / (1 + 10.0 ** np.clip(single - stream[:, None], -200, 200))
            share = (1 + np.cumsum(lead, axis=0) - lead) / (2 + np.arange(len(at)))[:, None]
            top = np.maximum(single, stream[:, None])
            mixed = top + np.log10(share * 10.0 ** (stream[:, None] - top) + (1 - share) * 10.0 ** (single - top))
            each = mixed.sum(axis=0) + start
            best = each.max()
            out.append((int((c[at] > 0).sum()), float(base[at].sum()),
                        float(best + np.log10((10.0 ** (each - best)).sum()))))
        columns = [left.column(n).combine_chunks() for n in ("doc_id", "held_out", "n_tokens", "n_bytes")]
        known, based, scored = zip(*out) if out else ((), (), ())
        return pa.Table.from_arrays([*columns, pa.array(known, pa.int64()), pa.array(based, pa.float64()),
                                     pa.array(scored, pa.float64())],
                                    names=["doc_id", "held_out", "n_tokens", "n_bytes", "n_known", "base_score", "score"])
    return run


class _Tables:
    """The stream's tables, broadcast as compressed blocks; a worker unpacks them once."""

    def __init__(self, sent, bits):
        self.sent, self.bits = sent, bits

    @property
    def value(self) -> np.ndarray:
        tables = shipped(self.sent, lambda rows: _stream_tables(rows, self.bits))
        vars(self.sent).pop("_value", None)          # the compressed blocks, which pyspark keeps once read
        return tables


class _Sent:
    """The stream's broadcast tables and weights."""

    def __init__(self, tables, bits, weights):
        self.tables, self.bits, self.weights = tables, bits, weights

    @property
    def value(self):
        return self.tables.value, self.bits, self.weights.value


#: Spark's setting to remove the shuffle files of a statement when it has ended.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _step(df: DataFrame, purpose: str) -> DataFrame:
    """``written``; the shuffle files of the step go as it ends, not when the driver happens to collect its garbage."""
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP, "false")
    conf.set(_CLEANUP, "true")
    try:
        return written(df, purpose)
    finally:
        conf.set(_CLEANUP, before)


def score_documents(docs: DataFrame, held_out=lambda doc_id: crc_mod(doc_id, 10) == 0) -> DataFrame:
    """``docs`` (doc_id, text) -> doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score,
    bits_per_byte; learnt from the documents that are not ``held_out``."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", held_out(F.col("doc_id")).alias("held_out"))
    counted = written(rows.mapInArrow(_count_chunks, _COUNTED), "lm/chunks")
    by_kind = [f"c{k}" for k in range(KINDS)]
    tokens = counted.where("kind = 1").select("chunk", "place", "token", *by_kind)
    vocabulary = tokens.groupBy("token").agg(*[F.sum(k).alias(k) for k in by_kind])
    vocabulary = vocabulary.select("token", sum((F.col(k) for k in by_kind), F.lit(0)).cast("long").alias("c"), *by_kind)
    vocabulary = _step(vocabulary.repartitionByRange("token").sortWithinPartitions("token"), "lm/vocabulary")
    facts = vocabulary.agg(*[x for k in ("c", *by_kind) for x in (
        F.sum(k).alias(f"{k}_n"), F.count_if(F.col(k) > 0).alias(f"{k}_v"), F.count_if(F.col(k) == 1).alias(f"{k}_1"),
        F.count_if(F.col(k) == 2).alias(f"{k}_2"), F.sum(F.when(F.col("token") == F.lit(END), F.col(k))).alias(f"{k}_e"))]).first()
    found = {k: Counts(*(facts[f"{k}_{x}"] for x in "nv12")) for k in ("c", *by_kind)}
    ends = np.array([facts[f"{k}_e"] or 0 for k in by_kind], float)
    blocks = vocabulary.select("token", "c").mapInArrow(_count_bits, "block bigint, counts binary")
    # fixed by BITS, whatever the corpus
    zeros, ones = _tables(blocks.repartition("block").sortWithinPartitions("block")
                          .mapInArrow(_merge_blocks, "block bigint, counts binary").collect())
    tables = spark.sparkContext.broadcast((zeros, ones))
    learnt = (vocabulary.select("token", "c").mapInArrow(_learn(tables), "kind int, place bigint, total double")
              .groupBy("kind", "place").agg(F.sum("total").alias("total")).collect())
    tables.destroy()
    model = spark.sparkContext.broadcast((zeros, ones, *_joined(learnt)))
    texts = rows.where(~F.col("held_out")).select("text")
    n_bytes = counted.where("kind = 0 and not held_out").agg(F.sum("n_bytes")).first()[0]
    bits = table_bits(n_bytes or 0)
    contexts = texts.mapInArrow(_count_stream(bits), "block bigint, counts binary")
    # written: they are read a part at a time, the tasks' own tables need not stay for that
    merged = _step(contexts.repartition("block").sortWithinPartitions("block")
                   .mapInArrow(_merge_stream, "block bigint, counts binary"), "lm/blocks")
    # sent as they come, compressed: every executor keeps a broadcast on its disk, the tables are mostly empty
    stream = _Tables(ship(spark, [(r.block, bytes(r.counts)) for r in merged.toLocalIterator()]), bits)
    weights = np.full((STREAM_GATES, PREDICTORS + 1), 0.2)
    for r in (texts.mapInArrow(_learn_stream(stream, bits), "place bigint, total double, sure double")
              .groupBy("place").agg((F.sum("total") / F.sum("sure")).alias("weight")).collect()):
        weights[np.unravel_index(r.place, weights.shape)] = r.weight
    weights = spark.sparkContext.broadcast(weights)
    coded = vocabulary.drop("c").mapInArrow(
        _code(model), "token binary, " + ", ".join(f"{k} bigint" for k in by_kind) + ", coded double")
    values = tokens.drop(*by_kind).join(coded, "token").select(F.col("chunk").alias("of"), "place", "token", "coded", *by_kind)
    documents = counted.where("kind = 0").select("chunk", "doc_id", "held_out", "n_tokens", "n_bytes", "at")
    scored = documents.groupBy("chunk").cogroup(values.groupBy("of")).applyInArrow(
        _sum_documents(found["c"], [found[k] for k in by_kind], ends / max(1.0, ends.sum()),
                       _Sent(stream, bits, weights)),
        "doc_id bigint, held_out boolean, n_tokens bigint, n_bytes bigint, n_known bigint, base_score double, score double")
    return scored.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(found["c"].total).cast("long").alias("train_tokens"),
        "base_score", "score", (F.col("score") * -float(np.log2(10)) / F.col("n_bytes")).alias("bits_per_byte"))
