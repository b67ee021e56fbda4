"""Operator 3: byte-level BPE encoding and decoding by corpus-level merge replay.

Encoding works on the distinct pre-tokens of a slice of the corpus, not on
documents.  A slice's new pre-tokens are laid out together, places by words, with
the rank of every adjacent pair.  A round merges in every word at once its pair of
the lowest rank, leftmost first, and only the pairs with the merged token's two
neighbours are looked up anew; words whose pairs all stay leave the arrays.  Words
of more than ``SHORT`` bytes are one sequence of byte tokens with an inverted index
from ranks to the positions of their pairs; ranks are taken in ascending order, a
merge is applied at all its positions.  A pre-token met again is not merged again,
also not by later tasks of a worker while it is remembered: documents are put
together from the replayed pieces.  Slices are the parts of a document partition,
so the work is spread by the scan, nothing is shuffled, and a lost executor costs
only its slices.

Defined results: null text encodes like the empty text (no ids); null ids
decode to no bytes; other columns of the input are not read.
"""

from __future__ import annotations

import base64
import heapq
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField, StructType

from .common import ship, shipped

#: Characters of text whose pre-tokens are held at once.
SLICE_CHARS = 2_000_000
#: Pre-tokens replayed together, and pieces remembered between slices of a task.
REPLAY_WORDS, KEEP_PIECES = 50_000, 240_000
#: Ids whose bytes are gathered at once.
GATHER_IDS = 1 << 18
#: Bytes of the longest words that are merged by rounds, and of the groups that share a round; a pair's
#: rank and place in a word as one number, and the number of no pair.
SHORT, LENGTHS, PLACE_BITS, NO_PAIR = 60, (4, 6, 8, 10, 13, 17, 25, 40, 60), 6, 1 << 30
#: Places of words in the arrays of a round.
ROUND_PLACES = 1 << 18


def parse_ranks(data: bytes) -> dict[bytes, int]:
    """token bytes -> rank, from lines of a base64 token and a rank."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, data.splitlines())}


def read_ranks(path: str) -> dict[bytes, int]:
    return parse_ranks(read_bytes(path))


def read_bytes(path: str) -> bytes:
    """A file on the driver; workers get its bytes and need not see the path."""
    with open(path, "rb") as file:
        return file.read()


class MergeReplay:
    """Replays the merges of a rank table over many words at once."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.token = {rank: token for token, rank in ranks.items()}
        self.byte_rank = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.pairs: dict[int, int] = {}
        self.short = SHORT if max(ranks.values()) < NO_PAIR >> PLACE_BITS else 0
        # every pair of tokens that merges, ascending; the codes of two tokens are one number
        found = sorted((ranks[token[:k]] << 20 | ranks[token[k:]], rank) for token, rank in ranks.items()
                       for k in range(1, len(token)) if token[:k] in ranks and token[k:] in ranks)
        self.pair_codes = np.array([c for c, _ in found] + [1 << 62], np.int64)
        self.pair_ranks = np.array([r for _, r in found] + [-1], np.int64)

    def pair_rank(self, left: int, right: int) -> int:
        """Rank of the token that the pair merges to, -1 if there is none."""
        key = left << 20 | right
        rank = self.pairs.get(key)
        if rank is None:
            rank = self.ranks.get(self.token[left] + self.token[right], -1)
            if len(self.pairs) > 500_000:
                self.pairs.clear()
            self.pairs[key] = rank
        return rank

    def replay(self, words: list[bytes]) -> list[bytes]:
        """Ids of every (non-empty) word, as packed little-endian int32."""
        sizes = np.array([len(w) for w in words], np.int64)
        out: list[bytes] = [b""] * len(words)
        low = 0
        for high in (*(n for n in LENGTHS if n <= self.short), int(sizes.max(initial=0))):
            mine = np.flatnonzero((sizes > low) & (sizes <= high)).tolist()
            run, size = ((self._by_rounds, ROUND_PLACES // (high + 1)) if high <= self.short else
                         (self._by_index, REPLAY_WORDS))
            for at in range(0, len(mine), size):
                part = mine[at:at + size]
                for i, ids in zip(part, run([words[i] for i in part])):
                    out[i] = ids
            low = max(low, high)
        return out

    def _pair_ends(self, left: np.ndarray, right: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Rank and place, as one number, of pairs of tokens (-1: no token); NO_PAIR if they do not merge."""
        code = left.astype(np.int64) << 20 | right
        at = np.searchsorted(self.pair_codes, code)
        return np.where(self.pair_codes[at] == code, self.pair_ranks[at] << PLACE_BITS | place, NO_PAIR).astype(np.int32)

    def _by_rounds(self, words: list[bytes]) -> list[bytes]:
        """Short words: a round merges in each word its pair of the lowest rank, of equal ones the first.

        The arrays are places x words, with one more place that stands for "none"."""
        n, sizes = len(words), np.array([len(w) for w in words], np.int32)
        if not n:
            return []
        length = int(sizes.max())
        data = np.frombuffer(b"".join(words) + b"\0" * length, np.uint8)
        starts = np.cumsum(sizes, dtype=np.int64) - sizes
        places = np.arange(length + 1, dtype=np.int32)[:, None]
        inside = places < sizes
        token = np.full((length + 1, n), -1, np.int32)
        token[:-1] = np.where(inside[:-1], self.byte_rank[data[starts + places[:-1]]], -1)
        after = np.where(places + 1 < sizes, places + 1, length).astype(np.int32)
        before = np.where(inside & (places > 0), places - 1, length).astype(np.int32)
        best = np.full((length + 1, n), NO_PAIR, np.int32)
        best[:-1] = self._pair_ends(token[:-1], token[1:], places[:-1])
        word = np.arange(n)                          # of each column of ``best``: done words leave it
        token, after, before = token.reshape(-1), after.reshape(-1), before.reshape(-1)
        while len(word):
            least = best.min(axis=0)
            live = np.flatnonzero(least < NO_PAIR)
            if len(live) < 0.8 * len(word):
                best, word, least = best[:, live], word[live], least[live]
                live = np.arange(len(live))
            of, place, rank = word[live], least[live] & (1 << PLACE_BITS) - 1, least[live] >> PLACE_BITS
            here = place * n + of
            second = after[here]
            third = after[second * n + of]
            first = before[here]
            token[here], token[second * n + of] = rank, -1
            after[here], before[third * n + of] = third, place
            best[second, live] = NO_PAIR
            best[place, live] = self._pair_ends(rank, token[third * n + of], place)
            best[first, live] = self._pair_ends(token[first * n + of], rank, first)
        token = token.reshape(length + 1, n)[:-1].T
        keep = token >= 0
        ends = np.cumsum(keep.sum(axis=1)).tolist()
        packed = token[keep].astype("<i4").tobytes()
        return [packed[4 * a:4 * b] for a, b in zip([0, *ends], ends)]

    def _by_index(self, words: list[bytes]) -> list[bytes]:
        """Words of any length: the ranks are taken in order, each at all positions of its pair."""
        if not words:
            return []
        data = np.frombuffer(b"".join(words), np.uint8)
        ends = np.cumsum([len(w) for w in words])
        starts = ends - np.array([len(w) for w in words])
        tokens = self.byte_rank[data]
        inner = np.ones(len(data), bool)
        inner[ends - 1] = False                      # the last byte of a word has no right neighbour
        at = np.flatnonzero(inner)
        codes, inverse = np.unique(tokens[at].astype(np.int64) << 20 | tokens[at + 1],
                                   return_inverse=True)
        code_rank = np.array([self.pair_rank(c >> 20, c & 0xFFFFF) for c in codes.tolist()], np.int64)
        found = code_rank[inverse] if len(codes) else np.zeros(0, np.int64)
        index: dict[int, list[int]] = {}
        live = found >= 0
        order = np.argsort(found[live], kind="stable")
        positions, by = at[live][order], found[live][order]
        cuts = np.flatnonzero(np.diff(by)) + 1
        for group in np.split(np.arange(len(by)), cuts) if len(by) else []:
            index[int(by[group[0]])] = positions[group].tolist()

        pair = np.full(len(data), -1, np.int64)
        pair[at] = found
        token, pair = tokens.tolist(), pair.tolist()
        nxt = np.where(inner, np.arange(1, len(data) + 1), -1).tolist()
        prv = np.arange(-1, len(data) - 1)
        prv[starts] = -1
        prv = prv.tolist()
        first, rank_of, known = starts.tolist(), self.pair_rank, self.pairs.get
        heap = list(index)
        heapq.heapify(heap)
        while heap:
            rank = heapq.heappop(heap)
            todo = index.pop(rank, None)
            if todo is None:
                continue
            todo.sort()
            held = -1                                # a word whose lower rank comes first
            for i in todo:
                if pair[i] != rank:
                    continue
                if i < held:
                    again = index.get(rank)
                    if again is None:
                        index[rank] = [i]
                        heapq.heappush(heap, rank)
                    else:
                        again.append(i)
                    continue
                j = nxt[i]
                k = nxt[j]
                token[i] = rank
                token[j] = pair[j] = -1
                nxt[i] = k
                late = False
                if k >= 0:
                    prv[k] = i
                    new = known(rank << 20 | token[k])
                    if new is None:
                        new = rank_of(rank, token[k])
                    pair[i] = new
                    if new >= 0:
                        late = new <= rank
                        spots = index.get(new)
                        if spots is None:
                            index[new] = [i]
                            heapq.heappush(heap, new)
                        else:
                            spots.append(i)
                else:
                    pair[i] = -1
                h = prv[i]
                if h >= 0:
                    new = known(token[h] << 20 | rank)
                    if new is None:
                        new = rank_of(token[h], rank)
                    pair[h] = new
                    if new >= 0:
                        late = late or new <= rank
                        spots = index.get(new)
                        if spots is None:
                            index[new] = [h]
                            heapq.heappush(heap, new)
                        else:
                            spots.append(h)
                if late:
                    word = bisect_right(first, i)
                    held = first[word] if word < len(first) else len(data)
        left = np.array(token, np.int32)
        keep = left >= 0
        upto = np.concatenate([[0], np.cumsum(keep)])
        packed = left[keep].astype("<i4").tobytes()
        return [packed[4 * a:4 * b] for a, b in zip(upto[starts].tolist(), upto[ends].tolist())]


def _learn(words: set[str], replay: MergeReplay, pieces: dict[str, bytes]) -> None:
    """Adds the ids of ``words`` to ``pieces``; a word that is itself a token is that token."""
    open_words: list[str] = []
    coded: list[bytes] = []
    get = replay.ranks.get
    for word in words:
        data = word.encode()
        rank = get(data)
        if rank is None:
            open_words.append(word)
            coded.append(data)
        else:
            pieces[word] = rank.to_bytes(4, "little")
    for at in range(0, len(open_words), REPLAY_WORDS):
        pieces.update(zip(open_words[at:at + REPLAY_WORDS], replay.replay(coded[at:at + REPLAY_WORDS])))


class Pieces:
    """What a worker has replayed so far; it goes with the broadcast of the ranks.

    The recent pieces and those before them; when the recent ones are many, the older ones go."""

    def __init__(self, data: bytes):
        self.replay = MergeReplay(parse_ranks(data))
        self.recent: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def for_words(self, words: set[str]) -> dict[str, bytes]:
        """The pieces of all ``words`` (and others)."""
        if len(self.recent) > KEEP_PIECES // 2:
            self.recent, self.older = {}, self.recent
        new, older = words.difference(self.recent), self.older
        self.recent.update([(w, older[w]) for w in new if w in older])
        _learn(new.difference(older), self.replay, self.recent)
        return self.recent


def _encode_texts(texts: Iterable[str], pattern, kept: Pieces) -> Iterator[bytes]:
    """Packed ids of each text, in order."""
    def packed(held: list[list[str]]) -> Iterator[bytes]:
        pieces = kept.for_words(set().union(*held))
        for words in held:
            yield b"".join(map(pieces.__getitem__, words))

    held: list[list[str]] = []
    chars = 0
    for text in texts:
        if len(text) > SLICE_CHARS:                  # a long text is its own run of slices
            yield from packed(held)
            held, chars = [], 0
            matches, out = pattern.finditer(text), []
            while part := [m.group() for m in islice(matches, SLICE_CHARS // 8)]:
                out.extend(packed([part]))
            yield b"".join(out)
            continue
        held.append(pattern.findall(text))
        chars += len(text)
        if chars > SLICE_CHARS:
            yield from packed(held)
            held, chars = [], 0
    yield from packed(held)


def _encoder(spark: SparkSession, ranks_path: str, pattern: str, id_col: str):
    """Batches of ids and texts -> batches of ids and lists of token ids."""
    sent = ship(spark, read_bytes(ranks_path))

    def run(batches):
        kept, split = shipped(sent, Pieces), regex.compile(pattern)
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            size = max(1, min(1024, len(texts)))
            for at in range(0, len(texts), size):
                rows = texts.slice(at, size)
                coded = _encode_texts((t.as_py() or "" for t in rows), split, kept)
                lists = [np.frombuffer(c, "<i4") for c in coded]
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int32)
                flat = np.concatenate([np.zeros(0, np.int32), *lists])
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(at, size), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))],
                    names=[id_col, "ids"])

    return run


def _coded_schema(rows: DataFrame, id_col: str) -> StructType:
    return StructType([StructField(id_col, rows.schema[id_col].dataType), StructField("ids", ArrayType(IntegerType()))])


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """(id_col, ids array<int>): the ids of each whole text, one row per input row."""
    rows = docs.select(id_col, text_col)
    return rows.mapInArrow(_encoder(docs.sparkSession, ranks_path, pattern, id_col), _coded_schema(rows, id_col))


class TokenBytes:
    """The bytes of all tokens one after another, and where each token's stand."""

    def __init__(self, data: bytes):
        ranks = parse_ranks(data)
        tokens = sorted(ranks, key=ranks.__getitem__)
        at = np.array([ranks[t] for t in tokens], np.int64)
        self.size = np.full(int(at.max(initial=-1)) + 1, -1, np.int64)
        self.size[at] = [len(t) for t in tokens]
        self.start = np.cumsum(np.maximum(self.size, 0)) - np.maximum(self.size, 0)
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)

    def of_ids(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes of all ids, size of each id's)."""
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.size) or self.size[ids].min() < 0):
            raise KeyError("an id that is no token's")
        size = self.size[ids]
        out, done = np.empty(int(size.sum()), np.uint8), 0
        for at in range(0, len(ids), GATHER_IDS):
            n = size[at:at + GATHER_IDS]
            upto = np.cumsum(n)
            where = np.arange(upto[-1]) + np.repeat(self.start[ids[at:at + GATHER_IDS]] - (upto - n), n)
            out[done:done + len(where)] = self.flat[where]
            done += len(where)
        return out, size

    def of_lists(self, lists: pa.Array) -> pa.Array:
        """Binary values of lists of ids; null for null."""
        ends = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy())])
        data, size = self.of_ids(lists.flatten().to_numpy())
        cuts = np.concatenate([[0], np.cumsum(size)])[ends]
        whole = pa.Array.from_buffers(pa.large_binary(), len(lists), [None, pa.py_buffer(cuts.astype(np.int64)),
                                                                      pa.py_buffer(data)])
        return pc.if_else(lists.is_valid(), whole, None).cast(pa.binary())


def _decoder(spark: SparkSession, ranks_path: str, ids_col: str):
    """Batches with lists of token ids -> the same with the bytes that these stand for."""
    sent = ship(spark, read_bytes(ranks_path))

    def run(batches):
        token = shipped(sent, TokenBytes)
        for batch in batches:
            decoded = token.of_lists(batch.column(batch.schema.get_field_index(ids_col)))
            yield pa.RecordBatch.from_arrays([*batch.columns, decoded], names=[*batch.schema.names, "decoded"])

    return run


def decode(coded: DataFrame, ranks_path: str, ids_col: str = "ids") -> DataFrame:
    """``coded`` with ``decoded`` binary: the bytes that the ids stand for (a column of this name in
    the input is replaced)."""
    coded = coded.drop("decoded")
    schema = StructType([*coded.schema.fields, StructField("decoded", BinaryType())])
    return coded.mapInArrow(_decoder(coded.sparkSession, ranks_path, ids_col), schema)


def encode_decode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """``decode(encode(docs))``: both steps of a task in one worker, which hands the ids over as they are.

    As two steps of a plan they take two workers a task, and the ids pass through the JVM between them."""
    rows = docs.select(id_col, text_col)
    to_ids = _encoder(docs.sparkSession, ranks_path, pattern, id_col)
    to_bytes = _decoder(docs.sparkSession, ranks_path, "ids")
    schema = StructType([*_coded_schema(rows, id_col).fields, StructField("decoded", BinaryType())])
    return rows.mapInArrow(lambda batches: to_bytes(to_ids(batches)), schema)


def digests(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Per document: number of ids, and digests of the ids and of the decoded bytes."""
    both = encode_decode(docs, ranks_path, pattern)
    joined = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(joined.cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
