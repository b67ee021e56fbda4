"""Operator 13: ranked lexical search by hashed max-sketches.

A document's score for an item sums, over the item's terms, the term's weight
times the document's impact for the term, ``1e9 tf div (1000 tf + 8 m)``.
Within a document the impact only grows with ``tf``.

* Index (``build_index``, one pass over the texts, written to the shared
  folder).  Every term of a document has two coordinates of its sketch, and a
  coordinate holds the greatest frequency level of the terms that fall on it,
  so it gives the greatest impact of any of them.  A sketch has
  ``COORDINATES`` coordinates for each distinct term of its document and half
  a byte for each; levels are rounded up.  The same pass counts document
  frequencies, merged by Spark.
* Bounds (``search``).  Items come in blocks of at most ``BLOCK_BYTES`` of
  text.  A pass over the sketches, not the texts, looks up all terms of the
  block in every sketch: the lesser of a term's two coordinates bounds its
  impact, the weighted sum bounds the score from above.
* Rescoring by descending bound.  The ``FIRST`` documents of the highest bound
  of each item are scored exactly; the k-th best of them is the item's
  threshold.  A second pass keeps every document whose bound reaches the
  threshold, and those alone are scored.  A document left out has a bound, so
  a score, below k exact scores: the result is exact, whatever the bounds are.

Defined results: null and empty texts have no term and rank nowhere; a
repeated row is a document of its own; a null ``doc_id`` ranks behind its
equals; an item without terms has no rows; equal rows of the items are one
item, equal ids with different texts are items of their own; other columns of
either table are ignored; an empty table gives no rows.  A term of any length is a term.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ship, shipped, written

#: Fixed value: the maximal runs of `[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]`, as UTF-8 bytes in lower case.
TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
#: Fixed values of the score.
SCALE, SLOPE, LENGTH, FLAT, WEIGHT = 1_000_000_000, 1000, 8, 25, 75

#: Parameter: coordinates of a sketch for each distinct term of its document (two of them are the term's).
COORDINATES = 8
#: Parameter: highest frequency of each level above 0; the last has no upper end.
LEVELS = (1, 2, 3, 4, 5, 6, 7, 9, 12, 16, 24, 48, 128, 512)
#: Parameter: documents of the highest bound that set an item's threshold.
FIRST = 64
#: Parameter: bytes of item texts looked up in one pass over the sketches.
BLOCK_BYTES = 8 << 20
#: Parameter: distinct terms counted in a task before their counts are handed on.
HELD_TERMS = 1 << 20

_LEVEL_OF = np.searchsorted(np.array(LEVELS), np.arange(LEVELS[-1] + 2)).astype(np.uint8) + 1
_LEVEL_OF[0] = 0


def terms_of(text: bytes | None) -> list[bytes]:
    """The terms of a text's UTF-8 bytes; ``bytes.lower`` changes A-Z only."""
    return TERM.findall(text.lower()) if text else []


def _halves(terms: Iterable[bytes], n: int) -> tuple[np.ndarray, np.ndarray]:
    full = np.fromiter((xxhash.xxh3_64_intdigest(t) for t in terms), np.uint64, n)
    return full & np.uint64(0xFFFFFFFF), full >> np.uint64(32)


def sketch_of(counts: dict[bytes, int]) -> bytes:
    """Coordinatewise greatest frequency level, two coordinates a byte."""
    n = len(counts)
    if not n:
        return b""
    size = COORDINATES * n
    low, high = _halves(counts, n)
    tf = np.fromiter(counts.values(), np.int64, n)
    level = _LEVEL_OF[np.minimum(tf, len(_LEVEL_OF) - 1)]
    held = np.zeros(size, np.uint8)
    for at in (low, high):
        np.maximum.at(held, (at % np.uint64(size)).astype(np.int64), level)
    return (held[0::2] | held[1::2] << 4).tobytes()


@dataclass
class Index:
    """``sketches`` (key, doc_id, n, sketch), ``frequencies`` (term, df), and the counts N and L."""

    sketches: DataFrame
    frequencies: DataFrame
    n_docs: int
    n_terms: int


def keyed(docs: DataFrame) -> DataFrame:
    """(key, doc_id, text): rows that agree in id and text share the key."""
    return docs.select(F.xxhash64("doc_id", "text").alias("key"), F.col("doc_id").cast("long"),
                       F.col("text").cast("binary").alias("text"))


def build_index(docs: DataFrame) -> Index:
    schema = "key long, doc_id long, n long, sketch binary, term binary, df long"
    arrow = pa.schema([("key", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int64()), ("sketch", pa.binary()),
                       ("term", pa.binary()), ("df", pa.int64())])

    def frequencies(df: Counter) -> pa.RecordBatch:
        none = pa.nulls(len(df), pa.int64())
        return pa.RecordBatch.from_arrays([none, none, none, pa.nulls(len(df), pa.binary()),
                                           pa.array(list(df), pa.binary()), pa.array(list(df.values()), pa.int64())],
                                          schema=arrow)

    def index(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df: Counter = Counter()
        for batch in batches:
            sketches, sizes = [], []
            for text in batch.column("text").to_pylist():
                counts = Counter(found := terms_of(text))
                sketches.append(sketch_of(counts))
                sizes.append(len(found))
                df.update(counts.keys())
                if len(df) >= HELD_TERMS:
                    yield frequencies(df)
                    df.clear()
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("doc_id"), pa.array(sizes, pa.int64()),
                                              pa.array(sketches, pa.binary()), pa.nulls(len(batch), pa.binary()),
                                              pa.nulls(len(batch), pa.int64())], schema=arrow)
        if df:
            yield frequencies(df)

    rows = written(keyed(docs).mapInArrow(index, schema), "lexical/index")
    sketches = rows.where("term IS NULL AND n > 0").select("key", "doc_id", "n", "sketch")
    total = sketches.agg(F.count("*").alias("docs"), F.sum("n").alias("terms")).first()
    return Index(sketches, rows.where("term IS NOT NULL").groupBy("term").agg(F.sum("df").alias("df")),
                 total.docs, total.terms or 0)


class Block:
    """A block of items as arrays: distinct terms, and each item's terms with weight times repeats."""

    def __init__(self, texts: list[bytes], df: dict[bytes, int], n_docs: int, n_terms: int):
        self.n_docs, self.n_terms, self.n_items = n_docs, n_terms, len(texts)
        number: dict[bytes, int] = {}
        self.weights: list[dict[bytes, int]] = []
        at, starts, products = [], [], []
        for text in texts:
            known = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * c
                     for t, c in Counter(terms_of(text)).items() if t in df}
            self.weights.append(known)
            starts.append(len(at))
            for t, product in known.items():
                at.append(number.setdefault(t, len(number)))
                products.append(product)
        self.at, self.products = np.array(at, np.int64), np.array(products, np.int64)
        self.low, self.high = _halves(number, len(number))
        starts = np.array(starts + [len(at)], np.int64)
        self.filled = np.flatnonzero(np.diff(starts))          # items with a term that some document holds
        self.starts = starts[self.filled]

    def m(self, n: int) -> int:
        return FLAT + WEIGHT * n * self.n_docs // self.n_terms

    def bounds(self, n: int, sketch: bytes) -> np.ndarray:
        """Upper bound of the document's score for each of the ``filled`` items."""
        m = self.m(n)
        highest = [0, *(SCALE * tf // (SLOPE * tf + LENGTH * m) for tf in LEVELS), SCALE // SLOPE]
        packed = np.frombuffer(sketch, np.uint8)
        size = np.uint64(2 * len(packed))
        levels = []
        for half in (self.low, self.high):
            i = half % size
            levels.append(packed[i >> np.uint64(1)] >> ((i & np.uint64(1)) << np.uint64(2)).astype(np.uint8) & 15)
        impact = np.array(highest, np.int64)[np.minimum(*levels)]
        return np.add.reduceat(self.products * impact[self.at], self.starts)

    def score(self, item: int, n: int, counts: dict[bytes, int]) -> int:
        m = self.m(n)
        return sum(w * (SCALE * counts[t] // (SLOPE * counts[t] + LENGTH * m))
                   for t, w in self.weights[item].items() if t in counts)


def _bounded(index: Index, sent, thresholds) -> DataFrame:
    """(key, item, bound): without thresholds the ``FIRST`` highest bounds above 0 of each item and task;
    with them, every document whose bound reaches the item's threshold."""
    arrow = pa.schema([("key", pa.int64()), ("item", pa.int32()), ("bound", pa.int64())])

    def rows(keys, items, bounds):
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(items, pa.int32()),
                                           pa.array(bounds, pa.int64())], schema=arrow)

    def matrices(batches, block):
        for batch in batches:
            bounds = np.empty((len(batch), len(block.filled)), np.int64)
            for i, (n, sketch) in enumerate(zip(batch.column("n").to_pylist(), batch.column("sketch").to_pylist())):
                bounds[i] = block.bounds(n, sketch)
            yield batch, bounds

    def first(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shipped(sent)
        keys = best = None
        for batch, bounds in matrices(batches, block):
            new = np.repeat(batch.column("key").to_numpy()[:, None], bounds.shape[1], 1)
            if best is not None:
                bounds, new = np.vstack([best, bounds]), np.vstack([keys, new])
            if len(bounds) > FIRST:
                at = np.argpartition(-bounds, FIRST - 1, axis=0)[:FIRST]
                bounds, new = np.take_along_axis(bounds, at, 0), np.take_along_axis(new, at, 0)
            best, keys = bounds, new
        if best is not None:
            i, j = np.nonzero(best > 0)
            yield rows(keys[i, j], block.filled[j], best[i, j])

    def reaching(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shipped(sent)
        score, last = (x[block.filled] for x in shipped(thresholds))
        for batch, bounds in matrices(batches, block):
            ids = batch.column("doc_id").fill_null(np.iinfo(np.int64).max).to_numpy()
            # a bound that only equals the threshold wins by a lower id alone
            i, j = np.nonzero((bounds > score) | ((bounds == score) & (bounds > 0) & (ids[:, None] <= last)))
            if len(i):
                yield rows(batch.column("key").to_numpy()[i], block.filled[j], bounds[i, j])

    return index.sketches.mapInArrow(reaching if thresholds else first, "key long, item int, bound long")


def _rescored(docs: DataFrame, candidates: DataFrame, sent) -> DataFrame:
    """(item, doc_id, score) of the candidate documents (key, items), for their items, from the whole texts."""
    arrow = pa.schema([("item", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shipped(sent)
        for batch in batches:
            out: list[tuple] = []
            for doc, text, items in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "items"))):
                counts = Counter(found := terms_of(text))
                out += [(i, doc, s) for i in items if (s := block.score(i, len(found), counts)) > 0]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), arrow)], schema=arrow)

    return (keyed(docs).join(candidates, "key").select("doc_id", "text", "items")
            .mapInArrow(score, "item int, doc_id long, score long"))


def _ranked(scores: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return scores.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _search_block(docs: DataFrame, index: Index, block: Block, k: int) -> DataFrame:
    spark = docs.sparkSession
    sent = ship(spark, block)
    by_document = lambda pairs: pairs.groupBy("key").agg(F.collect_set("item").alias("items"))
    highest = Window.partitionBy("item").orderBy(F.col("bound").desc(), "key")
    first = (_bounded(index, sent, None).withColumn("place", F.row_number().over(highest))
             .where(F.col("place") <= FIRST))
    # FIRST rows an item of a block of bounded bytes: small enough to broadcast at every size of the corpus
    at_first = _ranked(_rescored(docs, F.broadcast(by_document(first)), sent), k).where(F.col("rank") == k)
    score, last = np.zeros(block.n_items, np.int64), np.zeros(block.n_items, np.int64)
    for row in at_first.select("item", "doc_id", "score").collect():          # one row an item of the block
        score[row.item] = row.score
        last[row.item] = np.iinfo(np.int64).max if row.doc_id is None else row.doc_id
    reaching = by_document(_bounded(index, sent, ship(spark, (score, last))))
    return _ranked(_rescored(docs, reaching, sent), k)


def search(docs: DataFrame, items: DataFrame, k: int = 10, index: Index | None = None) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of every item."""
    spark = docs.sparkSession
    asked = (items.select("item_id", F.col("text").cast("binary").alias("text"))
             .where("text IS NOT NULL").distinct())
    size = F.octet_length("text") + 64
    n_blocks = 1 + (asked.agg(F.sum(size)).first()[0] or 0) // BLOCK_BYTES
    index = index or build_index(docs)
    found = []
    for b in range(n_blocks):
        # a block's items, of bounded bytes, and the frequencies of their terms are held by the driver
        block = asked.where(F.pmod(F.xxhash64("text", "item_id"), F.lit(n_blocks)) == b).collect()
        texts = [bytes(r.text) for r in block]
        terms = sorted({t for text in texts for t in terms_of(text)})
        known = index.frequencies.join(F.broadcast(spark.createDataFrame([(t,) for t in terms], "term binary")), "term")
        df = {bytes(r.term): r.df for r in known.collect()}
        if df:
            names = spark.createDataFrame([(i, r.item_id) for i, r in enumerate(block)], "item int, item_id long")
            ranked = _search_block(docs, index, Block(texts, df, index.n_docs, index.n_terms), k)
            found.append(ranked.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
    if not found:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


#: DuckDB SQL of the registered query, for tables without null or repeated ids.
RANKED_SQL = r"""
WITH d AS (SELECT doc_id, unnest(regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM d GROUP BY ALL),
size AS (SELECT doc_id, count(*) AS n FROM d GROUP BY ALL),
total AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM size),
weight AS (SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS w
           FROM tf, total GROUP BY term, docs),
asked AS (SELECT item_id, unnest(regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
scored AS (SELECT item_id, doc_id,
                  sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // terms))))::BIGINT AS score
           FROM asked JOIN weight USING (term) JOIN tf USING (term) JOIN size USING (doc_id), total
           GROUP BY item_id, doc_id)
SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score
FROM scored WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 10
"""
