"""Operator 2: toxicity by nearest labelled examples.

A document's score is the distance-weighted vote of its nearest labelled
examples under exact TF-IDF cosine, calibrated; the neighbours are returned as
evidence.

* ``fit`` uses a bounded sample of the labelled training rows: those of least
  keyed hash of their id, up to ``MAX_EXAMPLES`` rows and ``MAX_CHARS``
  characters of text.  The features are all words and word beginnings
  (``PREFIXES`` letters, for inflected and compound forms) of the sample, as
  64-bit hashes.  How surely a feature tells the sample's classes apart
  is a factor of its weight, never 0, so a long text's neighbours are found by
  what matters for the label more than by its filler.  Document frequencies
  are counted over all documents.
* The examples form an inverted index of blocks of ``BLOCK`` examples, with
  the greatest weight of each term in each block; frequent terms are rows of a
  matrix.  A query sums the frequent terms first; the k-th best of these sums is
  a threshold, and postings are read only in blocks whose upper bound reaches
  it: the top k are exact.
* Raw votes are calibrated by isotonic regression on the examples' own
  leave-one-out votes.  A text without any word of the sample gets the base
  rate, and less than ``REJECT``: no evidence is no reason to reject.

Sample, vocabulary, index and calibration are bounded by the sample's rows and
characters, so the model is a bounded broadcast whatever the size of the
corpus, and the driver holds nothing of the sample but arrays of numbers.
Scoring is one pass over the documents without a shuffle.

Defined results: null text counts as empty; label rows without an id or a
label are ignored; of several labels of an id the greatest counts; of several
texts of a labelled id the least is the example; a row without an id is not
held out; without labelled rows the score is 0.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BooleanType, DoubleType, IntegerType, LongType, StructField,
                               StructType)

from .common import apart, crc_mod, ship, shipped, slots, written

#: Parameters of the fit: most labelled rows, and characters of their texts; the likelihood ratio (twice its logarithm) at which a
#: word has half of the full weight, and the share of it that every word has.
MAX_EXAMPLES, MAX_CHARS, SURE, FLOOR = 16_384, 2_500_000, 64.0, 0.02
#: Lengths of the word beginnings that may be features, ascending.
PREFIXES = (4, 5, 6, 7)
#: Neighbours, examples of a block, evidence rows kept, score from which a text is rejected.
NEIGHBOURS, BLOCK, EVIDENCE, REJECT = 15, 128, 3, 0.3
#: A term that stands in one of so many examples is kept as a row of a matrix.
FREQUENT = 20

_WORD = re.compile(r"[^\W\d_]+")
_LETTERS = "".join(chr(i) if chr(i).isalpha() else " " for i in range(128))
#: Characters of a text whose words are held at once; words whose features a worker remembers.
PIECE, HELD_WORDS = 2_000_000, 400_000
#: Rows that are scored and handed on at once.
ROWS = 1_024


def words_of(text: str | None):
    """Lists of the letter runs of the text, lower-cased, piece by piece."""
    text = (text or "").lower()
    if len(text) <= PIECE and text.isascii():        # the same words by cheaper means
        yield text.translate(_LETTERS).split()
        return
    at = 0
    while at < len(text):
        end = min(len(text), at + PIECE)
        while end < len(text) and text[end - 1].isalpha():      # not inside a word
            end += 1
        yield _WORD.findall(text, at, end)
        at = end


def codes_of(word: str, code=xxhash.xxh3_64_intdigest) -> list[int]:
    """Codes of the word and, marked by a star, of its beginnings."""
    return [code(word), *[code(word[:k] + "*") for k in PREFIXES if len(word) > k]]


class Vocabulary:
    """Features by number: their codes, ascending.  A task remembers the numbers of words that it met."""

    def __init__(self, codes: np.ndarray):
        self.codes, self.size, self.numbers = codes, len(codes), None
        self.forget()

    def __getstate__(self):
        return {"codes": self.codes, "size": self.size, "known": {}, "beginnings": {}, "numbers": None}

    def forget(self) -> None:
        """Of the words that were met; a worker that waits for its next task holds the codes alone."""
        self.known, self.beginnings = {}, {}

    def _features(self, words: list[str]) -> list[tuple[int, ...]]:
        """The numbers of each word's features; those of words that are not remembered are looked up."""
        found = list(map(self.known.get, words))
        if None not in found:
            return found
        if self.numbers is None:
            self.numbers = dict(zip(self.codes.tolist(), range(self.size)))
        if max(len(self.known), len(self.beginnings)) > HELD_WORDS:
            self.forget()
        known = self.known
        for i, features in enumerate(found):
            if features is None:
                word = words[i]
                features = known.get(word)
                if features is None:
                    features = known[word] = self._look_up(word)
                found[i] = features
        return found

    def _look_up(self, word: str, code=xxhash.xxh3_64_intdigest) -> tuple[int, ...]:
        # where a beginning is no feature, neither is a longer one, nor the word
        beginnings, numbers, size, found = self.beginnings, self.numbers, len(word), ()
        for k in PREFIXES:
            if size <= k:
                break
            begin = word[:k]
            upto = beginnings.get(begin)
            if upto is None:                         # the features up to this one, if it is one
                number = numbers.get(code(begin + "*"))
                upto = beginnings[begin] = False if number is None else (*found, number)
            if upto is False:
                return found
            found = upto
        number = numbers.get(code(word))
        return found if number is None else (*found, number)

    def present(self, text: str | None) -> np.ndarray:
        """Numbers of the features in the text."""
        found: set[int] = set()
        for words in words_of(text):
            found.update(chain.from_iterable(self._features([*set(words)])))
        return np.fromiter(found, np.int64, len(found))

    def held(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and counts of the features in the text."""
        found: Counter = Counter()
        for words in words_of(text):
            found.update(chain.from_iterable(self._features(words)))
        return np.fromiter(found, np.int64, len(found)), np.fromiter(found.values(), np.int64, len(found))

    def counts(self, text: str | None) -> dict[int, int]:
        return dict(zip(*(x.tolist() for x in self.held(text))))


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers of the ranges, one after another."""
    return np.arange(size.sum()) + np.repeat(start - (np.cumsum(size) - size), size)


def _arrays(vector) -> tuple[np.ndarray, np.ndarray]:
    """(terms, weights) of a sparse vector, given so or as a dict."""
    if isinstance(vector, dict):
        terms = sorted(vector)
        return np.array(terms, np.int64), np.array([vector[t] for t in terms], float)
    return vector


class BlockMaxIndex:
    """Sparse unit vectors by term, in blocks, with the greatest weight of each term in each block.

    Vectors are laid out by their heaviest terms, so that a block's vectors are alike and its
    greatest weights are close to each vector's own; empty vectors are in no block.  The postings of
    a term that stands in a ``FREQUENT``-th of the vectors are a row of a matrix: their part of every
    cosine is one product, exact, and counts in a block's bound by its greatest value in the block."""

    def __init__(self, n_terms: int, vectors):
        """vectors: (terms ascending, weights) of each example, or a dict of them."""
        heaviest, own = [], []
        for i, vector in enumerate(vectors):
            terms, weights = _arrays(vector)
            own.append((terms, weights.astype(np.float32)))
            if len(terms):
                heaviest.append((tuple(terms[np.lexsort((terms, -weights))[:8]].tolist()), i))
        self.order = np.array([i for _, i in sorted(heaviest)], np.int64)
        held = [own[i] for i in self.order.tolist()]
        terms = np.concatenate([t for t, _ in held] or [np.zeros(0, np.int32)])
        weights = np.concatenate([w for _, w in held] or [np.zeros(0, np.float32)])
        place = np.repeat(np.arange(len(held), dtype=np.int32), [len(t) for t, _ in held])
        del own, held, heaviest, vectors
        by_term = np.argsort(terms, kind="stable")
        terms, place, weights = terms[by_term], place[by_term], weights[by_term]
        del by_term
        distinct, of, often = np.unique(terms, return_inverse=True, return_counts=True)
        frequent = often * FREQUENT >= max(1, len(self.order))
        self.row = np.full(n_terms, -1, np.int32)
        self.row[distinct[frequent]] = np.arange(frequent.sum())
        dense = frequent[of]
        self.matrix = np.zeros((int(frequent.sum()), len(self.order)), np.float32)
        self.matrix[self.row[terms[dense]], place[dense]] = weights[dense]
        terms, self.place, self.weight = terms[~dense], place[~dense], weights[~dense]
        del place, weights, of, dense
        block = self.place // BLOCK
        # a run: the vectors of one block that hold one term
        first = np.flatnonzero(np.append(True, (terms[1:] != terms[:-1]) | (block[1:] != block[:-1]))[:len(terms)])
        self.run = np.append(first, len(terms))
        self.block = block[first]
        self.most = np.maximum.reduceat(self.weight, first) if len(first) else self.weight
        self.at = np.searchsorted(terms[first], np.arange(n_terms + 1))
        self.runs_of, self.length = np.diff(self.at), np.diff(self.run)

    def top(self, query, k: int) -> list[tuple[float, int]]:
        """The k examples of greatest positive cosine: (cosine, example); query: (terms, weights), or a dict."""
        terms, values = _arrays(query)
        if not len(terms) or not len(self.order):
            return []
        row = self.row[terms]
        frequent = row >= 0
        score = (values[frequent].astype(np.float32) @ self.matrix[row[frequent]]).astype(float)
        terms, values = terms[~frequent], values[~frequent]
        size = self.runs_of[terms]
        first = self.run[self.at[terms]]
        held = self.run[self.at[terms + 1]] - first
        if held.sum() <= 4 * size.sum():             # bounds of blocks would cost what the postings cost
            postings, weights = _ranges(first, held), np.repeat(values, held)
            score += np.bincount(self.place[postings], weights * self.weight[postings], len(score))
            return self._best(score, k)
        runs = _ranges(self.at[terms], size)
        weights = np.repeat(values, size)
        block = self.block[runs]
        starts = np.arange(0, len(self.order), BLOCK)
        bound = np.bincount(block, weights * self.most[runs], len(starts)) + np.maximum.reduceat(score, starts)
        least = 0.0
        if len(score) > k:                           # what is summed so far is at most the cosine
            least = max(0.0, float(np.partition(score, len(score) - k)[len(score) - k]))
        # sums may round down, the bound as well as the cosines
        some = (bound > 0) & (bound * (1 + 1e-5) >= least)
        if not some.all():
            mine = some[block]
            runs, weights = runs[mine], weights[mine]
        lengths = self.length[runs]
        postings = _ranges(self.run[runs], lengths)
        score += np.bincount(self.place[postings], np.repeat(weights, lengths) * self.weight[postings], len(score))
        return self._best(score, k)

    def _best(self, score: np.ndarray, k: int) -> list[tuple[float, int]]:
        least = 0.0
        if len(score) > k:
            least = max(0.0, float(np.partition(score, len(score) - k)[len(score) - k]))
        found = np.flatnonzero((score >= least) & (score > 0))
        best = sorted(zip((-score[found]).tolist(), self.order[found].tolist()))[:k]
        return [(min(1.0, -s), i) for s, i in best]


def _unit(weights: np.ndarray) -> np.ndarray:
    norm = float(np.sqrt(weights @ weights))
    return weights / norm if norm else weights


@dataclass
class Model:
    terms: Vocabulary
    idf: np.ndarray
    ids: list[int]
    labels: np.ndarray
    index: BlockMaxIndex
    base: float
    empty: float
    steps: tuple[np.ndarray, np.ndarray]

    def unit(self, terms: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return terms, _unit((1 + np.log(counts)) * self.idf[terms])

    def vector(self, counts: dict[int, int]) -> dict[int, float]:
        return dict(zip(counts, self.unit(*(x.astype(np.int64) for x in _arrays(counts)))[1].tolist()))

    def vote(self, near: list[tuple[float, int]]) -> float:
        """Votes weighted by closeness, with one vote at half weight for the base rate."""
        weights = [1 / (1.05 - min(1.0, cosine)) for cosine, _ in near]
        votes = sum(w * self.labels[i] for w, (_, i) in zip(weights, near))
        return (votes + 0.5 * self.base) / (sum(weights) + 0.5)

    def score(self, counts) -> tuple[float, list[tuple[float, int]]]:
        near = self.index.top(self.unit(*(x.astype(np.int64) for x in _arrays(counts))), NEIGHBOURS)
        if not near:
            return self.empty, near
        return float(np.interp(self.vote(near), *self.steps)), near


def _isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the rising fit of y on x (pooled adjacent violators), each pool shrunk to the mean."""
    pools: list[list[float]] = []                    # sum y, n, sum x
    mean = float(y.mean())
    for a, b in sorted(zip(x.tolist(), y.tolist())):
        if pools and pools[-1][2] / pools[-1][1] == a:
            pools[-1][0] += b
            pools[-1][1] += 1
            pools[-1][2] += a
        else:
            pools.append([b, 1, a])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            last = pools.pop()
            pools[-1] = [p + q for p, q in zip(pools[-1], last)]
    at = np.array([p[2] / p[1] for p in pools])
    return at, np.array([(p[0] + mean) / (p[1] + 1) for p in pools])


def _sample(docs: DataFrame, labels: DataFrame, train) -> DataFrame:
    """(doc_id, toxic, text) of the bounded sample of training rows, one row an id."""
    rows = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & train(F.col("doc_id")))
            .groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic")))
    order = [F.xxhash64("doc_id", F.lit(5)), F.col("doc_id")]
    # the broadcast sides: MAX_EXAMPLES rows of two numbers at most
    first = F.broadcast(rows.orderBy(*order).limit(MAX_EXAMPLES))
    sizes = (docs.select("doc_id", F.coalesce(F.length("text"), F.lit(0)).alias("chars")).join(first, "doc_id")
             .groupBy("doc_id", "toxic").agg(F.max("chars").alias("chars")))
    known = written(sizes, "toxicity/sizes")
    held, total = [], 0
    for row in known.orderBy(*order).collect():                  # MAX_EXAMPLES narrow rows at most
        total += row.chars
        if held and total > MAX_CHARS:
            break
        held.append((row.doc_id, row.toxic))
    chosen = docs.sparkSession.createDataFrame(held, "doc_id long, toxic int")
    text = F.coalesce("text", F.lit(""))
    return written(docs.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic").agg(F.min(text).alias("text"))
                   .repartition(slots(docs.sparkSession), "doc_id"), "toxicity/sample")


def _code_counts(sample: DataFrame) -> DataFrame:
    """(code, rows, toxic): in how many sample documents a feature stands, by class, for each task."""
    def run(batches):
        codes, labels = [], []
        for batch in batches:
            for text, toxic in zip(batch.column(0), batch.column(1)):
                words = set().union(*words_of(text.as_py()))
                own = np.unique(np.fromiter(chain.from_iterable(map(codes_of, words)), np.uint64))
                codes.append(own)
                labels.append(np.full(len(own), toxic.as_py(), np.int64))
        if codes:
            distinct, of = np.unique(np.concatenate(codes), return_inverse=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(distinct.view(np.int64)), pa.array(np.bincount(of)),
                 pa.array(np.bincount(of, np.concatenate(labels)).astype(np.int64))], names=["code", "rows", "toxic"])

    return sample.select("text", "toxic").mapInArrow(run, "code bigint, rows bigint, toxic bigint")


def _sureness(rows: np.ndarray, toxic: np.ndarray, base: float) -> np.ndarray:
    """Factor of each word's weight, by the likelihood ratio of its own rate of toxic rows against the base rate."""
    if not len(rows):
        return rows
    rows, toxic = np.maximum(rows, 0), np.minimum(np.maximum(toxic, 0), np.maximum(rows, 0))

    def part(n, expected):
        return n * np.log(np.maximum(n, 1e-300) / np.maximum(expected, 1e-300))

    ratio = 2 * np.maximum(0, part(toxic, rows * base) + part(rows - toxic, rows * (1 - base)))
    return FLOOR + (1 - FLOOR) * ratio / (ratio + SURE)


def _own_votes(spark, model: "Model", rows: pa.Table, idf: np.ndarray, held: np.ndarray, toxic: np.ndarray) -> list[tuple[int, float]]:
    """(example, vote of its nearest other examples) of the examples that have any.

    idf, held, toxic: of each word, to weigh an example's words as if its own label were not known."""
    if not len(rows):
        return []
    sent = ship(spark, (model, idf, held, toxic))

    def found(model, idf, held, toxic, y, terms, counts):
        at = np.frombuffer(terms, np.int32).astype(np.int64)
        weights = idf[at] * _sureness(held[at] - 1, toxic[at] - y, model.base)
        return model.index.top((at, _unit(weights * (1 + np.log(np.frombuffer(counts, np.int64))))), NEIGHBOURS + 1)

    def run(batches):
        values, known = shipped(sent), {}
        model = values[0]
        for batch in batches:
            out = []
            for i, *key in zip(*(c.to_pylist() for c in batch.columns)):
                if tuple(key) not in known:          # copies vote once
                    known[tuple(key)] = found(*values, *key)
                near = [x for x in known[tuple(key)] if x[1] != i][:NEIGHBOURS]
                if near:
                    out.append((i, model.vote(near)))
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in out], pa.int64()),
                                              pa.array([v for _, v in out], pa.float64())], names=["example", "vote"])

    table = rows.select(["toxic", "terms", "counts"]).add_column(0, "example", pa.array(range(len(rows)), pa.int64()))
    voted = spark.createDataFrame(table).repartition(slots(spark), "example").mapInArrow(run, "example bigint, vote double")
    return sorted((r.example, r.vote) for r in voted.collect())


def fit(docs: DataFrame, labels: DataFrame, train=lambda doc_id: F.lit(True)) -> Model:
    """The model from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic) where ``train(doc_id)``."""
    spark = docs.sparkSession
    sample = _sample(docs, labels, train)
    n, toxic = (x or 0 for x in sample.agg(F.count("*"), F.sum("toxic")).first())
    base = toxic / n if n else 0.0
    codes = held = of_toxic = np.zeros(0)
    if 0 < toxic < n:
        stats = (_code_counts(sample).groupBy("code").agg(F.sum("rows").alias("rows"), F.sum("toxic").alias("toxic"))
                 .toArrow())
        codes = stats.column("code").to_numpy().view(np.uint64)
        by = np.argsort(codes)
        codes, held, of_toxic = codes[by], *(stats.column(c).to_numpy()[by].astype(float) for c in ("rows", "toxic"))
        del stats
    terms = Vocabulary(codes.astype(np.uint64))
    sent = ship(spark, terms)

    def frequencies(batches):
        terms = shipped(sent)
        total, rows = np.zeros(terms.size + 1, np.int64), 0
        for batch in batches:
            for text in batch.column(0):
                total[terms.present(text.as_py())] += 1
            rows += len(batch)
        terms.forget()
        total[-1] = rows
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["term", "n"])

    counted = np.zeros(terms.size + 1)
    if terms.size:
        found = (docs.select("text").mapInArrow(frequencies, "term bigint, n bigint")
                 .groupBy("term").agg(F.sum("n").alias("n")).toArrow())
        counted[found.column("term").to_numpy()] = found.column("n").to_numpy()
        del found
    idf = np.log((counted[-1] + 1) / (counted[:-1] + 1)) + 1

    def counts(batches):
        terms = shipped(sent)
        for batch in batches:
            found = [(t.astype(np.int32), n) for t, n in (terms.held(x.as_py()) for x in batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array([t.tobytes() for t, _ in found], pa.binary()),
                 pa.array([c.tobytes() for _, c in found], pa.binary())], names=["doc_id", "toxic", "terms", "counts"])
        terms.forget()

    # the examples as arrays of numbers, bounded by the sample's rows and characters
    rows = (sample.select("doc_id", "text", "toxic")
            .mapInArrow(counts, "doc_id bigint, toxic int, terms binary, counts binary").toArrow().sort_by("doc_id"))
    rows = rows if terms.size else rows.slice(0, 0)
    model = Model(terms, idf * _sureness(held, of_toxic, base), rows.column("doc_id").to_pylist(),
                  rows.column("toxic").to_numpy().astype(float), BlockMaxIndex(terms.size, []), base, min(base, REJECT / 2),
                  (np.array([0.0, 1.0]), np.array([0.0, 1.0])))
    model.index = BlockMaxIndex(terms.size, (
        model.unit(np.frombuffer(t.as_buffer(), np.int32).astype(np.int64), np.frombuffer(c.as_buffer(), np.int64))
        for t, c in zip(rows.column("terms"), rows.column("counts"))))
    # without the example itself, by the tasks of a bounded table
    votes = _own_votes(spark, model, rows, idf, held, of_toxic)
    if votes:
        model.steps = _isotonic(np.array([v for _, v in votes]), model.labels[[i for i, _ in votes]])
    return model


_ADDED = [StructField("score", DoubleType()), StructField("predicted", IntegerType()),
          StructField("evidence", ArrayType(StructType([
              StructField("doc_id", LongType()), StructField("cosine", DoubleType()),
              StructField("toxic", BooleanType())])))]


def apply(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` (with text) and score, predicted, evidence: the nearest examples (columns of these
    names in the input are replaced)."""
    docs = docs.drop(*(f.name for f in _ADDED))
    schema = StructType([*docs.schema.fields, *_ADDED])
    evidence_type = pa.list_(pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64()), ("toxic", pa.bool_())]))
    sent = ship(docs.sparkSession, model)

    def run(batches):
        model, known = shipped(sent), {}
        ids, labels = model.ids, model.labels
        for batch in (b.slice(at, ROWS) for b in batches for at in range(0, len(b), ROWS)):
            found = []
            for text in batch.column(batch.schema.get_field_index("text")):
                text = text.as_py() or ""
                key = xxhash.xxh3_128_digest(text)                   # copies are scored once
                if key not in known:
                    if len(known) > 20_000:
                        known.clear()
                    score, near = model.score(model.terms.held(text))
                    known[key] = score, near[:EVIDENCE]
                found.append(known[key])
            evidence = [[{"doc_id": ids[i], "cosine": c, "toxic": bool(labels[i])} for c, i in near] for _, near in found]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([s for s, _ in found], pa.float64()),
                 pa.array([int(s >= REJECT) for s, _ in found], pa.int32()), pa.array(evidence, evidence_type)],
                names=[*batch.schema.names, *(f.name for f in _ADDED)])
        model.terms.forget()

    return docs.mapInArrow(run, schema)


def is_training(doc_id):
    """Labels are learnt from ids whose crc32, as text, modulo 4 is not 2."""
    return crc_mod(doc_id, 4) != 2


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, evidence for every document."""
    docs = docs.select("doc_id", "text")
    model = fit(docs, labels.select("doc_id", "toxic"), is_training)
    return apply(docs, model).select("doc_id", F.coalesce(~is_training(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
                                     "predicted", "evidence")


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, as they are."""
    model = fit(docs, labels.select("doc_id", "toxic"), is_training)
    rows, back = apart(docs, "doc_id", "text")
    return apply(rows, model).where("predicted = 0").select(*back)
