"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.materialize import written
from ..sources.tables import read_table

#: Fixed value: a word is a longest run without space, tab, line feed,
#: vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """The named columns of a given table (other columns are never read)."""
    return read_table(spark, sf_dir, name).select(*cols)


def crc_mod(col: Column, n: int) -> Column:
    """crc32 of the value as text, modulo ``n`` (null stays null)."""
    return F.crc32(col.cast("string").cast("binary")) % n


def slots(spark: SparkSession) -> int:
    """Tasks of one wave for work whose input is tiny but whose CPU time is not."""
    return max(2 * spark.sparkContext.defaultParallelism,
               int(spark.conf.get("spark.sql.shuffle.partitions")))


def apart(docs: DataFrame, *used: str) -> tuple[DataFrame, list[Column]]:
    """``docs`` with its columns other than ``used`` under names that clash with no working column, and
    the columns that give the old names back."""
    names = [c if c in used else f"__{i}" for i, c in enumerate(docs.columns)]
    return docs.toDF(*names), [F.col(n).alias(c) for n, c in zip(names, docs.columns)]


def ship(spark: SparkSession, value) -> Broadcast:
    """A broadcast of an object whose class the workers need not be able to import."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def shipped(sent: Broadcast, build=lambda value: value):
    """What ``build`` makes of the object of ``ship``, made once by each worker that is used again.

    It goes with the broadcast, which a worker drops at its first task of a job that does not use it:
    what one operator remembers is not held while another one runs."""
    if not hasattr(sent, "unpacked"):
        sent.unpacked = build(cloudpickle.loads(sent.value))
    return sent.unpacked


def whole_groups(batches: Iterable[pa.RecordBatch], *keys: str) -> Iterator[pa.Table]:
    """Batches sorted by (integer) keys, cut anew so that no group spans two tables."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not len(batch):
            continue
        cols = [batch.column(k).to_numpy() for k in keys]
        if held and any(held[-1].column(k)[-1].as_py() != c[0] for k, c in zip(keys, cols)):
            yield pa.Table.from_batches(held)
            held = []
        other = np.flatnonzero(np.logical_or.reduce([c != c[-1] for c in cols]))
        if len(other):                               # the last group may go on in the next batch
            cut = int(other[-1]) + 1
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = [batch.slice(cut)]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


__all__ = ["WORD", "apart", "crc_mod", "ship", "shipped", "slots", "table", "whole_groups", "written"]
