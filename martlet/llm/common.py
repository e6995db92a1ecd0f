"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import weakref
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from martlet.session import stage, unstage


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Remembered(dict):
    """Values by key, made on first sight, of which at most ``room`` are kept, and none
    for keys of more than ``longest`` characters: so the bytes are bounded, whatever the texts.

    Only the newest of a worker process holds any: starting one empties the others,
    so that operators that follow each other in one worker do not add up.
    """

    _all: weakref.WeakValueDictionary = weakref.WeakValueDictionary()

    def __init__(self, make: Callable, room: int = 400_000, longest: int = 64):
        super().__init__()
        self.make, self.room, self.longest = make, room, longest
        for other in self._all.values():
            other.clear()
        self._all[id(self)] = self

    def __missing__(self, key):
        if len(key) > self.longest:
            return self.make(key)
        if len(self) >= self.room:
            self.clear()
        found = self[key] = self.make(key)
        return found


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once under the cluster's shared folder and read it back.

    This cuts the lineage: what follows survives lost executors without
    computing ``df`` again, and a frame that several consumers read is made once.
    """
    return stage(df, name)


def discard(df: DataFrame) -> None:
    """Delete a materialised frame that nothing reads any more."""
    unstage(df)


def map_texts(df: DataFrame, fn: Callable[[list, list], dict[str, list]], schema: str,
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``schema`` from ``fn(ids, texts)`` per Arrow batch of whole texts.

    ``fn`` is called with the ids and the texts of a batch (nulls stay None) and
    returns the output columns by name. Only the two named columns are read.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow_schema = to_arrow_schema(StructType.fromDDL(schema))

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            # Slices bound the Python objects alive at a time, whatever the batch size.
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                out = fn(part.column(0).to_pylist(), part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[f.name], type=f.type) for f in arrow_schema], schema=arrow_schema)

    return df.select(df[id_col], df[text_col]).mapInArrow(batches, schema)
