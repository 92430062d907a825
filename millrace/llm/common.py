"""Small helpers that several operators share: Arrow mapping by rows, byte-balanced batches, shared tables."""
from __future__ import annotations

import io
import os
import tempfile
import zipfile
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import session


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """`df` as a Parquet table in the shared folder, read back: cuts lineage, and Spark knows its true size.

    The schema is given to the reader, so an empty table keeps its columns.
    """
    path = session.new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Sends this library to the executors, once a context, so that what runs inside tasks can be imported there and
    keeps its tables from task to task. Spark copies the file itself; nobody else reads the driver's folder."""
    context = spark.sparkContext
    if getattr(context, "_millrace_shipped", False):
        return
    root, held = Path(__file__).resolve().parents[2], io.BytesIO()
    with zipfile.ZipFile(held, "w") as z:
        for file in sorted((root / "millrace").rglob("*.py")):
            z.write(file, file.relative_to(root))
    path = os.path.join(tempfile.mkdtemp(prefix="millrace-code-"), "millrace_code.zip")
    Path(path).write_bytes(held.getvalue())
    context.addPyFile(path)
    context._millrace_shipped = True


def by_bytes(batch: pa.RecordBatch, column: int, limit: int):
    """Slices of a batch whose texts hold about `limit` bytes each; one longer text is a slice of its own."""
    sizes = pc.binary_length(batch.column(column)).to_pylist()
    start = held = 0
    for row, size in enumerate(sizes):
        held += size or 0
        if held >= limit:
            yield batch.slice(start, row + 1 - start)
            start, held = row + 1, 0
    if start < batch.num_rows:
        yield batch.slice(start)


def map_arrow(df: DataFrame, columns: list[str], make, schema: str, limit: int = 1 << 20) -> DataFrame:
    """Maps `columns` of `df` (the last is the text) by batches: make() gives, once a task, a function from
    lists of the columns to lists of the output columns of `schema`."""
    ship(df.sparkSession)
    out = df.sparkSession.createDataFrame([], schema).schema

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow, work = to_arrow_schema(out), make()
        for batch in batches:
            for part in by_bytes(batch, batch.num_columns - 1, limit):
                results = work(*[c.to_pylist() for c in part.columns])
                yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(results, arrow)], schema=arrow)
        pa.default_memory_pool().release_unused()

    return df.select(*[F.col(c) for c in columns]).mapInArrow(run, out)


def keep_rows(df: DataFrame, text_col: str, make) -> DataFrame:
    """The rows of `df`, with all their columns, for which make()(texts) says true. Columns are taken by position, so
    their names do not matter."""
    ship(df.sparkSession)
    place = df.columns.index(text_col)

    def run(batches):
        keep = make()
        for batch in batches:
            for part in by_bytes(batch, place, 1 << 20):
                yield part.filter(pa.array(keep(part.column(place).to_pylist()), pa.bool_()))

    return df.mapInArrow(run, df.schema)


def may_hold(keys: DataFrame, *columns: str, most: int = 1 << 27):
    """A function of key columns that says of every row whether `columns` of `keys` may hold its key: never wrongly no,
    wrongly yes for a row in 32 or fewer, for more beyond `most` / 32 keys. A join needs to move only rows it says yes to.

    Every key sets one bit of a map. The map is put together on Spark, 2^15 bits a row; the driver gets and broadcasts
    at most `most` bits of it.
    """
    spark = keys.sparkSession
    ship(spark)
    size = min(most, max(1 << 15, 1 << (32 * keys.count()).bit_length()))
    spot = lambda *key: F.pmod(F.xxhash64(*key), F.lit(size)) + 1
    rows = (keys.groupBy(F.bitmap_bucket_number(spot(*columns)).alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(spot(*columns))).alias("bits")).collect())
    held = np.zeros((size >> 15, 1 << 12), np.uint8)
    for row in rows:
        held[row["bucket"] - 1] = np.frombuffer(row["bits"], np.uint8)
    sent = spark.sparkContext.broadcast(held.tobytes())

    @F.pandas_udf("boolean")
    def marked(spots: pd.Series) -> pd.Series:
        at = spots.to_numpy() - 1
        return pd.Series(np.frombuffer(sent.value, np.uint8)[at >> 3] >> (at & 7) & 1 == 1)

    return lambda *key: marked(spot(*key))


class Memo(dict):
    """A dictionary that computes what it lacks and empties itself when full, so its memory is bounded.

    Only results for keys of at most `longest` characters are kept.
    """

    def __init__(self, compute, most: int = 300_000, longest: int = 64):
        super().__init__()
        self.compute, self.most, self.longest = compute, most, longest

    def __missing__(self, key):
        value = self.compute(key)
        if len(key) <= self.longest:
            if len(self) >= self.most:
                self.clear()
            self[key] = value
        return value
