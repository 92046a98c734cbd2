"""Small helpers shared by the operators: table access, written tables,
Arrow maps over documents."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mailstream.session import scratch_path, ship_package

# A word is a run of anything but space and \t \n \v \f \r.
WORD = r"[^\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"

# Fixed value: A-Z only, not the locale's case rules.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Documents handled at once inside a Python task.
SLICE_ROWS = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and read it back: the
    lineage is cut, and a lost executor only costs a re-read. The files stay
    until the job's end, so they are packed well."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def lower_ascii(c: Column) -> Column:
    return F.translate(c, UPPER, UPPER.lower())


def count_words(text: Column) -> Column:
    """Number of words (0 for null)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD + "+")), F.lit(0)).cast("long")


def map_rows(df: DataFrame, schema: T.StructType,
             fn: Callable[[list[dict]], Iterator[dict]], slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Arrow map: ``fn`` gets slices of at most ``slice_rows`` rows and yields
    row dicts of ``schema``. Narrow, no shuffle; memory is one Arrow batch
    plus one slice."""
    from pyspark.sql.pandas.types import to_arrow_schema

    ship_package(df.sparkSession)
    out_schema = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, slice_rows):
                rows = list(fn(batch.slice(at, slice_rows).to_pylist()))
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=out_schema)

    return df.mapInArrow(run, schema)


def renamed(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with neutral column names, and which of them stands for a name:
    the column of exactly that name, else the first that differs by letter
    case only. Keeps columns whose names clash apart."""
    names = [f"c{i}" for i in range(len(df.columns))]
    at: dict[str, str] = {}
    for c, n in zip(df.columns, names):
        at.setdefault(c.lower(), n)
    at.update(zip(df.columns, names))
    return df.toDF(*names), at


def only(df: DataFrame, *names: str) -> DataFrame:
    """Just the columns ``names``, whatever else ``df`` holds."""
    own, at = renamed(df)
    return own.select(*[own[at[n]].alias(n) for n in names])


def slices_of(batch: pa.RecordBatch, column: str, most_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose ``column`` holds at most ``most_bytes``
    together (a longer text is a run of its own)."""
    import numpy as np
    import pyarrow.compute as pc

    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.concatenate(([0], np.cumsum(size, dtype=np.int64)))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + most_bytes, side="right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def arrow_map(df: DataFrame, schema: T.StructType, fn) -> DataFrame:
    """``fn`` maps a task's batches to dicts of columns of ``schema``."""
    from pyspark.sql.pandas.types import to_arrow_schema

    ship_package(df.sparkSession)
    out = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cols in fn(batches):
            yield pa.RecordBatch.from_arrays([pa.array(cols[f.name], type=f.type) if not isinstance(cols[f.name], pa.Array)
                                              else cols[f.name].cast(f.type) for f in out], schema=out)

    return df.mapInArrow(run, schema)
