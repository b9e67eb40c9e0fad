"""Tables between steps: written to the shared folder, so that a lost executor costs no recomputation."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from flowlab.storage import scratch_path


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once and read again."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def batch_of(schema: pa.Schema, *columns) -> pa.RecordBatch:
    """A batch of columns in the order of ``schema``; without columns it is empty."""
    if not columns:
        columns = [[] for _ in schema]
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


#: Rows that a task handles at a time where they carry whole texts.
PIECE_ROWS = 1024


def pieces(batch: pa.RecordBatch, rows: int = PIECE_ROWS) -> Iterator[pa.RecordBatch]:
    """The batch in pieces, so that what is made of it and sent back stays small."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def text_place(docs: DataFrame, text: str) -> int | None:
    """The place of the column ``text`` if it holds strings and so need not be sent to the tasks a second time as one."""
    return docs.columns.index(text) if (text, "string") in docs.dtypes else None
