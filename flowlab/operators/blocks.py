"""Training rows as blocks of NumPy arrays, for trainers that pass over all rows many times.

A block is cut inside its task and written to the shared folder first: its rows, and so the random choices that are seeded
by it, stay the same when a lost executor's blocks are read again. Blocks are dealt out evenly, to as many tasks as their
rows are worth and the cluster has cores, however few files the table came in.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReader, MLWriter
from pyspark.sql import Column, DataFrame, functions as F

from flowlab.functions.names import quoted
from flowlab.operators.batches import matrix, packed
from flowlab.storage import scratch_path

BLOCK_ROWS = 1 << 14
#: Rows of a partition at least, as far as there are as many.
TASK_ROWS = 1 << 13
#: The same where several fits keep the cores busy between them.
SHARED_TASK_ROWS = 1 << 17


#: ``x``: rows x features, missing values as NaN; ``y``: classes; a checksum to seed random choices.
Block = tuple[np.ndarray, np.ndarray, int]


def training_blocks(
    df: DataFrame, features: Sequence[str], label: str, block_rows: int = BLOCK_ROWS, side_by_side: int = 1
) -> tuple[RDD, int]:
    """The labelled rows as an RDD of blocks, and their number. Rows without a label are left out. So many fits that run
    ``side_by_side`` share the cores: each gets fewer and larger tasks."""
    spark, width = df.sparkSession, len(features)
    rows = df.select(packed([quoted(c) for c in features]).alias("x"), quoted(label).cast("int").alias("y")).filter("y is not null")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, block_rows):
                part = batch.slice(at, block_rows)
                x = np.ascontiguousarray(matrix(part.column("x"), width))
                y = part.column("y").to_numpy(zero_copy_only=False).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([len(y)], pa.int64()), pa.array([x.tobytes()], pa.binary()), pa.array([y.tobytes()], pa.binary())],
                    names=["n", "x", "y"],
                )

    path = scratch_path(spark, "blocks")
    schema = "n long, x binary, y binary"
    rows.mapInArrow(cut, schema).write.parquet(path)
    table = spark.read.schema(schema).parquet(path)
    row = table.agg(F.sum("n"), F.count("*")).first()
    total = row[0] or 0
    cores = max(1, spark.sparkContext.defaultParallelism // side_by_side)
    tasks = max(1, min(cores, row[1], -(-total // (TASK_ROWS if side_by_side == 1 else SHARED_TASK_ROWS))))

    def block(row) -> Block:
        x, y = np.frombuffer(row.x, np.float64), np.frombuffer(row.y, np.int32)
        return x.reshape(row.n, width), y, zlib.crc32(row.x, zlib.crc32(row.y))

    return table.repartition(tasks).rdd.map(block), total


def scored_columns(df: DataFrame, features: Sequence[str], scorer: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """Adds ``probability``, the scores of each class, and ``prediction``, the lowest class of the highest score.

    ``scorer`` turns a matrix of features into one of scores and runs in the tasks, batch by batch.
    """

    @F.pandas_udf("array<double>")
    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            x = np.stack(batch.to_numpy()) if len(batch) else np.empty((0, len(features)))
            yield pd.Series(list(scorer(x)), dtype=object)

    named = df.withColumn("probability", scores(packed([quoted(c) for c in features])))
    return named.withColumn("prediction", best_class(F.col("probability")))


def best_class(scores: Column) -> Column:
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("double")


class ArrayModelWriter(MLWriter):
    """Writes a model's settings as metadata and its arrays as rows of a Parquet table."""

    def __init__(self, model):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        settings, arrays = self.model.state()
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession, extraMetadata={"settings": json.dumps(settings)})
        rows = [(name, a.dtype.str, list(a.shape), a.tobytes()) for name, a in arrays.items()]
        table = self.sparkSession.createDataFrame(rows, "name string, kind string, shape array<int>, data binary")
        table.coalesce(1).write.parquet(f"{path}/arrays")


class ArrayModelReader(MLReader):
    def __init__(self, kind):
        super().__init__()
        self.kind = kind

    def load(self, path: str):
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        rows = self.sparkSession.read.parquet(f"{path}/arrays").collect()
        arrays = {r.name: np.frombuffer(r.data, r.kind).reshape(r.shape) for r in rows}
        model = self.kind.from_state(json.loads(metadata["settings"]), arrays)
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model
