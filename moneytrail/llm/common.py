"""Shared folder, lineage cuts and small helpers of the training-data operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Collection, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: A tokeniser, a regex or a numpy pass works on about this many bytes at once.
PIECE_BYTES = 1 << 20


#: Bytes of rows that go to a Python worker at once, where the session has Spark's default.
BATCH_BYTES = 16 << 20


def bound_batches(spark: SparkSession) -> None:
    """Keep the batches of rows that Python workers get small: their copies add up in an executor."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name) == "67108864b":
        spark.conf.set(name, f"{BATCH_BYTES}b")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, whole."""
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors see: ``spark.checkpoint.dir``.

    Where it is unset, a temporary folder serves a ``local`` master; on a cluster that
    folder would be another one on each machine, so it is refused.
    """
    bound_batches(spark)
    context = spark.sparkContext
    known = context.getConf().get("spark.checkpoint.dir", None)
    if known is None and context._jsc.sc().getCheckpointDir().isDefined():
        known = context._jsc.sc().getCheckpointDir().get()
    if known is None:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        known = "file://" + tempfile.mkdtemp(prefix="llm-")
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(known)
    return known.rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Checkpoint in the shared folder: later reads survive lost executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, label: str) -> DataFrame:
    """Parquet in the shared folder, read back: lineage cut with column pruning kept."""
    path = fresh_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library made, by Spark's own file system client."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z, every other character as it is."""
    return F.translate(text, _UPPER, _UPPER.lower())


def crc_mod(doc_id: Column, modulus: int) -> Column:
    """crc32(doc_id as text) mod ``modulus``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def offsets_before(counts: DataFrame, key: str, level: int = 1024) -> DataFrame:
    """(key, offset): the sum of column n over all smaller keys (whole numbers, each once).

    In two levels, so that no window holds all keys: first over runs of ``level`` keys, then inside each.
    """
    high = F.floor(F.col(key) / F.lit(level)).alias("high")
    every = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    top = counts.groupBy(high).agg(F.sum("n").alias("n")).select("high", every(Window.orderBy("high")).alias("base"))
    inner = counts.withColumn("high", high).withColumn("inner", every(Window.partitionBy("high").orderBy(key)))
    return inner.join(top, "high").select(key, (F.col("base") + F.col("inner")).cast("bigint").alias("offset"))


def row_ranges(texts: pa.Array, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows of at most ``limit`` bytes, one row at least.

    ``texts`` has no nulls (string or binary, 32-bit offsets); the bytes are a view of its buffer.
    """
    n = len(texts)
    if not n:
        return
    _, where, data = texts.buffers()
    at = np.frombuffer(where, np.int32)[texts.offset : texts.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        end = max(first + 1, int(np.searchsorted(at, at[first] + limit, "right")) - 1)
        yield first, end, data[at[first] : at[end]], at[first : end + 1] - at[first]
        first = end


def map_texts(docs: DataFrame, text: str, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], results: str, before: dict[str, Column] | None = None) -> DataFrame:
    """``row`` (the other columns), ``text`` and what ``run`` adds to each batch of them.

    ``run`` gets the columns row, text (nulls kept) and those of ``before``, and yields row, text and
    ``results`` (a schema). Rows go to Python and back once, each text once.
    """
    bound_batches(docs.sparkSession)
    others = [F.col(f"`{c}`") for c in docs.columns if c != text]
    rows = docs.select(F.struct(F.lit(0).alias("_"), *others).alias("row"), F.col(text).cast("string").alias("text"), *[v.alias(k) for k, v in (before or {}).items()])
    return rows.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, text string, {results}")


def input_columns(docs: DataFrame, text: str, without: Collection[str] = (), new_text: Column | None = None) -> list[Column]:
    """The input's columns, in their order, from what ``map_texts`` gives."""
    return [(F.col("text") if new_text is None else new_text).alias(c) if c == text else F.col(f"row.`{c}`") for c in docs.columns if c not in without]


def filled(texts: pa.Array | pa.ChunkedArray) -> pa.Array:
    """One contiguous array in which nulls are empty texts."""
    return whole(texts).fill_null("")


def whole(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """One contiguous array."""
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
