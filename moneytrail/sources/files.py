"""File sources and sinks."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moneytrail.plans import session
from moneytrail.sources.schemas import CSV_DATASETS, raw_schema


# --------------------------------------------------------------------- S1 / S2
def scan_pipe_raw(spark: SparkSession, path: str, dataset: str) -> DataFrame:
    """Pipe-delimited, header-less, unquoted latin-1 text; every column is
    text and named by the pinned layout. Stray quotes and backslashes are data,
    a blank field is NULL, and a malformed line fails the read."""
    return (spark.read.schema(raw_schema(dataset))
            .option("sep", "|")
            .option("header", "false")
            .option("quote", "")
            .option("escape", "")
            .option("comment", "")
            .option("encoding", "ISO-8859-1")
            .option("ignoreLeadingWhiteSpace", "false")
            .option("ignoreTrailingWhiteSpace", "false")
            .option("mode", "FAILFAST")
            .csv(path))


def scan_ie_csv(spark: SparkSession, path: str) -> DataFrame:
    """The IE file is real CSV: comma, double-quoted with doubled-quote
    escape, UTF-8, first line is a header that is dropped (names are pinned and
    applied by position). A quoted field may hold line ends, so a file is one
    task: a large dataset should come as many files."""
    return (spark.read.schema(raw_schema("ie"))
            .option("header", "true")
            .option("enforceSchema", "true")
            .option("sep", ",")
            .option("quote", '"')
            .option("escape", '"')
            .option("multiLine", "true")
            .option("encoding", "UTF-8")
            .option("mode", "FAILFAST")
            .csv(path))


def write_pipe_text(df: DataFrame, path: str) -> str:
    """Write a raw dataset in the bulk-file form: one ``|``-joined latin-1 line
    per row, NULL as an empty field, no quoting, no header."""
    (df.write.mode("overwrite")
       .option("sep", "|").option("header", "false")
       .option("quote", "").option("escape", "").option("quoteAll", "false")
       .option("nullValue", "").option("emptyValue", "")
       .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
       .option("encoding", "ISO-8859-1").csv(path))
    return path


def write_ie_csv(df: DataFrame, path: str) -> str:
    """Write the IE dataset as quoted CSV with a header line."""
    (df.write.mode("overwrite")
       .option("header", "true").option("quote", '"').option("escape", '"')
       .option("quoteAll", "false").option("emptyValue", '""')
       .csv(path))
    return path


def scan_bulk(spark: SparkSession, path, dataset: str) -> DataFrame:
    """S1 or S2, whichever form the dataset's bulk files have."""
    return scan_ie_csv(spark, path) if dataset in CSV_DATASETS else scan_pipe_raw(spark, path, dataset)


def raw_lines(df: DataFrame, dataset: str) -> DataFrame:
    """Any raw dataset in one shape: its name, how many fields are NULL, and
    the fields joined by ``|`` (NULL as nothing)."""
    nulls = sum((F.col(c).isNull().cast("int") for c in df.columns), F.lit(0))
    return df.select(F.lit(dataset).alias("dataset"), nulls.alias("n_null"),
                     F.concat_ws("|", *[F.coalesce(F.col(c), F.lit("")) for c in df.columns])
                     .alias("line"))


# --------------------------------------------------------------------- S4-S6
def land_raw_parquet(df: DataFrame, path: str) -> DataFrame:
    """Write the raw text columns losslessly as zstd parquet (full replace)."""
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def scan_raw_parquet(spark: SparkSession, path: str, dataset: str | None = None) -> DataFrame:
    """Parquet scan of a landed raw dataset (schema pinned when known)."""
    r = spark.read
    if dataset:
        r = r.schema(raw_schema(dataset))
    return r.parquet(path)


def replace_curated(df: DataFrame, path: str) -> DataFrame:
    """Full, idempotent replace of a curated table."""
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def landed_counts(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Row and column count per landed dataset (the landing report)."""
    out = None
    for ds, p in paths.items():
        df = spark.read.parquet(p)
        one = df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(ds).alias("dataset"), "rows", F.lit(len(df.columns)).cast("long").alias("cols"))
        out = one if out is None else out.unionByName(one)
    return out


# --------------------------------------------------------------------- S12
# A document's whole JSON object, NULL fields kept: a reader finds "state": null.
JSON_OPTIONS = {"ignoreNullFields": "false"}


def _marker(path: str) -> str:
    """The file beside an export's folder that marks it as its own: the next export replaces it whole."""
    head, _, name = path.rstrip("/").rpartition("/")
    return f"{head}/.{name}-export"


def write_angles(docs: DataFrame, path: str, tasks: int | None = None) -> str:
    """One JSON document per candidate x angle as ``<dirname>/<angle_id>.json``,
    NULL fields written out; documents of an earlier export that are no longer among
    ``docs`` are gone. Namesakes who run for one seat share a folder: their documents, in the order
    of their text, are ``<angle_id>.json``, ``<angle_id>.2.json`` and so on.

    Tasks stage the documents in a folder beside ``path``; when all are written, the driver
    puts that folder in the place of ``path``. A failed export leaves ``path`` as it was. An
    existing folder is replaced only when an export made it (or it is empty): a folder that
    holds anything else is refused before a document is written. One export at a time."""
    spark = docs.sparkSession
    path = session.fs_qualified(spark, path)
    if not session.fs_exists(spark, _marker(path)) and session.fs_list(spark, path):
        raise ValueError(f"{path} holds files that no export wrote; name another folder")
    staged = _beside(path, "staged")
    stage_documents(docs, staged, tasks)
    before = _beside(path, "before")
    if session.fs_exists(spark, path):
        session.fs_move(spark, path, before)
    try:
        session.fs_move(spark, staged, path)
    except Exception:
        if session.fs_exists(spark, before) and not session.fs_exists(spark, path):
            session.fs_move(spark, before, path)
        raise
    session.fs_write(spark, _marker(path), "")
    if session.fs_exists(spark, before):
        session.fs_delete(spark, before)
    return path


def write_folder(docs: DataFrame, path: str, folder: str, angle_ids: tuple[str, ...]) -> str:
    """The documents of one candidate as ``path/<folder>/<angle_id>.json``, whatever else
    ``path`` holds. Documents of ``angle_ids`` that the candidate no longer has are removed
    from its folder, other files stay."""
    spark = docs.sparkSession
    path = session.fs_qualified(spark, path)
    staged = _beside(path, "staged")
    stage_documents(docs, staged, 1)
    for angle in angle_ids:
        new, old = f"{staged}/{folder}/{angle}.json", f"{path}/{folder}/{angle}.json"
        if session.fs_exists(spark, old):
            session.fs_delete(spark, old)
        if session.fs_exists(spark, new):
            session.fs_mkdirs(spark, f"{path}/{folder}")
            session.fs_move(spark, new, old)
    session.fs_delete(spark, staged)
    return path


def _beside(path: str, what: str) -> str:
    """A new name in the folder that holds ``path`` (the same file system: a rename)."""
    head, _, name = path.rstrip("/").rpartition("/")
    return f"{head}/.{name}-{what}-{uuid.uuid4().hex[:12]}"


def stage_documents(docs: DataFrame, path: str, tasks: int | None = None) -> None:
    """Write every document below the new folder ``path``.

    Spark's writers name their own files, so each task writes its documents to
    their final names through pyarrow's file systems (file, hdfs, s3, gs): first
    under a name of its own in ``_parts``, then moved, so a task that runs twice leaves one
    whole file; what lost tasks leave in ``_parts`` is removed. Documents of one name lie in one task, sorted,
    so each has its number and none replaces another. The explicit task count keeps a
    small document set from being written by one task."""
    spark = docs.sparkSession
    tasks = tasks or spark.sparkContext.defaultParallelism
    fields = [c for c in docs.columns if c not in ("dirname", "angle_id")]
    rows = docs.select("dirname", "angle_id", F.to_json(F.struct(*fields), JSON_OPTIONS).alias("doc"))
    session.fs_mkdirs(spark, f"{path}/_parts")
    laid = rows.repartition(max(1, tasks), "dirname", "angle_id").sortWithinPartitions("dirname", "angle_id", "doc")
    written = laid.mapInArrow(_document_writer(path), "dirname string, angle_id string")
    try:
        written.write.format("noop").mode("overwrite").save()
    except Exception:
        session.fs_delete(spark, path)
        raise
    session.fs_delete(spark, f"{path}/_parts")


def _opener(root: str):
    """For tasks: the file system of ``root`` and its path there."""
    def opened():
        from pyarrow import fs

        return ((fs.LocalFileSystem(), root.removeprefix("file://")) if root.startswith("file://")
                else fs.FileSystem.from_uri(root))

    return opened


def _document_writer(root: str):
    opened = _opener(root)

    def run(batches):
        import uuid

        import pyarrow as pa

        store, base = opened()
        name, n = None, 0
        for batch in batches:
            for row in batch.to_pylist():
                n = n + 1 if name == (row["dirname"], row["angle_id"]) else 1
                name = row["dirname"], row["angle_id"]
                folder = f"{base}/{row['dirname']}"
                store.create_dir(folder, recursive=True)
                part = f"{base}/_parts/{uuid.uuid4().hex}"
                with store.open_output_stream(part) as out:
                    out.write(row["doc"].encode() + b"\n")
                store.move(part, f"{folder}/{row['angle_id']}{f'.{n}' if n > 1 else ''}.json")
            yield pa.RecordBatch.from_arrays([batch.column("dirname"), batch.column("angle_id")],
                                             ["dirname", "angle_id"])

    return run


def read_angles(spark: SparkSession, path: str, schema, tasks: int | None = None) -> DataFrame:
    """The documents of ``write_angles`` with their folder and angle.

    Spark's file sources list every file on the driver and keep what they find; here one task
    names the folders and tasks that share them list and read each. As there, names that begin
    with ``_`` or ``.`` are left out, a line is a record, and one that is no JSON has NULL fields."""
    path = session.fs_qualified(spark, path)
    tasks = tasks or spark.sparkContext.defaultParallelism
    folders = spark.range(1, numPartitions=1).mapInArrow(_folder_lister(path), "folder string")
    docs = folders.repartition(max(1, tasks), "folder").mapInArrow(
        _document_reader(path), "dirname string, angle_id string, doc string")
    return (docs.select(F.from_json("doc", schema).alias("_doc"), "dirname", "angle_id")
            .select("_doc.*", "dirname", "angle_id"))


def _folder_lister(root: str, size: int = 10_000):
    opened = _opener(root)

    def run(batches):
        import pyarrow as pa
        from pyarrow import fs

        store, base = opened()
        for _ in batches:
            found = store.get_file_info(fs.FileSelector(base))
            names = [f.base_name for f in found if f.type == fs.FileType.Directory and f.base_name[0] not in "_."]
            for i in range(0, len(names), size):
                yield pa.RecordBatch.from_pydict({"folder": pa.array(names[i:i + size], pa.string())})

    return run


def _document_reader(root: str, size: int = 1_000):
    opened = _opener(root)

    def run(batches):
        import re

        import pyarrow as pa
        from pyarrow import fs

        store, base = opened()

        def lines():
            for batch in batches:
                for folder in batch.column(0).to_pylist():
                    for f in store.get_file_info(fs.FileSelector(f"{base}/{folder}", recursive=True)):
                        inside = f.path[len(base):].strip("/").split("/")
                        if f.type != fs.FileType.File or any(name[0] in "_." for name in inside):
                            continue
                        with store.open_input_stream(f.path) as stream:
                            text = stream.read().decode()
                        for line in filter(str.strip, text.split("\n")):
                            yield inside[-2], re.sub(r"(\.[0-9]+)?\.json$", "", inside[-1]), line

        names, kept = ("dirname", "angle_id", "doc"), []
        for row in lines():
            kept.append(row)
            if len(kept) == size:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*kept)], names)
                kept = []
        if kept:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*kept)], names)

    return run
