"""Session settings and shared folders.

Everything here is ordinary SparkSession configuration. Derived tables and
checkpoints live under ``spark.checkpoint.dir``, a folder that all executors
share. Where it is unset, a ``local[...]`` session (tests, one machine) gets a
private folder under the system temp dir; on a cluster that folder would be a
different one on every machine, so the library refuses to run there without
the setting.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

# Settings the library relies on (UTC for timestamp_ntz formatting, AQE for
# runtime coalescing / skew splitting, ANSI stays on as Spark's default).
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "moneytrail") -> SparkSession:
    """Create (or reuse) a session with the library's settings."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    for k, v in SESSION_CONF.items():
        b = b.config(k, v)
    b = (b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
          .config("spark.ui.enabled", "false")
          .config("spark.driver.memory", os.environ.get("MONEYTRAIL_DRIVER_MEMORY", "16g"))
          .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    return spark


def prepare(spark: SparkSession) -> None:
    """Apply the runtime settings to a session someone else created."""
    for k, v in SESSION_CONF.items():
        if spark.conf.isModifiable(k):
            spark.conf.set(k, v)
    checkpoint_dir(spark)


_LOCAL_ROOT: dict[str, str] = {}


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and derived tables:
    ``spark.checkpoint.dir``, or a fresh private one for a ``local`` master."""
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if root is None:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        app = app_id(spark)
        if app not in _LOCAL_ROOT:
            _LOCAL_ROOT[app] = tempfile.mkdtemp(prefix="moneytrail-")
        root = _LOCAL_ROOT[app]
    if sc._jsc.sc().getCheckpointDir().isEmpty():  # noqa: SLF001
        sc.setCheckpointDir(os.path.join(root, "checkpoints"))
    return root


def app_id(spark: SparkSession) -> str:
    return spark.sparkContext.applicationId


def scratch_path(spark: SparkSession, *parts: str, unique: bool = False) -> str:
    """A path under the shared folder; ``unique`` adds a fresh component."""
    p = os.path.join(checkpoint_dir(spark), "moneytrail", *parts)
    if unique:
        p = os.path.join(p, uuid.uuid4().hex[:12])
    return p


# --------------------------------------------------------------- shared folder
# Paths may live on any Hadoop-compatible file system, so the session's own
# client is asked; an error of the file system is an error here, never "absent".
def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm  # noqa: SLF001 - classic sessions only
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())  # noqa: SLF001


def fs_exists(spark: SparkSession, path: str) -> bool:
    p, fs = _fs(spark, path)
    return bool(fs.exists(p))


def fs_status(spark: SparkSession, path: str) -> tuple[int, int] | None:
    """(total length, latest modification time) of a file or directory tree."""
    p, fs = _fs(spark, path)
    if not fs.exists(p):
        return None
    cs = fs.getContentSummary(p)
    mtime = max(int(st.getModificationTime()) for st in fs.listStatus(p))
    return int(cs.getLength()), mtime


def fs_list(spark: SparkSession, path: str) -> list[str]:
    """Names directly below ``path`` (none when it does not exist)."""
    p, fs = _fs(spark, path)
    return sorted(st.getPath().getName() for st in fs.listStatus(p)) if fs.exists(p) else []


def fs_modified(spark: SparkSession, path: str) -> int:
    """When a file or folder was last changed (milliseconds)."""
    p, fs = _fs(spark, path)
    return int(fs.getFileStatus(p).getModificationTime())


def fs_listing(spark: SparkSession, path: str) -> dict[str, tuple[int, int, bool]]:
    """name -> (length, modification time, is a folder) of what lies directly below ``path``."""
    p, fs = _fs(spark, path)
    return {st.getPath().getName(): (int(st.getLen()), int(st.getModificationTime()), bool(st.isDirectory()))
            for st in fs.listStatus(p)} if fs.exists(p) else {}


def fs_read(spark: SparkSession, path: str) -> str:
    """A small text file, whole."""
    p, fs = _fs(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def fs_write(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text file, replacing it."""
    p, fs = _fs(spark, path)
    out = fs.create(p, True)
    out.write(bytearray(text, "utf-8"))
    out.close()


def fs_create(spark: SparkSession, staged: str, path: str, text: str) -> bool:
    """Make ``path`` a file that holds ``text``, whole at once; False when it exists already.

    The text is written to ``staged``, which then becomes ``path`` in one step that fails where
    another writer was first: a hard link on a local disk, else a rename that never replaces."""
    jvm = spark._jvm  # noqa: SLF001 - classic sessions only
    p, fs = _fs(spark, staged)
    out = fs.create(p, True)
    out.write(bytearray(text, "utf-8"))
    out.close()
    q, _ = _fs(spark, path)
    fs.mkdirs(q.getParent())
    local = fs.getUri().getScheme() == "file"
    try:
        if local:
            paths = jvm.java.nio.file.Paths
            uri = lambda x: jvm.java.net.URI("file://" + fs.makeQualified(x).toUri().getPath())
            jvm.java.nio.file.Files.createLink(paths.get(uri(q)), paths.get(uri(p)))
            fs.delete(p, False)
        else:
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
                fs.getUri(), spark._jsc.hadoopConfiguration())  # noqa: SLF001
            options = jvm.org.apache.hadoop.fs.Options
            none = spark.sparkContext._gateway.new_array(getattr(options, "Rename"), 1)  # noqa: SLF001
            none[0] = getattr(options, "Rename").NONE
            context.rename(p, q, none)
    except Py4JJavaError as e:
        if "FileAlreadyExists" in str(e.java_exception.getClass().getName()):
            fs.delete(p, False)
            return False
        raise
    return True


def fs_qualified(spark: SparkSession, path: str) -> str:
    """The path with the scheme that Spark itself resolves it to (``fs.defaultFS`` where it
    names none), so that executors' own clients write where Spark would."""
    p, fs = _fs(spark, path)
    full = fs.makeQualified(p)
    uri = full.toUri()
    return f"file://{uri.getPath()}" if uri.getScheme() == "file" else full.toString()


def fs_mkdirs(spark: SparkSession, path: str) -> None:
    """Make a folder and its parents."""
    p, fs = _fs(spark, path)
    fs.mkdirs(p)


def fs_move(spark: SparkSession, path: str, to: str) -> None:
    """Rename a file or folder; an error where ``to`` exists (a plain rename would move a
    folder INTO an existing one)."""
    p, fs = _fs(spark, fs_qualified(spark, path))
    q, _ = _fs(spark, fs_qualified(spark, to))
    jvm = spark._jvm  # noqa: SLF001 - classic sessions only
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        fs.getUri(), spark._jsc.hadoopConfiguration())  # noqa: SLF001
    rename = getattr(jvm.org.apache.hadoop.fs.Options, "Rename")
    none = spark.sparkContext._gateway.new_array(rename, 1)  # noqa: SLF001
    none[0] = rename.NONE
    context.rename(p, q, none)


def fs_delete(spark: SparkSession, path: str) -> None:
    """Remove a folder that this library made."""
    p, fs = _fs(spark, path)
    fs.delete(p, True)
