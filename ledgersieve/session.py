"""Session helpers: settings worth fixing, and the shared folder for cut lineage."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

_made: list[str] = []
#: Folders that a session was found to share with its executors.
_seen: set[tuple[str, str]] = set()


def build_session(master: str | None = None, shuffle_partitions: int | None = None, **conf) -> SparkSession:
    """A session with the settings this library relies on; all can be overridden."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Splitting output by outcome and range needs no sort for so few directories.
        "spark.sql.maxConcurrentOutputFileWriters": "16",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.showConsoleProgress": "false",
    }
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update({k: str(v) for k, v in conf.items()})
    builder = SparkSession.builder.appName("ledgersieve")
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder for checkpoints and staged tables: the session's own if it names one.

    Without one, a session whose tasks run in the driver's process takes a temporary folder, any other the
    warehouse, which its executors share as well. A ``file:`` folder may be a mount that all machines have:
    a small job finds out whether the driver sees what the executors write there, and raises if it does not.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    folder = named or _own_dir(spark)
    if not _one_process(context) and _scheme(context, folder) == "file" and (context.applicationId, folder) not in _seen:
        if not _is_shared(spark, folder):
            raise ValueError(f"{folder} is local to each machine; set spark.checkpoint.dir to a folder all executors share")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    _seen.update((context.applicationId, known) for known in (folder, context.getCheckpointDir()))
    return folder.rstrip("/")


def new_work_dir(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder; nothing is created yet.

    ``remove_work_dirs`` deletes it; so does the end of this process, if the session is still up.
    """
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if not _made:
        atexit.register(_remove_at_exit)
    _made.append(path)
    return path


def staged_table(df: DataFrame, name: str) -> DataFrame:
    """Writes the rows to the shared folder and returns a frame that reads them, so that they no longer change."""
    path = new_work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def delete_path(spark: SparkSession, path: str) -> None:
    """Deletes a folder that this library has written; nothing happens if there is none."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def remove_work_dirs(spark: SparkSession) -> None:
    """Deletes the staged copies made so far; frames that read them can no longer be used."""
    while _made:
        delete_path(spark, _made.pop())


def _remove_at_exit() -> None:
    session = SparkSession.getActiveSession()
    if session is not None:
        with contextlib.suppress(Exception):  # the JVM may be gone already; nothing else is lost
            remove_work_dirs(session)


def _own_dir(spark: SparkSession) -> str:
    if _one_process(spark.sparkContext):
        return tempfile.mkdtemp(prefix="ledgersieve-")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/ledgersieve-{uuid.uuid4().hex}"


def _one_process(context) -> bool:
    """Whether tasks run in the driver's process, not in executors with working folders of their own."""
    return context.master.startswith("local") and not context.master.startswith("local-cluster")


def _is_shared(spark: SparkSession, folder: str) -> bool:
    """Whether the driver finds what tasks write to a folder, and tasks what other tasks have written."""
    path, tasks = f"{folder.rstrip('/')}/shared-{uuid.uuid4().hex}", spark.sparkContext.defaultParallelism
    try:
        spark.range(0, tasks, 1, tasks).write.parquet(path)
        return spark.read.schema("id long").parquet(path).count() == tasks
    except (PySparkException, Py4JJavaError):
        return False
    finally:
        delete_path(spark, path)


def _scheme(context, folder: str) -> str:
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(context._jsc.hadoopConfiguration()).getUri().getScheme()
