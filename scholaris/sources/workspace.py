"""Intermediate tables, kept in the shared folder the cluster names."""

import re
import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context
from functools import partial

from pyspark.sql import DataFrame, SparkSession

_local_folders: dict[str, str] = {}
_scoped_paths: ContextVar[list[str] | None] = ContextVar("scoped_paths", default=None)


def workspace(spark: SparkSession) -> str:
    """This application's folder below `spark.checkpoint.dir`.

    Executors must be able to read it after the one that wrote it is gone. Whether the
    folder is shared cannot be seen from its name, so the setting is demanded; only where
    the whole application is one process (master `local` or `local[...]`) is a temporary
    folder made for an application that has none.
    """
    app = spark.conf.get("spark.app.id")
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        if app not in _local_folders:
            _local_folders[app] = tempfile.mkdtemp(prefix="scholaris-")
        shared = _local_folders[app]
    return f"{shared.rstrip('/')}/scholaris/{app}"


def new_path(spark: SparkSession, name: str) -> str:
    path = f"{workspace(spark)}/{name}-{uuid.uuid4().hex}"
    if (paths := _scoped_paths.get()) is not None:
        paths.append(path)
    return path


@contextmanager
def intermediate_tables(spark: SparkSession):
    """Delete at the end what was stored inside the block.

    For work whose results are all written elsewhere by then; frames that still read an
    intermediate table must not leave the block.
    """
    token = _scoped_paths.set([])
    try:
        yield
    finally:
        for path in _scoped_paths.get():
            _delete(spark, path)
        _scoped_paths.reset(token)


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame written out and read back.

    The result has files behind it: later passes read only the columns they use, and
    an executor lost later costs a re-read, not a recomputation.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def together[T](work: dict[str, Callable[[], T]]) -> dict[str, T]:
    """What each of some jobs returns, all run at the same time: the tasks of one fill the cores that another leaves idle.

    All of them end before this does; of errors the first in order is raised.
    """
    with ThreadPoolExecutor(max_workers=max(len(work), 1)) as pool:
        # Each thread works in a copy of this context, so that a block still knows its tables.
        tasks = {key: pool.submit(copy_context().run, job) for key, job in work.items()}
        return {key: task.result() for key, task in tasks.items()}


def in_turn(*work: Callable[[], object]) -> Callable[[], None]:
    """One job of several that wait for each other."""

    def all_of_it() -> None:
        for job in work:
            job()

    return all_of_it


def stored_together(frames: dict[str, DataFrame], name: str) -> dict[str, DataFrame]:
    """Each frame written out and read back, all at the same time: small jobs that would wait for each other."""
    return together({key: partial(stored, df, f"{name}-{key}") for key, df in frames.items()})


def clear_workspace(spark: SparkSession) -> None:
    """Delete this application's intermediate tables, once no result needs them."""
    _delete(spark, workspace(spark))


def children(spark: SparkSession, folder: str) -> list[str]:
    """Names of what lies in a folder; none if there is no such folder."""
    path, files = _folder(spark, folder)
    if not files.exists(path):
        return []
    return sorted(status.getPath().getName() for status in files.listStatus(path))


def delete_folder(spark: SparkSession, folder: str) -> None:
    _delete(spark, folder)


def write_text(spark: SparkSession, file: str, text: str) -> None:
    """A small new file; one of that name is not replaced."""
    path, files = _folder(spark, file)
    stream = files.create(path, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def read_text(spark: SparkSession, file: str) -> str:
    return "\n".join(row["value"] for row in spark.read.text(file).collect())


def replace_folder(spark: SparkSession, source: str, target: str) -> None:
    """Put `source` in the place of `target`, which is deleted; nothing happens without `source`."""
    (new, files), (old, _) = _folder(spark, source), _folder(spark, target)
    if not files.exists(new):
        return
    files.delete(old, True)
    files.mkdirs(old.getParent())
    if not files.rename(new, old):
        raise RuntimeError(f"cannot move {source} to {target}")


def _folder(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def _delete(spark: SparkSession, folder: str) -> None:
    path, files = _folder(spark, folder)
    files.delete(path, True)
