"""Intermediate tables in the folder all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

Stage = Callable[[DataFrame], DataFrame]


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, or set as checkpoint folder.

    Only a local session that has neither gets a temporary folder; on a cluster
    such a folder would be lost together with its machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    context = spark.sparkContext
    if not context.getCheckpointDir():
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="marketbars-"))
    return context.getCheckpointDir()


_SCRATCH: ContextVar[tuple[str, list[Callable[[], object]]] | None] = ContextVar(
    "scratch", default=None
)


def new_folder(spark: SparkSession) -> str:
    """The path of a folder in the shared one that nothing else uses."""
    held = _SCRATCH.get()
    root = held[0] if held else f"{shared_dir(spark).rstrip('/')}/marketbars"
    return f"{root}/{uuid.uuid4().hex}"


def at_end(action: Callable[[], object]) -> None:
    """Have something done when the `scratch` around the call ends, if there is one."""
    held = _SCRATCH.get()
    if held:
        held[1].append(action)


def delete(spark: SparkSession, folder: str) -> None:
    """Remove a folder, if it is there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def subfolders(spark: SparkSession, folder: str) -> list[str]:
    """The names of the folders in a folder; none if it is not there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = files.listStatus(path) if files.exists(path) else []
    return [f.getPath().getName() for f in found if f.isDirectory()]


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """A lifetime for copies that queries stage: all new folders go at its end.

    A query's result reads its copies, so it must be written or collected before.
    """
    folder, actions = new_folder(spark), []
    token = _SCRATCH.set((folder, actions))
    try:
        yield
    finally:
        _SCRATCH.reset(token)
        for action in reversed(actions):
            action()
        delete(spark, folder)


def _store(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage(df: DataFrame) -> DataFrame:
    """Write ``df`` once and go on from the stored copy.

    For frames used by more than one branch of a plan: the upstream work runs
    once, each branch reads only its columns, a lost executor costs a re-read,
    and Spark sees the stored size when it decides whether to broadcast. The
    copy stays until the `scratch` around ends, or else as long as the shared
    folder keeps it, like a checkpoint.
    """
    return _store(df, new_folder(df.sparkSession))


@contextmanager
def staging(spark: SparkSession) -> Iterator[Stage]:
    """`stage` for the length of a job: its copies are removed at the end."""
    folder = new_folder(spark)
    try:
        yield lambda df: _store(df, f"{folder}/{uuid.uuid4().hex}")
    finally:
        delete(spark, folder)
