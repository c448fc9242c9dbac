"""Folders and files of any store that Spark's Hadoop can open: whole publication, and copies made by tasks.

Spark lists, and the driver renames: a folder is one or a few names to it, however much it holds. Contents are read and
written in tasks only.
"""

from __future__ import annotations

import hashlib
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes that a copy holds at once.
BLOCK = 1 << 20


def _at(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def qualified(spark: SparkSession, path: str) -> str:
    """path with its store's scheme, so that Spark and the tasks' own writers mean the same place."""
    store, p = _at(spark, path)
    return str(store.makeQualified(p)).rstrip("/")


def scratch(spark: SparkSession) -> str:
    """A new folder that all executors share, under spark.checkpoint.dir; where that is unset, a temporary one if Spark runs in one process."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        named = "file://" + tempfile.mkdtemp(prefix="trackframe-")
    return f"{qualified(spark, named)}/trackframe-{uuid.uuid4().hex}"


def exists(spark: SparkSession, path: str) -> bool:
    store, p = _at(spark, path)
    return store.exists(p)


def delete(spark: SparkSession, path: str) -> None:
    store, p = _at(spark, path)
    store.delete(p, True)


def rename(spark: SparkSession, old: str, new: str) -> None:
    """old under the name new, which must be free: a store would put it below a folder that is there."""
    store, p = _at(spark, new)
    if store.exists(p):
        raise FileExistsError(new)
    store.mkdirs(p.getParent())
    if not store.rename(spark._jvm.org.apache.hadoop.fs.Path(old), p):
        raise OSError(f"{old} could not be renamed to {new}")


def _beside(spark: SparkSession, output: str, kind: str) -> list[str]:
    """Folders .name.kind-* beside an output."""
    store, p = _at(spark, output)
    if p.getParent() is None or not store.exists(p.getParent()):
        return []
    prefix = f".{p.getName()}.{kind}-"
    return sorted(str(f.getPath()) for f in store.listStatus(p.getParent()) if f.getPath().getName().startswith(prefix))


def recover(spark: SparkSession, output: str) -> None:
    """Undo what a publication that was killed left: the old folder comes back, or goes if the new one was in place."""
    backups = _beside(spark, output, "backup")
    if backups and not exists(spark, output):
        rename(spark, backups.pop(), output)
    for path in backups:
        delete(spark, path)


@contextmanager
def published(spark: SparkSession, output: str, overwrite: bool = False) -> Iterator[str]:
    """A folder beside output to write to, which becomes output when the block ends well, and else is deleted.

    An output that is there already is an error unless `overwrite`; then it is set aside, the new one takes its name, and
    only then it is deleted. Where that fails, the old one gets its name back; where the driver dies on the way, the
    next publication (or `recover`) does so. A reader sees the old folder, the new one, or for a moment none, and never
    half of one. Renames must be those of a file system: on a store of objects they copy. Folders .name.stage-* of a
    killed driver stay, as another driver may be writing to one. Two publications of one output at a time: one fails.
    """
    output = qualified(spark, output)
    parent, _, name = output.rpartition("/")
    recover(spark, output)
    if exists(spark, output) and not overwrite:
        raise FileExistsError(f"{output} is there already; overwrite it?")
    mark = uuid.uuid4().hex
    stage, backup = f"{parent}/.{name}.stage-{mark}", f"{parent}/.{name}.backup-{mark}"
    try:
        yield stage
        if not exists(spark, stage):
            raise ValueError(f"nothing was written for {output}")
        if not exists(spark, output):
            rename(spark, stage, output)
            return
        if not overwrite:
            raise FileExistsError(f"{output} has come meanwhile")
        rename(spark, output, backup)
        try:
            rename(spark, stage, output)
        except BaseException:
            if not exists(spark, output):
                rename(spark, backup, output)
            raise
        delete(spark, backup)
    finally:
        delete(spark, stage)


def local_store(path: str):
    """The store of a path, and the path in it, for a task's own reads and writes."""
    from pyarrow import fs

    if path.startswith("file:/"):
        path = path.removeprefix("file:").removeprefix("//")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def opened(path: str):
    """A file for random access, by a task."""
    store, inner = local_store(path)
    return store.open_input_file(inner)


@contextmanager
def whole_file(path: str) -> Iterator:
    """A stream to write to; the file has its name only when the block ends well, and leaves nothing if it doesn't.

    Attempts of a task write beside one another, and the last one to end counts.
    """
    store, inner = local_store(path)
    store.create_dir(inner.rsplit("/", 1)[0], recursive=True)
    task = TaskContext.get()
    own = f"{inner}.{task.taskAttemptId() if task else 0}-{uuid.uuid4().hex}.tmp"
    out = store.open_output_stream(own)
    try:
        yield out
        out.close()
        store.move(own, inner)
    except BaseException:
        out.close()
        store.delete_file(own)
        raise


def listed(spark: SparkSession, root: str, hidden: str = r"(^|/)[._]") -> DataFrame:
    """path below root, source (the whole path), bytes of each file; contents are not read. Hidden files are left out, and files without bytes, which Spark's listing skips."""
    root = qualified(spark, root)
    if not exists(spark, root):
        return spark.createDataFrame([], "path string, source string, bytes long")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select(F.col("path").alias("source"), F.col("length").alias("bytes"))
    path = F.substring("source", len(root) + 2, 1 << 30)
    return files.select(path.alias("path"), "source", "bytes").where(~F.col("path").rlike(hidden))


def hashed(files: DataFrame, source: str = "source") -> DataFrame:
    """files with sha256 of what is under the path `source`, read in blocks by tasks; null: there is no such file."""
    names = files.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [_digest(p) if p is not None else None for p in b.column(source).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.string())], names=[*names, "sha256"])

    schema = T.StructType([*files.schema.fields, T.StructField("sha256", T.StringType())])
    return _spread(files, source).mapInArrow(run, schema)


def _digest(path: str) -> str | None:
    try:
        with opened(path) as f:
            h = hashlib.sha256()
            while block := f.read(BLOCK):
                h.update(block)
            return h.hexdigest()
    except FileNotFoundError:
        return None


def _spread(files: DataFrame, by: str) -> DataFrame:
    """Files over tasks: each is one row of work, however few rows there are."""
    spark = files.sparkSession
    n = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return files.repartition(n, by)


def copied(files: DataFrame) -> DataFrame:
    """Copy files (source, target): source, target, bytes, sha256, state (copied, there) when the rows are read.

    A target with the same content stays as it is; one with another content is an error, and so is a source that is
    not there or that changes while it is read. Each copy is one row of a task, in blocks, and whole or not there, so
    a task that runs again does no harm.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [_copy(s, t) for s, t in zip(b.column("source").to_pylist(), b.column("target").to_pylist(), strict=True)]
            size, digest, state = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([b.column("source"), b.column("target"), pa.array(size, pa.int64()), pa.array(digest, pa.string()), pa.array(state, pa.string())], names=["source", "target", "bytes", "sha256", "state"])

    return _spread(files.select("source", "target"), "target").mapInArrow(run, "source string, target string, bytes long, sha256 string, state string")


def _copy(source: str, target: str) -> tuple[int, str, str]:
    before = _digest(target)
    if before is not None:
        if _digest(source) != before:
            raise ValueError(f"{target} is there with another content than {source}")
        with opened(target) as f:
            return f.size(), before, "there"
    h, n = hashlib.sha256(), 0
    with opened(source) as f, whole_file(target) as out:
        while block := f.read(BLOCK):
            h.update(block)
            n += len(block)
            out.write(block)
    if _digest(target) != h.hexdigest():
        raise OSError(f"{target}: the copy differs from what was read")
    return n, h.hexdigest(), "copied"


__all__ = ["copied", "delete", "exists", "hashed", "listed", "opened", "published", "qualified", "recover", "rename", "scratch", "whole_file"]
