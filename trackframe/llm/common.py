"""Helpers that the training-data operators share."""

from __future__ import annotations

import ctypes
import gc
import re
import sys
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A word: a run of characters that are not ASCII white space.
WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Rows and bytes of an Arrow batch that goes to a Python worker: whole texts must fit, and a long one is a batch of its own.
BATCH_ROWS, BATCH_BYTES = 1000, 8 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share; where none is named, a temporary one if Spark runs in one process (tests)."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not named:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        named = "file://" + tempfile.mkdtemp(prefix="trackframe-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(named)
    return named


def columns(names: Iterable[str]) -> list[Column]:
    """Columns by their exact names, whatever characters these have."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in names]


def row_key() -> Column:
    """A 16-byte hash of doc_id and text: rows that share it are alike."""
    return F.unhex(F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.coalesce(F.concat(F.lit(" "), F.col("text")), F.lit("")))))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names like those given that no column of df has."""
    taken, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in taken:
            n += "_"
        taken.add(n.lower())
        out.append(n)
    return out


def checkpointed(df: DataFrame) -> DataFrame:
    """df with its lineage cut, kept in the shared folder so that a lost executor loses nothing."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame) -> DataFrame:
    """df as a Parquet table in the shared folder: for tables that are read more than once by column."""
    return _write(df)[0]


def _write(df: DataFrame) -> tuple[DataFrame, str]:
    path = f"{shared_dir(df.sparkSession)}/trackframe-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


class Scratch:
    """Tables in the shared folder that are deleted together, once what is made of them has been written."""

    def __init__(self):
        self.paths: list[tuple[SparkSession, str]] = []

    def written(self, df: DataFrame) -> DataFrame:
        out, path = _write(df)
        self.paths.append((df.sparkSession, path))
        return out

    def clear(self) -> None:
        for spark, path in self.paths:
            delete(spark, path)
        self.paths = []


def delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def give_back() -> None:
    """Memory that this worker process holds free goes back to the system: the next task may be another stage's, or the JVM may need it."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)


def map_batches(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType) -> DataFrame:
    """mapInArrow that takes columns of any name, dots included; run sees the names of df and gives those of schema."""
    names = df.columns
    plain = T.StructType([T.StructField(f"c{i}", f.dataType) for i, f in enumerate(schema.fields)])

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in run(b.rename_columns(names) for b in batches):
            yield b.rename_columns(plain.names)
        give_back()

    return df.toDF(*[f"c{i}" for i in range(len(names))]).mapInArrow(go, plain).toDF(*schema.names)


def map_texts(
    df: DataFrame,
    make: Callable[[], Callable[[list], Iterable[tuple]]],
    fields: list[T.StructField],
    keep: list[str],
    inputs: tuple[str, ...] = ("text",),
) -> DataFrame:
    """Add columns that are computed from whole rows in Arrow batches; a narrow map, without a shuffle.

    make() runs once a task and returns a function from the lists of the input columns to one tuple a row.
    keep: columns that go through; of these, names in fields are replaced.
    """
    new = {f.name for f in fields}
    keep = [c for c in keep if c not in new]
    schema = T.StructType([df.schema[c] for c in keep] + fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        compute = make()
        types = [to_arrow_type(f.dataType) for f in fields]
        for b in batches:
            if not b.num_rows:
                continue
            rows = list(compute(*[b.column(b.schema.get_field_index(c)).to_pylist() for c in inputs]))
            cols = list(zip(*rows, strict=True))
            arrays = [b.column(b.schema.get_field_index(c)) for c in keep]
            arrays += [pa.array(v, t) for v, t in zip(cols, types, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=keep + [f.name for f in fields])

    need = list(dict.fromkeys([*keep, *inputs]))
    return map_batches(df.select(*columns(need)), run, schema)


def long_(name: str) -> T.StructField:
    return T.StructField(name, T.LongType())


def string_(name: str) -> T.StructField:
    return T.StructField(name, T.StringType())


def bool_(name: str) -> T.StructField:
    return T.StructField(name, T.BooleanType())


def held_out(doc_id: Column) -> Column:
    """Whether a labelled row is kept from training: crc32 of the id as text, mod 3, is 1."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1
