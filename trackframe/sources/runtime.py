"""Runtime sets: folders of files that a dataset's sensors ran with, named by episodes, copied by content.

A set is <folder>/<id>/ with manifest.json (schema_version 2, runtime_set_id, sensors: name to serial, runtime, runtime_sha256).
"""

from __future__ import annotations

import posixpath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackframe.operators.datasets import RUNTIME_ID

from . import store

VERSION = 2
_MANIFEST = "schema_version int, runtime_set_id string, sensors map<string, struct<serial: string, runtime: string, runtime_sha256: string>>"
#: A file of a manifest lies in the manifest's folder: a relative path without a step up.
INSIDE = r"^(?!/)(?!(.*/)?\.\.(/|$)).+$"


def sensors(spark: SparkSession, root: str, folder: str) -> DataFrame:
    """set_id, version, named (the manifest's own id), sensor, serial, runtime, runtime_sha256; a manifest without sensors has one row without."""
    base = f"{store.qualified(spark, root)}/{folder}"
    files = store.listed(spark, base).where(F.col("path").rlike("^[^/]+/manifest\\.json$"))
    if files.isEmpty():
        return spark.createDataFrame([], "set_id string, version int, named string, sensor string, serial string, runtime string, runtime_sha256 string")
    text = spark.read.text(f"{base}/*/manifest.json", wholetext=True).select(F.element_at(F.split(F.input_file_name(), "/"), -2).alias("set_id"), F.from_json("value", _MANIFEST).alias("m"))
    rows = text.select("set_id", F.col("m.schema_version").alias("version"), F.col("m.runtime_set_id").alias("named"), F.explode_outer("m.sensors").alias("sensor", "s"))
    return rows.select("set_id", "version", "named", "sensor", "s.serial", "s.runtime", "s.runtime_sha256")


def faults(used: DataFrame, held: DataFrame, files: DataFrame, serials: list[str]) -> DataFrame:
    """set_id, sensor, why: what is wrong with sets that episodes use.

    used: set_id, one row or more each; held: as `sensors` gives; files (set_id, path below the set, sha256). serials: those that
    every set must have, and no other; none: not checked.
    """
    u = used.select("set_id").distinct()
    h = u.join(held, "set_id", "left")
    f = files.select("set_id", F.col("path").alias("runtime"), "sha256")
    j = h.join(f, ["set_id", "runtime"], "left")
    why = (
        F.when(F.col("set_id").isNull() | ~F.col("set_id").rlike(RUNTIME_ID), "id")
        .when(F.col("version").isNull(), "no manifest")
        .when(F.col("version") != VERSION, "version")
        .when(~F.col("named").eqNullSafe(F.col("set_id")), "other id")
        .when(F.col("sensor").isNull() | F.col("serial").isNull(), "no sensor")
        .when(F.col("runtime").isNull() | ~F.col("runtime").rlike(INSIDE), "path")
        .when(F.col("sha256").isNull(), "no file")
        .when(~F.col("sha256").eqNullSafe(F.col("runtime_sha256")), "content")
    )
    out = j.select("set_id", "sensor", why.alias("why")).where("why is not null")
    if serials:
        wanted = F.array(*map(F.lit, sorted(set(serials))))
        of_set = h.where("serial is not null").groupBy("set_id").agg(F.array_sort(F.collect_set("serial")).alias("serials"))
        out = out.union(of_set.where(F.col("serials") != wanted).select("set_id", F.lit(None).cast("string").alias("sensor"), F.lit("serials").alias("why")))
    return out


def files_of(spark: SparkSession, root: str, folder: str, used: DataFrame) -> DataFrame:
    """set_id, path below the set, source, sha256 of the files of sets that are used; contents are read by tasks."""
    files = store.listed(spark, f"{root}/{folder}").where(F.col("path").contains("/"))
    split = files.select(F.substring_index("path", "/", 1).alias("set_id"), F.expr("substring(path, locate('/', path) + 1)").alias("path"), "source")
    return store.hashed(split.join(used.select("set_id").distinct(), "set_id", "left_semi"))


def collisions(files: DataFrame) -> DataFrame:
    """set_id of sets that several datasets (owner) hold with different files; files: owner, set_id, path, sha256."""
    one = files.groupBy("owner", "set_id").agg(F.sha2(F.array_join(F.array_sort(F.collect_list(F.concat("path", F.lit(" "), "sha256"))), "\n"), 256).alias("content"))
    return one.groupBy("set_id").agg(F.count_distinct("content").alias("contents")).where("contents > 1").select("set_id")


def copies(files: DataFrame, target: str, folder: str) -> DataFrame:
    """source, target of each set's files, each set once whoever holds it."""
    once = files.groupBy("set_id", "path").agg(F.min("source").alias("source"))
    return once.select("source", F.concat(F.lit(posixpath.join(target, folder) + "/"), "set_id", F.lit("/"), "path").alias("target"))


__all__ = ["collisions", "copies", "faults", "files_of", "sensors"]
