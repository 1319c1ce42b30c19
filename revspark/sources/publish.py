"""Outputs of several tables that change together.

A run writes its tables beside the ones of earlier runs, under a folder of its own, and then publishes
all of them by one small file, the manifest, which names the run and its tables::

    out/_manifest.json                      {"run": "...", "tables": {"product_stats": ..., ...}}
    out/runs/<run>/product_stats/...
    out/runs/<run>/ranked_reviews/...

The manifest is written aside and renamed over the old one, so a reader sees the tables of one run: of
the previous one until that moment, of the new one after it. A job that dies between two tables leaves
the previous run as it was; its folder goes with the next run that is published, as do runs older than
the one before.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from revspark.session import file_system

MANIFEST, RUNS = "_manifest.json", "runs"


def _read_text(spark: SparkSession, path: str) -> str | None:
    fs, to_path = file_system(spark, path)
    if not fs.exists(to_path(path)):
        return None
    stream = fs.open(to_path(path))
    try:
        utils = spark.sparkContext._jvm.org.apache.commons.io.IOUtils
        return utils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a file aside and rename it over ``path``: readers see the old one or the new one."""
    jvm = spark.sparkContext._jvm
    fs, to_path = file_system(spark, path)
    aside = f"{path}.{uuid.uuid4().hex}"
    stream = fs.create(to_path(aside), True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(to_path(aside), to_path(path), options)


def new_run(output_path: str) -> str:
    """The folder of a new run; nothing reads it until it is published."""
    return f"{output_path.rstrip('/')}/{RUNS}/{uuid.uuid4().hex}"


def published(spark: SparkSession, output_path: str) -> dict[str, str]:
    """Paths of the tables of the run that is published, by name; none before the first one."""
    base = output_path.rstrip("/")
    text = _read_text(spark, f"{base}/{MANIFEST}")
    if text is None:
        return {}
    manifest = json.loads(text)
    return {name: f"{base}/{RUNS}/{manifest['run']}/{name}" for name in manifest["tables"]}


def publish(spark: SparkSession, run: str, tables: list[str]) -> None:
    """Make a run's tables, all written, the ones that are read; keep the previous run's for readers
    that have begun, and remove all others."""
    runs, name = run.rsplit("/", 1)
    base = runs.rsplit("/", 1)[0]
    manifest = f"{base}/{MANIFEST}"
    before = _read_text(spark, manifest)
    _replace_text(spark, manifest, json.dumps({"run": name, "tables": sorted(tables)}))
    keep = {name, json.loads(before)["run"]} if before else {name}
    fs, to_path = file_system(spark, runs)
    for status in fs.listStatus(to_path(runs)):
        if status.getPath().getName() not in keep:
            fs.delete(status.getPath(), True)


def read_published(spark: SparkSession, output_path: str, table: str,
                   schema: StructType | None = None) -> DataFrame:
    """A table of the published run: JSON lines of ``schema``, or Parquet without one."""
    path = published(spark, output_path)[table]
    return spark.read.schema(schema).json(path) if schema else spark.read.parquet(path)
