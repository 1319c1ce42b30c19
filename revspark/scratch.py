"""Scratch: who owns the tables that a query or a job writes for itself, and when they go.

Intermediate tables, checkpoints and catalog tables are written under the shared folder
(``session.checkpoint_dir``) and belong to a scope::

    with scratch(spark):
        query(spark, sf_dir).write.parquet(out)

Everything that was written within the scope is removed at its end, on failure too. Results are lazy
DataFrames that read these tables, so the scope must enclose the action. Scopes nest: an inner one
removes its own tables only. Without any scope the tables belong to the session, and go when the
interpreter ends.

A table that a scope owns is always complete: it was written by one job's commit. A scope that is
never closed (a killed driver) leaves its folder, whose name starts with ``scratch-``.
"""

from __future__ import annotations

import atexit
import contextlib
import uuid
from collections.abc import Iterator
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from revspark.session import checkpoint_dir, file_system


class Scratch:
    """Paths and catalog tables that are removed together."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []
        self.tables: list[str] = []

    def path(self, name: str) -> str:
        """A new, unique path under the shared folder, removed with the scope."""
        base = checkpoint_dir(self.spark).rstrip("/")
        path = f"{base}/scratch-{name}-{uuid.uuid4().hex}"
        self.paths.append(path)
        return path

    def table(self, name: str) -> str:
        """A new, unique name of a catalog table, dropped with the scope."""
        table = f"scratch_{name}_{uuid.uuid4().hex}"
        self.tables.append(table)
        return table

    def release(self, df_path: str) -> None:
        """Remove one path before the scope ends."""
        if df_path in self.paths:
            self.paths.remove(df_path)
            fs, to_path = file_system(self.spark, df_path)
            fs.delete(to_path(df_path), True)

    def close(self) -> None:
        tables, self.tables = self.tables, []
        for table in tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        for path in list(self.paths):
            self.release(path)


_SCOPES: ContextVar[tuple[Scratch, ...]] = ContextVar("revspark_scratch", default=())
_OF_SESSION: dict[str, Scratch] = {}


def _close_session(owner: Scratch) -> None:
    # The session may have been stopped, or its JVM gone: then there is nobody left to ask.
    with contextlib.suppress(Exception):
        owner.close()


def current(spark: SparkSession) -> Scratch:
    """The innermost open scope, else the session's own."""
    open_scopes = _SCOPES.get()
    if open_scopes:
        return open_scopes[-1]
    key = spark.sparkContext.applicationId
    if key not in _OF_SESSION:
        _OF_SESSION[key] = Scratch(spark)
        atexit.register(_close_session, _OF_SESSION[key])
    return _OF_SESSION[key]


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[Scratch]:
    """A scope that owns all tables written within it and removes them at its end."""
    scope = Scratch(spark)
    token = _SCOPES.set((*_SCOPES.get(), scope))
    try:
        yield scope
    finally:
        _SCOPES.reset(token)
        scope.close()


def shared_path(spark: SparkSession, name: str) -> str:
    """A new, unique path for a written table that the current scope owns."""
    return current(spark).path(name)


def kept_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: the lineage is cut there, so a
    lost executor never sends a later step back to the source."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
