"""Sources: anything that gives a DataFrame for an object."""

from __future__ import annotations

from typing import Protocol, runtime_checkable

from pyspark.sql import DataFrame, SparkSession

from tidemark.control.store import SourceObject
from tidemark.operators.watermark import Watermark, newer_than
from tidemark.storage.fs import Files


@runtime_checkable
class Source(Protocol):
    def read(self, obj: SourceObject) -> DataFrame: ...


@runtime_checkable
class IncrementalSource(Source, Protocol):
    def read_since(self, obj: SourceObject, since: Watermark | None) -> DataFrame: ...


class ParquetSource:
    """``root/{object_name}.parquet``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def read(self, obj: SourceObject) -> DataFrame:
        path = f"{self.root}/{obj.object_name}.parquet"
        if not Files(self.spark, self.root).exists(path):
            raise FileNotFoundError(f"{obj.object_name}: nothing at {path}")
        return self.spark.read.parquet(path)


class FrameSource:
    """Frames in memory or built elsewhere, by object name."""

    def __init__(self, frames: dict[str, DataFrame]):
        self.frames = frames

    def read(self, obj: SourceObject) -> DataFrame:
        return self.frames[obj.object_name]


class JdbcSource:
    """Tables of a database, by schema and object name; filters on the watermark are pushed into it."""

    def __init__(self, spark: SparkSession, url: str, **options: str):
        self.spark, self.url, self.options = spark, url, options

    def read(self, obj: SourceObject) -> DataFrame:
        return self.spark.read.format("jdbc").options(url=self.url, dbtable=f"{obj.schema_name}.{obj.object_name}", **self.options).load()


class FilteringSource:
    """Makes any source incremental by a filter on top; Parquet and JDBC scans evaluate it themselves."""

    def __init__(self, inner: Source):
        self.inner = inner

    def read(self, obj: SourceObject) -> DataFrame:
        return self.inner.read(obj)

    def read_since(self, obj: SourceObject, since: Watermark | None) -> DataFrame:
        if not obj.incremental_column:
            raise ValueError(f"{obj.object_name} has no incremental column")
        return newer_than(self.inner.read(obj), obj.incremental_column, since)
