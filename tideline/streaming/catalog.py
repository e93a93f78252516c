"""Tables of the catalog: managed copies, and external tables over what ``writers`` keeps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tideline.spec import Dataset
from tideline.streaming import paths, writers


def _quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def save_managed(df: DataFrame, name: str, dataset: Dataset | None = None) -> DataFrame:
    """Replace the managed table ``name`` with ``df``, laid out as the dataset says."""
    dataset = dataset or Dataset(name)
    shaped = writers.lay_out(dataset.shape(df), dataset)
    shaped.write.mode("overwrite").partitionBy(*dataset.partition_by).saveAsTable(name)
    return df.sparkSession.table(name)


def drop(spark: SparkSession, name: str) -> None:
    """Drop a table if there is one; the files of an external table stay."""
    spark.sql(f"DROP TABLE IF EXISTS {_quoted(name)}")


def register(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Make ``name`` an external table over the newest version of the live table at ``path``.

    Call it after every refresh. The name then points to the new version's directory; queries that have started
    go on reading the version they began with.
    """
    version = paths.latest_version(spark, path)
    if version is None:
        raise ValueError(f"{path} holds no live table")
    schema = writers.read_snapshot(spark, path).schema
    location = paths.version_path(path, version)
    parts = [n for n in schema.names if n in _partition_columns(spark, location)]
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    by = f" PARTITIONED BY ({', '.join(f'`{p}`' for p in parts)})" if parts else ""
    drop(spark, name)
    escaped = location.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE {_quoted(name)} ({columns}) USING parquet{by} LOCATION '{escaped}'")
    if parts:
        spark.sql(f"ALTER TABLE {_quoted(name)} RECOVER PARTITIONS")
    return spark.table(name)


def refresh(df: DataFrame, path: str, dataset: Dataset, name: str) -> writers.FlowProgress:
    """Refresh a live table and point its catalog name to the new version."""
    progress = writers.write_live_table(df, path, dataset)
    register(df.sparkSession, name, path)
    return progress


def _partition_columns(spark: SparkSession, folder: str) -> list[str]:
    """Names of the directory levels below ``folder``."""
    names = []
    while True:
        below = next((n for n in paths.children(spark, folder) if "=" in n and not n.startswith(("_", "."))), None)
        if below is None:
            return names
        names.append(below.split("=")[0])
        folder = f"{folder}/{below}"
