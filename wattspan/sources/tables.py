"""Stored tables: one parquet folder per table, contract re-applied on read."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S


class TableMissing(FileNotFoundError):
    """A table that an earlier stage should have written is not there."""


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def write_table(
    df: DataFrame,
    root: str,
    name: str,
    partition_by: tuple[str, ...] = (),
    sort_by: tuple[str, ...] = (),
) -> str:
    """Overwrite a table.

    Partition columns let readers skip folders; sorting within files narrows the value ranges of
    row groups, so that point and time filters skip those.
    """
    path = table_path(root, name)
    present = [c for c in (*partition_by, *sort_by) if c in df.columns]
    laid = df.sortWithinPartitions(*present) if present else df
    laid.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return path


MANIFEST = "_manifest"


def write_clustered(df: DataFrame, root: str, name: str, by: tuple[str, ...], files: int | None = None) -> str:
    """Overwrite a table whose files hold neighbouring ranges of the `by` columns, and list their ranges.

    Rows are dealt by range and sorted, so a file covers one stretch of the first column. The manifest, one row
    per file with the least and greatest value of every `by` column, lies inside the table's folder: the next
    overwrite drops both together, and a table without one is read whole. `files` is a least number; without
    it Spark's advisory partition size decides.
    """
    path = table_path(root, name)
    dealt = df.repartitionByRange(files, *by) if files else df.repartitionByRange(*by)
    dealt.sortWithinPartitions(*by).write.mode("overwrite").parquet(path)
    ranges = [f(c).alias(f"{c}_{side}") for c in by for f, side in ((F.min, "least"), (F.max, "most"))]
    # Only the key columns are read again.
    held = df.sparkSession.read.schema(df.schema).parquet(path).groupBy(F.col("_metadata.file_path").alias("file"))
    held.agg(F.count(F.lit(1)).alias("n_rows"), *ranges).coalesce(1).write.parquet(f"{path}/{MANIFEST}")
    return path


def read_manifest(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    """(file, n_rows, ranges of the clustering columns) of a clustered table; None where it has none."""
    try:
        return spark.read.parquet(f"{table_path(root, name)}/{MANIFEST}")
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def read_span(
    spark: SparkSession, root: str, name: str, column: str, low=None, high=None, schema: T.StructType | None = None
) -> DataFrame:
    """Rows of a clustered table with `low <= column <= high`, from the files whose ranges meet the span.

    Bounds may be values or expressions over the manifest's whole range `first` and `last`, so that "the
    last day" costs no read of the table.
    """
    whole, manifest = read_table(spark, root, name, schema), read_manifest(spark, root, name)
    if manifest is None:
        ends = whole.agg(F.min(column).alias("first"), F.max(column).alias("last"))
    else:
        ends = manifest.agg(F.min(f"{column}_least").alias("first"), F.max(f"{column}_most").alias("last"))
    kind = whole.schema[column].dataType

    def value(bound, end: str):
        bound = F.col(end) if bound is None else bound
        return (bound if isinstance(bound, Column) else F.lit(bound)).cast(kind)

    found = ends.select(value(low, "first").alias("low"), value(high, "last").alias("high")).first()
    if manifest is not None:
        meets = (F.col(f"{column}_most") >= F.lit(found.low)) & (F.col(f"{column}_least") <= F.lit(found.high))
        files = [r.file for r in manifest.where(meets).select("file").collect()]
        if not files:
            return whole.limit(0)
        whole = S.enforce(spark.read.schema(whole.schema).parquet(*files), whole.schema)
    return whole.where(F.col(column).between(F.lit(found.low), F.lit(found.high)))


def read_table(
    spark: SparkSession, root: str, name: str, schema: T.StructType | None = None
) -> DataFrame:
    """Read a table and pin its contract; raise TableMissing when it was never written."""
    try:
        df = spark.read.parquet(table_path(root, name))
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise TableMissing(f"no table {name} under {root}") from error
        raise
    wanted = schema or S.TABLES.get(name)
    return S.enforce(df, wanted) if wanted is not None else df


def read_tables(spark: SparkSession, root: str, names: list[str]) -> dict[str, DataFrame]:
    return {name: read_table(spark, root, name) for name in names}


def write_json(df: DataFrame, root: str, name: str) -> str:
    """Write nested rows as JSON lines."""
    path = table_path(root, name)
    df.write.mode("overwrite").json(path)
    return path


def write_feature_list(spark: SparkSession, names: list[str], root: str) -> str:
    """Store the ordered feature list beside the matrix as one JSON record."""
    frame = spark.range(1).select(F.array(*[F.lit(n) for n in names]).alias("features"))
    return write_json(frame, root, "feature_names")


def read_feature_list(spark: SparkSession, root: str) -> DataFrame:
    """The stored list as rows (position, feature)."""
    frame = spark.read.schema("features array<string>").json(table_path(root, "feature_names"))
    return frame.select(F.posexplode("features").alias("position", "feature"))
