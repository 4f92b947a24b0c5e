"""Input tables written in buckets of a key, so that work by that key needs no exchange.

Measures group claims, fills and spans by member again and again. Tables that are read by many
runs can be written once in buckets of ``member_id``: rows of a member then lie in one file, and
aggregates and windows by member start from the scan.

A scan reads a bucket in one task, so one member with a large share of all rows would make one
long task. ``save_clustered`` counts the rows of every bucket first, and writes a table whose
largest bucket is out of proportion (or which is empty) without buckets; it then reads like any other table.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A table whose largest bucket has more than this many times the mean is not clustered.
MOST_UNEVEN = 4.0


def unevenness(df: DataFrame, key: str, buckets: int) -> float:
    """Rows of the largest bucket, in units of the mean; 0 for an empty table."""
    sizes = df.groupBy(F.pmod(F.hash(key), F.lit(buckets)).alias("bucket")).agg(F.count("*").alias("n"))
    largest, rows = sizes.agg(F.max("n"), F.sum("n")).first()
    return largest * buckets / rows if rows else 0.0


def save_clustered(
    df: DataFrame, path: str, name: str, buckets: int, key: str = "member_id", most_uneven: float = MOST_UNEVEN
) -> DataFrame:
    """Write ``df`` to ``path`` in ``buckets`` buckets of ``key`` and read it as table ``name``.

    A null key is a key like any other. How the table is laid out is written beside it, for
    ``open_clustered``.
    """
    spark = df.sparkSession
    if not 0 < unevenness(df, key, buckets) <= most_uneven:
        buckets = 0
        df.write.mode("overwrite").parquet(path)
    else:
        # one file for each bucket, whatever the number of input partitions
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        writer = df.repartition(buckets, key).write.mode("overwrite").format("parquet")
        writer.bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)
    layout = spark.createDataFrame([(key, buckets)], "key string, buckets int")
    layout.coalesce(1).write.mode("overwrite").parquet(_layout(path))
    return open_clustered(spark, path, name)


def open_clustered(spark: SparkSession, path: str, name: str) -> DataFrame:
    """The table at ``path``, registered as ``name`` with its buckets in a session that lacks it.

    Folders that ``save_clustered`` did not write, or wrote without buckets, are read as they are.
    """
    try:
        layout = spark.read.parquet(_layout(path)).first()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        layout = None
    rows = spark.read.parquet(path)
    if layout is None or not layout["buckets"]:
        return rows
    columns = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in rows.schema.fields)
    spark.sql(f"DROP TABLE IF EXISTS {name}")  # an external table: its files stay
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{layout['key']}`) "
        f"SORTED BY (`{layout['key']}`) INTO {layout['buckets']} BUCKETS LOCATION '{path}'"
    )
    return spark.table(name)


def _layout(path: str) -> str:
    return f"{path.rstrip('/')}.layout"
