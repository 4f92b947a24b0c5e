"""What the operators share: tables, folds, bounded batches, texts as code points."""

from __future__ import annotations

import sys
import types
import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caregauge.sources.scratch import scratch_folder

#: Rows and bytes of an Arrow batch: bounds what a Python worker holds at once.
BATCH_ROWS = 2000
BATCH_BYTES = 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Table ``name`` of the folder, with batches to Python workers kept small."""
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession, rows: int = BATCH_ROWS, size: int = BATCH_BYTES) -> None:
    """Long texts must not pile up in one Arrow batch."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))


def fold(doc_id: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id belongs to no fold (-1)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts, F.lit(-1))


def stored_in_buckets(df: DataFrame, purpose: str, key: str) -> DataFrame:
    """As ``stored``, in buckets of ``key``: joins and counts by it need no exchange of these rows.

    There are as many buckets as shuffle partitions. Meant for keys that one task writes all rows of,
    so that every task writes one file and no row is moved.
    """
    spark = df.sparkSession
    name = f"scratch_{uuid.uuid4().hex}"
    writer = df.write.format("parquet").option("compression", "zstd")
    writer = writer.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), key)
    writer.option("path", f"{scratch_folder(spark, purpose)}.parquet").saveAsTable(name)
    rows = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # an external table: its files stay, and ``rows`` reads them
    return rows


def worker_state(key: str, make: Callable[[], object]) -> object:
    """An object that a Python worker makes once and keeps for its later tasks."""
    kept = sys.modules.setdefault("_llm_worker_state", types.ModuleType("_llm_worker_state"))
    if key not in kept.__dict__:
        kept.__dict__[key] = make()
    return kept.__dict__[key]


def groups_of(values: Sequence, sizes: Sequence[int], most: int) -> Iterator[tuple[int, int]]:
    """(begin, end) of runs whose sizes sum to about ``most``; a large value stands alone."""
    begin = total = 0
    for k, size in enumerate(sizes):
        if k > begin and total + size > most:
            yield begin, k
            begin, total = k, 0
        total += size
    if len(values) > begin:
        yield begin, len(values)


def codepoints(texts: Sequence[str]) -> np.ndarray:
    """All texts, each followed by a NUL, as one array of code points."""
    joined = "\0".join(texts) + "\0"
    return np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)


def text_starts(texts: Sequence[str]) -> np.ndarray:
    """Where each text begins in :func:`codepoints`, and the end of all."""
    return np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)))


def smallest_hashes(rows: DataFrame, group: str, most: int, groups: int) -> list[tuple]:
    """(group, doc_id) of the ``most`` rows of each ``group`` value whose ``doc_id`` has the smallest hash.

    A count of each value gives a hash bound that about twice as many rows pass; only these come to
    the driver, which ranks them. So what moves is bounded by ``most`` and ``groups``, whatever the
    table's size. Of more values than ``groups`` the most frequent count, of equally frequent
    ones the first in order.
    """
    sizes = rows.groupBy(group).agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), group).limit(groups).collect()
    h = F.shiftrightunsigned(F.xxhash64("doc_id"), 1)
    bounds = [x for k, n in sizes for x in (F.lit(k), F.lit(min(2**63 - 1, (2**63 - 1) * (2 * most + 100) // n)))]
    if not bounds:
        return []
    near = rows.where(h <= F.create_map(*bounds)[F.col(group)]).select(group, h.alias("h"), "doc_id").distinct().collect()
    taken: dict[object, int] = {}
    out = []
    for value, _, doc_id in sorted(map(tuple, near)):
        taken[value] = taken.get(value, 0) + 1
        if taken[value] <= most:
            out.append((value, doc_id))
    return out


def labelled_ids(labels: DataFrame, label: str, parts: int, held_out: int, per_class: int) -> dict[int, int]:
    """Label by id of a bounded sample: the ``per_class`` rows of each label with the smallest hashes
    among those whose fold isn't ``held_out``. Of repeated ids the largest label counts."""
    once = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & (fold("doc_id", parts) != held_out))
        .groupBy("doc_id")
        .agg(F.max(label).cast("int").alias("y"))
    )
    return {doc_id: y for y, doc_id in smallest_hashes(once, "y", per_class, 2)}


def sample_rows(documents: DataFrame, label_of: dict[int, int]) -> DataFrame:
    """(doc_id, text) of the documents of a sample."""
    return documents.where(F.col("doc_id").isin(list(label_of))).select("doc_id", "text")
