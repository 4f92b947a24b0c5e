"""SimHash near-duplicates linked through a grid over per-segment bit counts.

A fingerprint is mapped to the vector of the bit counts of its 32 two-bit segments. The
Manhattan distance of two vectors never exceeds the Hamming distance of the fingerprints. So
fingerprints within 3 bits have vectors within 3, and in one of the two halves (16 segments
each) within 1. In each half the vectors are points of an integer grid: every point stands in
its own cell, and points of even coordinate sum also look into the neighbouring cells (points at
distance 1 differ in parity). What meets in a cell is verified on the fingerprints.

Defined results: null and empty texts have fingerprint 0 and link like any other; words are cut
at ASCII white space only; repeated rows and ids share a component; a null doc_id is larger than
any other for ``component_id``; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caregauge.llm.common import bounded_batches
from caregauge.llm.components import components
from caregauge.sources.scratch import stored

SHINGLE = 3
SEED = 42
MAX_BITS = 3
#: Members of a cell that one task compares with each other; larger cells go to several tasks.
CELL_BLOCK = 2048

_LOW = 0x55555555  # the low bit of every two-bit segment of a half


def fingerprint(text: str | None) -> int:
    """64-bit SimHash of the word 3-shingles of ``text``, unsigned."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space
    if not words:
        return 0
    if len(words) < SHINGLE:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(words, words[1:], words[2:]))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(x, SEED) for x in shingles], "<u8")
    octets = hashes.view(np.uint8).reshape(-1, 8)
    if len(hashes) < 256:
        counts = np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    else:  # histogram of the octet values at each place, then bits of the values
        seen = np.bincount((octets + np.arange(0, 2048, 256, dtype=np.uint16)).ravel(), minlength=2048)
        bits = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
        counts = (seen.reshape(8, 256) @ bits).ravel()
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(documents: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and ``fp`` (the fingerprint as a signed long) of every row."""
    bounded_batches(documents.sparkSession)
    rows = documents.select(*keep, "text")
    schema = rows.drop("text").withColumn("fp", F.lit(0).cast("long")).schema

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            texts = part.column(part.num_columns - 1).to_pylist()
            fps = np.array([fingerprint(t) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(fps)], [*part.schema.names[:-1], "fp"])

    return rows.mapInArrow(batches, schema)


def _cells(fp: Column) -> Column:
    """Array of (cell, home) of a fingerprint over both halves."""
    entries = []
    for half in (0, 1):
        x = F.shiftrightunsigned(fp, 32 * half).bitwiseAND(F.lit(0xFFFFFFFF))
        counts = x.bitwiseAND(F.lit(_LOW)) + F.shiftrightunsigned(x, 1).bitwiseAND(F.lit(_LOW))
        cell = counts + F.lit(half << 32)
        entries.append(F.array(F.struct(cell.alias("cell"), F.lit(True).alias("home"))))
        steps = []
        for segment in range(16):
            count = F.shiftrightunsigned(counts, 2 * segment).bitwiseAND(F.lit(3))
            step = F.lit(1 << 2 * segment)
            steps.append(F.when(count < 2, F.struct((cell + step).alias("cell"), F.lit(False).alias("home"))))
            steps.append(F.when(count > 0, F.struct((cell - step).alias("cell"), F.lit(False).alias("home"))))
        none = F.array().cast("array<struct<cell:bigint,home:boolean>>")
        entries.append(F.when(F.bit_count(x) % 2 == 0, F.array_compact(F.array(*steps))).otherwise(none))
    return F.concat(*entries)


def _near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Within MAX_BITS; counts bits of the unsigned value, as a signed one counts as its absolute."""
    return np.bitwise_count((a ^ b).view(np.uint64)) <= MAX_BITS


def _forest(fps: np.ndarray) -> list[tuple[int, int]]:
    """Links within MAX_BITS that connect what all links connect: n - 1 at most."""
    links, rest = [], fps
    while len(rest):
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            centre = queue.pop()
            near = _near(rest, centre)
            if near.any():
                found, rest = rest[near], rest[~near]
                links += [(int(centre), int(x)) for x in found]
                queue += list(found)
    return links


def _linked(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (cell, i, j, fp) in order of the first three; yields verified links (a, b)."""
    carried: np.ndarray | None = None

    def links(rows: np.ndarray, last: bool) -> tuple[np.ndarray | None, pa.RecordBatch | None]:
        new = np.flatnonzero((rows[1:, :3] != rows[:-1, :3]).any(axis=1)) + 1
        starts = np.concatenate(([0], new))
        if not last:  # the last group may go on in the next batch
            rest, rows, starts = rows[starts[-1] :], rows[: starts[-1]], starts[:-1]
        else:
            rest = None
        if not len(rows):
            return rest, None
        sizes = np.diff(np.concatenate((starts, [len(rows)])))
        group = np.repeat(np.arange(len(starts)), sizes)
        fps, a, b = rows[:, 3], [], []
        small = np.repeat(sizes <= 8, sizes)
        for lag in range(1, int(min(8, sizes.max()))):
            near = small[lag:] & (group[lag:] == group[:-lag]) & _near(fps[lag:], fps[:-lag])
            a.append(fps[lag:][near])
            b.append(fps[:-lag][near])
        for begin, size in zip(starts[sizes > 8], sizes[sizes > 8], strict=True):
            pairs = np.array(_forest(fps[begin : begin + size]), np.int64).reshape(-1, 2)
            a.append(pairs[:, 0])
            b.append(pairs[:, 1])
        if not a:
            return rest, None
        return rest, pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"])

    for part in parts:
        rows = np.stack([c.to_numpy(zero_copy_only=False) for c in part.columns], axis=1)
        rows = rows if carried is None else np.concatenate((carried, rows))
        carried, found = links(rows, False)
        if found is not None:
            yield found
    if carried is not None and len(carried):
        _, found = links(carried, True)
        if found is not None:
            yield found


def similar_pairs(nodes: DataFrame) -> DataFrame:
    """Links (a, b) among distinct fingerprints ``fp`` that connect all within MAX_BITS.

    Cells with one member are left out after a count. A cell of many members is cut into blocks
    that meet pairwise in tasks of their own; a task returns a spanning forest of what it verified,
    so that a group of n near copies gives at most n - 1 links a task and never all its pairs.

    The cells are merged with their counts, never broadcast: Spark sizes them as the file of ``nodes``,
    though a row of it becomes 26 on average.
    """
    placed = nodes.select("fp", F.explode(_cells(F.col("fp"))).alias("at")).select("fp", "at.cell", "at.home")
    shared = (
        placed.groupBy("cell")
        .agg(F.count("*").alias("n"), F.max("home").alias("met"))
        .where("n > 1 and met")
        .select("cell", F.ceil(F.col("n") / CELL_BLOCK).cast("int").alias("blocks"))
    )
    mine = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("long")
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks").cast("long") - 1))
    dealt = (
        placed.hint("merge")
        .join(shared, "cell")
        .select("cell", "fp", mine.alias("mine"), other.alias("other"))
        .select("cell", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "fp")
        .repartition("cell", "i", "j")
        .sortWithinPartitions("cell", "i", "j")
    )
    return dealt.mapInArrow(_linked, "a long, b long").distinct()


def near_duplicates(documents: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, ``fingerprint`` (16 hex digits) and ``component_id`` of every row.

    The first column of ``keep`` is the id; ``component_id`` is its smallest value among all
    documents that links of at most MAX_BITS differing bits reach.

    The fingerprints of all rows are merged with the names, never broadcast: the file that Spark sizes them
    by hardly grows with exact copies, the rows do.
    """
    bounded_batches(documents.sparkSession)
    key = keep[0]
    prints = stored(fingerprints(documents, keep), "fingerprints")
    nodes = stored(prints.groupBy("fp").agg(F.min(key).alias("least")), "nodes")
    roots = components(similar_pairs(nodes))
    rooted = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    named = rooted.join(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "root")
    return prints.hint("merge").join(named.select("fp", "component_id"), "fp").select(
        *keep, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
