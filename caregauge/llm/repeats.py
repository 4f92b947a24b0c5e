"""Removal of long repeated passages, found by recompression of word sequences.

**Naming.** Words are names of level 0. A round first names maximal runs of one name, then splits
all names into left and right ones by a bit of their hash and names every pair (left, right). A new
name is the hash of what it stands for, so all tasks of a Spark job give equal runs and pairs the
same name without a dictionary, and all rounds fit into one pass over the texts. Names of ``FULL``
words or more stay as they are.

**Consistency.** With each name goes the stretch of words that decided about it: its own words, and
of neighbours what its not merging with them depended on. Wherever this stretch of words occurs,
the name stands there too. So a window that holds the whole stretch of a name can repeat only where
the name does.

**Repeats.** A Spark round finds the names that stand in several texts. Windows that hold the stretch
of an unshared name are out; the others, few beyond those that do repeat, are verified by a 128-bit
key of their words in a second round, which finds the smallest document of each key. Windows that
hold no stretch at all (at the ends of texts, or periodic text) are verified likewise, so
nothing is lost. Equal texts are told first, by their digest, and take part once.

**Hot keys.** A task settles what it can among the texts of its own batch and hands on one row a
name or key, so a passage that a third of all texts share reaches the exchange once a batch; what is
settled goes on spread evenly. Receiving tasks stream: they hold one text's rows of one name.

Defined results: a null text has no words; texts shorter than a window are never touched; a null
doc_id counts as 2**63 - 1; rows with the same id are no smaller document for each other, and each
has a row of its own in the result; whole texts are read however long (long ones in overlapping
stretches); an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caregauge.llm.common import bounded_batches
from caregauge.sources.scratch import stored

WINDOW = 50
#: Names of so many words are not merged further, and rounds of runs and pairs.
FULL, ROUNDS = 12, 10
#: Words that are recompressed at once, and window starts of one stretch of a long text.
WORDS_AT_ONCE, STRETCH = 300_000, 100_000
_FAR = 1 << 40
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


def _name(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return _mix(_mix(a * _A) + b)


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of all texts, and where each text's words begin."""
    split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    words, begins = split.flatten(), split.offsets.to_numpy() - split.offsets[0].as_py()
    real = pc.greater(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
    if not real.all():
        begins = np.concatenate(([0], np.cumsum(real)))[begins]
        words = words.filter(pa.array(real))
    return words, begins.astype(np.int64)


def word_keys(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit keys of every word."""
    import xxhash

    coded = words.dictionary_encode()
    digests = b"".join(map(xxhash.xxh3_128_digest, coded.dictionary.cast(pa.binary()).to_pylist()))
    both = np.frombuffer(digests, np.uint64).reshape(-1, 2)[coded.indices.to_numpy()]
    return np.ascontiguousarray(both[:, 0]), np.ascontiguousarray(both[:, 1])


def joined_digests(words: pa.Array, begins: np.ndarray) -> list[str]:
    """SHA-256 of every text's words, joined by one blank."""
    lists = pa.ListArray.from_arrays(pa.array(begins, pa.int32()), words.cast(pa.binary()))
    return [hashlib.sha256(text).hexdigest() for text in pc.binary_join(lists, b" ").to_pylist()]


def recompressed(words: np.ndarray, part: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(names, begin, end): names of a sequence of word keys and the words [begin, end) that decided
    about each. ``part``: number of the stretch of every word; nothing is named across stretches.
    A name that the end of its stretch decided about reaches far beyond it."""
    n = len(words)
    name, low = words, np.arange(n)
    high, begin, end = low + 1, low, low + 1
    for round_ in range(ROUNDS):
        # runs
        m = len(name)
        free = high - low < FULL
        inside = np.zeros(m + 1, bool)  # is i - 1 in the stretch of i?
        inside[1:-1] = part[1:] == part[:-1]
        equal = inside.copy()
        equal[1:-1] &= (name[1:] == name[:-1]) & free[1:]
        first = np.flatnonzero(~equal[:-1])
        after = np.append(first[1:], m)
        last = after - 1
        times = after - first
        # A run ends where the neighbour is another name. If the next word already isn't the run's
        # first one (before it: its last one), that word alone decides; else the whole neighbour.
        before, behind = low[first] - 1, high[last]
        other = words[before] != words[high[first] - 1]
        left = np.where(inside[first], np.where(other, before, begin[first - 1]), -_FAR)
        other = words[np.minimum(behind, n - 1)] != words[low[last]]
        right = np.where(inside[after], np.where(other, behind + 1, end[np.minimum(after, m - 1)]), _FAR)
        free = free[first]
        begin, end = np.where(free, np.minimum(begin[first], left), begin[first]), np.where(free, np.maximum(end[last], right), end[last])
        name = np.where(times > 1, _name(name[first], times.astype(np.uint64)), name[first])
        low, high, part = low[first], high[last], part[first]
        # pairs
        m = len(name)
        free = high - low < FULL
        inside = np.zeros(m + 1, bool)
        inside[1:-1] = part[1:] == part[:-1]
        is_left = _mix(name + _A * np.array(round_ + 1, np.uint64)) >> np.uint64(63) == 1
        pair = inside.copy()  # do i - 1 and i become one?
        pair[1:-1] &= (free & is_left)[:-1] & (free & ~is_left)[1:]
        alone = np.flatnonzero(free & is_left & ~pair[1:])
        end = end.copy()
        begin, old_begin, old_end = begin.copy(), begin, end.copy()
        end[alone] = np.where(inside[alone + 1], np.maximum(old_end[alone], old_end[np.minimum(alone + 1, m - 1)]), _FAR)
        alone = np.flatnonzero(free & ~is_left & ~pair[:-1])
        begin[alone] = np.where(inside[alone], np.minimum(old_begin[alone], old_begin[alone - 1]), -_FAR)
        first = np.flatnonzero(~pair[:-1])
        two = pair[first + 1]
        last = first + two
        name = np.where(two, _name(name[first], name[last]), name[first])
        begin, end = np.minimum(begin[first], begin[last]), np.maximum(end[first], end[last])
        low, high, part = low[first], high[last], part[first]
    return name, begin, end


def window_keys(a: np.ndarray, window: int) -> np.ndarray:
    """Key of the ``window`` words from each place on; the last ``window - 1`` mean nothing."""

    def later(x: np.ndarray, k: int) -> np.ndarray:
        return np.concatenate((x[k:], np.zeros(min(k, len(x)), np.uint64)))

    size, doubled, key, done = 1, a, None, 0
    while size <= window:
        if window & size:
            key = doubled if key is None else _name(key, later(doubled, done))
            done += size
        size *= 2
        if size <= window:
            doubled = _name(doubled, later(doubled, size // 2))
    return key


class Stretches:
    """The stretches of a batch's texts, recompressed group by group."""

    def __init__(self, keys: np.ndarray, begins: np.ndarray, window: int):
        self.keys, self.window = keys, window
        rows, starts, stops = [], [], []
        for row, (b, e) in enumerate(zip(begins[:-1].tolist(), begins[1:].tolist(), strict=True)):
            for start in range(b, e - window + 1, STRETCH):
                rows.append(row)
                starts.append(start)
                stops.append(min(e, start + STRETCH + window - 1))
        self.rows, self.starts, self.stops = rows, starts, stops
        self.numbered: dict[int, int] = {}

    def groups(self) -> Iterator[tuple[np.ndarray, ...]]:
        """(rows of the windows, their starts; names that windows hold, their rows and numbers within
        the row, first and last window that holds each) of every group. Windows are numbered
        within the group."""
        low = 0
        while low < len(self.rows):
            high, size = low, 0
            while high < len(self.rows) and (high == low or size + self.stops[high] - self.starts[high] <= WORDS_AT_ONCE):
                size += self.stops[high] - self.starts[high]
                high += 1
            yield self._group(low, high)
            low = high

    def _group(self, low: int, high: int) -> tuple[np.ndarray, ...]:
        starts, stops = np.array(self.starts[low:high]), np.array(self.stops[low:high])
        rows = np.array(self.rows[low:high])
        sizes = stops - starts
        part = np.repeat(np.arange(len(sizes)), sizes)
        at = np.arange(len(part)) + np.repeat(starts - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes)
        name, begin, end = recompressed(self.keys[at], part)
        held = np.flatnonzero(end - begin <= self.window)
        name, begin, end = name[held], begin[held], end[held]
        name_part = part[begin]
        # windows of stretch p are the words of p but its last window - 1, so a place p words further
        # back is the number of the window
        shift = self.window - 1
        first_word = np.concatenate(([0], np.cumsum(sizes)))[:-1]
        first_window = first_word - shift * np.arange(len(sizes))
        count = sizes - shift
        from_ = np.maximum(end - self.window, first_word[name_part]) - shift * name_part
        to = np.minimum(begin - shift * name_part, (first_window + count - 1)[name_part])
        window_part = np.repeat(np.arange(len(sizes)), count)
        window_start = np.arange(count.sum()) - np.repeat(first_window, count) + np.repeat(starts, count)
        name_row = rows[name_part]
        number = np.zeros(len(name), np.int64)
        if len(name):
            cut = np.flatnonzero(np.diff(name_row, prepend=-1))
            for c, e in zip(cut.tolist(), [*cut[1:].tolist(), len(name)], strict=True):
                base = self.numbered.get(int(name_row[c]), 0)
                number[c:e] = np.arange(base, base + e - c)
                self.numbered[int(name_row[c])] = base + e - c
        return rows[window_part], window_start, name, name_row, number, from_, to


def uncovered(count: int, from_: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Places below ``count`` that none of the spans [from_, to] covers."""
    change = np.bincount(from_, minlength=count + 1)[: count + 1] - np.bincount(to + 1, minlength=count + 1)[: count + 1]
    return np.cumsum(change)[:count] == 0


# --- Spark rounds ---

def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _parsed(window: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(doc_id, o, th, text) to (doc_id, o, th, n_words, digest, names)."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            words, begins = words_of(part.column(3))
            stretches = Stretches(word_keys(words)[0], begins, window)
            found = [(g[3], g[2]) for g in stretches.groups()]
            rows = np.concatenate([r for r, _ in found] or [np.zeros(0, np.int64)])
            names = np.concatenate([x for _, x in found] or [np.zeros(0, np.uint64)])
            offsets = np.concatenate(([0], np.cumsum(np.bincount(rows, minlength=part.num_rows))))
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), _signed(names))
            columns = [*part.columns[:3], pa.array(np.diff(begins)), pa.array(joined_digests(words, begins)), lists]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "o", "th", "n_words", "digest", "names"])

    return batches


def _order(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, begins of groups): rows in order of all columns, cut where one but the last changes."""
    order = np.lexsort(columns[::-1])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for column in columns[:-1]:
        new[1:] |= column[order[1:]] != column[order[:-1]]
    return order, np.flatnonzero(new)


def _occurrences(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(o, th, names) to (name, o, th, number, settled). A name that texts of the batch share is settled
    for all of them; one row of number -1 stands for it elsewhere."""
    for part in parts:
        lists = part.column(2)
        sizes = lists.value_lengths().to_numpy()
        name = lists.flatten().to_numpy(zero_copy_only=False)
        if not len(name):
            continue
        row = np.repeat(np.arange(len(sizes)), sizes)
        number = np.arange(len(name)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        order, begins = _order(name, row)
        ends = np.append(begins[1:], len(name))
        shared = row[order[begins]] != row[order[ends - 1]]
        settled = np.zeros(len(name), bool)
        settled[order] = np.repeat(shared, ends - begins)
        herald = order[begins[shared]]
        spread = _name((name + number).view(np.uint64), part.column(0).to_numpy().view(np.uint64)[row]).view(np.int64)
        key = np.where(settled, spread, name)
        at = np.concatenate((row, row[herald]))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate((key, name[herald]))),
                part.column(0).take(pa.array(at)),
                part.column(1).take(pa.array(at)),
                pa.array(np.concatenate((number, np.full(len(herald), -1))), pa.int32()),
                pa.array(np.concatenate((settled, np.zeros(len(herald), bool)))),
            ],
            ["name", "o", "th", "number", "settled"],
        )


def _shared(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(name, o, th, number, settled) in order of (settled, name, o, th) to (o, th, number) of the names
    that stand in two texts; a row of number -1 stands for two texts."""
    held: pa.Table | None = None  # rows of the last name, while one text alone has it
    done = None  # or the last name, once two have it

    def numpy(rows: pa.Table) -> list[np.ndarray]:
        return [rows.column(k).to_numpy() for k in range(5)]

    def settled_rows(rows: pa.Table, last: bool) -> tuple[np.ndarray, int]:
        """Which rows are of shared names, and from where on rows must wait."""
        name, o, th, number, settled = numpy(rows)
        out = settled.copy()
        new = np.flatnonzero(np.diff(name, prepend=name[0]) | (np.diff(settled.astype(np.int8), prepend=0)) | (np.arange(len(name)) == 0))
        ends = np.append(new[1:], len(name))
        several = (o[new] != o[ends - 1]) | (th[new] != th[ends - 1])
        several |= np.add.reduceat(number < 0, new) > 0
        if done is not None and not settled[0] and name[0] == done:
            several[0] = True
        out |= np.repeat(several, ends - new)
        waits = len(name) if last or settled[-1] or several[-1] else int(new[-1])
        return out, waits

    def result(rows: pa.Table, out: np.ndarray) -> Iterator[pa.RecordBatch]:
        out = out & (rows.column(3).to_numpy() >= 0)
        yield from rows.filter(pa.array(out)).select(["o", "th", "number"]).combine_chunks().to_batches()

    for part in parts:
        if not part.num_rows:
            continue
        rows = pa.Table.from_batches([part])
        if held is not None:
            rows = pa.concat_tables([held, rows]).combine_chunks()
        out, waits = settled_rows(rows, False)
        done = rows.column(0)[-1].as_py() if waits == rows.num_rows and not rows.column(4)[-1].as_py() else None
        yield from result(rows.slice(0, waits), out[:waits])
        held = rows.slice(waits) if waits < rows.num_rows else None
    if held is not None:
        out, _ = settled_rows(held, True)
        yield from result(held, out)


def _candidates(window: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(o, th, text, shared numbers) to (k1, k2, o, th, start, settled) of the windows that may repeat.
    Where a smaller document of the batch has the window too, it is settled: a repeat."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            words, begins = words_of(part.column(2))
            first, second = word_keys(words)
            lists = part.column(3).combine_chunks() if isinstance(part.column(3), pa.ChunkedArray) else part.column(3)
            shared_of = [None] * part.num_rows
            for k, x in enumerate(lists):
                shared_of[k] = np.array(x.values.to_numpy() if x.is_valid else [], np.int64)
            rows, starts = [], []
            for window_row, window_start, _, name_row, number, from_, to in Stretches(first, begins, window).groups():
                bad = np.ones(len(number), bool)
                cut = np.flatnonzero(np.diff(name_row, prepend=-1))
                for c, e in zip(cut.tolist(), [*cut[1:].tolist(), len(number)] if len(cut) else [], strict=True):
                    mine = shared_of[int(name_row[c])]
                    bad[c:e][mine[(mine >= number[c]) & (mine <= number[e - 1])] - number[c]] = False
                open_ = np.flatnonzero(uncovered(len(window_row), from_[bad], to[bad]))
                rows.append(window_row[open_])
                starts.append(window_start[open_])
            row, start = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (rows, starts))
            if not len(row):
                continue
            k1, k2 = window_keys(first, window)[start], window_keys(second, window)[start]
            o, th = (part.column(k).to_numpy() for k in (0, 1))
            order, group = _order(k1, k2, o[row])
            least = np.repeat(o[row[order[group]]], np.diff(np.append(group, len(order))))
            settled = np.zeros(len(row), bool)
            settled[order] = o[row[order]] > least
            k1 = np.where(settled, _name(k1 + start.astype(np.uint64), o[row].view(np.uint64)), k1)
            yield pa.RecordBatch.from_arrays(
                [_signed(k1), _signed(k2), pa.array(o[row]), pa.array(th[row]), pa.array(start - begins[row], pa.int32()), pa.array(settled)],
                ["k1", "k2", "o", "th", "start", "settled"],
            )

    return batches


def _repeated(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(k1, k2, o, th, start, settled) in order of (settled, k1, k2, o) to (o, th, start) of the windows
    that a smaller document has."""
    last = None  # key of the last row and the smallest document that has it
    for part in parts:
        if not part.num_rows:
            continue
        k1, k2, o, th, start = (part.column(k).to_numpy() for k in range(5))
        settled = part.column(5).to_numpy(zero_copy_only=False)
        new = np.ones(len(o), bool)
        new[1:] = (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1]) | settled[1:]
        least = o[np.flatnonzero(new)][np.cumsum(new) - 1]
        if last is not None and last[:2] == (k1[0], k2[0]):
            upto = np.append(np.flatnonzero(new)[1:], len(o))[0]
            least[:upto] = last[2]
        last = None if settled[-1] else (k1[-1], k2[-1], least[-1])
        out = np.flatnonzero(settled | (o > least))
        yield pa.RecordBatch.from_arrays([pa.array(x[out]) for x in (o, th, start)], ["o", "th", "start"])


def _kept(window: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(o, th, text, starts of repeated windows) to (o, th, n_removed, kept_sha256)."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            words, begins = words_of(part.column(2))
            lists = part.column(3)
            row = np.repeat(np.arange(part.num_rows), lists.value_lengths().to_numpy())
            from_ = lists.flatten().to_numpy(zero_copy_only=False) + begins[row]
            kept = uncovered(len(words), from_, from_ + window - 1)
            left = np.concatenate(([0], np.cumsum(kept)))[begins]
            digests = joined_digests(words.filter(pa.array(kept)), left)
            removed = np.diff(begins) - np.diff(left)
            yield pa.RecordBatch.from_arrays([*part.columns[:2], pa.array(removed), pa.array(digests)], ["o", "th", "n_removed", "kept_sha256"])

    return batches


def without_repeats(documents: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every row: each word is removed that lies in a window
    of ``window`` words which also starts in a document with a smaller ``doc_id``."""
    bounded_batches(documents.sparkSession)
    kind = documents.schema["doc_id"].dataType.simpleString()
    order = F.coalesce(F.col("doc_id").cast("long"), F.lit(2**63 - 1)).alias("o")
    rows = documents.select("doc_id", order, F.xxhash64("text").alias("th"), "text")
    parsed = stored(
        rows.mapInArrow(_parsed(window), f"doc_id {kind}, o long, th long, n_words long, digest string, names array<long>"), "names"
    )
    # of equal texts the smallest document stands for all
    least = parsed.groupBy("digest").agg(F.min(F.struct("o", "th")).alias("least"))
    least = least.select("digest", F.col("least.o").alias("first_o"), F.col("least.th").alias("first_th"))
    classes = parsed.select("doc_id", "o", "th", "n_words", "digest").join(least, "digest")
    long_enough = parsed.where(F.col("n_words") >= window)
    firsts = (
        long_enough.join(least, (parsed["digest"] == least["digest"]) & (parsed["o"] == F.col("first_o")) & (parsed["th"] == F.col("first_th")))
        .select("o", "th", "names")
        .dropDuplicates(["o", "th"])
    )
    found = firsts.mapInArrow(_occurrences, "name long, o long, th long, number int, settled boolean")
    met = found.repartition("name").sortWithinPartitions("settled", "name", "o", "th").mapInArrow(_shared, "o long, th long, number int")
    shared = met.groupBy("o", "th").agg(F.collect_list("number").alias("shared"))
    asked = stored(firsts.select("o", "th").join(shared, ["o", "th"], "left"), "shared-names")

    # the texts are dealt out once; both later rounds read that exchange
    texts = rows.select("o", "th", "text").repartition("o", "th")
    once = texts.join(asked, ["o", "th"]).select("o", "th", "text", "shared")
    windows = once.mapInArrow(_candidates(window), "k1 long, k2 long, o long, th long, start int, settled boolean")
    again = windows.repartition("k1").sortWithinPartitions("settled", "k1", "k2", "o").mapInArrow(_repeated, "o long, th long, start int")
    starts = again.groupBy("o", "th").agg(F.collect_set("start").alias("starts"))
    changed = texts.join(starts, ["o", "th"]).select("o", "th", "text", "starts")
    removed = changed.mapInArrow(_kept(window), "o long, th long, n_removed long, kept_sha256 string").dropDuplicates(["o", "th"])

    later = F.col("o") > F.col("first_o")
    gone = later & (F.col("n_words") >= window)
    copies = classes.where(later).select(
        "doc_id",
        "n_words",
        F.when(gone, F.col("n_words")).otherwise(0).cast("long").alias("n_removed"),
        F.when(gone, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.col("digest")).alias("kept_sha256"),
    )
    own = classes.where(~later).select("doc_id", "n_words", "digest", F.col("first_o").alias("o"), F.col("first_th").alias("th"))
    first = own.join(removed, ["o", "th"], "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("kept_sha256", "digest").alias("kept_sha256"),
    )
    return first.unionByName(copies)
