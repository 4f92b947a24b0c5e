"""Packing of tokenised documents into sequences by minimum bin slack.

Documents are cut into whole windows of CAPACITY and a remainder. The remainders' lengths form a
multiset (at most CAPACITY - 1 different lengths, whatever the number of documents). For each
window the longest length left is fixed and a bitset subset-sum over the multiset finds what
fills the window closest to capacity; the chosen counts are read off backwards, and the window is
repeated as often as the multiset allows. Lengths that can't complete a window are laid end to
end and cut at the capacity, and the last stretch at powers of two, so nothing is padded.

Only the histogram of lengths meets at one place. A document finds its window by its rank among
the documents of its length: the rank within the task's block plus an offset from the counts of
the blocks before. A block has at most CAPACITY offsets; they are sent to its ids, which stay in the
buckets that the encoding tasks wrote.

Defined results: a null text is an empty one, whose only id is END_ID; null and repeated ids and
repeated rows are documents of their own; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caregauge.llm.common import bounded_batches, stored_in_buckets, worker_state

CAPACITY = 2048
END_ID = 1
#: Encoded pieces that a worker remembers.
REMEMBERED = 300_000

_UNUSUAL = re.compile("[^\n -~¡-¬®-ɏ]")


class _Encoded(dict):
    """Ids (as bytes) of a piece that follows a blank."""

    def __init__(self, encode):
        self.encode = encode

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= REMEMBERED:
            self.clear()
        ids = self[piece] = self.encode(" " + piece)
        return ids


class Encoder:
    """Ids of the tokenizers library for byte-level BPE.

    Most text consists of pieces between single blanks. Such a piece, with the blank before it, is
    always cut in the same way, whatever stands around it, so its ids are remembered. They come
    from the same vocabulary through a faster library; texts with white space side by side or with
    unusual characters go to the tokenizers library as a whole.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(path)
        self.slow.encode_special_tokens = True
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        shown = _shown_bytes()
        vocabulary = spec["model"]["vocab"]
        special = {t["content"] for t in spec.get("added_tokens", ())}
        ranks = {bytes(shown[c] for c in k): v for k, v in vocabulary.items() if k not in special}
        pair = [m if isinstance(m, str) else " ".join(m) for m in spec["model"]["merges"]]
        ids = [vocabulary[m.replace(" ", "")] for m in pair]
        ordered = all(a < b for a, b in zip(ids, ids[1:], strict=False)) and not spec.get("normalizer")
        self.dtype = "<u2" if max(vocabulary.values()) < 1 << 16 else "<u4"
        self.fast = None
        if ordered and spec["pre_tokenizer"].get("type") == "ByteLevel" and not spec["pre_tokenizer"]["add_prefix_space"]:
            import public_tokenizers

            self.fast = tiktoken.Encoding("byte bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.known = _Encoded(self._encode)

    def _encode(self, text: str) -> bytes:
        return np.array(self.fast.encode_ordinary(text), self.dtype).tobytes()

    def ids(self, text: str) -> bytes:
        """Little-endian ids of a text, without END_ID."""
        if self.fast is None or "  " in text or " \n" in text or "\n " in text or _UNUSUAL.search(text):
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()
        first, *rest = text.split(" ")
        return self._encode(first) + b"".join(map(self.known.__getitem__, rest))


def _shown_bytes() -> dict[str, int]:
    """Byte that each character of a byte-level vocabulary stands for."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


def tokenised(documents: DataFrame, path: str, capacity: int, keep: str = "doc_id") -> DataFrame:
    """A row per document: its ids, its remainder and the remainder's rank within the task's block.

    ``block`` numbers the task, ``full_before`` counts the block's whole windows before the row.
    """
    bounded_batches(documents.sparkSession)
    rows = documents.select(F.col(keep).alias("doc_id"), "text")
    kind = dict(rows.dtypes)["doc_id"]
    names = ["doc_id", "block", "full_before", "tail", "rank", "doc_tokens", "ids"]

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_state(f"encoder {path}", lambda: Encoder(path))
        block, full = TaskContext.get().partitionId(), 0
        ranks = np.zeros(capacity, np.int64)
        end = np.array([END_ID], encoder.dtype).tobytes()
        for part in parts:
            ids = [(encoder.ids(t) if t else b"") + end for t in part.column(1).to_pylist()]
            sizes = np.array([len(x) // len(end) for x in ids], np.int64)
            tails = sizes % capacity
            rank = np.zeros(len(ids), np.int64)
            for k, tail in enumerate(tails.tolist()):
                rank[k] = ranks[tail]
                ranks[tail] += 1
            whole = sizes // capacity
            before = full + np.cumsum(whole) - whole
            full += int(whole.sum())
            wide = pa.array(ids, pa.binary())
            columns = [part.column(0), pa.array(np.full(len(ids), block)), pa.array(before), pa.array(tails.astype(np.int32)), pa.array(rank), pa.array(sizes), wide]
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = f"doc_id {kind}, block long, full_before long, tail int, rank long, doc_tokens long, ids binary"
    return rows.mapInArrow(batches, schema)


def best_fill(counts: dict[int, int], room: int) -> dict[int, int]:
    """Lengths and their counts whose sum comes closest to ``room`` from below.

    Bit s of ``reach`` says that s is a sum of lengths taken so far; a length with several copies
    goes in as powers of two of its count. Stops as soon as ``room`` is reached.
    """
    reach, history = 1, []
    mask = (1 << room + 1) - 1
    for length in sorted((x for x in counts if x <= room), key=lambda x: (-counts[x], -x)):
        left, times = min(counts[length], room // length), 1
        while left > 0:
            take = min(times, left)
            history.append((length, take, reach))
            reach |= reach << length * take & mask
            left -= take
            times *= 2
        if reach >> room & 1:
            break
    total, chosen = reach.bit_length() - 1, {}
    for length, take, before in reversed(history):
        if not before >> total & 1:
            chosen[length] = chosen.get(length, 0) + take
            total -= length * take
    return chosen


def plan_windows(histogram: dict[int, int], capacity: int) -> dict:
    """Where the documents of each remainder length go, as arrays ordered by (length, first rank).

    ``begin``: length * 2**44 + first rank of a run; ``per``: documents of that length in a window;
    ``sequence`` and ``offset``: the run's first window and place there. A ``per`` of 0 marks the
    lengths laid end to end; their ``offset`` is the place in that stream.
    """
    left = {k: v for k, v in histogram.items() if k > 0 and v > 0}
    used = dict.fromkeys(left, 0)
    runs: list[tuple[int, int, int, int, int]] = []
    sequence, rest = 0, {}
    while left:
        longest = max(left)
        others = dict(left)
        others[longest] -= 1
        chosen = best_fill({k: v for k, v in others.items() if v}, capacity - longest)
        chosen[longest] = chosen.get(longest, 0) + 1
        if sum(k * v for k, v in chosen.items()) < capacity:
            rest[longest] = left.pop(longest)
            continue
        times, offset = min(left[k] // v for k, v in chosen.items()), 0
        for k in sorted(chosen, reverse=True):
            runs.append((k, used[k], chosen[k], sequence, offset))
            offset += k * chosen[k]
            used[k] += chosen[k] * times
            left[k] -= chosen[k] * times
            if not left[k]:
                del left[k]
        sequence += times
    stream = 0
    for k in sorted(rest, reverse=True):
        runs.append((k, used[k], 0, sequence, stream))
        stream += k * rest[k]
    table = np.array(sorted(runs), np.int64).reshape(-1, 5)
    tail = stream % capacity
    powers = [1 << b for b in range(tail.bit_length() - 1, -1, -1) if tail >> b & 1]
    cuts = stream - tail + np.cumsum([0, *powers])
    sequences = sequence + stream // capacity + len(powers)
    return {
        "begin": (table[:, 0] << 44) + table[:, 1], "first": table[:, 1], "per": table[:, 2], "sequence": table[:, 3],
        "offset": table[:, 4], "stream": sequence, "cuts": cuts, "sequences": sequences,
    }


def places(plan: dict, capacity: int, length: int, rank: int) -> list[tuple[int, int, int, int]]:
    """(start in the remainder, length, sequence, offset there) of the pieces of one remainder."""
    run = int(np.searchsorted(plan["begin"], (length << 44) + rank, side="right")) - 1
    nth, per = rank - int(plan["first"][run]), int(plan["per"][run])
    if per:
        window, slot = divmod(nth, per)
        return [(0, length, int(plan["sequence"][run]) + window, int(plan["offset"][run]) + slot * length)]
    at, out, done = int(plan["offset"][run]) + nth * length, [], 0
    cuts = plan["cuts"]
    while done < length:
        here = at + done
        if here < cuts[0]:
            sequence, offset = divmod(here, capacity)
            size = min(length - done, capacity - offset)
        else:
            nth_cut = int(np.searchsorted(cuts, here, side="right")) - 1
            sequence, offset = int(cuts[0]) // capacity + nth_cut, here - int(cuts[nth_cut])
            size = min(length - done, int(cuts[nth_cut + 1]) - here)
        out.append((done, size, plan["stream"] + sequence, offset))
        done += size
    return out


def packed(documents: DataFrame, path: str, capacity: int = CAPACITY, keep: str = "doc_id") -> DataFrame:
    """A row per piece: doc_id, start, length, ids (little-endian uint32), doc_tokens, sequence_id, offset.

    Sequence ids of whole windows lie above those of shared sequences, apart by block.
    """
    # A block's rows come from one task, so the buckets cost no exchange; ids stay where they were written.
    tokens = stored_in_buckets(tokenised(documents, path, capacity, keep), "tokens", "block")
    counts = tokens.groupBy("tail", "block").agg(F.count("*").alias("n"))
    histogram = counts.groupBy("tail").agg(F.sum("n").alias("n")).collect()  # at most ``capacity`` rows
    plan = plan_windows({r["tail"]: r["n"] for r in histogram}, capacity)
    before = Window.partitionBy("tail").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("block", F.struct("tail", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")).alias("entry"))
    by_block = offsets.groupBy("block").agg(F.map_from_entries(F.collect_list("entry")).alias("offsets"))
    rank = (F.col("rank") + F.element_at("offsets", F.col("tail"))).alias("rank")
    rows = tokens.join(by_block.hint("shuffle_hash"), "block").select(
        "doc_id", "block", "full_before", "tail", rank, "doc_tokens", "ids"
    )
    names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            who, out, ids = [], [], []
            block, full, tail, rank, size = (part.column(k).to_pylist() for k in range(1, 6))
            for k, raw in enumerate(part.column(6).to_pylist()):
                n = size[k]
                all_ids = np.frombuffer(raw, "<u2" if len(raw) == 2 * n else "<u4").astype("<u4")
                base = plan["sequences"] + (block[k] << 36) + full[k]
                pieces = [(w * capacity, capacity, base + w, 0) for w in range(n // capacity)]
                if tail[k]:
                    pieces += [(n - tail[k] + s, *more) for s, *more in places(plan, capacity, tail[k], rank[k])]
                for start, length, sequence, offset in pieces:
                    who.append(k)
                    out.append((start, length, n, sequence, offset))
                    ids.append(all_ids[start : start + length].tobytes())
            start, length, n, sequence, offset = (pa.array(x) for x in np.array(out, np.int64).reshape(-1, 5).T)
            doc = part.column(0).take(pa.array(who, pa.int64()))
            yield pa.RecordBatch.from_arrays([doc, start, length, pa.array(ids, pa.binary()), n, sequence, offset], names)

    kind = dict(tokens.dtypes)["doc_id"]
    return rows.mapInArrow(batches, f"doc_id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")
