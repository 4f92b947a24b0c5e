"""SentencePiece encoding and decoding by batched Viterbi in numpy.

Texts are normalised by the model's own rules and cut into words (a blank sign and what follows).
Each different word of a batch is segmented once. Words of equal length advance together: for every
end position the substrings that end there are looked up by hash among the sorted piece keys, and
the best predecessor is kept as backpointer, for all words in one numpy step.

For a unigram model the best predecessor has the greatest sum of scores. For a byte-pair model a
predecessor is possible only where the piece may stand after the last piece of the best way there:
merging would not have joined the two otherwise. Exactly one predecessor is possible then, and the
way back is what merging in order of rank gives, so the ids equal the library's for both kinds.

Defined results: null and empty texts have no ids and decode to an empty text; characters without a
piece become bytes (or the unknown id, where the model has no bytes); whole texts are encoded,
however long; a blank sign (U+2581) in a text decodes to a blank; repeated rows give the same ids;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caregauge.llm.common import bounded_batches, groups_of, worker_state

BLANK = "▁"
#: Words that a worker remembers, and code points segmented at once.
REMEMBERED = 300_000
BATCH_CHARS = 400_000
#: Code points of texts that are cut into words at once.
TEXT_CHARS = 1_000_000
#: Rows and bytes of an Arrow batch: a worker that encodes and one that decodes run for every core.
ROWS, BYTES = 600, 4 << 20
#: Words longer than this are cut where no piece can lie across, if such places exist.
LONG = 48
_R = np.uint64(0x9E3779B97F4A7C15)
_M = np.uint64(0xC2B2AE3D27D4EB4F)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _M
    return h ^ (h >> np.uint64(29))


def _taken(values: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``values`` of all stretches, one after the other."""
    return values[np.repeat(begins - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())]


def _trainer_kind(proto: bytes) -> int:
    """``trainer_spec.model_type`` of a serialised model: 1 unigram, 2 byte pairs."""

    def number(data: bytes, at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            value |= (data[at] & 127) << shift
            shift, at = shift + 7, at + 1
            if data[at - 1] < 128:
                return value, at

    def fields(data: bytes) -> Iterator[tuple[int, object]]:
        at = 0
        while at < len(data):
            key, at = number(data, at)
            if key & 7 == 0:
                value, at = number(data, at)
            elif key & 7 == 2:
                size, at = number(data, at)
                value, at = data[at : at + size], at + size
            else:
                size = 8 if key & 7 == 1 else 4
                value, at = data[at : at + size], at + size
            yield key >> 3, value

    spec = next((v for k, v in fields(proto) if k == 2), b"")
    return next((v for k, v in fields(spec) if k == 3), 1)


class Decoder:
    """The bytes of every piece."""

    def __init__(self, model):
        self.raw: list[bytes] = []
        for k in range(model.get_piece_size()):
            piece = model.id_to_piece(k)
            if model.is_byte(k):
                self.raw.append(bytes([int(piece[3:5], 16)]))
            elif model.is_unknown(k):
                self.raw.append(" ⁇ ".encode())
            else:
                plain = not (model.is_control(k) or model.is_unused(k))
                self.raw.append(piece.replace(BLANK, " ").encode() if plain else b"")

    def decode(self, ids: bytes | None) -> str:
        """Text of little-endian uint32 ids; the blank that encoding puts in front is taken off."""
        raw = self.raw
        text = b"".join([raw[k] for k in np.frombuffer(ids or b"", "<u4").tolist()]).decode("utf-8", "replace")
        return text[1:] if text[:1] == " " else text


def _model(path: str):
    """The model, once in a worker: Spark gives a worker encoding and decoding tasks by turns."""
    import sentencepiece

    return worker_state(f"model {path}", lambda: sentencepiece.SentencePieceProcessor(model_file=path))


class Segmenter(Decoder):
    """A SentencePiece model as sorted arrays."""

    def __init__(self, path: str):
        self.model = model = _model(path)
        super().__init__(model)
        size = model.get_piece_size()
        self.merging = _trainer_kind(model.serialized_model_proto()) == 2
        self.unknown = model.unk_id()
        self.byte_id = np.full(256, -1, np.int64)
        plain: list[tuple[float, int, str]] = []
        for k in range(size):
            piece = model.id_to_piece(k)
            if model.is_byte(k):
                self.byte_id[int(piece[3:5], 16)] = k
            elif not (model.is_unknown(k) or model.is_control(k) or model.is_unused(k)):
                plain.append((-model.get_score(k), k, piece))
        plain.sort()
        # rank: single characters first, then by score; -1 stands for a character without a piece
        ordered = [p for p in plain if len(p[2]) == 1] + [p for p in plain if len(p[2]) > 1]
        self.text = [p[2] for p in ordered]
        self.ids = np.array([p[1] for p in ordered], np.int64)
        self.score = np.array([-p[0] for p in ordered], np.float64)
        self.longest = max(map(len, self.text), default=1)
        self.crosses = any(BLANK in p[1:].lstrip(BLANK) for p in self.text)  # a blank after other characters
        self.joined = {pair for p in self.text for pair in zip(p, p[1:], strict=False)}
        keys = np.array([self._key(p) for p in self.text], np.uint64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank_of_key = keys[order], order.astype(np.int64)
        self.some_key = np.zeros(1 << 20, bool)  # by a key's first 20 bits: most substrings end here
        self.some_key[keys >> np.uint64(44)] = True
        if len(np.unique(keys)) != len(keys):
            raise ValueError("two pieces have one hash")
        self.powers = np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(1 << 16, _R, np.uint64))))
        self.of_character: dict[str, np.ndarray] = {}
        self._forget()
        if self.merging:
            self._learn_merges()

    @staticmethod
    def _key(piece: str) -> int:
        h = 0
        for c in piece:
            h = (h * int(_R) + ord(c) + 1) & (1 << 64) - 1
        return int(_mix(np.array([h], np.uint64))[0])

    def _learn_merges(self) -> None:
        """Last merge of every piece, and the sorted pairs; pieces that merging can't build stay out."""
        rank = {p: k for k, p in enumerate(self.text)}
        n = len(self.text)
        left, right, built = np.arange(n), np.arange(n), np.ones(n, bool)
        for k, piece in enumerate(self.text):
            if len(piece) == 1:
                continue
            parts = list(piece)
            while len(parts) > 2:
                best = min(((rank.get(a + b, n), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False))))
                if best[0] >= n:
                    break
                parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
            if len(parts) == 2 and all(p in rank for p in parts):
                left[k], right[k] = rank[parts[0]], rank[parts[1]]
            else:
                built[k] = False
        at = np.flatnonzero(built & (left != np.arange(n)))
        keys = left[at] << 32 | right[at]
        order = np.argsort(keys)
        self.left, self.right, self.built = left, right, built
        self.pair_keys, self.pair_rank = keys[order], at[order]
        self.memo_key, self.memo = np.full(1 << 20, -1, np.int64), np.zeros(1 << 20, bool)

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """May piece ``b`` stand after piece ``a``: would merging have kept them apart?"""
        if not self.merging:
            return np.ones(len(a), bool)
        key = (a + 1) << 32 | b + 1
        slot = (_mix(key.view(np.uint64)) >> np.uint64(44)).astype(np.int64)
        out = self.memo[slot]
        miss = np.flatnonzero(self.memo_key[slot] != key)
        if len(miss):
            fresh, back = np.unique(key[miss], return_inverse=True)
            known = self._kept_apart((fresh >> 32) - 1, (fresh & 0xFFFFFFFF) - 1)
            out[miss] = known[back]
            place = (_mix(fresh.view(np.uint64)) >> np.uint64(44)).astype(np.int64)
            self.memo_key[place], self.memo[place] = fresh, known
        return out

    def _kept_apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Undoes merges on both sides of the boundary, the latest first. A merge across the boundary
        that ranks before one undone would have come earlier: then the pair can't stand."""
        a, b = a.copy(), b.copy()
        out = np.ones(len(a), bool)
        limit = np.full(len(a), np.iinfo(np.int64).max)
        live = np.flatnonzero((a >= 0) & (b >= 0))
        while len(live):
            x, y = a[live], b[live]
            pair = x << 32 | y
            at = np.minimum(np.searchsorted(self.pair_keys, pair), max(len(self.pair_keys) - 1, 0))
            merged = np.where(self.pair_keys[at] == pair, self.pair_rank[at], np.iinfo(np.int64).max) if len(self.pair_keys) else np.full(len(live), np.iinfo(np.int64).max)
            bad = merged < limit[live]
            out[live[bad]] = False
            x_base, y_base = self.left[x] == x, self.left[y] == y
            undo_x = ~x_base & (y_base | (x > y))
            undo_y = ~y_base & ~undo_x
            # a tie in rank (the same piece on both sides): merges go from left to right, so the right one is undone first
            limit[live] = np.where(undo_x, x, np.where(undo_y, y + 1, limit[live]))
            a[live] = np.where(undo_x, self.right[x], x)
            b[live] = np.where(undo_y, self.left[y], y)
            live = live[~bad & (undo_x | undo_y)]
        return out

    def words(self, text: str) -> list[str]:
        """Words of a text, normalised; each is segmented on its own."""
        shown = self.model.normalize(text)
        if self.crosses:
            return [shown] if shown else []
        if shown[:1] == BLANK and BLANK * 2 not in shown and shown[-1] != BLANK:
            return shown.split(BLANK)[1:]
        return [w[1:] if w[0] == BLANK and (len(w) == 1 or w[1] != BLANK) else BLANK + w for w in re.findall(f"{BLANK}*[^{BLANK}]+|{BLANK}+", shown)]

    def _cut(self, word: str) -> list[str]:
        """A long word cut where no piece has the two characters side by side."""
        cuts = [0, *(k for k in range(1, len(word)) if (word[k - 1], word[k]) not in self.joined), len(word)]
        return [word[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]

    def segment(self, words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words as they stand, without a blank sign added, and where each word's begin."""
        count = np.ones(len(words), np.int64)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        if lengths.max(initial=0) > LONG:
            cut = [self._cut(w) if len(w) > LONG else (w,) for w in words]
            count = np.fromiter(map(len, cut), np.int64, len(words))
            words = list(itertools.chain.from_iterable(cut))
            lengths = np.fromiter(map(len, words), np.int64, len(words))
        ids, sizes, begin, total = [], np.zeros(len(words), np.int64), np.zeros(len(words), np.int64), 0
        for length in np.unique(lengths).tolist():
            same = np.flatnonzero(lengths == length)
            step = max(1, BATCH_CHARS // max(length, 1))
            for low in range(0, len(same), step):
                at = same[low : low + step]
                found, size = self._viterbi([words[k] for k in at.tolist()], length)
                ids.append(found)
                sizes[at], begin[at] = size, total + np.cumsum(size) - size
                total += len(found)
        flat = np.concatenate(ids) if ids else np.zeros(0, self.kind)
        ends = np.concatenate(([0], np.cumsum(sizes)))
        return _taken(flat, begin, sizes), ends[np.concatenate(([0], np.cumsum(count)))]

    def _viterbi(self, words: Sequence[str], length: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, number of each word's)."""
        n = len(words)
        if not length:
            return np.zeros(0, self.kind), np.zeros(n, np.int64)
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(n, length).T.astype(np.uint64)
        if length >= len(self.powers):
            self.powers = np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(length + 1, _R, np.uint64))))
        prefix = np.zeros((length + 1, n), np.uint64)
        for k in range(length):
            prefix[k + 1] = prefix[k] * _R + points[k] + np.uint64(1)
        total = np.full((length + 1, n), -np.inf)
        total[0] = 0
        last = np.full((length + 1, n), -1, np.int64)  # rank of the last piece of the best way
        back = np.zeros((length + 1, n), np.int32)
        worst = (self.score.min() if len(self.score) else 0.0) - 10
        for end in range(1, length + 1):
            begins = np.arange(max(0, end - self.longest), end)
            h = _mix(prefix[end] - prefix[begins] * self.powers[end - begins, None]).ravel()
            flat = np.flatnonzero(self.some_key[h >> np.uint64(44)])
            h = h[flat]
            at = np.minimum(np.searchsorted(self.keys, h), max(len(self.keys) - 1, 0))
            found = self.keys[at] == h if len(self.keys) else np.zeros(len(h), bool)
            flat, rank = flat[found], self.rank_of_key[at[found]]
            row, begin = flat % n, begins[flat // n]
            none = np.ones(n, bool)
            none[row[begin == end - 1]] = False
            none = np.flatnonzero(none)  # a character without a piece
            ok = np.isfinite(total[begin, row])
            if self.merging:
                ok &= self.built[rank]
                some = np.flatnonzero(ok & (begin > 0))
                ok[some] = self.compatible(last[begin[some], row[some]], rank[some])
            row, rank, begin = row[ok], rank[ok], begin[ok]
            if self.merging:  # one way only is possible
                value = total[begin, row]
            else:
                value = total[begin, row] + self.score[rank]
                order = np.lexsort((begin, -value, row))  # a word's best way first, of equal ones the longest piece
                row, rank, begin, value = row[order], rank[order], begin[order], value[order]
                best = np.flatnonzero(np.diff(row, prepend=-1) != 0)
                row, rank, begin, value = row[best], rank[best], begin[best], value[best]
            total[end, row], last[end, row], back[end, row] = value, rank, begin
            value = total[end - 1, none] + (0.0 if self.merging else worst)
            better = value > total[end, none]
            none = none[better]
            total[end, none], last[end, none], back[end, none] = value[better], -1, end - 1
        # the ways back of all words, a piece a step
        steps, place = [], np.full(n, length)
        at = np.arange(n)
        size = np.zeros(n, np.int64)
        while len(at):
            rank, begin = last[place[at], at], back[place[at], at]
            steps.append((at, rank, begin))
            many = np.ones(len(at), np.int64)
            for k in np.flatnonzero(rank < 0).tolist():
                many[k] = len(self._bytes(words[at[k]][begin[k]]))
            size[at] += many
            place[at] = begin
            at = at[begin > 0]
        ids = np.zeros(int(size.sum()), self.kind)
        end = np.cumsum(size)
        for at, rank, begin in steps:
            known = rank >= 0
            end[at[known]] -= 1
            ids[end[at[known]]] = self.ids[rank[known]]
            for k in np.flatnonzero(~known).tolist():
                some = self._bytes(words[at[k]][begin[k]])
                end[at[k]] -= len(some)
                ids[end[at[k]] : end[at[k]] + len(some)] = some
        return ids, size

    @property
    def kind(self) -> str:
        return "<u2" if len(self.raw) < 1 << 16 else "<u4"

    def _bytes(self, character: str) -> np.ndarray:
        """Ids of a character without a piece."""
        ids = self.of_character.get(character)
        if ids is None:
            ids = self.byte_id[list(character.encode("utf-8", "surrogatepass"))]
            ids = np.array([self.unknown], np.int64) if (ids < 0).any() else ids
            self.of_character[character] = ids  # as many as there are characters
        return ids

    def encode(self, texts: Sequence[str | None]) -> list[bytes]:
        """Ids of every text, little-endian uint32."""
        out: list[bytes] = []
        for low, high in groups_of(texts, [len(t or "") for t in texts], TEXT_CHARS):
            out += self._encode(texts[low:high])
        return out

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.known_ids, self.known_ends = np.zeros(0, self.kind), np.zeros(1, np.int64)

    def _encode(self, texts: Sequence[str | None]) -> list[bytes]:
        split = [self.words(t) if t else [] for t in texts]
        new = set().union(*split).difference(self.known)
        if len(self.known) + len(new) > REMEMBERED:
            self._forget()
            new = set().union(*split)
        new = list(new)
        # a word that keeps its own blank signs (or has none) is marked by one more
        ids, begins = self.segment([w[1:] if w[:1] == BLANK else w if self.crosses else BLANK + w for w in new])
        self.known.update(zip(new, range(len(self.known), len(self.known) + len(new)), strict=True))
        self.known_ends = np.concatenate((self.known_ends, begins[1:] + len(self.known_ids)))
        self.known_ids = np.concatenate((self.known_ids, ids))
        words = np.concatenate(([0], np.cumsum([len(ws) for ws in split], dtype=np.int64)))
        at = np.fromiter(map(self.known.__getitem__, itertools.chain.from_iterable(split)), np.int64, int(words[-1]))
        sizes = self.known_ends[at + 1] - self.known_ends[at]
        ends = (4 * np.concatenate(([0], np.cumsum(sizes))))[words].tolist()
        whole = _taken(self.known_ids, self.known_ends[at], sizes).astype("<u4").tobytes()
        return [whole[a:b] for a, b in zip(ends, ends[1:], strict=False)]


def _segmenter(path: str) -> Segmenter:
    return worker_state(f"segmenter {path}", lambda: Segmenter(path))


def encoded(df: DataFrame, path: str, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """``keep`` columns and ``ids`` (little-endian uint32) of every row's whole text."""
    bounded_batches(df.sparkSession, ROWS, BYTES)
    rows = df.select(*keep, F.col(text).alias("_text"))
    schema = rows.drop("_text").withColumn("ids", F.lit(b"")).schema
    names = schema.names

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segmenter = _segmenter(path)
        for part in parts:
            ids = segmenter.encode(part.column(part.num_columns - 1).to_pylist())
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(ids, pa.binary())], names=names)

    return rows.mapInArrow(batches, schema)


def decoded(df: DataFrame, path: str, keep: tuple[str, ...] = ("doc_id",), ids: str = "ids") -> DataFrame:
    """``keep`` columns and ``text`` of every row's ids."""
    bounded_batches(df.sparkSession, ROWS, BYTES)
    rows = df.select(*keep, F.col(ids).alias("_ids"))
    schema = rows.drop("_ids").withColumn("text", F.lit("")).schema
    names = schema.names

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = worker_state(f"decoder {path}", lambda: Decoder(_model(path)))
        for part in parts:
            texts = [decoder.decode(x) for x in part.column(part.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(texts, pa.string())], names=names)

    return rows.mapInArrow(batches, schema)
