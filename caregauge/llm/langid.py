"""Language identification by cross-parsing against suffix automata.

For each language a suffix automaton is built of a bounded sample of labelled text. A text is cut
into phrases, each the longest piece that occurs in the sample; a phrase costs the logarithm of
the longest sample's length, whatever the language. The language that needs the fewest bits (phrases times cost) wins.

Only letters tell languages apart: everything between letters counts as one blank, and case is
folded. Every letter of every sample is a symbol of its own. Each automaton is turned into a sparse
table, the rows of its states laid into each other's gaps: state and symbol give the next state, and
whether a phrase ends and the symbol begins the next one. All pieces of a batch (CHUNK symbols of a
text) walk through the tables of all languages side by side, one numpy step a symbol, over the whole text.

Defined results: null texts and texts without a letter give ``und`` with score 0; so does every
text when nothing was learned; of more than MAX_LANGUAGES values of ``lang`` those of the most
documents are learned (of equally many the first in order); ties go to the language that comes first in order; an empty table
gives an empty result; repeated rows are predicted alike; other columns are ignored.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caregauge.llm.common import (
    bounded_batches,
    codepoints,
    fold,
    groups_of,
    smallest_hashes,
    text_starts,
    worker_state,
)

#: Bounds of the learned sample: code points and documents for each language, and languages.
SAMPLE_CHARS = 16_000
SAMPLE_DOCUMENTS = 64
MAX_LANGUAGES = 200
#: Gaps that are tried for a row of several transitions before it goes to the end.
TRIED = 64
#: Symbols that a walk covers; the next walk of the text goes on with its state.
CHUNK = 512
#: Code points of a batch that walk side by side.
BATCH_CHARS = 2_000_000
UNKNOWN = "und"

_LETTER = re.compile(r"[^\W\d_]")


def _lower() -> np.ndarray:
    """Lower-case letter of every code point of the basic plane, a blank for what isn't a letter."""
    out = np.full(0x10000, 32, np.uint32)
    for k in range(0x10000):
        low = chr(k).lower()
        if chr(k).isalpha():
            out[k] = ord(low) if len(low) == 1 else k
    return out


def letters(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Letters of all texts in lower case, words apart by one blank; where each text begins, and the end.

    Each text ends with one code point 0. Letters beyond the basic plane stay as they are.
    """
    table = worker_state("language letters", _lower)
    points, starts = codepoints(texts), text_starts(texts)
    low = np.where(points < 0x10000, table[np.minimum(points, 0xFFFF)], points)
    for point in np.unique(points[points >= 0x10000]).tolist():  # emoji and other signs are no letters
        if not chr(point).isalpha():
            low[points == point] = 32
    low[starts[1:] - 1] = 0
    keep = np.ones(len(low), bool)
    keep[1:] = (low[1:] != 32) | ((low[:-1] != 32) & (low[:-1] != 0))
    keep[0] = low[0] != 32
    return low[keep], np.concatenate(([0], np.cumsum(keep)))[starts]


def automaton(symbols: Sequence[int]) -> list[dict[int, int]]:
    """Suffix automaton: for each state the next state by symbol."""
    step: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in symbols:
        new = len(step)
        step.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and c not in step[p]:
            step[p][c] = new
            p = link[p]
        if p != -1:
            q = step[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                copy = len(step)
                step.append(dict(step[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p != -1 and step[p].get(c) == q:
                    step[p][c] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    return step


def parse_table(step: list[dict[int, int]], width: int) -> tuple[np.ndarray, np.ndarray]:
    """(owner, entry) of every place of a sparse table; ``width``: number of symbols.

    Each state has a place of its own where its row begins, state 0 the place 0 with a full row. The
    entry of a state and a symbol stands at begin + symbol if the owner there is begin: 4 * begin of
    the next state + phrases that ended. Elsewhere no transition goes on: the phrase ends and the
    symbol begins the next one (the entry of state 0, + 1). A symbol that the sample lacks is a
    phrase of its own.
    """
    begin, begins = [0] * len(step), {0}
    filled = bytearray(b"\1") * width
    low = width  # places before it are filled

    def free(place: int) -> int:
        found = filled.find(0, place)
        return found if found >= 0 else max(place, len(filled))

    for state in sorted(range(1, len(step)), key=lambda k: -len(step[k])):
        row = sorted(step[state]) or [0]
        low = place = free(low)
        for tried in itertools.count():
            if tried == TRIED and len(row) > 1:
                place = len(filled)
            at = place - row[0]
            if at not in begins and not any(at + c < len(filled) and filled[at + c] for c in row[1:]):
                break
            place = free(place + 1)
        begin[state] = at
        begins.add(at)
        if step[state]:
            filled.extend(bytes(max(0, at + row[-1] + 1 - len(filled))))
            for c in row:
                filled[at + c] = 1
    size = max(begins) + width
    owner, entry = np.full(size, -1, np.int32), np.ones(size, np.int32)
    owner[:width] = 0
    for state, moves in enumerate(step):
        for c, to in moves.items():
            owner[begin[state] + c], entry[begin[state] + c] = begin[state], 4 * begin[to]
    return owner, entry


class CrossParser:
    """The tables of all languages and what maps code points to their symbols."""

    def __init__(self, samples: dict[str, str]):
        self.languages = sorted(samples)
        folded = {k: letters([samples[k]])[0][:-1] for k in self.languages}
        points, counts = np.unique(np.concatenate([np.zeros(0, np.uint32), *folded.values()]), return_counts=True)
        often = points[np.lexsort((points, -counts))]
        self.symbol = np.full(0x110000, len(often), np.int32)  # what no sample has
        self.symbol[often] = np.arange(len(often), dtype=np.int32)
        tables = [parse_table(automaton(self.symbol[x].tolist()), len(often) + 1) for x in folded.values()]
        # The longest sample's cost for all: a short sample must not make its phrases cheap.
        longest = max(map(len, folded.values()), default=0)
        self.cost = np.full(len(folded), np.log2(longest + 1.0))
        begins = np.cumsum([0, *[len(owner) for owner, _ in tables]])
        self.begin = begins[:-1].astype(np.int32)
        none = np.zeros(0, np.int32)
        self.owner = np.concatenate([none, *[np.where(o >= 0, o + b, -1) for (o, _), b in zip(tables, begins, strict=False)]]).astype(np.int32)
        self.entry = np.concatenate([none, *[e + 4 * b for (_, e), b in zip(tables, begins, strict=False)]]).astype(np.int32)

    def bits(self, texts: Sequence[str]) -> np.ndarray:
        """Bits of every text under every language (texts by languages)."""
        out = np.zeros((len(texts), len(self.languages)))
        for low, high in groups_of(texts, [len(t) for t in texts], BATCH_CHARS):
            out[low:high] = self._phrases(texts[low:high]) * self.cost
        return out

    def _phrases(self, texts: Sequence[str]) -> np.ndarray:
        points, starts = letters(texts)
        symbols = self.symbol[points]
        lengths = np.diff(starts) - 1
        pieces = np.maximum(-(-lengths // CHUNK), 1)
        owner = np.repeat(np.arange(len(texts)), pieces)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        begin = starts[owner] + nth * CHUNK
        size = np.minimum(lengths[owner] - nth * CHUNK, CHUNK)
        first = np.repeat(self.begin[:, None], len(begin), axis=1)
        last, count = first.copy(), np.zeros(first.shape, np.int32)
        lanes = np.arange(len(begin))
        while len(lanes):
            last[:, lanes], count[:, lanes] = self._walk(symbols, begin[lanes], size[lanes], first[:, lanes])
            # A lane goes on with the phrase under way at the end of the one before; walks that started
            # with another state are walked again, after the second round few.
            follows = np.flatnonzero(nth > 0)
            lanes = follows[(first[:, follows] != last[:, follows - 1]).any(axis=0)]
            first[:, lanes] = last[:, lanes - 1]
        ends = np.append(nth[1:] == 0, True) if len(nth) else np.zeros(0, bool)
        count += ends & (last != self.begin[:, None])  # the phrase under way at the end of the text
        return np.stack([np.bincount(owner, weights=row, minlength=len(texts)) for row in count], axis=1)

    def _walk(self, symbols: np.ndarray, begin: np.ndarray, size: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(states, phrases that ended) of all languages and lanes after walks from the states ``first``."""
        order = np.argsort(-size, kind="stable")  # lanes still walking come first
        begin, size = begin[order], size[order]
        walking = np.searchsorted(-size, -np.arange(1, size[0] + 1), side="right") if len(size) else []
        state = first[:, order]
        count = np.zeros(state.shape, np.int32)
        for t, n in enumerate(walking):
            symbol, now = symbols[begin[:n] + t], state[:, :n]
            place = now + symbol
            moved = np.where(self.owner[place] == now, self.entry[place], self.entry[self.begin[:, None] + symbol] + 1)
            count[:, :n] += moved & 3
            state[:, :n] = moved >> 2
        back = np.argsort(order)
        return state[:, back], count[:, back]


def learned(documents: DataFrame, parts: int, held_out: int) -> dict[str, str]:
    """Sample text by language, from rows whose fold isn't ``held_out``.

    First the ids are chosen (the smallest hashes of each language) from two narrow columns, then
    the texts of at most SAMPLE_DOCUMENTS rows a language are read.
    """
    rows = documents.where(F.col("lang").isNotNull() & (fold("doc_id", parts) != held_out))
    narrow = rows.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select("doc_id", "lang")
    ids = sorted({doc_id for _, doc_id in smallest_hashes(narrow, "lang", SAMPLE_DOCUMENTS, MAX_LANGUAGES)})
    cut = F.substring("text", 1, SAMPLE_CHARS).alias("text")  # of the sample only
    texts = (
        rows.where(F.col("doc_id").isin(ids) & F.col("text").isNotNull())
        .select("lang", F.xxhash64("doc_id").alias("h"), "doc_id", cut)
        .dropDuplicates(["lang", "doc_id"])
        .collect()
    )
    samples: dict[str, str] = {}
    for row in sorted(texts, key=lambda r: (r["lang"], r["h"], r["doc_id"])):
        samples[row["lang"]] = (samples.get(row["lang"], "") + row["text"] + "\n")[:SAMPLE_CHARS]
    return {k: v for k, v in samples.items() if v.strip()}


def random_cost(samples: dict[str, str]) -> float:
    """Bits for each letter of a text whose letters are drawn evenly from those of the samples."""
    return float(np.log2(max(2, len(np.unique(letters(list(samples.values()))[0])) - 1)))


def has_letter(text: str | None) -> bool:
    found = _LETTER.search(text) if text else None
    return bool(found) and (found.group().isalpha() or any(map(str.isalpha, text)))


def predicted(documents: DataFrame, samples: dict[str, str], keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns with ``lang_pred``, ``score`` (probability of that language) and
    ``bits_per_char`` (cost under it of all phrases but one, by the text's length) for the whole
    text of every row."""
    bounded_batches(documents.sparkSession)
    rows = documents.select(*keep, F.col("text").alias("_text"))
    more = "lang_pred string, score double, bits_per_char double"
    made = rows.drop("_text").select("*", *[F.lit(None).cast(x.split()[1]).alias(x.split()[0]) for x in more.split(", ")])
    names = made.columns
    # Plain arrays; their size is bounded by SAMPLE_CHARS for each language.
    given = documents.sparkSession.sparkContext.broadcast(vars(CrossParser(samples)))

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = CrossParser.__new__(CrossParser)
        parser.__dict__.update(given.value)
        for part in parts:
            texts = part.column(part.num_columns - 1).to_pylist()
            some = [k for k, t in enumerate(texts) if parser.languages and has_letter(t)]
            lang, score, rate = [UNKNOWN] * len(texts), [0.0] * len(texts), [None] * len(texts)
            bits = parser.bits([texts[k] for k in some])
            best = bits.argmin(axis=1) if some else []
            for k, b, row in zip(some, best, bits, strict=True):
                lang[k] = parser.languages[b]
                score[k] = float(1.0 / np.exp2(np.maximum(row[b] - row, -1000.0)).sum())
                rate[k] = float((row[b] - parser.cost[b]) / len(texts[k]))
            new = [pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rate, pa.float64())]
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], *new], names=names)

    return rows.mapInArrow(batches, made.schema)
