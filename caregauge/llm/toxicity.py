"""Toxicity by a weighted lexicon matched with Aho-Corasick on folded text.

Folding: composed form, lower case, compatibility forms (styled letters, ligatures) and look-alike
letters of other scripts to plain letters, digits and signs that stand for letters to those letters,
invisible characters removed, everything else a blank. Accents stay, as they tell words apart; the
text without accents is matched beside it. The lexicon holds word beginnings (a stem covers its endings) with log-odds weights, and
exception phrases (a word, or a word with the next or the one before it) that cancel a match.
The summed weights and their share of the text's words go through a logistic curve.

Shares are rates within each label, and both labels weigh the same in the curve, so neither the
lexicon's thresholds nor the score depend on how many rows of each label the sample holds.

Defined results: null texts score like empty texts; whole texts are read; overlapping entries of
one word count once, the heaviest; repeated rows score alike; where a label has no example every
score is that of an empty lexicon; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import unicodedata
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caregauge.llm.common import (
    bounded_batches,
    codepoints,
    groups_of,
    labelled_ids,
    sample_rows,
    text_starts,
    worker_state,
)
from caregauge.sources.scratch import stored

#: Bound of the learned sample, for each label.
SAMPLE_DOCUMENTS = 4000
#: Parts of the written sample.
SAMPLE_PARTS = 32
#: An entry is this many times as frequent in one label's documents as in the other's, in so many documents at least.
TIMES, LEAST = 4, 3
#: Beginnings or phrases that a task counts before it hands them on.
COUNTED = 500_000
#: Word beginnings of these lengths are tried.
SHORTEST, LONGEST = 3, 12
BATCH_CHARS = 1_000_000

# Digits and signs that are read as letters, and look-alikes of other scripts.
STAND_INS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "€": "e"}
LOOK_ALIKES = {
    **dict(zip("авекмнорстухіѕјԁһԛԝ", "abekmhopctyxisjdhqw", strict=True)),
    **dict(zip("αβεικνορτυχγ", "abeiknoptuxy", strict=True)),
    "ı": "i", "ł": "l", "đ": "d", "ø": "o", "þ": "p",
}
INVISIBLE = {0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF, *range(0xFE00, 0xFE10), *range(0xE0100, 0xE01F0)}
#: White on black letters A to Z, which have no compatibility form.
NEGATIVE = (0x1F150, 0x1F170)
#: Letters end before; what lies beyond is a blank or invisible. Accents are taken off below the other.
LAST_LETTER, LAST_ACCENTED = 0x33480, 0x2000
MANY = 0x110000


def _plain(c: str) -> str:
    """Folded form of a character: some letters, or nothing."""
    for first in NEGATIVE:
        if first <= ord(c) < first + 26:
            return STAND_INS.get(x := chr(ord("a") + ord(c) - first), x)
    form = unicodedata.normalize("NFKC", c).lower()
    form = "".join(x for x in unicodedata.normalize("NFC", form) if not unicodedata.combining(x))
    if len(form) == 3 and form[0] == "(" and form[2] == ")":
        form = form[1]
    form = "".join(STAND_INS.get(x, x) for x in (LOOK_ALIKES.get(x, x) for x in form))
    return form if form.isalnum() else ""


def _folding() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Folded code point, and number of folded letters, of every code point; letters of those that
    have several (they stand at the code point less MANY); every letter without its accent."""
    out, size = np.full(0x110000, 32, np.uint32), np.ones(0x110000, np.uint8)
    letters: list[int] = []
    for k in range(LAST_LETTER):
        c = chr(k)
        if 0xD800 <= k < 0xE000:
            continue
        if unicodedata.combining(c):
            size[k] = 0
        elif plain := _plain(c):
            out[k] = ord(plain) if len(plain) == 1 else MANY + len(letters)
            if len(plain) > 1:
                size[k] = len(plain)
                letters += map(ord, plain)
    size[list(INVISIBLE)] = 0
    out[0] = 0
    bare = np.arange(0x110000, dtype=np.uint32)
    for k in range(LAST_ACCENTED):
        first, *accents = unicodedata.normalize("NFD", chr(k))
        if accents and all(map(unicodedata.combining, accents)):
            bare[k] = ord(LOOK_ALIKES.get(first, first))
    return out, size, np.array(letters, np.uint32), bare


def folded(texts: Sequence[str]) -> tuple[str, np.ndarray]:
    """All folded texts, each begun and ended by a blank, in one string; where each begins, and the end."""
    table, sizes, letters, _ = worker_state("toxicity folding", _folding)
    texts = [f" {unicodedata.normalize('NFC', t.replace(chr(0), ' '))} " for t in texts]
    points, starts = codepoints(texts), text_starts(texts)
    out, size = table[points], sizes[points]
    if (size != 1).any():
        begins = np.concatenate(([0], np.cumsum(size, dtype=np.int64)))
        out, nth = np.repeat(out, size), np.arange(begins[-1]) - np.repeat(begins[:-1], size)
        several = out >= MANY
        out[several] = letters[out[several] - MANY + nth[several]]
        starts = begins[starts]
    return out.astype("<u4").tobytes().decode("utf-32-le"), starts


def without_accents(folded_text: str) -> str:
    """Each letter without its accents, in the same place."""
    bare = worker_state("toxicity folding", _folding)[3]
    return bare[np.frombuffer(folded_text.encode("utf-32-le"), np.uint32)].astype("<u4").tobytes().decode("utf-32-le")


def folded_words(text: str) -> list[str]:
    return folded([text])[0].replace("\0", " ").split()


def _matcher(model: dict):
    """Automaton of the stems, each after a blank."""
    import ahocorasick

    found = ahocorasick.Automaton()
    for stem, weight in model["stems"].items():
        found.add_word(" " + stem, (len(stem), weight))
    found.make_automaton()
    return found


def matches(texts: Sequence[str], model: dict, machine) -> tuple[list[tuple[int, str, str, str, float]], np.ndarray]:
    """(text number, word before, word, word after, weight) of every matched word; words of every text."""
    joined, starts = folded(texts)
    points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    word = (points != 32) & (points != 0)
    begins = np.flatnonzero(word[1:] & ~word[:-1]) + 1
    ends = np.flatnonzero(word[:-1] & ~word[1:]) + 1
    words = np.diff(np.searchsorted(begins, starts))
    best: dict[int, float] = {}
    if model["stems"]:
        bare = without_accents(joined)
        for text in (joined, bare) if bare != joined else (joined,):
            for end, (size, weight) in machine.iter(text):
                begin = end - size + 1
                best[begin] = max(best.get(begin, -math.inf), weight)
    at = np.fromiter(best, np.int64, len(best))
    owner = np.searchsorted(starts, at, side="right") - 1
    nth = np.searchsorted(begins, at)
    first, last = np.searchsorted(begins, starts[owner]), np.searchsorted(begins, starts[owner + 1]) - 1

    def said(k: int) -> str:
        return joined[begins[k] : ends[k]]

    found = [
        (k, said(n - 1) if n > low else "", said(n), said(n + 1) if n < high else "", best[begin])
        for begin, k, n, low, high in zip(*(x.tolist() for x in (at, owner, nth, first, last)), strict=True)
    ]
    return found, words


def phrases(before: str, word: str, after: str) -> tuple[str, str, str]:
    """What an exception can name: the word, the word and the next, the one before and the word."""
    return word, f"{word} {after}", f"{before} {word}"


def _measures(texts: Sequence[str | None], model: dict, machine) -> np.ndarray:
    """Summed weight of every text, as a logarithm and by the text's length."""
    texts = [t or "" for t in texts]
    out = np.zeros((len(texts), 2))
    for low, high in groups_of(texts, [len(t) for t in texts], BATCH_CHARS):
        found, words = matches(texts[low:high], model, machine)
        total = np.zeros(high - low)
        for k, before, word, after, weight in found:
            if not any(p in model["exceptions"] for p in phrases(before, word, after)):
                total[k] += weight
        out[low:high] = np.stack((np.log1p(total), total / np.sqrt(words + 10.0)), axis=1)
    return out


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression, each label weighing the same, with a small penalty by Newton steps; the
    last weight is the constant."""
    share = np.where(y == 1, 0.5 / y.sum(), 0.5 / (1 - y).sum()) * len(y)
    x, w = np.column_stack((x, np.ones(len(y)))), np.zeros(x.shape[1] + 1)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        curve = (x * (share * p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(len(w))
        w = w + np.linalg.solve(curve, x.T @ (share * (y - p)) - 0.05 * w)
    return w


def _beginnings(text: str) -> set[str]:
    return {w[:n] for w in set(folded_words(text)) for n in range(SHORTEST, min(LONGEST, len(w)) + 1)}


def _counts(rows: DataFrame, said_by, kind: str, label_of: dict[int, int]) -> DataFrame:
    """(``kind``, toxic, clean): documents or places of each string that ``said_by(ids, texts)`` yields
    as (id, string); counted within a task first, which hands its counts on when they are many."""

    def batches(pieces: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: tuple[Counter[str], Counter[str]] = (Counter(), Counter())

        def handed_on() -> pa.RecordBatch:
            keys = list(seen[0].keys() | seen[1].keys())
            counts = [pa.array([seen[y][x] for x in keys], pa.int64()) for y in (1, 0)]
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), *counts], [kind, "toxic", "clean"])

        for piece in pieces:
            for doc_id, strings in said_by(piece.column(0).to_pylist(), [t or "" for t in piece.column(1).to_pylist()]):
                seen[label_of[doc_id]].update(strings)
                if len(seen[0]) + len(seen[1]) > COUNTED:
                    yield handed_on()
                    seen = (Counter(), Counter())
        yield handed_on()

    counted = rows.mapInArrow(batches, f"{kind} string, toxic long, clean long").groupBy(kind)
    return counted.agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def learned(documents: DataFrame, labels: DataFrame, parts: int, held_out: int) -> dict:
    """Lexicon, exceptions and curve from a bounded sample of labelled rows outside the held-out fold.

    The sample's texts are read once and written. Beginnings are counted over documents of both
    labels. Candidates are those TIMES as frequent in toxic documents whose binomial evidence
    outweighs the number of beginnings tried, also when toxic documents with the same word before
    count once, so that copies of a document are no evidence of their own; of those, ones for which
    no shorter one says the same are taken. Spark sifts the counts: only candidates come to the
    driver, each of which stands in many documents of the sample.
    """
    label_of = labelled_ids(labels, "toxic", parts, held_out, SAMPLE_DOCUMENTS)
    n_toxic = sum(label_of.values())
    n_clean = len(label_of) - n_toxic
    empty = {"stems": {}, "exceptions": frozenset(), "curve": np.array([0.0, 0.0, -4.0])}
    if not n_toxic or not n_clean:
        return empty
    rows = stored(sample_rows(documents, label_of).repartition(SAMPLE_PARTS, "doc_id"), "toxicity_sample")
    base = n_toxic / (n_toxic + n_clean)

    def begun(ids: list[int], texts: list[str]) -> Iterator[tuple[int, set[str]]]:
        return zip(ids, map(_beginnings, texts), strict=True)

    tried = stored(_counts(rows, begun, "stem", label_of).where(F.col("toxic") >= LEAST), "toxicity_stems")
    need = math.log(tried.count() + 1) + 1

    def evidence(t: int, c: int) -> float:
        """Log-likelihood ratio of the beginning's own rate against the sample's; none if it is no sign of toxicity."""
        if t * n_clean <= TIMES * c * n_toxic:
            return -math.inf
        rate = t / (t + c)
        return t * math.log(rate / base) + (c * math.log((1 - rate) / (1 - base)) if c else 0.0)

    hit, miss = F.col("toxic"), F.col("clean")
    share = hit / (hit + miss)
    gain = hit * F.log(share / base) + F.when(miss > 0, miss * F.log((1 - share) / (1 - base))).otherwise(0.0)
    passed = tried.where((hit * n_clean > TIMES * miss * n_toxic) & (gain >= need)).collect()
    hits, misses = {r["stem"]: r["toxic"] for r in passed}, {r["stem"]: r["clean"] for r in passed}
    tried_stems = frozenset(hits)

    def standing(pieces: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Candidates of toxic documents with a hash of the word before their first place."""
        seen: set[tuple[str, int]] = set()
        for piece in pieces:
            for text in piece.column(1).to_pylist():
                words, here = folded_words(text or ""), {}
                for before, word in zip(["", *words], words, strict=False):
                    for n in range(SHORTEST, min(LONGEST, len(word)) + 1):
                        if word[:n] in tried_stems:
                            here.setdefault(word[:n], zlib.crc32(before.encode()))
                seen.update(here.items())
        yield pa.RecordBatch.from_arrays(
            [pa.array([x for x, _ in seen], pa.string()), pa.array([h for _, h in seen], pa.int64())], ["stem", "before"]
        )

    toxic = [k for k, y in label_of.items() if y]
    contexts = rows.where(F.col("doc_id").isin(toxic)).mapInArrow(standing, "stem string, before long").groupBy("stem")
    apart = {r["stem"]: r["n"] for r in contexts.agg(F.count_distinct("before").alias("n")).collect()}
    weight: dict[str, float] = {}
    for stem in sorted(tried_stems, key=lambda x: (len(x), x)):
        t, c = hits[stem], misses[stem]
        if evidence(apart.get(stem, 1), c) < need:
            continue
        odds = math.log((t + 0.5) / (n_toxic + 1)) - math.log((c + 0.5) / (n_clean + 1))
        shorter = max((weight[stem[:n]] for n in range(SHORTEST, len(stem)) if stem[:n] in weight), default=-math.inf)
        if odds > shorter + 0.7:
            weight[stem] = round(odds, 4)
    # as long as possible: a stem goes on to a candidate as long as one letter follows in nearly all its documents
    onward: dict[str, tuple[int, str]] = {}
    for stem, n in hits.items():
        onward[stem[:-1]] = max(onward.get(stem[:-1], (0, "")), (n, stem))
    stems: dict[str, float] = {}
    for stem, odds in weight.items():
        while onward.get(stem, (0, ""))[0] >= 0.9 * hits[stem]:
            stem = onward[stem][1]
        stems[stem] = max(odds, stems.get(stem, odds))
    model = {"stems": stems, "exceptions": frozenset(), "curve": empty["curve"]}

    def matched(ids: list[int], texts: list[str]) -> Iterator[tuple[int, tuple[str, ...]]]:
        machine = _matcher(model)
        for low, high in groups_of(texts, [len(x) for x in texts], BATCH_CHARS):
            for k, before, word, after, _ in matches(texts[low:high], model, machine)[0]:
                yield ids[low + k], phrases(before, word, after)

    harmless = _counts(rows, matched, "phrase", label_of).where((miss >= LEAST) & (miss * n_toxic > TIMES * hit * n_clean))
    model["exceptions"] = frozenset(r["phrase"] for r in harmless.select("phrase").collect())

    def measured(pieces: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _matcher(model)
        for piece in pieces:
            x = _measures(piece.column(1).to_pylist(), model, machine)
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(x[:, 0]), pa.array(x[:, 1])], ["doc_id", "a", "b"])

    got = sorted(rows.mapInArrow(measured, "doc_id long, a double, b double").collect())
    y = np.array([label_of[r["doc_id"]] for r in got])
    if len(y) and y.min() != y.max():
        model["curve"] = _logistic(np.array([(r["a"], r["b"]) for r in got]), y)
    return model


def scored(documents: DataFrame, model: dict, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and ``score`` of every row."""
    bounded_batches(documents.sparkSession)
    rows = documents.select(*keep, F.col("text").alias("_text"))
    schema = rows.drop("_text").withColumn("score", F.lit(0.5)).schema
    names = schema.names

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _matcher(model)
        for part in parts:
            x = _measures(part.column(part.num_columns - 1).to_pylist(), model, machine)
            w = model["curve"]
            scores = 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -500, 500)))
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(scores)], names=names)

    return rows.mapInArrow(batches, schema)
