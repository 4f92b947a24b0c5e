"""Document quality by a linear-chain conditional random field over lines.

Every line is good or bad. A line's features are shape counts of its own (letters, symbols,
repeated words, ...) and those of its neighbours; two-state forward-backward gives each line's
probability of being good; their mean weighted by length, calibrated by a logistic curve, is the
document's score.

Defined results: a null text counts as one empty line, as an empty text does; whole texts are
read, however long; repeated rows score alike; where a label has no example every score is 0.5;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

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

#: Bounds of the learned sample: documents of each label, and lines of each document.
SAMPLE_DOCUMENTS = 1500
SAMPLE_LINES = 64
#: Code points whose features are computed at once.
BATCH_CHARS = 1_000_000
STEPS = 150

FEATURES = 13
_OTHER, _LOWER, _UPPER, _DIGIT, _SPACE, _STOP, _LOUD, _LETTER, _BREAK = range(9)
_R = 0x9E3779B97F4A7C15


def _classes() -> np.ndarray:
    """Class of every code point of the basic plane."""
    out = np.zeros(0x10000, np.uint8)
    for k in range(0x10000):
        c = chr(k)
        if c.isalpha():
            out[k] = _LOWER if c.islower() else _UPPER if c.isupper() else _LETTER
        elif c.isdigit():
            out[k] = _DIGIT
        elif c.isspace():
            out[k] = _SPACE
    for c in ".,;:'\"?-()’“”–":
        out[ord(c)] = _STOP
    out[ord("!")] = _LOUD
    out[[0, 10]] = _BREAK
    return out


def line_features(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of every line, the lines' lengths, and the number of lines of every text."""
    lut = worker_state("quality classes", _classes)
    points = codepoints(texts)
    kind = lut[np.minimum(points, 0xFFFF)]
    kind[points >= 0x20000] = _LETTER
    ends = np.flatnonzero(kind == _BREAK)  # a NUL inside a text breaks a line, too
    begins = np.concatenate(([0], ends[:-1] + 1))
    size, n = ends - begins, len(ends)
    line = np.repeat(np.arange(n), size + 1)
    count = np.bincount(line * 9 + kind, minlength=9 * n).reshape(n, 9)[:, :8].astype(np.float64)
    lines_of = np.diff(np.searchsorted(ends, text_starts(texts) - 1, side="right"))
    # words: runs of what is neither space nor break; a hash of each tells repeated ones
    inside = (kind != _SPACE) & (kind != _BREAK)
    edge = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).astype(np.int8)))
    start, stop = edge[::2], edge[1::2]
    powers = worker_state("quality powers", lambda: {})
    need = len(points) + 1
    if len(powers.get("up", ())) < need:
        for name, r in (("up", _R), ("down", pow(_R, -1, 1 << 64))):
            powers[name] = np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(need, r, np.uint64))))
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(points * powers["up"][: len(points)])))
    word = (total[stop] - total[start]) * powers["down"][start]
    of = line[start]
    again = np.zeros(len(word), bool)
    for lag in (1, 2):
        again[lag:] |= (word[lag:] == word[:-lag]) & (of[lag:] == of[:-lag])
    words = np.bincount(of, minlength=n)
    repeated = np.bincount(of, weights=again, minlength=n)
    capital = np.bincount(of, weights=kind[start] == _UPPER, minlength=n)
    letters = count[:, _LOWER] + count[:, _UPPER] + count[:, _LETTER]
    chars, some = np.maximum(size, 1), np.maximum(words, 1)
    final = kind[np.maximum(ends - 1, 0)]
    whole = np.bincount(of, weights=(word >> np.uint64(11)).astype(np.float64), minlength=n)
    same = np.concatenate(([False], (whole[1:] == whole[:-1]) & (size[1:] == size[:-1]) & (size[1:] > 0)))
    same[np.cumsum(lines_of) - lines_of] = False  # a text's first line has none before
    return (
        np.stack(
            [
                np.ones(n),
                np.log1p(size) / 5,
                count[:, _UPPER] / np.maximum(letters, 1),
                letters / chars,
                10 * count[:, _DIGIT] / chars,
                10 * count[:, _OTHER] / chars,
                10 * count[:, _STOP] / chars,
                10 * count[:, _LOUD] / chars,
                3 * repeated / some,
                (size - count[:, _SPACE]) / some / 10,
                capital / some,
                same.astype(np.float64),
                ((final == _STOP) & (size > 0)).astype(np.float64),
            ],
            axis=1,
        ),
        size,
        lines_of,
    )


def with_neighbours(own: np.ndarray, lines_of: np.ndarray) -> np.ndarray:
    """Own features, those of the line before and those of the line after (zeros at the ends)."""
    first = np.cumsum(lines_of) - lines_of
    before = np.concatenate((np.zeros((1, own.shape[1])), own[:-1]))
    after = np.concatenate((own[1:], np.zeros((1, own.shape[1]))))
    before[first] = 0
    after[first + lines_of - 1] = 0
    return np.concatenate((own, before, after), axis=1)


def _message(x: np.ndarray, t: np.ndarray) -> np.ndarray:
    """Log odds that a state of log odds ``x`` passes on through transition weights t[from, to]."""
    return np.logaddexp(x + t[1, 1], t[0, 1]) - np.logaddexp(x + t[1, 0], t[0, 0])


def forward_backward(unary: np.ndarray, lines_of: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward and backward log odds of every line; their sum gives the marginal.

    All chains advance together, the longest first.
    """
    order = np.argsort(-lines_of, kind="stable")
    first, many = (np.cumsum(lines_of) - lines_of)[order], lines_of[order]
    alive = np.searchsorted(-many, -np.arange(1, (many[0] if len(many) else 0) + 1), side="right")
    ahead, back = unary.copy(), np.zeros_like(unary)
    for k, n in enumerate(alive[1:], 1):
        at = first[:n] + k
        ahead[at] += _message(ahead[at - 1], t)
    for k in range(len(alive) - 2, -1, -1):
        at = first[: alive[k + 1]] + k
        back[at] = _message(back[at + 1] + unary[at + 1], t.T)
    return ahead, back


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def fit_chain(features: np.ndarray, lines_of: np.ndarray, good: np.ndarray, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray]:
    """Weights and transitions of the greatest likelihood, by gradient ascent with a small penalty."""
    x = np.zeros(features.shape[1] + 4)
    m, v = np.zeros_like(x), np.zeros_like(x)
    inner = np.ones(len(good), bool)
    inner[np.cumsum(lines_of) - 1] = False  # lines that another line follows
    at = np.flatnonzero(inner)
    seen = np.bincount(good[at] * 2 + good[at + 1], minlength=4)
    for step in range(1, steps + 1):
        unary, t = features @ x[:-4], x[-4:].reshape(2, 2)
        ahead, back = forward_backward(unary, lines_of, t)
        slope = features.T @ (good - _sigmoid(ahead + back))
        after = unary[at + 1] + back[at + 1]
        both = np.stack([t[0, 0] + 0 * after, t[0, 1] + after, ahead[at] + t[1, 0], ahead[at] + t[1, 1] + after])
        both = np.exp(both - both.max(axis=0, initial=-np.inf, keepdims=True)) if len(at) else both
        pairs = (both / both.sum(axis=0)).sum(axis=1) if len(at) else np.zeros(4)
        grad = np.concatenate((slope, seen - pairs)) / max(len(good), 1) - 1e-4 * x
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        x = x + 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
    return x[:-4], x[-4:].reshape(2, 2)


def document_means(marginal: np.ndarray, size: np.ndarray, lines_of: np.ndarray) -> np.ndarray:
    """Mean of the lines' marginals by length; the line break counts, so that none weighs nothing."""
    owner = np.repeat(np.arange(len(lines_of)), lines_of)
    weight = size + 1.0
    return np.bincount(owner, weights=marginal * weight, minlength=len(lines_of)) / np.bincount(
        owner, weights=weight, minlength=len(lines_of)
    )


def _calibrated(means: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Logistic curve over the means, each label weighing the same; Newton steps."""
    weight = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1)) * len(y)
    x, ab = np.stack([means - 0.5, np.ones(len(y))], axis=1), np.zeros(2)
    for _ in range(50):
        p = _sigmoid(x @ ab)
        slope = x.T @ (weight * (y - p)) - 0.05 * ab
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(2)
        ab = ab + np.linalg.solve(curve, slope)
    return float(ab[0]), float(ab[1])


def learned(documents: DataFrame, labels: DataFrame, parts: int, held_out: int) -> dict | None:
    """The model as plain arrays, from a bounded sample of labelled rows outside the held-out fold.

    A line starts with its document's label. Documents of label 0 may hold good lines, too: after
    a first fit, their lines that the chain finds good change label (one stays bad at least), and
    the chain is fitted again.
    """
    label_of = labelled_ids(labels, "quality", parts, held_out, SAMPLE_DOCUMENTS)

    def batches(pieces: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces:
            texts = [t or "" for t in piece.column(1).to_pylist()]
            own, size, lines_of = line_features(texts)
            out, first = [], np.cumsum(lines_of) - lines_of
            for k, n in enumerate(lines_of):
                begin = max(0, (n - SAMPLE_LINES) // 2)  # of a long sampled document the middle
                at = slice(first[k] + begin, first[k] + min(n, begin + SAMPLE_LINES))
                out.append(np.concatenate((own[at], size[at, None]), axis=1).astype("<f4").tobytes())
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(out, pa.binary())], ["doc_id", "lines"])

    got = sample_rows(documents, label_of).mapInArrow(batches, "doc_id long, lines binary").collect()
    got = sorted(got, key=lambda r: (r["doc_id"], bytes(r["lines"])))
    y = np.array([label_of[r["doc_id"]] for r in got], np.int64)
    if not len(y) or y.min() == y.max():
        return None
    tables = [np.frombuffer(r["lines"], "<f4").reshape(-1, FEATURES + 1).astype(np.float64) for r in got]
    lines_of = np.array([len(x) for x in tables])
    rows = np.concatenate(tables)
    size, features = rows[:, -1], with_neighbours(rows[:, :-1], lines_of)
    owner = np.repeat(np.arange(len(y)), lines_of)
    good = y[owner]
    w, t = fit_chain(features, lines_of, good)
    p = _sigmoid(sum(forward_backward(features @ w, lines_of, t)))
    worst = np.full(len(y), np.inf)
    np.minimum.at(worst, owner, p)
    good = np.where((y[owner] == 0) & (p > 0.5) & (p > worst[owner]), 1, good)
    w, t = fit_chain(features, lines_of, good)
    p = _sigmoid(sum(forward_backward(features @ w, lines_of, t)))
    return {"w": w, "t": t, "curve": _calibrated(document_means(p, size, lines_of), y)}


def score_texts(texts: Sequence[str | None], model: dict | None) -> np.ndarray:
    """Score of every whole text."""
    texts = [t or "" for t in texts]
    if model is None:
        return np.full(len(texts), 0.5)
    out = np.zeros(len(texts))
    for low, high in groups_of(texts, [len(t) for t in texts], BATCH_CHARS):
        own, size, lines_of = line_features(texts[low:high])
        ahead, back = forward_backward(with_neighbours(own, lines_of) @ model["w"], lines_of, model["t"])
        means = document_means(_sigmoid(ahead + back), size, lines_of)
        out[low:high] = _sigmoid(model["curve"][0] * (means - 0.5) + model["curve"][1])
    return out


def scored(documents: DataFrame, model: dict | None, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and ``score`` of every row."""
    bounded_batches(documents.sparkSession)
    rows = documents.select(*keep, F.col("text").alias("_text"))
    schema = rows.drop("_text").withColumn("score", F.lit(0.5)).schema
    names = schema.names

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            scores = score_texts(part.column(part.num_columns - 1).to_pylist(), model)
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(scores)], names=names)

    return rows.mapInArrow(batches, schema)
