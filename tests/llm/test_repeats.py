"""Repeated passages against brute force over all windows."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from caregauge.llm import repeats
from caregauge.llm.common import table

SCHEMA = "doc_id long, text string, n_words long, digest string, name int"


def brute_force(rows, window):
    least = {}
    split = [(2**63 - 1 if i is None else i, i, (t or "").translate({k: 32 for k in range(9, 14)}).split(" ")) for i, t in rows]
    split = [(o, i, [w for w in ws if w]) for o, i, ws in split]
    for o, _, ws in split:
        for s in range(len(ws) - window + 1):
            key = tuple(ws[s : s + window])
            least[key] = min(o, least.get(key, o))
    out = []
    for o, i, ws in split:
        gone = set()
        for s in range(len(ws) - window + 1):
            if least[tuple(ws[s : s + window])] < o:
                gone |= set(range(s, s + window))
        kept = " ".join(w for k, w in enumerate(ws) if k not in gone)
        out.append((i, len(ws), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def check(spark, rows, window):
    df = spark.createDataFrame([(i, t, 5, "d", 1) for i, t in rows], SCHEMA).repartition(3)
    got = sorted((tuple(r) for r in repeats.without_repeats(df, window).collect()), key=repr)
    want = brute_force(rows, window)
    assert got == want
    return sum(r[2] for r in got)


def made(seed, documents, length, alphabet, passages, size):
    rng = random.Random(seed)
    pool = [[str(rng.randrange(alphabet)) for _ in range(rng.randrange(size, 2 * size))] for _ in range(passages)]
    rows = []
    for k in range(documents):
        words = []
        while len(words) < length:
            words += rng.choice(pool) if rng.random() < 0.4 else [str(rng.randrange(alphabet)) for _ in range(rng.randrange(1, size))]
        rows.append((k, " ".join(words[: rng.randrange(1, 2 * length)])))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("window, alphabet", [(50, 10**6), (50, 2), (50, 1), (20, 3), (5, 4), (1, 50), (2, 9), (64, 30)])
def test_made_up_texts(spark, window, alphabet):
    rows = made(window, 60, 300, alphabet, 8, 40)
    rows += [(1000 + k, rows[k][1]) for k in range(20)]  # copies
    rows += [(2000 + k, rows[1][1].replace(" ", "\n ", k)) for k in range(4)]  # other white space
    rows += [(3000 + k, rows[2][1] + f" end{k}") for k in range(30)]  # near copies
    assert check(spark, rows, window) > 0


def test_odd_rows(spark):
    long = " ".join(map(str, range(60)))
    rows = [(1, None), (2, ""), (3, " \t\n "), (4, "one word"), (None, long), (None, long + " x"), (5, long), (5, long), (5, "y " + long), (6, long), (7, "\x0b" + long + "\x1c "), (2**63 - 1, long)]
    rows += [(8, " ".join(["the"] * 300)), (9, " ".join(["the"] * 200)), (10, " ".join(["a", "b"] * 150)), (11, " ".join(["b", "a"] * 120)), (12, "日本 語 " * 80), (13, "語 日本 " * 80)]
    assert check(spark, rows, 50) > 0
    assert check(spark, [(3, " ".join(["the"] * 51)), (4, " ".join(["the"] * 51))], 50) == 51


def test_empty_table(spark):
    assert repeats.without_repeats(spark.createDataFrame([], SCHEMA)).collect() == []


def test_windows_are_judged_on_the_input(spark):
    """Document 2 loses a passage of document 1; document 3 repeats what document 2 loses in part."""
    w = [str(k) for k in range(200)]
    rows = [(1, " ".join(w[:100])), (2, " ".join(w[50:150])), (3, " ".join(w[90:145])), (4, " ".join(w[:49])), (5, " ".join(w[:50]))]
    assert check(spark, rows, 50) == 50 + 55 + 50


def test_long_texts_in_stretches(spark, monkeypatch):
    monkeypatch.setattr(repeats, "STRETCH", 70)
    monkeypatch.setattr(repeats, "WORDS_AT_ONCE", 200)
    rows = made(3, 40, 600, 10**6, 6, 60)
    assert check(spark, rows, 50) > 0


def test_a_passage_in_most_documents(spark):
    """Near copies and a frequent passage; small batches, so that names and keys meet in the exchange."""
    passage = " ".join(f"p{k}" for k in range(70))
    rows = [(k, f"{passage} own{k} " + " ".join(f"{k}-{j}" for j in range(k % 60))) for k in range(300)]
    df = spark.createDataFrame([(i, t, 5, "d", 1) for i, t in rows], SCHEMA).repartition(50)
    assert sorted(tuple(r) for r in repeats.without_repeats(df).collect()) == sorted(brute_force(rows, 50))


@pytest.mark.parametrize("alphabet", [1, 2, 5, 1000])
def test_names_depend_on_their_stretch_alone(alphabet):
    """Whatever surrounds the words that decided about a name, the name is there."""
    rng = np.random.default_rng(alphabet)
    words = rng.integers(1, alphabet + 1, 400).astype(np.uint64)
    name, begin, end = repeats.recompressed(words, np.zeros(400, int))
    for k in np.flatnonzero(end - begin <= 60)[::5]:
        inside = words[begin[k] : end[k]]
        for _ in range(5):
            left, right = (rng.integers(1, alphabet + 2, rng.integers(0, 40)).astype(np.uint64) for _ in range(2))
            other = np.concatenate((left, inside, right))
            names, b, e = repeats.recompressed(other, np.zeros(len(other), int))
            same = (names == name[k]) & (b == len(left)) & (e == len(left) + len(inside))
            assert same.any()


def test_names_get_long():
    words = np.random.default_rng(1).integers(0, 2**60, 20_000).astype(np.uint64)
    name, begin, end = repeats.recompressed(words, np.zeros(len(words), int))
    assert len(words) / len(name) > 6 and (end - begin <= 50).mean() > 0.8


def test_shared_names_over_batches():
    rows = [(1, 1, 1, 0, False), (1, 1, 1, 5, False), (1, 2, 1, 0, False), (2, 1, 1, 1, False), (3, 1, 1, 2, False), (3, 1, 1, -1, False), (4, 1, 1, 3, False), (4, 1, 2, 3, False), (4, 9, 2, 7, False), (9, 4, 4, 4, True)]
    want = [(1, 1, 0), (1, 1, 5), (2, 1, 0), (1, 1, 2), (1, 1, 3), (1, 2, 3), (9, 2, 7), (4, 4, 4)]
    names = ["name", "o", "th", "number", "settled"]
    for step in (1, 2, 3, 20):
        parts = [pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows[k : k + step]]) for k in range(0, len(rows), step)]
        got = [tuple(r.values()) for b in repeats._shared(iter(parts)) for r in b.to_pylist()]
        assert sorted(got) == sorted(want)


def test_the_table(spark):
    df = table(spark, "/root/testdata/sf0.01", "documents")
    got = sorted((tuple(r) for r in repeats.without_repeats(df).collect()), key=repr)
    assert got == brute_force([tuple(r) for r in df.select("doc_id", "text").collect()], 50)
    assert sum(r[2] for r in got) > 0
