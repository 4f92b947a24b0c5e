"""Packing and SentencePiece: exact ids, exact covers, plans against brute force."""

import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from caregauge.llm import packing, pieces

BPE, MODEL = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
rng = random.Random(7)
TEXTS = [
    None, "", " ", "  a  b ", "a\n b\n\n c", "don't we'll", "▁x▁▁y", "<s>x<0x41></s> <|endoftext|>", "你好世界 こんにちは", "😀😀 a\0b\n\n\tfoo   bar",
    "a" * 5000, "x y " * 4000, "https://example.com/a/b?c=d&e=f#g " * 30, "été là ½ Ⅳ ǅ", "THE!! END!!",
    *["".join(rng.choice("abcdetinorsh ▁  AÉß\n你1.'") for _ in range(rng.randint(1, 90))) for _ in range(400)],
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, t, "x", 0) for k, t in enumerate(TEXTS)] + [(3, TEXTS[3], "x", 0), (None, "no id", "x", 0)]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string, start long")


def test_encoder_equals_the_library():
    encoder, library = packing.Encoder(BPE), Tokenizer.from_file(BPE)
    library.encode_special_tokens = True
    for text in filter(None, TEXTS):
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.ids(text), encoder.dtype).tolist() == want


def check_packed(pieces_: list, docs_: list, capacity: int) -> None:
    library = Tokenizer.from_file(BPE)
    library.encode_special_tokens = True
    want = sorted((k if k is not None else -1, library.encode(t or "", add_special_tokens=False).ids + [1]) for k, t in docs_)
    fill: dict[int, list] = {}
    got: dict[int, list] = {}
    for r in pieces_:
        fill.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert len(ids) == r["length"] > 0
        got.setdefault(r["doc_id"] if r["doc_id"] is not None else -1, []).append((r["start"], ids, r["doc_tokens"]))
    for parts in fill.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity and (at == capacity or at & (at - 1) == 0)  # nothing is padded
    for key, group in itertools.groupby(want, key=lambda x: x[0]):
        group = [ids for _, ids in group]
        once = [x for x in sorted(got[key])]
        assert sorted(t for ids in group for t in ids) == sorted(t for _, ids, _ in once for t in ids)
        if len(group) == 1:
            assert [t for _, ids, _ in once for t in ids] == group[0] and {n for *_, n in once} == {len(group[0])}


@pytest.mark.parametrize("capacity", [2048, 16, 7])
def test_every_id_lies_in_one_piece(docs, capacity):
    got = packing.packed(docs, BPE, capacity).collect()
    check_packed(got, [(r["doc_id"], r["text"]) for r in docs.collect()], capacity)


def test_no_ids_are_shuffled(docs):
    """The offsets come to the ids: no exchange or sort lies above the scan that reads ids."""
    lines = packing.packed(docs, BPE)._jdf.queryExecution().executedPlan().toString().splitlines()
    depths = [len(line) - len(line.lstrip(" :+-*(0123456789)")) for line in lines]
    (at,) = [k for k, line in enumerate(lines) if "FileScan parquet" in line and "ids#" in line]
    assert "SelectedBucketsCount" in lines[at]
    depth, above = depths[at], []
    for k in range(at - 1, -1, -1):
        if depths[k] < depth:
            depth = depths[k]
            above.append(lines[k].lstrip(" :+-*(0123456789)"))
    assert any(line.startswith("ShuffledHashJoin") for line in above)
    assert not any(line.startswith(("Exchange", "Sort")) for line in above)


def test_packing_of_nothing(docs):
    assert packing.packed(docs.limit(0), BPE).collect() == []


def test_best_fill_equals_enumeration():
    for _ in range(300):
        counts = {rng.randint(1, 30): rng.randint(1, 4) for _ in range(rng.randint(0, 5))}
        room = rng.randint(0, 60)
        chosen = packing.best_fill(counts, room)
        assert all(v <= counts[k] for k, v in chosen.items())
        sums = {sum(k * n for k, n in zip(counts, ns, strict=True)) for ns in itertools.product(*[range(v + 1) for v in counts.values()])}
        assert sum(k * v for k, v in chosen.items()) == max(s for s in sums if s <= room)


@pytest.mark.parametrize("histogram", [{}, {5: 1}, {2047: 3}, {1500: 100_000}, {1: 10}, {1024: 3, 512: 1}, {700: 7, 648: 9, 30: 2}])
def test_plan_places_every_remainder(histogram):
    plan = packing.plan_windows(histogram, 2048)
    fill: dict[int, int] = {}
    for length, n in histogram.items():
        for rank in range(0, n, max(1, n // 500)) if n > 500 else range(n):
            parts = packing.places(plan, 2048, length, rank)
            assert sum(p[1] for p in parts) == length
            for _, size, sequence, offset in parts:
                assert 0 <= offset and offset + size <= 2048 and sequence < plan["sequences"]
                fill[sequence] = fill.get(sequence, 0) + size
    if sum(histogram.values()) <= 500:
        assert all(v == 2048 or v & (v - 1) == 0 for v in fill.values())


def test_segmenter_equals_the_library():
    segmenter, library = pieces.Segmenter(MODEL), sentencepiece.SentencePieceProcessor(model_file=MODEL)
    got = segmenter.encode(TEXTS)
    for text, ids in zip(TEXTS, got, strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text or "")
        assert segmenter.decode(ids) == (text or "").replace(pieces.BLANK, " ")


def test_long_single_words_equal_the_library():
    """Words that are cut, words that can't be, words of the same length in one batch, unknown characters."""
    segmenter, library = pieces.Segmenter(MODEL), sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = ["e" * 3000, "the" * 900, "x" * 47 + "\u4e00" * 40, "ab\U0001f600" * 200, "-" * 49, "tion" * 12, "tion" * 13, "\u0416\u0378" * 100]
    texts += [f"{w} {w}{w} again" for w in texts]
    for text, ids in zip(texts, segmenter.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text)


def test_memo_that_overflows(monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED", 5)
    monkeypatch.setattr(pieces, "TEXT_CHARS", 40)
    segmenter, library = pieces.Segmenter(MODEL), sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = [f"word{k} and word{k % 3} \U0001f600{k}" for k in range(30)]
    for text, ids in zip(texts, segmenter.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text)


def test_unigram_viterbi_equals_the_library(tmp_path):
    """The same pieces and scores read as a unigram model."""
    proto = sentencepiece.SentencePieceProcessor(model_file=MODEL).serialized_model_proto()
    at = proto.rindex(b"tok_v0\x18\x02") + 7
    path = tmp_path / "unigram.model"
    path.write_bytes(proto[:at] + b"\x01" + proto[at + 1 :])
    segmenter, library = pieces.Segmenter(str(path)), sentencepiece.SentencePieceProcessor(model_file=str(path))
    assert not segmenter.merging
    total = lambda ids: sum(library.get_score(int(k)) for k in ids if not library.is_byte(int(k)))
    for text in filter(None, TEXTS[:120]):
        got, want = np.frombuffer(segmenter.encode([text])[0], "<u4"), library.encode(text)
        assert total(got) == pytest.approx(total(want)) and segmenter.decode(got.tobytes()) == text.replace(pieces.BLANK, " ")


def test_encoding_rows(docs):
    ids = pieces.encoded(docs, MODEL, ("doc_id", "start"))
    back = pieces.decoded(ids, MODEL).collect()
    want = sorted(((r["text"] or "").replace(pieces.BLANK, " ") for r in docs.collect()))
    assert sorted(r["text"] for r in back) == want
    assert pieces.encoded(docs.limit(0), MODEL).collect() == []


def test_digests_of_the_packing_query(spark):
    from caregauge.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    library = Tokenizer.from_file(BPE)
    got = {(r["doc_id"], r["start"]): r for r in QUERIES["op1_packing"](spark, sf).collect()}
    for row in spark.read.parquet(f"{sf}/documents.parquet").limit(40).collect():
        ids = np.array(library.encode(row["text"], add_special_tokens=False).ids + [1], "<u4")
        at = 0
        while at < len(ids):
            r = got[row["doc_id"], at]
            assert r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes()) and r["doc_tokens"] == len(ids)
            at += r["length"]


def test_workers_hold_one_model_and_small_batches(spark):
    """Encoding and decoding workers stand side by side on every core of an executor."""
    assert pieces._model(MODEL) is pieces._model(MODEL)
    rows = spark.createDataFrame([(k, "a text") for k in range(700)], "doc_id long, text string").coalesce(1)
    ids = pieces.encoded(rows, MODEL)
    sizes = ids.mapInArrow(lambda parts: (p.slice(0, 1).select(["doc_id"]).set_column(0, "doc_id", pa.array([p.num_rows])) for p in parts), "doc_id long")
    assert max(r[0] for r in sizes.collect()) <= 600
    assert pieces.decoded(ids, MODEL).where("text = 'a text'").count() == 700


def test_sentencepiece_query_has_one_worker_a_task(docs, spark, tmp_path):
    """Encoding and decoding stand in jobs of their own, and every row comes back with its text."""
    from caregauge.llm.queries import QUERIES

    docs.write.parquet(f"{tmp_path}/documents.parquet")
    found = QUERIES["op2_sentencepiece"](spark, str(tmp_path))
    assert found._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    want = []
    for r in docs.collect():
        ids = np.array(library.encode(r["text"] or ""), "<u4")
        want.append((str(r["doc_id"]), len(ids), zlib.crc32(ids.tobytes()), len(r["text"] or ""), True))
    assert sorted((str(r["doc_id"]), *r[1:]) for r in found.collect()) == sorted(want)
