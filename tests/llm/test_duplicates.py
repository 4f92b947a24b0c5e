"""SimHash near-duplicates, components, and the pipeline against brute force."""

import random

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from caregauge.llm import components, packing, simhash
from caregauge.llm.common import table
from caregauge.sources.scratch import stored

SF = "/root/testdata/sf0.01"


def plain_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps: dict) -> dict:
    keys = sorted(set(fps.values()))
    x = np.array(keys, np.uint64)
    root = list(range(len(keys)))

    def find(k):
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    for k in range(len(keys)):
        for j in np.flatnonzero(np.bitwise_count(x[k + 1 :] ^ x[k]) <= 3):
            root[find(k)] = find(k + 1 + int(j))
    of = {fp: find(k) for k, fp in enumerate(keys)}
    least: dict = {}
    for doc, fp in fps.items():
        least[of[fp]] = min(least.get(of[fp], doc), doc)
    return {doc: least[of[fp]] for doc, fp in fps.items()}


TEXTS = [None, "", "one", "One two", "a b c", "A  B\tC", "A B c", "É É é", "x " * 3000, "\n", "a b c d", "ÀB ab"]


def test_fingerprints_of_odd_texts():
    rng = random.Random(1)
    texts = TEXTS + [" ".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 700))) for _ in range(30)]
    assert [simhash.fingerprint(t) for t in texts] == [plain_fingerprint(t) for t in texts]


def test_near_duplicates_of_the_table(spark):
    docs = table(spark, SF, "documents")
    fps = {r["doc_id"]: plain_fingerprint(r["text"]) for r in docs.collect()}
    want = plain_components(fps)
    got = simhash.near_duplicates(docs).collect()
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in got} == {k: (f"{fps[k]:016x}", want[k]) for k in fps}


def test_links_of_chosen_fingerprints(spark, monkeypatch):
    """Dense neighbourhoods, chains at the limit, all four corners of the grid, cells over several tasks."""
    monkeypatch.setattr(simhash, "CELL_BLOCK", 16)
    rng = random.Random(3)
    fps = {0, (1 << 64) - 1, 7, 8, 15, 1 << 63, (1 << 63) | 1}
    for _ in range(6):
        centre = rng.getrandbits(64)
        for _ in range(120):
            fps.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))))
    chain = rng.getrandbits(64)
    for k in range(20):
        chain ^= sum(1 << (3 * k + j) for j in range(3))
        fps.add(chain)
    fps |= {rng.getrandbits(64) for _ in range(300)}
    fps = sorted(fps)
    nodes = spark.createDataFrame([(int(np.uint64(x).view(np.int64)),) for x in fps], "fp long")
    pairs = [(r["a"] % 2**64, r["b"] % 2**64) for r in simhash.similar_pairs(nodes).collect()]
    assert all(bin(a ^ b).count("1") <= 3 for a, b in pairs)
    roots = {r["node"] % 2**64: r["root"] % 2**64 for r in components.components(simhash.similar_pairs(nodes)).collect()}
    got: dict = {}
    for x in fps:
        got.setdefault(roots.get(x, x), set()).add(x)
    want: dict = {}
    for x, c in plain_components({x: x for x in fps}).items():
        want.setdefault(c, set()).add(x)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_a_group_of_near_copies_gives_few_links(spark):
    """Each of a thousand fingerprints is within 3 bits of nearly all others; links stay near their number."""
    base = 0x0123456789ABCDEF
    fps = {base ^ (1 << a) ^ (1 << b) for a in range(64) for b in range(a)} | {base}
    nodes = spark.createDataFrame([(int(np.uint64(x).view(np.int64)),) for x in fps], "fp long")
    assert simhash.similar_pairs(nodes).count() < 40 * len(fps)


def test_what_spark_sizes_too_low_is_not_broadcast(spark):
    """The cells are many times the rows of the file they are made of; fingerprints of copies are more rows than their file tells."""

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    docs = spark.createDataFrame([(k, f"text {k % 50} of {k % 50 * 7919} words") for k in range(200)], "doc_id long, text string")
    nodes = stored(simhash.fingerprints(docs).select("fp").distinct(), "nodes")
    pairs, found = plan(simhash.similar_pairs(nodes)), plan(simhash.near_duplicates(docs))
    assert "Generate explode" in pairs and "Broadcast" not in pairs
    last_join = next(line for line in found.splitlines() if "Join" in line)
    assert "SortMergeJoin [fp" in last_join, last_join


def test_odd_rows_of_documents(spark):
    rows = [(k, t, "fp", 1) for k, t in enumerate(TEXTS)] + [(4, "a b c", "fp", 1), (None, "a b c", "fp", 1), (99, "  ", "fp", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string, root long")
    got = {(r["doc_id"], r["component_id"]) for r in simhash.near_duplicates(docs).collect()}
    assert {(0, 0), (1, 0), (9, 0), (99, 0), (4, 4), (5, 4), (None, 4)} <= got
    assert simhash.near_duplicates(docs.limit(0)).collect() == []


def test_components_of_long_paths(spark):
    edges = [(k, k + 1) for k in range(300)] + [(1000, 1001), (1001, 1000), (2000, 2000)] + [(5000, 5000 + k) for k in range(1, 400)]
    random.Random(1).shuffle(edges)
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(1, 301)} | {1001: 1000} | {5000 + k: 5000 for k in range(1, 400)}


def test_stages_keep_the_columns_and_decide(spark):
    docs = table(spark, SF, "documents")
    labels = {r["doc_id"]: r["quality"] for r in table(spark, SF, "labels").collect()}
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = spark.createDataFrame(stage(spark, docs, SF).collect(), docs.schema)
        assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"] and 0 < kept.count() <= before, name
        ids = {r["doc_id"] for r in kept.select("doc_id").collect()}
        if name == "quality classifier":
            assert sum(i in ids for i, y in labels.items() if y == 0) <= 0.05 * len(labels)
            assert sum(i in ids for i, y in labels.items() if y) >= 0.97 * sum(labels.values())
        if name == "language identification":
            assert len(ids) >= 0.99 * before
        if name == "near-duplicates":
            rows = {r["doc_id"]: r["text"] for r in docs.collect()}
            assert ids == set(plain_components({i: plain_fingerprint(t) for i, t in rows.items()}).values())
        docs, before = kept, len(ids)


def test_stages_with_odd_rows(spark, tmp_path):
    columns = "doc_id long, text string, lang string, source string, n_chars long, _row long, score double"
    good = "Some words of a good text, which goes on for a while and ends here."
    rows = [(1, None), (2, ""), (3, good), (3, good), (4, good + " More."), (None, good), (5, "日本語の文章です。" * 20), (6, "123 !!!")]
    docs = spark.createDataFrame([(i, t, "en" if i in (3, 4) else None, "s", 1, 0, 0.0) for i, t in rows], columns)
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    none = corpus_pipeline.good_quality(spark, docs, str(tmp_path))
    assert none.columns == list(corpus_pipeline.COLUMNS)  # nothing learned: every score is 0.5
    known = corpus_pipeline.known_language(spark, docs, str(tmp_path)).collect()
    assert sorted(r["doc_id"] or 0 for r in known) == [0, 3, 3, 4]
    unique = corpus_pipeline.near_unique(spark, docs, str(tmp_path)).collect()
    assert sorted(r["doc_id"] or 0 for r in unique if r["text"] == good) == [3]
    assert sum(not (r["text"] or "").strip() for r in unique) == 1
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), str(tmp_path)).collect() == []


def test_near_unique_when_files_are_split_anew(spark, tmp_path, monkeypatch):
    """The table's files go to one task when fingerprints are made, and to a task each afterwards."""
    columns = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(k // 2, f"text {k // 2} of pair {k // 2 * 7919} stands twice", "en", "s", 1) for k in range(40)]
    spark.createDataFrame(rows, columns).repartition(8).write.parquet(f"{tmp_path}/docs.parquet")
    splits = {"spark.sql.files.maxPartitionBytes": "1", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in splits}
    plain = simhash.near_duplicates

    def then_split(*given):
        found = plain(*given)
        for k, v in splits.items():
            spark.conf.set(k, v)
        return found

    monkeypatch.setattr(simhash, "near_duplicates", then_split)
    spark.conf.set("spark.sql.files.minPartitionNum", "1")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got = corpus_pipeline.near_unique(spark, spark.read.parquet(f"{tmp_path}/docs.parquet"), SF).collect()
    finally:
        spark.conf.unset("spark.sql.files.minPartitionNum")
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted(r["doc_id"] for r in got) == list(range(20))


def test_pipeline_packs_what_the_stages_keep(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, "/root/testdata/sf0.001").collect(), docs.schema)
    got = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    assert {r["doc_id"] for r in got} == {r["doc_id"] for r in docs.collect()}
    total: dict = {}
    for r in got:
        total[r["doc_id"]] = total.get(r["doc_id"], 0) + r["length"]
        assert r["length"] <= packing.CAPACITY and len(r["ids"]) == 4 * r["length"]
    assert all(total[r["doc_id"]] == r["doc_tokens"] for r in got)


@pytest.mark.parametrize("name", ["op3_chat_formatting"])
def test_oracles(spark, name):
    import duckdb

    from caregauge.llm import queries

    with duckdb.connect() as db:
        db.sql(f"CREATE VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
        want = db.sql(queries.ORACLES[name])
        columns = want.columns
        rows = sorted(want.fetchall())
    assert sorted(tuple(r[c] for c in columns) for r in queries.QUERIES[name](spark, SF).collect()) == rows
