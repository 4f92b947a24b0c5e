"""Value-set tagging."""

import pytest
from pyspark.sql import functions as F

from caregauge.operators.valuesets import (
    ClaimNeed,
    CodeBook,
    CodeRule,
    SharedTags,
    claim_value_sets,
    codes_unique_to,
    frequent_codes,
    normalise_value_sets,
    require,
    require_code_systems,
    require_one_code_system,
    require_value_sets,
    split_value_sets,
    unaccounted_code_systems,
    unpivot_codes,
)
from tests.helpers import rows, table

REFERENCE = """
Visit V1 CPT
Visit R1 UBREV
Diabetes E11.9 ICD10CM
Diabetes 250.0 ICD9CM
Kidney 0TY ICD10PCS
O'Brien V2 HCPCS
"""
CLAIMS = """
both V1 X 10 E119 - - c1
visit_only V1 X 10 I10 - - c2
wrong_version - R1 09 E119 - - c3
second_position - - 10 I10 E119 - c4
icd9 - - 09 2500 - - c5
unpadded - - 9 2500 - - c6
procedure - - 10 - - 0TY c7
quoted V2 - 10 - - - c8
nothing Z Z 10 Z Z Z c9
"""


@pytest.fixture
def reference(spark):
    return table(spark, "value_set_name string, code string, code_system string", REFERENCE)


@pytest.fixture
def claims(spark):
    return table(
        spark,
        "member_id string, hcpcs string, revcode string, icdversion string, icddiag1 string, "
        "icddiag2 string, icdproc1 string, claimid string",
        CLAIMS,
    )


def members(book, claims, reference, tag):
    tagged = book.tag(claims, reference, ["member_id"]).where(book.has(tag))
    return {row["member_id"] for row in tagged.collect()}


def test_channels_and_versions(claims, reference):
    rules = [
        CodeRule("visit", "hcpcs", ("Visit",), ("CPT",)),
        CodeRule("visit", "revcode", ("Visit",), ("UBREV",)),
        CodeRule("diabetes", "icddiag", ("Diabetes",)),
        CodeRule("principal", "icddiag", ("Diabetes",), principal=True),
        CodeRule("unversioned", "icddiag", ("Diabetes",), versioned=False),
        CodeRule("kidney", "icdproc", ("Kidney",)),
        CodeRule("brien", "hcpcs", ("O'Brien",)),
        CodeRule("pattern", "icddiag", pattern=r"^Dia\w+s$"),
    ]
    book = CodeBook(*rules)
    found = {tag: members(book, claims, reference, tag) for tag in dict.fromkeys(r.tag for r in rules)}
    assert found == {
        "visit": {"both", "visit_only", "wrong_version"},
        "diabetes": {"both", "second_position", "unpadded"},
        "principal": {"both", "unpadded"},
        "unversioned": {
            "both", "wrong_version", "second_position", "icd9", "unpadded",
        },
        "kidney": {"procedure"},
        "brien": {"quoted"},
        "pattern": {"both", "second_position", "unpadded"},
    }
    padded = CodeBook(*rules, version="padded")
    assert members(padded, claims, reference, "diabetes") == {"both", "second_position", "icd9"}


def test_conditions_across_columns_of_one_row(claims, reference):
    book = CodeBook(
        CodeRule("visit", "hcpcs", ("Visit",)), CodeRule("diabetes", "icddiag", ("Diabetes",))
    )
    tagged = book.tag(claims, reference, ["member_id"])
    both = tagged.where(book.has("visit") & book.has("diabetes"))
    assert {row["member_id"] for row in both.collect()} == {"both"}


def test_untagged_rows_are_dropped_unless_wanted(claims, reference):
    book = CodeBook(CodeRule("visit", "hcpcs", ("Visit",)))
    assert book.tag(claims, reference, ["member_id"]).count() == 2
    assert book.tag(claims, reference, ["member_id"], also=claims["member_id"] == "nothing").count() == 3


def test_claim_value_sets(claims, reference):
    full = claims.selectExpr("*", "CAST(NULL AS STRING) AS billtype")
    found = claim_value_sets(full, reference, ["Visit", "Diabetes", "Kidney"])
    assert rows(found, "claimid", "value_set_names") == sorted(
        [
            ("c1", ["Diabetes", "Visit"]),
            ("c2", ["Visit"]),
            ("c3", ["Visit"]),
            ("c4", ["Diabetes"]),
            ("c5", ["Diabetes"]),
            ("c7", ["Kidney"]),
        ],
        key=repr,
    )


def test_normalise_and_split(reference):
    normal = rows(normalise_value_sets(reference), "code", "icdversion")
    assert ("E119", "10") in normal and ("2500", "9") in normal and ("V1", None) in normal
    split = split_value_sets(reference)
    assert rows(split["icddiag"], "icddiag", "icdversion") == [("2500", "09"), ("E119", "10")]
    assert rows(split["hcpcs"], "hcpcs") == [("V1",), ("V2",)]


def test_requirements(reference):
    require_value_sets(reference, ["Visit", "Kidney"])
    with pytest.raises(ValueError, match="Missing"):
        require_value_sets(reference, ["Visit", "Missing"])
    require_one_code_system(reference, "Kidney")
    with pytest.raises(ValueError, match="Diabetes"):
        require_one_code_system(reference, "Diabetes")
    accounted = {"Visit": ("CPT",), "Kidney": ("ICD10PCS",)}
    assert rows(unaccounted_code_systems(reference, accounted), "code_system") == [("UBREV",)]
    with pytest.raises(ValueError, match="UBREV"):
        require_code_systems(reference, accounted)


def test_requirements_together(reference):
    require(reference, ["Visit"], ["Kidney"], {"Visit": ("CPT", "UBREV"), "Kidney": ("ICD10PCS",)})
    with pytest.raises(ValueError, match="Kidney"):
        require(reference, ["Visit"], accounted={"Kidney": ("CPT",)})


def test_many_value_sets_at_once(spark):
    """More sets than one word of tags holds; every claim carries the code of some."""
    names = [f"Set {k:03}" for k in range(130)]
    reference = spark.createDataFrame([(n, f"V{k}", "CPT") for k, n in enumerate(names)], "value_set_name string, code string, code_system string")
    claims = spark.createDataFrame(
        [(f"m{k % 7}", f"V{k}", f"c{k % 13}") for k in range(140)], "member_id string, hcpcs string, claimid string"
    )
    claims = claims.selectExpr("*", "CAST(NULL AS STRING) AS revcode", "CAST(NULL AS STRING) AS billtype", "'10' AS icdversion", "CAST(NULL AS STRING) AS icddiag1", "CAST(NULL AS STRING) AS icdproc1")
    found = {(r[0], r[1]): r[2] for r in claim_value_sets(claims, reference, names).collect()}
    expected = {}
    for k in range(130):
        expected.setdefault((f"m{k % 7}", f"c{k % 13}"), []).append(names[k])
    assert {key: value for key, value in found.items() if value} == expected


def test_shuffled_tagging_spreads_a_hot_code(spark):
    """Without broadcast no partition gets a share of the rows that match nothing."""
    claims = spark.range(20_000).selectExpr(
        "CAST(id AS STRING) AS member_id", "CAST(NULL AS STRING) AS hcpcs", "'10' AS icdversion",
        "CAST(NULL AS STRING) AS icddiag1", "IF(id % 3 = 0, 'E119', NULL) AS icddiag2",
    )
    reference = spark.createDataFrame([("Diabetes", "E11.9", "ICD10CM")], "value_set_name string, code string, code_system string")
    book = CodeBook(CodeRule("diabetes", "icddiag", ("Diabetes",)), version="digits")
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        tagged = book.tag(claims, reference, ["member_id"], also=F.lit(True))
        share = tagged.where("icd_ordinal = 0").groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
        assert tagged.where(book.has("diabetes")).count() == 6667
        assert share < 2 * 20_000 / int(spark.conf.get("spark.sql.shuffle.partitions"))
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_unpivot_keeps_the_position(claims):
    found = unpivot_codes(claims, "icddiag", ["member_id"]).where("member_id = 'second_position'")
    assert rows(found, "ordinal", "code") == [(1, "I10"), (2, "E119")]


def test_codes_unique_to(spark):
    sets = table(
        spark,
        "value_set_name string, code string",
        """
        A only_a
        A shared
        B shared
        B only_b
        A twice
        A twice
        """,
    )
    assert rows(codes_unique_to(sets, "A", "B"), "code") == [("only_a",)]


def largest_share(df) -> float:
    """Rows of the fullest partition over those of an even one."""
    sizes = df.groupBy(F.spark_partition_id()).count().toPandas()["count"]
    return sizes.max() / (sizes.sum() / 8)


@pytest.fixture
def shuffled(spark):
    """Joins by exchange, whose partitions stay as they are."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in zip(names, ("-1", "false", "-1"), strict=True):
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@pytest.mark.parametrize("icd", [False, True])
def test_null_and_frequent_codes_are_spread(spark, reference, shuffled, icd):
    """95 % of the rows without a code; then one code in half of the rows."""
    rules = [CodeRule("other", "revcode", ("Visit",)), CodeRule("visit", "hcpcs", ("Visit",))]  # the last join shows
    rules += [CodeRule("diabetes", "icddiag", ("Diabetes",))] * icd
    book = CodeBook(*rules)
    base = ["cast(id as string) member_id", "'10' icdversion", "cast(null as string) revcode", "cast(null as string) icddiag1"]
    ids = spark.range(0, 20_000, 1, 3)
    nulls = ids.selectExpr(*base, "CASE WHEN id % 20 = 0 THEN concat('X', id % 400) END AS hcpcs")
    tagged = book.tag(nulls, reference, ["member_id"], also=F.lit(True))
    assert tagged.count() == 20_000 and largest_share(tagged) < 2
    hot = ids.selectExpr(*base, "CASE WHEN id % 2 = 0 THEN 'V1' ELSE concat('X', id) END AS hcpcs")
    if icd:
        hot = hot.withColumn("icddiag1", F.expr("CASE WHEN hcpcs = 'V1' THEN 'E119' ELSE concat('Y', hcpcs) END"))
    frequent = frequent_codes(hot, ["hcpcs", "icddiag"])
    assert frequent == ["E119"] * icd + ["V1"]
    for codes in (frequent, ()):
        tagged = book.tag(hot, reference, ["member_id"], also=F.lit(True), frequent=codes)
        assert tagged.where(book.has("visit")).select("member_id").distinct().count() == 10_000
        assert tagged.where("tags != 0").count() == 10_000 * (1 + icd)
        assert (largest_share(tagged) < 2) == bool(codes)


def test_more_tags_than_a_word_holds(spark, claims):
    """200 tags: the first, one at the edge of each word, the last."""
    many = spark.createDataFrame([(f"S{i}", "V1" if i % 50 == 12 else f"Z{i}", "CPT") for i in range(200)] + [("D", "E11.9", "ICD10CM")], "value_set_name string, code string, code_system string")
    book = CodeBook(*[CodeRule(f"S{i}", "hcpcs", (f"S{i}",)) for i in range(200)], CodeRule("D", "icddiag", ("D",), principal=True))
    assert len(book.words) == 4
    for i in (0, 12, 61, 62, 63, 112, 123, 124, 162, 199):
        assert members(book, claims, many, f"S{i}") == ({"both", "visit_only"} if i % 50 == 12 else set())
    assert members(book, claims, many, "D") == {"both"}


def test_shared_pass_equals_own_passes(spark, claims, reference):
    """Books of several styles, code tables, conditions and widths in one pass."""
    claims = claims.withColumn("day", F.lit(3)).withColumn("unused", F.lit(0))
    other = reference.withColumn("value_set_name", F.concat(F.lit("my "), "value_set_name"))
    wide = [CodeRule(f"w{i}", "hcpcs", ("Visit",) if i == 70 else ("None",)) for i in range(80)]
    needs = [
        ClaimNeed(CodeBook(CodeRule("visit", "hcpcs", ("Visit",)), CodeRule("dm", "icddiag", ("Diabetes",), principal=True)), reference, ("member_id",)),
        ClaimNeed(CodeBook(CodeRule("dm", "icddiag", ("Diabetes",)), version="digits"), reference, ("member_id", "day"), F.col("day") > 2),
        ClaimNeed(CodeBook(CodeRule("dm", "icddiag", ("Diabetes",), versioned=False), version="padded"), reference, ("claimid", "member_id"), F.col("claimid") != "c1"),
        ClaimNeed(CodeBook(CodeRule("kidney", "icdproc", ("my Kidney",)), CodeRule("x", "revcode", ("my Visit",))), other, ("member_id",), also=F.col("icd_ordinal") == 0),
        ClaimNeed(CodeBook(*wide, CodeRule("dm", "icddiag", ("Diabetes",))), reference, ("member_id",), F.col("claimid").isin("c1", "c2", "c3")),
        ClaimNeed(CodeBook(CodeRule("none", "hcpcs", ("None",))), reference, ("member_id",), F.col("day") > 5),
    ]
    needs = [ClaimNeed(n.book, n.codes, (*n.columns, "claimid", "day"), n.rows, n.also) if n.rows is not None else n for n in needs]
    needs = [ClaimNeed(n.book, n.codes, tuple(dict.fromkeys(n.columns)), n.rows, n.also) for n in needs]
    shared = SharedTags(claims, needs).stored()
    for need in needs:
        # an own pass keeps no row of an ICD code that only another book knows
        wanted = [*need.columns, *need.book.words]
        assert set(rows(shared.rows(need), *wanted)) == set(rows(need.tag(claims), *wanted))
    assert rows(shared.rows(needs[3]), "member_id") and not rows(shared.rows(needs[5]), "member_id")


def test_shared_rows_hold_only_what_their_needs_read(claims, reference):
    """A column that one need reads is empty, and its bits are none, where that need doesn't want the row."""
    visit = ClaimNeed(CodeBook(CodeRule("visit", "hcpcs", ("Visit",))), reference, ("member_id", "claimid"), F.col("claimid") == "c1")
    dm = ClaimNeed(CodeBook(CodeRule("dm", "icddiag", ("Diabetes",))), reference, ("member_id",))
    shared = SharedTags(claims, [visit, dm]).stored()
    assert set(rows(shared._rows, "claimid")) == {("c1",), (None,)}
    assert shared._rows.where("claimid IS NULL AND _shared_0 & 1 != 0").isEmpty()
    for need in (visit, dm):
        wanted = [*need.columns, *need.book.words]
        assert rows(shared.rows(need), *wanted)
        assert set(rows(shared.rows(need), *wanted)) == set(rows(need.tag(claims), *wanted))
