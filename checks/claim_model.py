"""Claim-model tables derived from the retail tables by arithmetic on their keys.

Customers become members, line items become claims and pharmacy fills, orders become
discharges. The same derivation is written once more in SQL for the oracle
(``checks/oracle_views.py``).
"""

from __future__ import annotations

import datetime
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caregauge.sources.catalogue import local_table
from checks.claim_rows import ndc_rows, reference_rows

PY = datetime.date(1998, 1, 1)
LATEST_PAID = datetime.date(1998, 9, 30)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _birth(key: Column) -> Column:
    return F.date_add(F.lit(datetime.date(1930, 1, 1)), (key * 7919 % 25000).cast("int"))


def _gender(key: Column) -> Column:
    return F.when(key % 2 == 0, "F").otherwise("M")


def member(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return read(spark, sf_dir, "customer").select(
        key.cast("string").alias("member_id"),
        _birth(key).alias("dob"),
        _gender(key).alias("gender"),
    )


def member_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, year = F.col("c_custkey"), F.col("year")
    kind = (key % 10).cast("int")
    first = F.make_date(year, F.lit(1), F.lit(1))
    last = F.make_date(year, F.lit(12), F.lit(31))

    def on(month: int, day: int) -> Column:
        return F.make_date(year, F.lit(month), F.lit(day))

    def back(day: Column, days: Column) -> Column:
        return F.date_sub(day, days.cast("int"))

    def span(start: Column, end: Column) -> Column:
        return F.struct(start.alias("date_start"), end.alias("date_end"))

    spans = (
        F.when(
            kind == 4,
            F.array(span(first, back(on(6, 30), 1 + key % 80)), span(on(7, 1), last)),
        )
        .when(kind == 5, F.array(span(F.date_add(first, (key % 60).cast("int")), last)))
        .when(kind == 7, F.array(span(first, on(8, 31)), span(on(6, 1), last)))
        .when(kind == 9, F.array(span(first, back(on(11, 30), key % 50))))
        .otherwise(F.array(span(first, last)))
    )
    return (
        read(spark, sf_dir, "customer")
        .select("c_custkey", F.explode(F.sequence(F.lit(1996), F.lit(1999))).alias("year"))
        .select("c_custkey", "year", F.inline(spans))
        .select(
            key.cast("string").alias("member_id"),
            "date_start",
            "date_end",
            F.when((kind == 6) & (year == 1997), "N").otherwise("Y").alias("cover_medical"),
            F.when((kind == 8) & (year == 1998), "N").otherwise("Y").alias("cover_rx"),
        )
    )


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    lines = read(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey AS o_orderkey",
        "l_partkey AS p",
        "l_suppkey AS s",
        "l_linenumber AS n",
        "int(l_quantity) AS q",
        "date(l_shipdate) AS fromdate",
    )
    return lines.join(orders, "o_orderkey").selectExpr(
        "o_custkey AS k",
        "string(o_custkey) AS member_id",
        "concat_ws('-', o_orderkey, floor(unix_date(fromdate) / 15)) AS claimid",
        "p", "s", "n", "q", "fromdate",
    )


def claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _lines(spark, sf_dir)
    return lines.select(
        "member_id",
        "claimid",
        "fromdate",
        _gender(F.col("k")).alias("gender"),
        _birth(F.col("k")).alias("dob"),
        *[
            F.expr(f"{text} AS {name}")
            for name, text in {
                "todate": "date_add(fromdate, int(s % 3))",
                "admitdate": "fromdate",
                "dischdate": "date_add(fromdate, q % 7)",
                "hcpcs": "concat('H', p % 97)",
                "revcode": "concat('R', (p * 7 + s) % 31)",
                "billtype": "concat('B', p % 11)",
                "pos": "concat('P', s % 13)",
                "specialty": "string((p + s) % 45)",
                "modifier": "string(s % 60)",
                "modifier2": "string(p % 60)",
                "dischargestatus": "string((p * 3 + s) % 25)",
                "icdversion": "CASE n WHEN 7 THEN '09' WHEN 6 THEN '9' ELSE '10' END",
                "icddiag1": "concat('D', (p * 5 + s) % 89)",
                "icddiag2": "concat('D', (p * 3 + s * 2) % 89)",
                "icddiag3": "CASE WHEN n % 2 = 1 THEN concat('D', (s * 5 + n + p) % 89) END",
                "icdproc1": "concat('Q', (p * 11 + s) % 53)",
                "icdproc2": "CASE WHEN n % 3 = 0 THEN concat('Q', (p + s * 3) % 53) END",
            }.items()
        ],
    )


def rx_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fill from every order line; those of drug N21 stand in the table twice."""
    return (
        _lines(spark, sf_dir)
        .withColumn("copy", F.expr("explode(sequence(1, CASE p % 60 WHEN 21 THEN 2 ELSE 1 END))"))
        .selectExpr(
            "member_id",
            "claimid",
            "fromdate",
            "double(q * (1 + p % 4)) AS dayssupply",
            "concat('N', p % 60) AS ndc",
        )
    )


def followup_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = F.array(*[F.lit(x) for x in ("I11a", "i12", "I13b", "i14a", "O10", "P32")])
    key = F.col("o_orderkey")
    return read(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("member_id"),
        key.cast("string").alias("claimid"),
        F.get(lines, (key % 6).cast("int")).alias("service_line"),
        F.when(F.col("o_orderstatus") == "F", "Y").otherwise("N").alias(
            "pcp_followup_success_yn"
        ),
        F.when(F.col("o_orderstatus") == "P", "N").otherwise("Y").alias(
            "pcp_followup_potential_yn"
        ),
        (key * 7 % 19).cast("int").alias("pcp_followup_days_since"),
    )


def reference(spark: SparkSession) -> DataFrame:
    return local_table(spark, reference_rows(), "value_set_name code code_system")


def reference_awv(spark: SparkSession) -> DataFrame:
    """Medicare wellness codes of the claim model (its procedure codes are H0 … H96)."""
    return local_table(
        spark,
        [("Well-Care-Custom", f"H{n}", "HCPCS") for n in (40, 41)],
        "value_set_name code code_system",
    )


def ndc(spark: SparkSession) -> DataFrame:
    return local_table(
        spark, ndc_rows(), "medication_list ndc_code route description drug_id"
    )


class ClaimTables(Mapping[str, DataFrame]):
    """Every input table of the measures, built when it is asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self._builders = {
            "member": lambda: member(spark, sf_dir),
            "member_time": lambda: member_time(spark, sf_dir),
            "claims": lambda: claims(spark, sf_dir),
            "rx_claims": lambda: rx_claims(spark, sf_dir),
            "followup_claims": lambda: followup_claims(spark, sf_dir),
            "reference": lambda: reference(spark),
            "reference_awv": lambda: reference_awv(spark),
            "ndc": lambda: ndc(spark),
        }
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    def __iter__(self):
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)

    def __contains__(self, name: object) -> bool:
        return name in self._builders


def tables(spark: SparkSession, sf_dir: str) -> ClaimTables:
    return ClaimTables(spark, sf_dir)
