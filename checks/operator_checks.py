"""Checks of single operators, mostly straight on the retail tables."""

from __future__ import annotations

import datetime

from pyspark.sql import Window
from pyspark.sql import functions as F

from caregauge import functions as cf
from caregauge.operators import episodes, intervals, output, supply, valuesets
from caregauge.plans import AAB, CDC, PCR, PCPFollowup
from caregauge.plans.common import fills_of, member_flags, on_list, visit_rules
from caregauge.sources import catalogue, clustered, reference, schemas, tables
from caregauge.sources.scratch import scratch_folder
from checks import claim_model as model
from checks.claim_model import read
from checks.oracle_measures import (
    HCPCS,
    ICD,
    PCS,
    VISITS,
    _around,
    aab_events,
    code,
    diag,
    holes,
    measure_sql,
    pcr_stays,
    proc,
    supply_days,
)
from checks.oracle_views import with_views
from checks.registry import check

MEASURES = measure_sql()


def recursive(sql: str) -> str:
    return sql.replace("WITH ", "WITH RECURSIVE ", 1)


# --------------------------------------------------------------------------
# Retail tables seen as spans, fills and stays. Each has a Spark and an SQL side.


def order_spans(spark, sf_dir):
    """Every order is a span of its customer; some cover nothing."""
    key = F.col("o_orderkey")
    start = F.to_date("o_orderdate")
    return read(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("member_id"),
        start.alias("date_start"),
        F.date_add(start, (key % 90).cast("int")).alias("date_end"),
        F.when(key % 11 == 0, "N").otherwise("Y").alias("cover_medical"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("priority"),
        F.col("o_orderstatus").alias("status"),
    )


ORDER_SPANS = """order_spans AS (SELECT o_custkey AS member_id, CAST(o_orderdate AS DATE) AS date_start,
  CAST(o_orderdate AS DATE) + CAST(o_orderkey % 90 AS INTEGER) AS date_end,
  CASE WHEN o_orderkey % 11 = 0 THEN 'N' ELSE 'Y' END AS cover_medical,
  CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS priority, o_orderstatus AS status FROM orders)"""


def line_fills(spark, sf_dir):
    """Every line item is a fill of its customer; the part type is the drug."""
    parts = read(spark, sf_dir, "part").select("p_partkey", "p_type")
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return (
        read(spark, sf_dir, "lineitem")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.col("o_custkey").alias("member_id"),
            F.col("p_type").alias("drug_id"),
            F.to_date("l_shipdate").alias("fromdate"),
            "l_quantity",
            F.col("l_quantity").alias("dayssupply"),
        )
    )


LINE_FILLS = """line_fills AS (SELECT o_custkey AS member_id, p_type AS drug_id, CAST(l_shipdate AS DATE) AS fromdate,
  CAST(l_quantity AS INTEGER) AS days FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)"""


def order_stays(spark, sf_dir):
    """Every order is a stay of its customer."""
    key = F.col("o_orderkey")
    admit = F.to_date("o_orderdate")
    return read(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("member_id"),
        F.lpad(key.cast("string"), 12, "0").alias("transfer_claimid"),
        admit.alias("admitdate"),
        F.date_add(admit, (key % 5).cast("int")).alias("dischdate"),
        (F.col("o_orderstatus") == "P").alias("planned_flag"),
        F.col("o_orderstatus").alias("status"),
    )


ORDER_STAYS = """order_stays AS (SELECT o_custkey AS member_id, lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS transfer_claimid,
  CAST(o_orderdate AS DATE) AS admitdate, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 5 AS INTEGER) AS dischdate,
  o_orderstatus = 'P' AS planned_flag, o_orderstatus AS status FROM orders)"""


# --------------------------------------------------------------------------
# Sources and sinks


@check(
    "src_schema_csv",
    """SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM customer""",
)
def src_schema_csv(spark, sf_dir):
    folder = scratch_folder(spark, "schema-csv")
    columns = [
        ("c_custkey", "string", "FALSE "),
        ("c_name", "string", "false"),
        ("c_nationkey", "integer", "true"),
        ("c_acctbal", "double", "TRUE"),
    ]
    spark.createDataFrame(columns, "name string, datatype string, nullable string").coalesce(
        1
    ).write.csv(f"{folder}/schema.csv", header=True)
    read(spark, sf_dir, "customer").select(*[name for name, _, _ in columns]).write.csv(
        f"{folder}/data.csv", header=True
    )
    schema = reference.schema_from_csv(spark, f"{folder}/schema.csv")
    loaded = reference.read_reference_csv(spark, f"{folder}/data.csv", schema)
    return loaded.withColumn("c_custkey", F.col("c_custkey").cast("long"))


@check(
    "src_reference_catalogue",
    """SELECT 'part' AS table_name, 'compiled' AS source, count(*) AS n_rows, CAST(sum(p_partkey) AS BIGINT) AS key_sum FROM part
UNION ALL SELECT 'supplier', 'compiled', count(*), CAST(sum(s_suppkey) AS BIGINT) FROM supplier
UNION ALL SELECT 'supplier', 'csv', count(*), CAST(sum(s_suppkey) AS BIGINT) FROM supplier""",
)
def src_reference_catalogue(spark, sf_dir):
    folder = scratch_folder(spark, "references")
    for name, key in (("part", "p_partkey"), ("supplier", "s_suppkey")):
        source = read(spark, sf_dir, name).select(key)
        source.write.csv(f"{folder}/data/{name}.csv", header=True)
        spark.createDataFrame(
            [(key, "long", "false")], "name string, datatype string, nullable string"
        ).coalesce(1).write.csv(f"{folder}/schemas/{name}.csv", header=True)
    imported = reference.import_references(spark, f"{folder}/data", f"{folder}/schemas")
    reference.compile_references(imported, f"{folder}/compiled")

    def summary(name: str, source: str, df):
        return df.agg(
            F.count("*").alias("n_rows"), F.sum(df.columns[0]).alias("key_sum")
        ).select(F.lit(name).alias("table_name"), F.lit(source).alias("source"), "*")

    def load(name: str, compiled: str):
        return reference.load_reference(
            spark, name, f"{folder}/{compiled}", f"{folder}/data", f"{folder}/schemas"
        )

    return tables.stack(
        [
            summary("part", "compiled", load("part", "compiled")),
            summary("supplier", "compiled", load("supplier", "compiled")),
            summary("supplier", "csv", load("supplier", "not-compiled")),
        ]
    )


def _reference_rows(spark, sf_dir, name: str, compiled: bool):
    """A whole table through schema file, CSV and, if asked for, the compiled form."""
    folder = scratch_folder(spark, "reference-rows")
    source = read(spark, sf_dir, name)
    source.write.csv(f"{folder}/data/{name}.csv", header=True, escape='"')
    spark.createDataFrame(
        [(field.name, field.dataType.simpleString().replace("bigint", "long"), "true") for field in source.schema.fields],
        "name string, datatype string, nullable string",
    ).coalesce(1).write.csv(f"{folder}/schemas/{name}.csv", header=True)
    if compiled:
        imported = reference.import_references(spark, f"{folder}/data", f"{folder}/schemas")
        reference.compile_references(imported, f"{folder}/compiled")
    return reference.load_reference(spark, name, f"{folder}/compiled", f"{folder}/data", f"{folder}/schemas")


@check("src_reference_part", "SELECT * FROM part")
def src_reference_part(spark, sf_dir):
    return _reference_rows(spark, sf_dir, "part", compiled=True)


@check("src_reference_supplier", "SELECT * FROM supplier")
def src_reference_supplier(spark, sf_dir):
    return _reference_rows(spark, sf_dir, "supplier", compiled=False)


@check(
    "src_reference_builtin",
    """SELECT 'codes' AS table_name, p_brand AS name, 'P' || p_partkey AS code, p_name AS definition, p_type AS system FROM part
UNION ALL SELECT 'ndc_codes', p_type, 'P' || p_partkey, p_name, CAST(p_size AS VARCHAR) FROM part""",
)
def src_reference_builtin(spark, sf_dir):
    """Parts as a code table and as a drug table: files with prefixed names, built-in schemas, compiled form."""
    folder = scratch_folder(spark, "reference-builtin")
    code = F.concat(F.lit("P"), F.col("p_partkey").cast("string"))
    filled = {
        "codes": {"value_set_name": F.col("p_brand"), "code": code, "definition": F.col("p_name"), "code_system": F.col("p_type")},
        "ndc_codes": {"medication_list": F.col("p_type"), "ndc_code": code, "brand_name": F.col("p_name"), "form": F.col("p_size").cast("string")},
    }
    for name, columns in filled.items():
        read(spark, sf_dir, "part").select(
            *[columns.get(column, F.lit("-")).alias(column) for column, _, _ in schemas.REFERENCE_SCHEMAS[name]]
        ).write.csv(f"{folder}/data/retail_{name}.csv", header=True, escape='"')
    reference.compile_references(reference.import_references(spark, f"{folder}/data"), f"{folder}/compiled")
    return tables.stack(
        [
            reference.load_reference(spark, f"retail_{name}", f"{folder}/compiled", f"{folder}/data").select(
                F.lit(name).alias("table_name"), *[F.col(column).alias(to) for column, to in zip(columns, ("name", "code", "definition", "system"), strict=True)]
            )
            for name, columns in filled.items()
        ]
    )


@check(
    "src_clustered_table",
    """SELECT o_custkey, o_orderkey, count(*) OVER w AS orders_so_far, round(sum(o_totalprice) OVER (PARTITION BY o_custkey), 2) AS spent
FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey)""",
)
def src_clustered_table(spark, sf_dir):
    """Orders in buckets of their customer: both windows start from the scan."""
    folder = scratch_folder(spark, "clustered")
    name = "clustered_" + folder.rsplit("-", 1)[-1]
    orders = clustered.save_clustered(read(spark, sf_dir, "orders"), folder, name, 8, "o_custkey")
    customer = Window.partitionBy("o_custkey")
    return orders.select(
        "o_custkey",
        "o_orderkey",
        F.count("*").over(customer.orderBy("o_orderkey")).alias("orders_so_far"),
        F.round(F.sum("o_totalprice").over(customer), 2).alias("spent"),
    )


@check(
    "combine_results",
    "SELECT * FROM ("
    + " UNION ALL ".join(
        f"SELECT member_id, comp_quality_short, CAST(comp_quality_numerator AS BIGINT) AS comp_quality_numerator, "
        f"CAST(comp_quality_denominator AS BIGINT) AS comp_quality_denominator, comp_quality_date_last, "
        f"comp_quality_date_actionable, comp_quality_comments FROM ({MEASURES[name]})"
        for name in ("measure_cdc", "measure_pcp_7", "measure_pcp_14")
    )
    + ") WHERE comp_quality_denominator <> 0",
)
def combine_results(spark, sf_dir):
    folder = scratch_folder(spark, "results")
    inputs = model.tables(spark, sf_dir)
    results = {
        "diabetes_care": CDC().calc_measure(inputs, model.PY),
        "followup_7": PCPFollowup().calc_measure(inputs, model.PY, cutoff=7),
        "followup_14": PCPFollowup().calc_measure(inputs, model.PY, cutoff=14),
    }
    for name, result in results.items():
        tables.save_result(result, folder, name)
    return output.combine_results(tables.load_results(spark, folder))


# --------------------------------------------------------------------------
# Filters and predicates


@check(
    "pred_between",
    """SELECT l_orderkey, l_partkey, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS ship_day FROM lineitem
WHERE CAST(l_shipdate AS DATE) BETWEEN DATE '1998-03-01' AND DATE '1998-04-15'""",
)
def pred_between(spark, sf_dir):
    day = F.to_date("l_shipdate")
    return (
        read(spark, sf_dir, "lineitem")
        .where(
            day.between(
                F.lit(datetime.date(1998, 3, 1)), F.lit(datetime.date(1998, 4, 15))
            )
        )
        .select("l_orderkey", "l_partkey", day.alias("ship_day"))
    )


@check(
    "pred_isin",
    """SELECT o_orderkey, o_orderpriority FROM orders
WHERE lower(o_orderpriority) IN ('1-urgent', '5-low') AND year(o_orderdate) IN (1997, 1998)""",
)
def pred_isin(spark, sf_dir):
    return (
        read(spark, sf_dir, "orders")
        .where(
            F.lower("o_orderpriority").isin("1-urgent", "5-low")
            & F.year("o_orderdate").isin(1997, 1998)
        )
        .select("o_orderkey", "o_orderpriority")
    )


@check(
    "pred_span_inside",
    f"""WITH {ORDER_SPANS} SELECT member_id, CAST(date_start AS VARCHAR) AS date_start, CAST(date_end AS VARCHAR) AS date_end
FROM order_spans WHERE date_start >= DATE '1997-01-01' AND date_end <= DATE '1998-12-31'""",
)
def pred_span_inside(spark, sf_dir):
    return (
        order_spans(spark, sf_dir)
        .where(cf.inside_years("date_start", "date_end", model.PY))
        .select("member_id", "date_start", "date_end")
    )


@check(
    "pred_span_overlap",
    f"""WITH {ORDER_SPANS} SELECT member_id, CAST(date_start AS VARCHAR) AS date_start, CAST(date_end AS VARCHAR) AS date_end
FROM order_spans WHERE date_end >= DATE '1998-01-01' AND date_start <= DATE '1998-12-31'""",
)
def pred_span_overlap(spark, sf_dir):
    return (
        order_spans(spark, sf_dir)
        .where(
            (F.col("date_end") >= F.lit(cf.year_start(model.PY)))
            & (F.col("date_start") <= F.lit(cf.year_end(model.PY)))
        )
        .select("member_id", "date_start", "date_end")
    )


@check(
    "pred_regex",
    r"""SELECT p_partkey, p_name, regexp_matches(p_name, '\bring\b') AS is_ring, contains(p_type, 'ECON') AS is_economy
FROM part WHERE regexp_matches(p_name, '\bring\b|^blue') OR contains(p_type, 'ECON')""",
)
def pred_regex(spark, sf_dir):
    ring, economy = F.col("p_name").rlike(r"\bring\b"), F.col("p_type").contains("ECON")
    return (
        read(spark, sf_dir, "part")
        .where(F.col("p_name").rlike(r"\bring\b|^blue") | economy)
        .select("p_partkey", "p_name", ring.alias("is_ring"), economy.alias("is_economy"))
    )


@check(
    "pred_null",
    """SELECT d.doc_id, coalesce(l.quality, -1) AS quality, l.doc_id IS NULL AS unlabelled
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
)
def pred_null(spark, sf_dir):
    labels = read(spark, sf_dir, "labels").select("doc_id", "quality", F.lit(False).alias("no"))
    return (
        read(spark, sf_dir, "documents")
        .select("doc_id")
        .join(labels, "doc_id", "left")
        .fillna({"quality": -1})
        .select("doc_id", "quality", F.col("no").isNull().alias("unlabelled"))
    )


@check(
    "pred_case_when",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN CASE WHEN o_totalprice > 250000 THEN 'closed large' ELSE 'closed small' END
  ELSE CASE WHEN o_orderstatus = 'P' THEN 'pending' ELSE 'open' END END AS state FROM orders""",
)
def pred_case_when(spark, sf_dir):
    status = F.col("o_orderstatus")
    closed = F.when(F.col("o_totalprice") > 250000, "closed large").otherwise("closed small")
    return read(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(status == "F", closed)
        .otherwise(F.when(status == "P", "pending").otherwise("open"))
        .alias("state"),
    )


# --------------------------------------------------------------------------
# Joins


@check(
    "join_inner",
    """SELECT o_orderkey, c_mktsegment, CAST(count(*) AS BIGINT) AS n_lines FROM customer JOIN orders ON c_custkey = o_custkey
JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey, c_mktsegment""",
)
def join_inner(spark, sf_dir):
    # Lines are counted per order first; only one row per order is joined.
    lines = (
        read(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.count("*").alias("n_lines"))
    )
    customer = read(spark, sf_dir, "customer")
    orders = read(spark, sf_dir, "orders").join(lines, "o_orderkey")
    return orders.join(customer, F.col("c_custkey") == F.col("o_custkey")).select(
        "o_orderkey", "c_mktsegment", "n_lines"
    )


@check(
    "join_left",
    """SELECT c_custkey, coalesce(n, 0) AS n_urgent FROM customer LEFT JOIN
(SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY o_custkey) ON c_custkey = o_custkey""",
)
def join_left(spark, sf_dir):
    urgent = (
        read(spark, sf_dir, "orders")
        .where(F.col("o_orderpriority") == "1-URGENT")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.count("*").alias("n"))
    )
    return (
        read(spark, sf_dir, "customer")
        .join(urgent, "c_custkey", "left")
        .select("c_custkey", F.coalesce("n", F.lit(0)).alias("n_urgent"))
    )


def _big_orders(spark, sf_dir):
    return (
        read(spark, sf_dir, "orders")
        .where(F.col("o_totalprice") > 400000)
        .select(F.col("o_custkey").alias("c_custkey"))
    )


@check(
    "join_anti",
    """SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)""",
)
def join_anti(spark, sf_dir):
    return (
        read(spark, sf_dir, "customer")
        .select("c_custkey")
        .join(_big_orders(spark, sf_dir).distinct(), "c_custkey", "left_anti")
    )


@check(
    "join_semi",
    """SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)""",
)
def join_semi(spark, sf_dir):
    return (
        read(spark, sf_dir, "customer")
        .select("c_custkey")
        .join(_big_orders(spark, sf_dir).distinct(), "c_custkey", "left_semi")
    )


@check(
    "join_full",
    """SELECT coalesce(a.k, b.k) AS o_custkey, coalesce(a.n, 0) AS n_pending, coalesce(b.n, 0) AS n_large
FROM (SELECT o_custkey AS k, count(*) AS n FROM orders WHERE o_orderstatus = 'P' GROUP BY o_custkey) a
FULL JOIN (SELECT o_custkey AS k, count(*) AS n FROM orders WHERE o_totalprice > 400000 GROUP BY o_custkey) b ON a.k = b.k""",
)
def join_full(spark, sf_dir):
    orders = read(spark, sf_dir, "orders")

    def per_customer(condition, name):
        return orders.where(condition).groupBy("o_custkey").agg(F.count("*").alias(name))

    pending = per_customer(F.col("o_orderstatus") == "P", "n_pending")
    large = per_customer(F.col("o_totalprice") > 400000, "n_large")
    return pending.join(large, "o_custkey", "full_outer").fillna(0, ["n_pending", "n_large"])


def _customer_days(spark, sf_dir):
    """Order days and ship days of every customer on one timeline."""
    orders = read(spark, sf_dir, "orders")
    lines = read(spark, sf_dir, "lineitem").join(
        orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    shipped = lines.select(
        F.col("o_custkey").alias("member_id"),
        F.to_date("l_shipdate").alias("day"),
        (F.col("l_returnflag") == "R").alias("returned"),
        F.lit(True).alias("shipped"),
        (cf.day_number(F.to_date("l_shipdate")) + F.col("l_quantity").cast("int")).alias("until"),
    )
    ordered = orders.select(
        F.col("o_custkey").alias("member_id"),
        F.to_date("o_orderdate").alias("day"),
        F.lit(True).alias("ordered"),
    )
    events = ordered.unionByName(shipped, allowMissingColumns=True)
    return episodes.day_timeline(
        events,
        "member_id",
        "day",
        {name: F.col(name) for name in ("ordered", "returned", "shipped", "until")},
    )


CUSTOMER_DAYS = """ordered AS (SELECT DISTINCT o_custkey AS member_id, CAST(o_orderdate AS DATE) AS day FROM orders),
shipped AS (SELECT o_custkey AS member_id, CAST(l_shipdate AS DATE) AS day, l_returnflag = 'R' AS returned,
  CAST(l_quantity AS INTEGER) AS q FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def _seen(flag, low, high):
    return F.coalesce(episodes.within_days(flag, low, high), F.lit(False))


@check(
    "join_interval_lookback",
    f"""WITH {CUSTOMER_DAYS} SELECT member_id, CAST(day AS VARCHAR) AS day,
  EXISTS (SELECT 1 FROM shipped s WHERE s.member_id = o.member_id AND returned AND s.day BETWEEN o.day - 365 AND o.day) AS returned_in_year,
  EXISTS (SELECT 1 FROM shipped s WHERE s.member_id = o.member_id AND s.day BETWEEN o.day - 30 AND o.day - 1) AS shipped_in_month
FROM ordered o""",
)
def join_interval_lookback(spark, sf_dir):
    return (
        _customer_days(spark, sf_dir)
        .select(
            "member_id",
            "day",
            "ordered",
            _seen("returned", -365, 0).alias("returned_in_year"),
            _seen("shipped", -30, -1).alias("shipped_in_month"),
        )
        .where("ordered")
        .drop("ordered")
    )


@check(
    "join_interval_forward",
    f"""WITH {CUSTOMER_DAYS} SELECT member_id, CAST(day AS VARCHAR) AS day,
  EXISTS (SELECT 1 FROM shipped s WHERE s.member_id = o.member_id AND s.day BETWEEN o.day AND o.day + 3) AS shipped_soon,
  EXISTS (SELECT 1 FROM shipped s WHERE s.member_id = o.member_id AND returned AND s.day BETWEEN o.day - 30 AND o.day + 7) AS returned_around
FROM ordered o""",
)
def join_interval_forward(spark, sf_dir):
    return (
        _customer_days(spark, sf_dir)
        .select(
            "member_id",
            "day",
            "ordered",
            _seen("shipped", 0, 3).alias("shipped_soon"),
            _seen("returned", -30, 7).alias("returned_around"),
        )
        .where("ordered")
        .drop("ordered")
    )


@check(
    "join_point_in_interval",
    f"""WITH {CUSTOMER_DAYS} SELECT member_id, CAST(day AS VARCHAR) AS day, EXISTS (SELECT 1 FROM shipped s
  WHERE s.member_id = o.member_id AND s.day < o.day AND o.day <= s.day + s.q) AS supplied FROM ordered o""",
)
def join_point_in_interval(spark, sf_dir):
    active = episodes.within_days("until", None, -1) >= F.col("_n")
    return (
        _customer_days(spark, sf_dir)
        .select("member_id", "day", "ordered", F.coalesce(active, F.lit(False)).alias("supplied"))
        .where("ordered")
        .drop("ordered")
    )


def merged_stays(spark, sf_dir):
    """Orders as stays, one per (customer, admission, discharge)."""
    return (
        order_stays(spark, sf_dir)
        .groupBy("member_id", "admitdate", "dischdate")
        .agg(
            F.max("transfer_claimid").alias("transfer_claimid"),
            F.bool_or("planned_flag").alias("planned_flag"),
        )
    )


@check(
    "readmit_30d",
    f"""WITH {ORDER_STAYS}, stays AS (SELECT member_id, admitdate, dischdate, max(transfer_claimid) AS transfer_claimid,
  bool_or(planned_flag) AS planned_flag FROM order_stays GROUP BY member_id, admitdate, dischdate)
SELECT member_id, transfer_claimid, EXISTS (SELECT 1 FROM stays r
  WHERE r.member_id = s.member_id AND r.transfer_claimid <> s.transfer_claimid AND NOT r.planned_flag
    AND r.admitdate BETWEEN s.dischdate AND s.dischdate + 30) AS has_readmit FROM stays s""",
)
def readmit_30d(spark, sf_dir):
    return episodes.flag_readmissions(
        merged_stays(spark, sf_dir), ~F.col("planned_flag")
    ).select("member_id", "transfer_claimid", "has_readmit")


@check(
    "pair_min_days_apart",
    """SELECT DISTINCT a.o_custkey, a.o_orderpriority FROM orders a JOIN orders b ON a.o_custkey = b.o_custkey
AND a.o_orderpriority = b.o_orderpriority AND CAST(b.o_orderdate AS DATE) - CAST(a.o_orderdate AS DATE) >= 700""",
)
def pair_min_days_apart(spark, sf_dir):
    days = read(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderpriority", F.to_date("o_orderdate").alias("day")
    )
    return episodes.far_apart(days, ["o_custkey", "o_orderpriority"], "day", 700)


@check(
    "direct_transfer",
    f"""WITH {ORDER_STAYS} SELECT e.member_id, min(e.transfer_claimid) AS transfer_claimid, CAST(coalesce(min(t.dischdate), e.dischdate) AS VARCHAR) AS dischdate
FROM order_stays e LEFT JOIN order_stays t ON t.member_id = e.member_id AND t.status = 'O' AND t.admitdate - 1 = e.dischdate
WHERE e.status = 'F' AND NOT EXISTS (SELECT 1 FROM order_stays v WHERE v.member_id = e.member_id AND v.status = 'P'
  AND v.admitdate - 1 = e.dischdate) GROUP BY e.member_id, e.dischdate""",
)
def direct_transfer(spark, sf_dir):
    status = F.col("status")
    return episodes.direct_transfers(
        order_stays(spark, sf_dir),
        episode=status == "F",
        transfer=status == "O",
        veto=status == "P",
        episode_id="transfer_claimid",
    )


# --------------------------------------------------------------------------
# Aggregations


@check(
    "agg_basic",
    """SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity,
CAST(CAST(min(l_shipdate) AS DATE) AS VARCHAR) AS first_day, CAST(CAST(max(l_shipdate) AS DATE) AS VARCHAR) AS last_day
FROM lineitem GROUP BY l_returnflag, l_linestatus""",
)
def agg_basic(spark, sf_dir):
    return (
        read(spark, sf_dir, "lineitem")
        .groupBy("l_returnflag", "l_linestatus")
        .agg(
            F.count("*").alias("n"),
            F.sum(F.col("l_quantity").cast("long")).alias("quantity"),
            F.to_date(F.min("l_shipdate")).alias("first_day"),
            F.to_date(F.max("l_shipdate")).alias("last_day"),
        )
    )


@check(
    "agg_conditional",
    """SELECT o_custkey, CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS n_closed,
CAST(sum(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) AS BIGINT) AS n_pending FROM orders GROUP BY o_custkey""",
)
def agg_conditional(spark, sf_dir):
    status = F.col("o_orderstatus")
    return (
        read(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(
            F.sum(F.when(status == "F", 1).otherwise(0)).alias("n_closed"),
            F.count_if(status == "P").alias("n_pending"),
        )
    )


@check(
    "agg_count_distinct",
    """SELECT o_custkey, count(DISTINCT o_orderdate) AS n_days, count(DISTINCT (o_orderdate, o_orderstatus)) AS n_day_states,
count(DISTINCT (o_orderstatus, o_orderpriority)) >= 2 AS mixed FROM orders GROUP BY o_custkey""",
)
def agg_count_distinct(spark, sf_dir):
    # Reduced to distinct (customer, day, status) first: a hot customer is combined
    # on the map side and counted from at most a few rows per day.
    days = (
        read(spark, sf_dir, "orders")
        .groupBy("o_custkey", "o_orderdate", "o_orderstatus")
        .agg(
            F.min(F.struct("o_orderstatus", "o_orderpriority")).alias("low"),
            F.max(F.struct("o_orderstatus", "o_orderpriority")).alias("high"),
        )
        .groupBy("o_custkey", "o_orderdate")
        .agg(F.count("*").alias("states"), F.min("low").alias("low"), F.max("high").alias("high"))
    )
    return days.groupBy("o_custkey").agg(
        F.count("*").alias("n_days"),
        F.sum("states").alias("n_day_states"),
        (F.min("low") != F.max("high")).alias("mixed"),
    )


@check(
    "agg_having",
    """SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey HAVING count(*) >= 12""",
)
def agg_having(spark, sf_dir):
    return (
        read(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("n")).where("n >= 12")
    )


@check(
    "agg_collect_set",
    """SELECT o_custkey, string_agg(DISTINCT o_orderpriority, '|' ORDER BY o_orderpriority) AS priorities,
count(DISTINCT o_orderpriority) AS n, bool_or(o_orderpriority = '1-URGENT') AS has_urgent FROM orders GROUP BY o_custkey""",
)
def agg_collect_set(spark, sf_dir):
    sets = (
        read(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(F.sort_array(F.collect_set("o_orderpriority")).alias("found"))
    )
    return sets.select(
        "o_custkey",
        F.array_join("found", "|").alias("priorities"),
        F.size("found").cast("long").alias("n"),
        F.array_contains("found", "1-URGENT").alias("has_urgent"),
    )


@check(
    "agg_bool_or",
    """SELECT l_orderkey, bool_or(l_returnflag = 'R') AS returned, bool_or(l_quantity > 45) AS bulky FROM lineitem GROUP BY l_orderkey""",
)
def agg_bool_or(spark, sf_dir):
    return (
        read(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.bool_or(F.col("l_returnflag") == "R").alias("returned"),
            F.bool_or(F.col("l_quantity") > 45).alias("bulky"),
        )
    )


@check(
    "agg_two_level",
    """SELECT o_custkey, CAST(sum(most) AS BIGINT) AS total FROM (SELECT o_custkey, CAST(l_shipdate AS DATE) AS day,
max(CAST(l_quantity AS BIGINT)) AS most FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL) GROUP BY o_custkey""",
)
def agg_two_level(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return (
        read(spark, sf_dir, "lineitem")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("o_custkey", F.to_date("l_shipdate").alias("day"))
        .agg(F.max(F.col("l_quantity").cast("long")).alias("most"))
        .groupBy("o_custkey")
        .agg(F.sum("most").alias("total"))
    )


@check(
    "codes_unique_to_set",
    """WITH keyed AS (SELECT l_returnflag AS value_set_name, l_orderkey || '-' || l_linenumber AS code FROM lineitem)
SELECT code FROM keyed WHERE value_set_name IN ('A', 'R') GROUP BY code HAVING count(*) < 2 AND max(value_set_name) = 'A'""",
)
def codes_unique_to_set(spark, sf_dir):
    keyed = read(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("value_set_name"),
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("code"),
    )
    return valuesets.codes_unique_to(keyed, "A", "R").select("code")


# --------------------------------------------------------------------------
# Set operations


def _customers_with(spark, sf_dir, condition):
    return read(spark, sf_dir, "orders").where(condition).select("o_custkey")


@check(
    "set_union_distinct",
    """SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT' UNION SELECT o_custkey FROM orders WHERE o_totalprice > 400000""",
)
def set_union_distinct(spark, sf_dir):
    urgent = _customers_with(spark, sf_dir, F.col("o_orderpriority") == "1-URGENT")
    return urgent.unionByName(
        _customers_with(spark, sf_dir, F.col("o_totalprice") > 400000)
    ).distinct()


@check(
    "set_intersect",
    """SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT' INTERSECT SELECT o_custkey FROM orders WHERE o_totalprice > 400000""",
)
def set_intersect(spark, sf_dir):
    urgent = _customers_with(spark, sf_dir, F.col("o_orderpriority") == "1-URGENT").distinct()
    return urgent.intersect(
        _customers_with(spark, sf_dir, F.col("o_totalprice") > 400000).distinct()
    )


@check(
    "set_except",
    """SELECT o_custkey FROM orders EXCEPT ALL SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'""",
)
def set_except(spark, sf_dir):
    return _customers_with(spark, sf_dir, F.lit(True)).exceptAll(
        _customers_with(spark, sf_dir, F.col("o_orderpriority") == "1-URGENT")
    )


# --------------------------------------------------------------------------
# Scalar functions


@check(
    "fn_date",
    """SELECT o_orderkey, date_diff('day', CAST(o_orderdate AS DATE), DATE '1998-12-31') AS days_left,
CAST(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 30 AS INTEGER) AS VARCHAR) AS later,
CAST(CAST(o_orderdate AS DATE) - 365 AS VARCHAR) AS year_before, year(o_orderdate) AS order_year,
strftime(o_orderdate, '%m/%d/%Y') AS us_date, CAST(least(CAST(o_orderdate AS DATE), DATE '1998-06-30') AS VARCHAR) AS capped,
CAST(greatest(CAST(o_orderdate AS DATE), DATE '1998-06-30') AS VARCHAR) AS floored FROM orders""",
)
def fn_date(spark, sf_dir):
    day = F.to_date("o_orderdate")
    mid = F.lit(datetime.date(1998, 6, 30))
    return read(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.datediff(F.lit(cf.year_end(model.PY)), day).cast("long").alias("days_left"),
        cf.add_days(day, F.col("o_orderkey") % 30).alias("later"),
        F.date_sub(day, 365).alias("year_before"),
        F.year(day).cast("long").alias("order_year"),
        F.date_format(day, "MM/dd/yyyy").alias("us_date"),
        F.least(day, mid).alias("capped"),
        F.greatest(day, mid).alias("floored"),
    )


@check(
    "fn_age_band",
    with_views(
        "member",
        """SELECT member_id, date_diff('day', dob, DATE '1998-12-31') / 365 >= 18 AS adult,
date_diff('day', dob, DATE '1998-12-31') / 365 BETWEEN 40 AND 75 AS statin_age,
date_diff('day', dob, DATE '1997-01-01') / 365.25 < 18 AS too_young, abs(year(dob) - 1998) BETWEEN 5 AND 64 AS asthma_age,
CAST(dob + 730 AS VARCHAR) AS second_birthday FROM member""",
    ),
)
def fn_age_band(spark, sf_dir):
    age = cf.age_on(cf.year_end(model.PY))
    return model.member(spark, sf_dir).select(
        "member_id",
        (age >= 18).alias("adult"),
        age.between(40, 75).alias("statin_age"),
        (cf.age_on(datetime.date(1997, 1, 1), days_per_year=365.25) < 18).alias("too_young"),
        F.abs(F.year("dob") - 1998).between(5, 64).alias("asthma_age"),
        F.date_add("dob", 730).alias("second_birthday"),
    )


@check(
    "fn_math",
    """SELECT l_orderkey, l_linenumber, CAST(round_even(l_quantity / 4, 0) AS BIGINT) AS half_even, CAST(floor(l_quantity / 30) AS BIGINT) AS months,
round(l_quantity / 8, 2) AS eighths, abs(l_linenumber - 4) AS from_middle FROM lineitem""",
)
def fn_math(spark, sf_dir):
    quantity = F.col("l_quantity")
    return read(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.bround(quantity / 4).cast("long").alias("half_even"),
        F.floor(quantity / 30).alias("months"),
        F.round(quantity / 8, 2).alias("eighths"),
        F.abs(F.col("l_linenumber") - 4).alias("from_middle"),
    )


@check(
    "fn_string",
    """SELECT p_partkey, replace(p_brand || '.' || p_size, '.', '') AS bare, regexp_extract(p_brand, '[0-9]+') AS digits,
lower(p_type) AS kind, p_name || ' (' || p_type || ')' AS label FROM part""",
)
def fn_string(spark, sf_dir):
    return read(spark, sf_dir, "part").select(
        "p_partkey",
        cf.strip_dots(F.concat_ws(".", "p_brand", "p_size")).alias("bare"),
        cf.icd_version("p_brand", "digits").alias("digits"),
        F.lower("p_type").alias("kind"),
        F.concat("p_name", F.lit(" ("), "p_type", F.lit(")")).alias("label"),
    )


@check(
    "fn_nested",
    """SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN p_brand || '|' ELSE '' END || p_name || '|' || p_type AS parts,
CASE WHEN p_size % 2 = 0 THEN 3 ELSE 2 END AS n_parts, p_type IN ('SMALL', 'ECONOMY') AS wanted, p_name AS from_map,
unnest(['prior', 'after']) AS period, unnest([p_size - 5, p_size]) AS low FROM part""",
)
def fn_nested(spark, sf_dir):
    maybe = F.when(F.col("p_size") % 2 == 0, F.array("p_brand"))
    parts = cf.concat_present(maybe, F.array("p_name"), F.array("p_type"))

    def period(name, low):
        return F.struct(F.lit(name).alias("period"), low.alias("low"))

    lookup = F.create_map(F.lit("name"), "p_name", F.lit("type"), "p_type")
    return read(spark, sf_dir, "part").select(
        "p_partkey",
        F.array_join(parts, "|").alias("parts"),
        F.size(parts).alias("n_parts"),
        cf.any_of(F.array("p_type"), ["SMALL", "ECONOMY"]).alias("wanted"),
        F.element_at(lookup, "name").alias("from_map"),
        F.inline(
            F.array(period("prior", F.col("p_size") - 5), period("after", F.col("p_size")))
        ),
    )


@check(
    "fn_cast",
    """SELECT o_orderkey, CAST(o_totalprice > 250000 AS INTEGER) AS is_large, CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) AS level,
CAST(NULL AS VARCHAR) AS nothing, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day FROM orders""",
)
def fn_cast(spark, sf_dir):
    level = F.substring("o_orderpriority", 1, 1).cast("double")
    return read(spark, sf_dir, "orders").select(
        "o_orderkey",
        (F.col("o_totalprice") > 250000).cast("int").alias("is_large"),
        level.alias("level", metadata={"label": "Level"}),
        F.lit(None).cast("string").alias("nothing"),
        F.to_date("o_orderdate").cast("string").cast("date").alias("day"),
    )


# --------------------------------------------------------------------------
# Intervals

PERIOD = (datetime.date(1996, 1, 1), datetime.date(1999, 12, 31))
GAPS = f"""WITH {ORDER_SPANS}, edges AS (
  SELECT member_id, date_start, date_end FROM order_spans WHERE cover_medical = 'Y' AND date_end >= DATE '1996-01-01' AND date_start <= DATE '1999-12-31'
  UNION ALL SELECT member_id, DATE '1995-12-31', DATE '1995-12-31' FROM order_spans
  UNION ALL SELECT member_id, DATE '2000-01-01', DATE '2000-01-01' FROM order_spans),
gaps AS ({holes('edges')}),
summary AS (SELECT m.member_id, coalesce(max(he - hs + 1), 0) AS largest_gap, count(hs) AS gap_count
  FROM (SELECT DISTINCT member_id FROM order_spans) m LEFT JOIN gaps USING (member_id) GROUP BY m.member_id)"""


@check("elig_gaps", f"{GAPS} SELECT * FROM summary")
def elig_gaps(spark, sf_dir):
    gaps = intervals.enrollment_gaps(order_spans(spark, sf_dir), *PERIOD)
    return gaps.withColumn("largest_gap", F.col("largest_gap").cast("long"))


@check(
    "elig_gap_flag",
    f"""{GAPS} SELECT member_id, CASE WHEN largest_gap > 300 OR gap_count > 9 THEN 'Y' ELSE 'N' END AS enrollment_gap_excluded FROM summary""",
)
def elig_gap_flag(spark, sf_dir):
    return intervals.flag_gaps(
        intervals.enrollment_gaps(order_spans(spark, sf_dir), *PERIOD), 300, 9
    )


SPLIT = f"""WITH {ORDER_SPANS}, cuts AS (SELECT member_id, date_start AS x FROM order_spans UNION SELECT member_id, date_end + 1 FROM order_spans),
pieces AS (SELECT member_id, x AS date_start, lead(x) OVER (PARTITION BY member_id ORDER BY x) - 1 AS date_end FROM cuts),
judged AS (SELECT member_id, date_start, date_end, EXISTS (SELECT 1 FROM order_spans s WHERE s.member_id = p.member_id
  AND s.date_start <= p.date_start AND s.date_end >= p.date_end) AS covered FROM pieces p WHERE date_end IS NOT NULL)
SELECT member_id, CAST(date_start AS VARCHAR) AS date_start, CAST(date_end AS VARCHAR) AS date_end"""


@check("decouple_windows", f"{SPLIT} FROM judged WHERE covered")
def decouple_windows(spark, sf_dir):
    return intervals.split_windows(order_spans(spark, sf_dir), "member_id")


@check("decouple_windows_gaps", f"{SPLIT}, covered FROM judged")
def decouple_windows_gaps(spark, sf_dir):
    return intervals.split_windows(order_spans(spark, sf_dir), "member_id", holes=True)


@check(
    "priority_windows",
    f"""WITH {ORDER_SPANS}, cuts AS (SELECT member_id, date_start AS x FROM order_spans UNION SELECT member_id, date_end + 1 FROM order_spans),
pieces AS (SELECT member_id, x AS date_start, lead(x) OVER (PARTITION BY member_id ORDER BY x) - 1 AS date_end FROM cuts),
ranked AS (SELECT p.member_id, p.date_start, p.date_end, s.status, row_number() OVER (PARTITION BY p.member_id, p.date_start
    ORDER BY s.priority, s.date_end DESC, s.status DESC) AS i
  FROM pieces p JOIN order_spans s ON s.member_id = p.member_id AND s.date_start <= p.date_start AND s.date_end >= p.date_end)
SELECT member_id, CAST(date_start AS VARCHAR) AS date_start, CAST(date_end AS VARCHAR) AS date_end, status FROM ranked WHERE i = 1""",
)
def priority_windows(spark, sf_dir):
    return intervals.priority_windows(
        order_spans(spark, sf_dir), "member_id", ["status"], "priority"
    )


@check(
    "priority_windows_any_level",
    f"""WITH {ORDER_SPANS}, levelled AS (SELECT *, CASE WHEN priority = 2 THEN NULL ELSE priority * 37 - 60 END AS level FROM order_spans),
cuts AS (SELECT member_id, date_start AS x FROM levelled UNION SELECT member_id, date_end + 1 FROM levelled),
pieces AS (SELECT member_id, x AS date_start, lead(x) OVER (PARTITION BY member_id ORDER BY x) - 1 AS date_end FROM cuts),
ranked AS (SELECT p.member_id, p.date_start, p.date_end, s.status, row_number() OVER (PARTITION BY p.member_id, p.date_start
    ORDER BY s.level NULLS LAST, s.date_end DESC, s.status DESC) AS i
  FROM pieces p JOIN levelled s ON s.member_id = p.member_id AND s.date_start <= p.date_start AND s.date_end >= p.date_end)
SELECT member_id, CAST(date_start AS VARCHAR) AS date_start, CAST(date_end AS VARCHAR) AS date_end, status FROM ranked WHERE i = 1""",
)
def priority_windows_any_level(spark, sf_dir):
    """Negative, sparse and null priorities."""
    level = F.when(F.col("priority") != 2, F.col("priority") * 37 - 60)
    return intervals.priority_windows(
        order_spans(spark, sf_dir).withColumn("level", level), "member_id", ["status"], "level"
    )


@check(
    "elig_per_event",
    with_views(
        "member_time",
        f""", events AS (SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS member_id, CAST(o_orderdate AS DATE) AS ev FROM orders)
{_around('events', 'e.ev - 365', 'e.ev + 7')}
SELECT member_id, CAST(ev AS VARCHAR) AS day, gap_count, CAST(gap_days AS BIGINT) AS gap_days FROM gap_summary""",
    ),
)
def elig_per_event(spark, sf_dir):
    day = F.to_date("o_orderdate")
    events = (
        read(spark, sf_dir, "orders")
        .select(F.col("o_custkey").cast("string").alias("member_id"), day.alias("event"))
        .distinct()
        .select(
            "*", F.date_sub("event", 365).alias("lo"), F.date_add("event", 7).alias("hi")
        )
    )
    return intervals.coverage_around(events, model.member_time(spark, sf_dir)).withColumnRenamed(
        "event", "day"
    )


# --------------------------------------------------------------------------
# Drug supply


@check(
    "stockpile_shift",
    recursive(
        f"""WITH {LINE_FILLS}, ordered AS (SELECT member_id, drug_id, fromdate, fromdate AS s, fromdate + days - 1 AS e,
    row_number() OVER (PARTITION BY member_id, drug_id ORDER BY fromdate, days) AS i FROM line_fills),
stacked AS (SELECT member_id, drug_id, fromdate, i, s, e FROM ordered WHERE i = 1
  UNION ALL SELECT o.member_id, o.drug_id, o.fromdate, o.i, CASE WHEN p.e >= o.s THEN p.e + 1 ELSE o.s END,
    CASE WHEN p.e >= o.s THEN o.e + CAST(p.e - o.s AS INTEGER) + 1 ELSE o.e END
  FROM stacked p JOIN ordered o ON o.member_id = p.member_id AND o.drug_id = p.drug_id AND o.i = p.i + 1)
SELECT member_id, drug_id, CAST(fromdate AS VARCHAR) AS fromdate, CAST(s AS VARCHAR) AS date_start, CAST(e AS VARCHAR) AS date_end FROM stacked"""
    ),
)
def stockpile_shift(spark, sf_dir):
    return supply.stockpile_shift(line_fills(spark, sf_dir), ["member_id", "drug_id"])


@check(
    "pdc",
    recursive(
        f"""WITH {LINE_FILLS}, fills AS (SELECT * FROM line_fills WHERE year(fromdate) = 1998)
{supply_days('fills')}
SELECT member_id, CAST(ipsd AS VARCHAR) AS ipsd, CAST(days_covered AS BIGINT) AS days_covered,
  CAST(treatment_period AS BIGINT) AS treatment_period, pdc FROM adherence"""
    ),
)
def pdc(spark, sf_dir):
    fills = line_fills(spark, sf_dir).where(cf.in_year("fromdate", model.PY))
    return supply.proportion_days_covered(fills, cf.year_end(model.PY)).withColumn(
        "treatment_period", F.col("treatment_period").cast("long")
    )


@check(
    "treatment_days",
    f"""WITH {LINE_FILLS} SELECT member_id, CAST(sum(least(fromdate + days, DATE '1998-12-31') - fromdate) AS BIGINT) AS treatment_days
FROM line_fills WHERE year(fromdate) = 1998 GROUP BY member_id""",
)
def treatment_days(spark, sf_dir):
    fills = line_fills(spark, sf_dir).where(cf.in_year("fromdate", model.PY))
    return supply.treatment_days(fills, cf.year_end(model.PY))


@check(
    "covered_days_after_index",
    f"""WITH {LINE_FILLS}, idx AS (SELECT o_custkey AS member_id, min(CAST(o_orderdate AS DATE)) AS dischdate FROM orders GROUP BY o_custkey),
clipped AS (SELECT member_id, greatest(dischdate, fromdate) AS s, least(dischdate + 179, fromdate + days) AS e
  FROM line_fills JOIN idx USING (member_id) WHERE fromdate + days >= dischdate OR fromdate >= dischdate),
days AS (SELECT DISTINCT member_id, unnest(generate_series(s, e - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS day FROM clipped WHERE s < e)
SELECT member_id, count(day) AS covered_days FROM idx LEFT JOIN days USING (member_id) GROUP BY member_id""",
)
def covered_days_after_index(spark, sf_dir):
    index = (
        read(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("member_id"))
        .agg(F.min(F.to_date("o_orderdate")).alias("dischdate"))
    )
    return supply.covered_days_after_index(line_fills(spark, sf_dir), index, 180)


@check(
    "rx_dispensing_events",
    """WITH fills AS (SELECT l_orderkey, l_linenumber, CASE l_linenumber % 4 WHEN 0 THEN 'oral' WHEN 1 THEN 'inhalation' WHEN 2 THEN 'subcutaneous' ELSE 'topical' END AS route,
  l_quantity * 5 AS d FROM lineitem),
counted AS (SELECT *, CAST(CASE route WHEN 'oral' THEN CASE WHEN d <= 30 THEN round_even(d / 30, 0) ELSE floor(d / 30) END
  WHEN 'topical' THEN 0 ELSE 1 END AS INTEGER) AS n FROM fills)
SELECT l_orderkey, l_linenumber, route, CAST(i AS INTEGER) AS rx_event_number FROM counted JOIN (SELECT unnest(range(1, 100)) AS i) ON i <= n""",
)
def rx_dispensing_events(spark, sf_dir):
    routes = F.array(*[F.lit(x) for x in ("oral", "inhalation", "subcutaneous", "topical")])
    fills = read(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.get(routes, F.col("l_linenumber") % 4).alias("route"),
        (F.col("l_quantity") * 5).alias("dayssupply"),
    )
    return supply.expand_dispensing_events(fills).drop("dayssupply")


# --------------------------------------------------------------------------
# Value sets

PART_CODES = """part_codes AS (SELECT p_brand AS value_set_name, p_name || '.' || p_size || '.' || p_partkey AS code,
  CASE p_size % 4 WHEN 0 THEN 'ICD9CM' WHEN 1 THEN 'ICD10PCS' WHEN 2 THEN 'CPT' ELSE 'UBREV' END AS code_system FROM part)"""


def part_codes(spark, sf_dir):
    systems = F.array(*[F.lit(x) for x in ("ICD9CM", "ICD10PCS", "CPT", "UBREV")])
    return read(spark, sf_dir, "part").select(
        F.col("p_brand").alias("value_set_name"),
        F.concat_ws(".", "p_name", "p_size", "p_partkey").alias("code"),
        F.get(systems, F.col("p_size") % 4).alias("code_system"),
    )


@check(
    "value_set_normalise",
    f"""WITH {PART_CODES} SELECT value_set_name, replace(code, '.', '') AS code, code_system,
  CASE WHEN starts_with(code_system, 'ICD') THEN regexp_extract(code_system, '[0-9]+') END AS icdversion,
  CASE code_system WHEN 'ICD9CM' THEN '09' WHEN 'ICD10PCS' THEN '10' END AS padded_version,
  CASE code_system WHEN 'ICD9CM' THEN 'icddiag' WHEN 'ICD10PCS' THEN 'icdproc' WHEN 'CPT' THEN 'hcpcs' ELSE 'revcode' END AS channel
FROM part_codes""",
)
def value_set_normalise(spark, sf_dir):
    codes = part_codes(spark, sf_dir)
    channel = F.coalesce(
        *[
            F.when(F.col("code_system").isin(*systems), name)
            for name, systems in valuesets.CHANNEL_SYSTEMS.items()
        ]
    )
    return valuesets.normalise_value_sets(codes).select(
        "value_set_name",
        "code",
        "code_system",
        "icdversion",
        cf.icd_version("code_system", "padded").alias("padded_version"),
        channel.alias("channel"),
    )


@check(
    "value_set_split",
    f"""WITH {PART_CODES} SELECT CASE code_system WHEN 'ICD9CM' THEN 'icddiag' WHEN 'ICD10PCS' THEN 'icdproc' WHEN 'CPT' THEN 'hcpcs'
  ELSE 'revcode' END AS channel, value_set_name, replace(code, '.', '') AS code FROM part_codes""",
)
def value_set_split(spark, sf_dir):
    split = valuesets.split_value_sets(part_codes(spark, sf_dir))
    return tables.stack(
        [
            lookup.select(F.lit(name).alias("channel"), "value_set_name", F.col(name).alias("code"))
            for name, lookup in split.items()
        ]
    )


@check(
    "value_set_coverage",
    f"""WITH {PART_CODES} SELECT 'Brand#' || i AS value_set_name, (SELECT count(*) FROM part_codes WHERE value_set_name = 'Brand#' || i) AS n_codes
FROM (SELECT unnest(range(0, 30)) AS i)""",
)
def value_set_coverage(spark, sf_dir):
    return valuesets.value_set_coverage(
        part_codes(spark, sf_dir), [f"Brand#{i}" for i in range(30)]
    )


@check(
    "unpivot_codes",
    with_views(
        "diagnoses",
        """SELECT member_id, CAST(pos_no AS INTEGER) AS ordinal, diag AS code, count(*) AS n FROM diagnoses JOIN numbered USING (row_id) GROUP BY ALL""",
    ),
)
def unpivot_codes(spark, sf_dir):
    return (
        valuesets.unpivot_codes(model.claims(spark, sf_dir), "icddiag", ["member_id"])
        .groupBy("member_id", "ordinal", "code")
        .agg(F.count("*").alias("n"))
    )


_ESRD = " OR ".join(
    [
        code("hcpcs", "ESRD", HCPCS),
        code("revcode", "ESRD", ["UBREV"]),
        code("pos", "ESRD", ["POS"]),
        diag("ESRD", ICD),
        proc("ESRD", PCS),
    ]
)
_MATCHED = (
    f"({code('hcpcs', VISITS, HCPCS)} OR {code('revcode', VISITS, ['UBREV'])}) AND {diag('Diabetes')}"
)


@check(
    "value_set_match",
    with_views(
        "diagnoses procedures ref",
        f"""SELECT member_id, bool_or(esrd) AS esrd, bool_or(visit) AS diabetes_visit FROM
(SELECT member_id, {_ESRD} AS esrd, {_MATCHED} AS visit FROM numbered) WHERE esrd OR visit GROUP BY member_id""",
    ),
)
def value_set_match(spark, sf_dir):
    book = valuesets.CodeBook(
        *visit_rules("visit", VISITS, VISITS),
        valuesets.CodeRule("diabetes", "icddiag", ("Diabetes",)),
        valuesets.CodeRule("esrd", "hcpcs", ("ESRD",), HCPCS),
        valuesets.CodeRule("esrd", "revcode", ("ESRD",), ("UBREV",)),
        valuesets.CodeRule("esrd", "pos", ("ESRD",), ("POS",)),
        valuesets.CodeRule("esrd", "icddiag", ("ESRD",), ICD),
        valuesets.CodeRule("esrd", "icdproc", ("ESRD",), PCS),
    )
    rows = book.tag(model.claims(spark, sf_dir), model.reference(spark), ["member_id"])
    return member_flags(
        rows,
        {"esrd": book.has("esrd"), "diabetes_visit": book.has("visit") & book.has("diabetes")},
    ).where("esrd OR diabetes_visit")


_STAY_SETS = ("Inpatient Stay", "Nonacute Inpatient Stay", "Pregnancy", "Chemotherapy")


def _claim_set(name: str) -> str:
    parts = [
        code("hcpcs", name, HCPCS),
        code("revcode", name, ["UBREV"]),
        code("billtype", name, ["UBTOB"]),
        diag(name, ICD, "padded"),
        proc(name, PCS, "padded"),
    ]
    return f"SELECT member_id, claimid, '{name}' AS name FROM numbered WHERE " + " OR ".join(parts)


@check(
    "claim_value_sets",
    with_views(
        "diagnoses procedures ref",
        f"""SELECT member_id, claimid, string_agg(DISTINCT name, '|' ORDER BY name) AS value_set_names FROM
({' UNION ALL '.join(_claim_set(name) for name in _STAY_SETS)}) GROUP BY member_id, claimid""",
    ),
)
def claim_value_sets(spark, sf_dir):
    return valuesets.claim_value_sets(
        model.claims(spark, sf_dir), model.reference(spark), _STAY_SETS
    ).withColumn("value_set_names", F.array_join("value_set_names", "|"))


# --------------------------------------------------------------------------
# Episodes


@check(
    "first_episode",
    """SELECT o_custkey, o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day FROM
(SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS i FROM orders) WHERE i = 1""",
)
def first_episode(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("day")
    )
    return episodes.first_episode(orders, "o_custkey", ["day", "o_orderkey"])


@check(
    "transfer_merge",
    f"""WITH {ORDER_STAYS}, stays AS (SELECT member_id, admitdate, dischdate, max(transfer_claimid) AS claimid, bool_or(status = 'F') AS exclude_base,
    bool_or(planned_flag) AS planned_flag FROM order_stays GROUP BY member_id, admitdate, dischdate),
linked AS (SELECT *, coalesce(admitdate - lag(dischdate) OVER w <= 1, FALSE) AS is_transfer, lag(claimid) OVER w AS previous
  FROM stays WINDOW w AS (PARTITION BY member_id ORDER BY admitdate, dischdate))
SELECT member_id, CASE WHEN is_transfer THEN previous ELSE claimid END AS transfer_claimid, CAST(min(admitdate) AS VARCHAR) AS admitdate,
  CAST(max(dischdate) AS VARCHAR) AS dischdate, bool_or(is_transfer) AS is_transfer, bool_or(exclude_base) AS exclude_base,
  bool_or(planned_flag AND NOT is_transfer) AS planned_flag FROM linked GROUP BY member_id, CASE WHEN is_transfer THEN previous ELSE claimid END""",
)
def transfer_merge(spark, sf_dir):
    stays = (
        order_stays(spark, sf_dir)
        .groupBy("member_id", "admitdate", "dischdate")
        .agg(
            F.max("transfer_claimid").alias("claimid"),
            F.bool_or(F.col("status") == "F").alias("exclude_base"),
            F.bool_or("planned_flag").alias("planned_flag"),
        )
    )
    return episodes.merge_transfers(stays, ["exclude_base"], ["planned_flag"])


@check(
    "planned_readmit_exclusion",
    with_views(
        "diagnoses procedures ref",
        f"""{pcr_stays()}
SELECT member_id, transfer_claimid, CAST(admitdate AS VARCHAR) AS admitdate, CAST(dischdate AS VARCHAR) AS dischdate,
  exclude_base, planned_flag, exclude_planned FROM planned""",
    ),
)
def planned_readmit_exclusion(spark, sf_dir):
    return (
        PCR()
        .stays(model.tables(spark, sf_dir), model.PY)
        .select(
            "member_id", "transfer_claimid", "admitdate", "dischdate",
            "exclude_base", "planned_flag", "exclude_planned",
        )
    )


@check(
    "lookback_exclusions",
    with_views(
        "diagnoses rx_claims ndc ref",
        f"""{aab_events()}
SELECT member_id, CAST(fromdate AS VARCHAR) AS day, negative_condition, recent_script, active_supply, competing_diagnosis FROM flagged""",
    ),
)
def lookback_exclusions(spark, sf_dir):
    last = datetime.date(1998, 12, 24)
    return (
        AAB()
        .timeline(model.tables(spark, sf_dir), model.PY)
        .where(
            F.col("index")
            & ~F.col("then_admitted")
            & F.col("day").between(F.lit(model.PY), F.lit(last))
        )
        .select(
            "member_id", "day", "negative_condition", "recent_script", "active_supply",
            "competing_diagnosis",
        )
    )


# --------------------------------------------------------------------------
# Output


@check(
    "measure_output",
    """SELECT CAST(c_custkey AS VARCHAR) AS member_id, 'Orders: ' || kind AS comp_quality_short,
CAST(c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' AND (kind = 'Closed' OR o_totalprice > 400000)) AS INTEGER) AS comp_quality_numerator,
CAST(c_custkey IN (SELECT o_custkey FROM orders WHERE year(o_orderdate) = 1998) AS INTEGER) AS comp_quality_denominator,
CAST(NULL AS VARCHAR) AS comp_quality_date_last, CAST(NULL AS VARCHAR) AS comp_quality_date_actionable, CAST(NULL AS VARCHAR) AS comp_quality_comments
FROM customer CROSS JOIN (VALUES ('Closed'), ('Closed large')) AS t(kind)""",
)
def measure_output(spark, sf_dir):
    closed = F.col("o_orderstatus") == "F"
    facts = member_flags(
        read(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "member_id"),
        {
            "closed": closed,
            "large": closed & (F.col("o_totalprice") > 400000),
            "this_year": F.year("o_orderdate") == 1998,
        },
    )
    members = (
        read(spark, sf_dir, "customer")
        .select(F.col("c_custkey").alias("member_id"))
        .join(facts, "member_id", "left")
        .withColumn("member_id", F.col("member_id").cast("string"))
    )
    return output.check_result(
        output.measure_rows(
            members,
            [
                ("Orders: Closed", F.col("closed"), F.col("this_year")),
                ("Orders: Closed large", F.col("large"), F.col("this_year")),
            ],
        )
    )


def _followup(spark, sf_dir, cutoff):
    return PCPFollowup().calc_measure(model.tables(spark, sf_dir), model.PY, cutoff=cutoff)


@check(
    "measure_rate",
    f"""SELECT CAST(sum(comp_quality_numerator) AS BIGINT) AS comp_quality_numerator,
CAST(sum(comp_quality_denominator) AS BIGINT) AS comp_quality_denominator,
round(sum(comp_quality_numerator) / sum(comp_quality_denominator), 6) AS comp_quality_rate FROM ({MEASURES['measure_pcp_14']})""",
)
def measure_rate(spark, sf_dir):
    return output.overall_rate(_followup(spark, sf_dir, 14)).withColumn(
        "comp_quality_rate", F.round("comp_quality_rate", 6)
    )


@check(
    "measure_catalogue",
    f"""SELECT comp_quality_short, n AS comp_quality_numerator, d AS comp_quality_denominator, round(n / d, 6) AS comp_quality_rate,
  'Higher_Better' AS comp_quality_direction, 0.5::DOUBLE AS comp_quality_target_value, n / d >= 0.5 AS comp_quality_target_met
FROM (SELECT comp_quality_short, CAST(sum(comp_quality_numerator) AS BIGINT) AS n, CAST(sum(comp_quality_denominator) AS BIGINT) AS d
  FROM (SELECT * FROM ({MEASURES['measure_pcp_7']}) UNION ALL SELECT * FROM ({MEASURES['measure_pcp_14']})) GROUP BY comp_quality_short)""",
)
def measure_catalogue(spark, sf_dir):
    rates = output.measure_rates(
        _followup(spark, sf_dir, 7).unionByName(_followup(spark, sf_dir, 14))
    )
    measures = reference.with_numeric_target(catalogue.measure_catalogue(spark))
    return output.rates_against_target(rates, measures).withColumn(
        "comp_quality_rate", F.round("comp_quality_rate", 6)
    )


@check(
    "drug_list_members",
    with_views(
        "rx_claims ndc",
        """SELECT member_id, bool_or(medication_list = 'Diabetes Medications') AS diabetes, bool_or(medication_list = 'Estrogen Agonists Medications') AS estrogen
FROM rx_claims x JOIN ndc d ON x.ndc = d.ndc_code WHERE medication_list IN ('Diabetes Medications', 'Estrogen Agonists Medications') GROUP BY member_id""",
    ),
)
def drug_list_members(spark, sf_dir):
    chosen = ("Diabetes Medications", "Estrogen Agonists Medications")
    fills = fills_of(model.rx_claims(spark, sf_dir), model.ndc(spark), on_list(*chosen))
    return member_flags(
        fills, {"diabetes": on_list(chosen[0]), "estrogen": on_list(chosen[1])}
    )
