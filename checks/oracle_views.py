"""DuckDB views of the claim model, written independently of the Spark derivation."""

from __future__ import annotations

from checks.claim_rows import ndc_rows, reference_rows


def _values(rows: list[tuple], columns: str) -> str:
    body = ", ".join(
        "(" + ", ".join("'" + str(value).replace("'", "''") + "'" for value in row) + ")"
        for row in rows
    )
    return f"SELECT * FROM (VALUES {body}) AS t({columns})"


LINES = """
SELECT o.o_custkey AS k, CAST(o.o_custkey AS VARCHAR) AS member_id,
       CAST(l_orderkey AS VARCHAR) || '-' ||
         CAST(CAST(floor(date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) / 15) AS BIGINT) AS VARCHAR) AS claimid,
       l_partkey AS p, l_suppkey AS s, l_linenumber AS n, CAST(l_quantity AS INTEGER) AS q,
       CAST(l_shipdate AS DATE) AS fromdate
FROM lineitem JOIN orders o ON l_orderkey = o_orderkey
"""

VIEWS = {
    "member": """
SELECT CAST(c_custkey AS VARCHAR) AS member_id,
       DATE '1930-01-01' + CAST(c_custkey * 7919 % 25000 AS INTEGER) AS dob,
       CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender
FROM customer
""",
    "member_time": """
SELECT CAST(k AS VARCHAR) AS member_id, date_start, date_end,
       CASE WHEN k % 10 = 6 AND y = 1997 THEN 'N' ELSE 'Y' END AS cover_medical,
       CASE WHEN k % 10 = 8 AND y = 1998 THEN 'N' ELSE 'Y' END AS cover_rx
FROM (
  SELECT k, y, make_date(y, 1, 1) AS date_start,
         CASE WHEN k % 10 = 4 THEN make_date(y, 6, 30) - CAST(1 + k % 80 AS INTEGER)
              WHEN k % 10 = 7 THEN make_date(y, 8, 31)
              WHEN k % 10 = 9 THEN make_date(y, 11, 30) - CAST(k % 50 AS INTEGER)
              ELSE make_date(y, 12, 31) END AS date_end
  FROM (SELECT c_custkey AS k FROM customer) CROSS JOIN (VALUES (1996), (1997), (1998), (1999)) AS t(y)
  WHERE k % 10 <> 5
  UNION ALL
  SELECT k, y, make_date(y, 1, 1) + CAST(k % 60 AS INTEGER), make_date(y, 12, 31)
  FROM (SELECT c_custkey AS k FROM customer) CROSS JOIN (VALUES (1996), (1997), (1998), (1999)) AS t(y)
  WHERE k % 10 = 5
  UNION ALL
  SELECT k, y, CASE WHEN k % 10 = 4 THEN make_date(y, 7, 1) ELSE make_date(y, 6, 1) END, make_date(y, 12, 31)
  FROM (SELECT c_custkey AS k FROM customer) CROSS JOIN (VALUES (1996), (1997), (1998), (1999)) AS t(y)
  WHERE k % 10 IN (4, 7)
)
""",
    "claims": f"""
SELECT member_id, claimid, fromdate, fromdate + CAST(s % 3 AS INTEGER) AS todate,
       fromdate AS admitdate, fromdate + q % 7 AS dischdate,
       'H' || (p % 97) AS hcpcs, 'R' || ((p * 7 + s) % 31) AS revcode, 'B' || (p % 11) AS billtype,
       'P' || (s % 13) AS pos, CAST((p + s) % 45 AS VARCHAR) AS specialty,
       CAST(s % 60 AS VARCHAR) AS modifier, CAST(p % 60 AS VARCHAR) AS modifier2,
       CAST((p * 3 + s) % 25 AS VARCHAR) AS dischargestatus,
       CASE n WHEN 7 THEN '09' WHEN 6 THEN '9' ELSE '10' END AS icdversion,
       'D' || ((p * 5 + s) % 89) AS icddiag1, 'D' || ((p * 3 + s * 2) % 89) AS icddiag2,
       CASE WHEN n % 2 = 1 THEN 'D' || ((s * 5 + n + p) % 89) END AS icddiag3,
       'Q' || ((p * 11 + s) % 53) AS icdproc1,
       CASE WHEN n % 3 = 0 THEN 'Q' || ((p + s * 3) % 53) END AS icdproc2,
       CASE WHEN k % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
       DATE '1930-01-01' + CAST(k * 7919 % 25000 AS INTEGER) AS dob
FROM ({LINES})
""",
    "rx_claims": f"""
SELECT member_id, claimid, fromdate, CAST(q * (1 + p % 4) AS DOUBLE) AS dayssupply,
       'N' || (p % 60) AS ndc
FROM ({LINES}) CROSS JOIN (VALUES (1), (2)) AS t(copy) WHERE copy = 1 OR p % 60 = 21
""",
    "followup_claims": """
SELECT CAST(o_custkey AS VARCHAR) AS member_id, CAST(o_orderkey AS VARCHAR) AS claimid,
       CASE o_orderkey % 6 WHEN 0 THEN 'I11a' WHEN 1 THEN 'i12' WHEN 2 THEN 'I13b'
            WHEN 3 THEN 'i14a' WHEN 4 THEN 'O10' ELSE 'P32' END AS service_line,
       CASE WHEN o_orderstatus = 'F' THEN 'Y' ELSE 'N' END AS success,
       CASE WHEN o_orderstatus = 'P' THEN 'N' ELSE 'Y' END AS potential,
       CAST(o_orderkey * 7 % 19 AS INTEGER) AS days_since
FROM orders
""",
    "reference": _values(reference_rows(), "value_set_name, code, code_system"),
    "reference_awv": "SELECT * FROM (VALUES ('Well-Care-Custom', 'H40', 'HCPCS'), "
    "('Well-Care-Custom', 'H41', 'HCPCS')) AS t(value_set_name, code, code_system)",
    "ndc": _values(ndc_rows(), "medication_list, ndc_code, route, description, drug_id"),
    # Code table without dots and with the ICD version in its three spellings.
    "ref": """
SELECT value_set_name, replace(code, '.', '') AS code, code_system,
       CASE WHEN contains(code_system, 'ICD') THEN regexp_extract(code_system, '[0-9]+') END AS version,
       CASE WHEN NOT contains(code_system, 'ICD') THEN NULL
            WHEN starts_with(code_system, 'ICD9') THEN '09' ELSE '10' END AS padded,
       regexp_extract(code_system, '[0-9]+') AS digits
FROM reference
""",
    # Claims row by row with their codes unpivoted (rows without a code left out).
    "numbered": "SELECT row_number() OVER () AS row_id, * FROM claims",
    "diagnoses": """
SELECT row_id, 1 AS pos_no, icddiag1 AS diag FROM numbered
UNION ALL SELECT row_id, 2, icddiag2 FROM numbered
UNION ALL SELECT row_id, 3, icddiag3 FROM numbered WHERE icddiag3 IS NOT NULL
""",
    "procedures": """
SELECT row_id, icdproc1 AS proc FROM numbered
UNION ALL SELECT row_id, icdproc2 FROM numbered WHERE icdproc2 IS NOT NULL
""",
}

DEPENDS = {
    "ref": ("reference",),
    "numbered": ("claims",),
    "diagnoses": ("numbered",),
    "procedures": ("numbered",),
}


def with_views(names: str, body: str) -> str:
    """SQL text: the named views (and what they read) as CTEs in front of ``body``.

    ``body`` starts with a SELECT or with further CTEs, introduced by a comma.
    """
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in DEPENDS.get(name, ()):
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names.split():
        add(name)
    # row_number() in "numbered" must be computed once, or the pieces would not line up.
    ctes = ",\n".join(
        f"{name} AS {'MATERIALIZED ' if name == 'numbered' else ''}({VIEWS[name].strip()})"
        for name in ordered
    )
    return f"WITH {ctes}\n{body.strip()}"
