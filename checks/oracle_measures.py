"""DuckDB statements of the measures, read off the published rules row by row.

They use plain semi-joins per value set and code column, recursive stacking of
supply and literal window splitting, none of which the library does.
"""

from __future__ import annotations

from checks.oracle_views import with_views

NULLS = (
    "CAST(NULL AS VARCHAR) AS comp_quality_date_last, "
    "CAST(NULL AS VARCHAR) AS comp_quality_date_actionable, "
    "CAST(NULL AS VARCHAR) AS comp_quality_comments"
)


def _list(values) -> str:
    values = [values] if isinstance(values, str) else values
    return ", ".join("'" + value.replace("'", "''") + "'" for value in values)


def code(column: str, sets, systems=None) -> str:
    """Row condition: the column holds a code of the value sets."""
    extra = f" AND code_system IN ({_list(systems)})" if systems else ""
    return (
        f"{column} IN (SELECT code FROM ref WHERE value_set_name IN ({_list(sets)}){extra})"
    )


def diag(sets, systems=None, version: str | None = "version", where: str = "TRUE") -> str:
    """Row condition: one of the row's diagnoses is in the value sets."""
    extra = f" AND r.code_system IN ({_list(systems)})" if systems else ""
    if version:
        extra += f" AND n2.icdversion = r.{version}"
    return (
        "row_id IN (SELECT d.row_id FROM diagnoses d JOIN numbered n2 ON d.row_id = n2.row_id "
        f"JOIN ref r ON d.diag = r.code WHERE r.value_set_name IN ({_list(sets)}){extra} AND {where})"
    )


def proc(sets, systems=None, version: str = "version") -> str:
    extra = f" AND r.code_system IN ({_list(systems)})" if systems else ""
    return (
        "row_id IN (SELECT d.row_id FROM procedures d JOIN numbered n2 ON d.row_id = n2.row_id "
        f"JOIN ref r ON d.proc = r.code AND n2.icdversion = r.{version} "
        f"WHERE r.value_set_name IN ({_list(sets)}){extra})"
    )


def holes(spans: str, keys: str = "member_id") -> str:
    """Uncovered windows (hs, he) between the spans of a key."""
    return (
        f"SELECT {keys}, reach + 1 AS hs, date_start - 1 AS he FROM (SELECT {keys}, date_start, "
        f"max(date_end) OVER (PARTITION BY {keys} ORDER BY date_start, date_end "
        f"ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM {spans}) "
        "WHERE date_start > reach + 1"
    )


def age(day: str, per_year: str = "365") -> str:
    return f"(date_diff('day', dob, DATE '{day}') / {per_year})"


def enrolled(condition: str) -> str:
    """CTEs spans, gaps, enrolled: spans by condition, at most one hole, at most 45 days."""
    return f""", spans AS (SELECT member_id, date_start, date_end FROM member_time JOIN member USING (member_id)
  WHERE {condition}),
gaps AS ({holes('spans')}),
enrolled AS (SELECT DISTINCT member_id FROM spans WHERE member_id NOT IN
  (SELECT member_id FROM gaps GROUP BY member_id HAVING count(*) > 1 OR max(he - hs) > 45))"""


def rate(name: str, numerator: str, denominator: str, source: str = "member") -> str:
    name = name if name.startswith("(") else f"'{name}'"
    return (
        f"SELECT member_id, {name} AS comp_quality_short, "
        f"CAST(CASE WHEN {numerator} THEN 1 ELSE 0 END AS INTEGER) AS comp_quality_numerator, "
        f"CAST(CASE WHEN {denominator} THEN 1 ELSE 0 END AS INTEGER) AS comp_quality_denominator, "
        f"{NULLS} FROM {source}"
    )


def supply_days(fills: str) -> str:
    """CTEs of the stacked supply: fills(member_id, drug_id, fromdate, days) → pdc."""
    return f""", ordered AS (SELECT member_id, drug_id, fromdate AS s, fromdate + days - 1 AS e,
    row_number() OVER (PARTITION BY member_id, drug_id ORDER BY fromdate, days) AS i FROM {fills}),
stacked AS (
  SELECT member_id, drug_id, i, s, e FROM ordered WHERE i = 1
  UNION ALL
  SELECT o.member_id, o.drug_id, o.i,
         CASE WHEN p.e >= o.s THEN p.e + 1 ELSE o.s END,
         CASE WHEN p.e >= o.s THEN o.e + CAST(p.e - o.s AS INTEGER) + 1 ELSE o.e END
  FROM stacked p JOIN ordered o ON o.member_id = p.member_id AND o.drug_id = p.drug_id AND o.i = p.i + 1),
cuts AS (SELECT member_id, s AS x FROM stacked UNION SELECT member_id, e + 1 FROM stacked),
pieces AS (SELECT member_id, x AS s, lead(x) OVER (PARTITION BY member_id ORDER BY x) - 1 AS e FROM cuts),
covered AS (SELECT member_id, s, e FROM pieces f WHERE e IS NOT NULL AND EXISTS
  (SELECT 1 FROM stacked w WHERE w.member_id = f.member_id AND w.s <= f.s AND w.e >= f.e)),
adherence AS (SELECT member_id, ipsd, least(days, period) AS days_covered, period AS treatment_period,
    round(least(days, period) / nullif(period, 0), 2) AS pdc
  FROM (SELECT member_id, min(s) AS ipsd, sum(least(e, DATE '1998-12-31') - s + 1) AS days,
               DATE '1998-12-31' - min(s) AS period FROM covered GROUP BY member_id))"""


HCPCS = ("CPT", "HCPCS")
ICD = ("ICD10CM", "ICD9CM")
PCS = ("ICD10PCS", "ICD9PCS")
IN_1998 = "fromdate BETWEEN DATE '1998-01-01' AND DATE '1998-12-31'"
TWO_YEARS = "fromdate BETWEEN DATE '1997-01-01' AND DATE '1998-12-31'"


def _pcp(cutoff: int) -> str:
    return with_views(
        "followup_claims",
        f"""SELECT member_id, 'PCP Followup: {cutoff}-Day' AS comp_quality_short,
  count(*) FILTER (success = 'Y' AND days_since BETWEEN 0 AND {cutoff}) AS comp_quality_numerator,
  count(*) FILTER (potential = 'Y') AS comp_quality_denominator, {NULLS}
FROM (SELECT DISTINCT claimid, member_id, success, potential, days_since FROM followup_claims
      WHERE lower(service_line) IN ('i11a', 'i12', 'i13a', 'i13b', 'i14a', 'i14b'))
GROUP BY member_id""",
    )


def _mpm() -> str:
    def test(name: str) -> str:
        return f"SELECT member_id FROM claims WHERE {IN_1998} AND {code('hcpcs', name, ['CPT'])}"

    return with_views(
        "member member_time claims rx_claims ndc ref",
        f""", treated AS (SELECT member_id FROM rx_claims x JOIN ndc d ON x.ndc = d.ndc_code
  WHERE medication_list = 'Diuretic Medications' AND {IN_1998} AND dayssupply > 0 GROUP BY member_id
  HAVING sum(least(fromdate + CAST(dayssupply AS INTEGER), DATE '1998-12-31') - fromdate) >= 180)
{enrolled(f"date_start >= DATE '1998-01-01' AND date_end <= DATE '1998-12-31' AND cover_medical = 'Y' "
          f"AND cover_rx = 'Y' AND {age('1998-12-31')} >= 18 AND member_id IN (SELECT member_id FROM treated)")},
tested AS ({test('Lab Panel')} UNION ({test('Serum Potassium')} INTERSECT {test('Serum Creatinine')}))
{rate('MPM3', 'member_id IN (SELECT member_id FROM enrolled) AND member_id IN (SELECT member_id FROM tested)',
      'member_id IN (SELECT member_id FROM enrolled)')}""",
    )


def _pbh() -> str:
    return with_views(
        "member member_time diagnoses rx_claims ndc ref",
        f""", acute_codes AS (SELECT code FROM ref WHERE value_set_name IN ('Inpatient Stay', 'Nonacute Inpatient Stay')
  GROUP BY code HAVING count(*) < 2 AND max(value_set_name) = 'Inpatient Stay'),
acute AS (SELECT * FROM numbered WHERE revcode IN (SELECT code FROM acute_codes)),
nonacute AS (SELECT * FROM numbered WHERE {code('revcode', 'Nonacute Inpatient Stay')}),
attacks AS (SELECT DISTINCT claimid, member_id, dischdate FROM acute
  WHERE dischdate BETWEEN DATE '1997-07-01' AND DATE '1998-06-30' AND {diag('AMI', version='digits')}),
moved AS (SELECT a.claimid, a.member_id, coalesce(t.dischdate, a.dischdate) AS dischdate FROM attacks a
  LEFT JOIN nonacute x ON x.member_id = a.member_id AND x.admitdate - 1 = a.dischdate
  LEFT JOIN acute t ON t.member_id = a.member_id AND t.admitdate - 1 = a.dischdate WHERE x.member_id IS NULL),
first_one AS (SELECT member_id, dischdate FROM
  (SELECT *, row_number() OVER (PARTITION BY member_id ORDER BY dischdate, claimid) AS i FROM moved) WHERE i = 1),
spans AS (SELECT member_id, date_start, date_end, dischdate FROM member_time JOIN member USING (member_id)
  JOIN first_one USING (member_id) WHERE cover_medical = 'Y' AND cover_rx = 'Y' AND {age('1998-12-31')} >= 18),
gaps AS ({holes('spans')}),
out_of_it AS (SELECT member_id FROM gaps JOIN first_one USING (member_id) GROUP BY member_id
  HAVING count(*) > 1 OR bool_or(hs BETWEEN dischdate AND dischdate + 179 AND he - hs >= 45)),
eligible AS (SELECT DISTINCT member_id, dischdate FROM spans WHERE member_id NOT IN (SELECT member_id FROM out_of_it)),
fills AS (SELECT member_id, dischdate, fromdate, fromdate + CAST(dayssupply AS INTEGER) AS until
  FROM rx_claims x JOIN eligible USING (member_id) JOIN ndc d ON x.ndc = d.ndc_code
  WHERE medication_list = 'Beta-Blocker Medications'),
clipped AS (SELECT member_id, greatest(dischdate, fromdate) AS date_start, least(dischdate + 179, until) AS date_end
  FROM fills WHERE until >= dischdate OR fromdate >= dischdate),
used AS (SELECT DISTINCT * FROM clipped WHERE date_start < date_end),
opened AS (SELECT *, CASE WHEN date_start <= max(date_end) OVER (PARTITION BY member_id ORDER BY date_start, date_end
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS opens FROM used),
islands AS (SELECT *, sum(opens) OVER (PARTITION BY member_id ORDER BY date_start, date_end
  ROWS UNBOUNDED PRECEDING) AS island FROM opened),
kept AS (SELECT member_id FROM (SELECT member_id, max(date_end) - min(date_start) AS days FROM islands
  GROUP BY member_id, island) GROUP BY member_id HAVING sum(days) >= 135)
{rate('PBH', 'member_id IN (SELECT member_id FROM kept)', 'member_id IN (SELECT member_id FROM eligible)')}""",
    )


def _around(events: str, lo: str, hi: str) -> str:
    """CTEs gap_summary(member_id, event columns, gap_count, gap_days) around events(member_id, ev, day)."""
    return f""", seen AS (SELECT e.member_id, e.ev, greatest(date_start, {lo}) AS date_start,
    least(date_end, {hi}) AS date_end, cover_medical
  FROM {events} e JOIN member_time t ON t.member_id = e.member_id AND date_end >= {lo} AND date_start <= {hi}),
seen_holes AS ({holes('seen', 'member_id, ev')}),
gap_rows AS (SELECT member_id, ev, he - hs + 1 AS days FROM seen_holes
  UNION ALL SELECT member_id, ev, date_end - date_start + 1 FROM seen WHERE cover_medical = 'N'),
gap_summary AS (SELECT k.member_id, k.ev, count(g.days) AS gap_count, coalesce(sum(g.days), 0) AS gap_days
  FROM (SELECT DISTINCT member_id, ev FROM seen) k LEFT JOIN gap_rows g ON g.member_id = k.member_id AND g.ev = k.ev
  GROUP BY k.member_id, k.ev)"""


def pcr_stays() -> str:
    """CTEs up to ``planned``: the merged stays with all flags."""
    systems = {"hcpcs": HCPCS, "revcode": ["UBREV"], "billtype": ["UBTOB"]}

    def any_code(name: str, diagnosis: str) -> str:
        parts = [code(column, name, allowed) for column, allowed in systems.items()]
        parts += [proc(name, PCS, "padded"), diagnosis]
        return "(" + " OR ".join(parts) + ")"

    def first(name: str) -> str:
        return any_code(name, diag(name, ICD, "padded", "d.pos_no = 1"))

    def anywhere(name: str) -> str:
        return any_code(name, diag(name, ICD, "padded"))

    return f""", lines AS (SELECT member_id, claimid, admitdate, dischdate, dischargestatus = '20' AS died,
    {first('Inpatient Stay')} AS inpatient, {first('Nonacute Inpatient Stay')} AS nonacute,
    {first('Pregnancy')} OR {first('Perinatal Conditions')} AS excluded,
    {first('Chemotherapy')} OR {first('Kidney Transplant')} OR {first('Bone Marrow Transplant')}
      OR {anywhere('Organ Transplant Other Than Kidney')} AS surely_planned,
    {first('Potentially Planned Procedures')} AS maybe_planned, {first('Acute Condition')} AS acute_condition
  FROM numbered WHERE dischdate >= DATE '1998-01-01'),
per_claim AS (SELECT member_id, claimid, min(admitdate) AS admitdate, max(dischdate) AS dischdate,
    bool_or(died) OR bool_or(excluded) AS exclude_base,
    bool_or(surely_planned) OR (bool_or(maybe_planned) AND NOT bool_or(acute_condition)) AS planned_flag
  FROM lines GROUP BY member_id, claimid HAVING bool_or(inpatient) AND NOT bool_or(nonacute)),
stays AS (SELECT member_id, admitdate, dischdate, max(claimid) AS claimid, bool_or(exclude_base) AS exclude_base,
    bool_or(planned_flag) AS planned_flag FROM per_claim GROUP BY member_id, admitdate, dischdate),
linked AS (SELECT *, coalesce(admitdate - lag(dischdate) OVER w <= 1, FALSE) AS is_transfer, lag(claimid) OVER w AS previous
  FROM stays WINDOW w AS (PARTITION BY member_id ORDER BY admitdate, dischdate)),
merged AS (SELECT member_id, CASE WHEN is_transfer THEN previous ELSE claimid END AS transfer_claimid,
    min(admitdate) AS admitdate, max(dischdate) AS dischdate, bool_or(is_transfer) AS is_transfer,
    bool_or(exclude_base) AS exclude_base, bool_or(planned_flag AND NOT is_transfer) AS planned_flag
  FROM linked GROUP BY ALL),
planned AS (SELECT *, coalesce(lead(admitdate) OVER w - dischdate <= 30 AND lead(planned_flag) OVER w, FALSE) AS exclude_planned
  FROM merged WINDOW w AS (PARTITION BY member_id ORDER BY admitdate, dischdate, transfer_claimid))"""


def pcr_index() -> str:
    return f"""{pcr_stays()},
candidates AS (SELECT * FROM planned WHERE admitdate <> dischdate AND NOT exclude_base AND NOT exclude_planned
  AND dischdate BETWEEN DATE '1998-01-01' AND DATE '1998-12-01'),
events AS (SELECT member_id, {{'id': transfer_claimid, 'period': period}} AS ev,
    CASE period WHEN 'prior' THEN dischdate - 365 ELSE dischdate END AS lo,
    CASE period WHEN 'prior' THEN dischdate ELSE dischdate + 30 END AS hi
  FROM candidates CROSS JOIN (VALUES ('prior'), ('after')) AS p(period))
{_around('events', 'lo', 'hi')},
lapses AS (SELECT member_id, ev.id AS transfer_claimid,
    bool_or(CASE ev.period WHEN 'prior' THEN gap_count > 1 OR gap_days > 45 ELSE gap_count > 0 END) AS lapsed
  FROM gap_summary GROUP BY ALL),
index_stays AS (SELECT c.member_id, c.transfer_claimid, EXISTS (SELECT 1 FROM planned r WHERE r.member_id = c.member_id
    AND NOT r.exclude_base AND r.transfer_claimid <> c.transfer_claimid
    AND r.admitdate BETWEEN c.dischdate AND c.dischdate + 30) AS has_readmit
  FROM candidates c JOIN lapses l ON l.member_id = c.member_id AND l.transfer_claimid = c.transfer_claimid
  WHERE NOT lapsed)"""


def _pcr() -> str:
    return with_views(
        "member member_time diagnoses procedures ref",
        f"""{pcr_index()}
SELECT member_id, 'PCR' AS comp_quality_short, count(*) FILTER (has_readmit) AS comp_quality_numerator,
  count(*) AS comp_quality_denominator, {NULLS}
FROM index_stays WHERE member_id IN (SELECT member_id FROM member WHERE {age('1998-12-31')} BETWEEN 18 AND 64)
GROUP BY member_id""",
    )


NEGATIVE = (
    "HIV", "HIV Type 2", "Malignant Neoplasms", "Emphysema", "COPD", "Cystic Fibrosis",
    "Comorbid Conditions", "Disorders of the Immune System",
)
VISITS = ("Outpatient", "Observation", "ED")


def aab_events() -> str:
    """CTEs up to ``flagged``: index visits with their look-back flags."""
    visit = f"({code('hcpcs', VISITS, HCPCS)} OR {code('revcode', VISITS, ['UBREV'])})"
    return f""", scripts AS (SELECT member_id, fromdate, max(dayssupply) AS days FROM rx_claims x JOIN ndc d ON x.ndc = d.ndc_code
  WHERE medication_list = 'AAB Antibiotic Medications' GROUP BY member_id, fromdate),
visits AS (SELECT DISTINCT member_id, fromdate FROM numbered WHERE {visit} AND {diag('Acute Bronchitis', version=None)}),
admissions AS (SELECT DISTINCT member_id, admitdate FROM numbered WHERE {code('revcode', 'Inpatient Stay')}),
negatives AS (SELECT DISTINCT member_id, fromdate FROM numbered WHERE {diag(NEGATIVE, version=None)}),
competitors AS (SELECT DISTINCT member_id, fromdate FROM numbered WHERE {diag(('Pharyngitis', 'Competing Diagnosis'), version=None)}),
flagged AS (SELECT v.member_id, v.fromdate,
    EXISTS (SELECT 1 FROM negatives n WHERE n.member_id = v.member_id AND n.fromdate BETWEEN v.fromdate - 365 AND v.fromdate) AS negative_condition,
    EXISTS (SELECT 1 FROM scripts n WHERE n.member_id = v.member_id AND n.fromdate BETWEEN v.fromdate - 30 AND v.fromdate - 1) AS recent_script,
    EXISTS (SELECT 1 FROM scripts n WHERE n.member_id = v.member_id AND n.fromdate < v.fromdate
      AND v.fromdate <= n.fromdate + CAST(n.days AS INTEGER)) AS active_supply,
    EXISTS (SELECT 1 FROM competitors n WHERE n.member_id = v.member_id AND n.fromdate BETWEEN v.fromdate - 30 AND v.fromdate + 7) AS competing_diagnosis
  FROM visits v WHERE v.fromdate BETWEEN DATE '1998-01-01' AND DATE '1998-12-24' AND NOT EXISTS
    (SELECT 1 FROM admissions a WHERE a.member_id = v.member_id AND a.admitdate BETWEEN v.fromdate AND v.fromdate + 1))"""


def _aab() -> str:
    return with_views(
        "member member_time diagnoses rx_claims ndc ref",
        f"""{aab_events()},
events AS (SELECT member_id, fromdate AS ev FROM flagged)
{_around('events', 'e.ev - 365', 'e.ev + 7')},
judged AS (SELECT f.member_id, f.fromdate, CASE WHEN negative_condition OR recent_script OR active_supply OR competing_diagnosis
    OR gap_count > 1 OR gap_days > 45 OR {age('1997-01-01', '365.25')} < 18 OR {age('1998-12-24', '365.25')} > 64
    THEN 0 ELSE 1 END AS good
  FROM flagged f JOIN gap_summary g ON g.member_id = f.member_id AND g.ev = f.fromdate JOIN member m ON m.member_id = f.member_id),
earliest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY member_id ORDER BY good DESC, fromdate) AS i FROM judged) WHERE i = 1)
{rate('AAB', "good = 1 AND NOT EXISTS (SELECT 1 FROM scripts s WHERE s.member_id = e.member_id "
      "AND s.fromdate BETWEEN e.fromdate AND e.fromdate + 3)", 'good = 1', 'earliest e')}""",
    )


def _statin_common(spans: str, first_last: str = "date_start >= DATE '1997-01-01' AND date_end <= DATE '1998-12-31'") -> str:
    inside = "fromdate >= DATE '1997-01-01' AND todate <= DATE '1998-12-31'"
    esrd = " OR ".join(
        [
            code("hcpcs", "ESRD", HCPCS), code("revcode", "ESRD", ["UBREV"]),
            code("pos", "ESRD", ["POS"]), diag("ESRD", ICD), proc("ESRD", PCS),
        ]
    )
    events = " OR ".join(
        [
            f"({code('revcode', 'Inpatient Stay')} AND {diag('MI')})",
            code("hcpcs", ("CABG", "PCI"), HCPCS), proc(("CABG", "PCI")),
            code("hcpcs", "Other Revascularization"),
        ]
    )
    return f"""{enrolled(f"{first_last} AND cover_medical = 'Y' AND cover_rx = 'Y' AND ({spans})")},
diabetic AS (SELECT member_id FROM numbered WHERE {inside} AND {diag('Diabetes')}
  UNION SELECT member_id FROM rx_claims x JOIN ndc d ON x.ndc = d.ndc_code
    WHERE medication_list = 'Diabetes Medications' AND year(fromdate) IN (1997, 1998)),
ivd_this AS (SELECT DISTINCT member_id FROM numbered WHERE fromdate >= DATE '1998-01-01' AND todate <= DATE '1998-12-31' AND {diag('IVD')}),
ivd_last AS (SELECT DISTINCT member_id FROM numbered WHERE fromdate >= DATE '1997-01-01' AND todate <= DATE '1997-12-31' AND {diag('IVD')}),
cardio AS (SELECT member_id FROM ivd_this INTERSECT SELECT member_id FROM ivd_last
  UNION SELECT member_id FROM numbered WHERE fromdate >= DATE '1997-01-01' AND todate <= DATE '1997-12-31' AND ({events})),
others AS (SELECT member_id FROM numbered WHERE year(fromdate) IN (1997, 1998) AND
    ((gender = 'F' AND {diag('Pregnancy')}) OR {code('hcpcs', 'IVF')} OR {diag(('Cirrhosis', 'Muscular Pain and Disease'))} OR {esrd})
  UNION SELECT member_id FROM rx_claims x JOIN ndc d ON x.ndc = d.ndc_code
    WHERE medication_list = 'Estrogen Agonists Medications' AND year(fromdate) IN (1997, 1998))"""


def _statin_rates(lists) -> str:
    return f""", fills AS (SELECT member_id, drug_id, fromdate, CAST(dayssupply AS INTEGER) AS days
  FROM rx_claims x JOIN ndc d ON x.ndc = d.ndc_code WHERE medication_list IN ({_list(lists)}) AND year(fromdate) = 1998
    AND dayssupply > 0 AND member_id IN (SELECT member_id FROM denom)),
treated AS (SELECT DISTINCT member_id FROM rx_claims x JOIN ndc d ON x.ndc = d.ndc_code
  WHERE medication_list IN ({_list(lists)}) AND year(fromdate) = 1998 AND member_id IN (SELECT member_id FROM denom))
{supply_days('fills')}"""


def _recursive(sql: str) -> str:
    return sql.replace("WITH ", "WITH RECURSIVE ", 1)


def _spd() -> str:
    return _recursive(
        with_views(
            "member member_time diagnoses procedures rx_claims ndc ref",
            f"""{_statin_common(f"{age('1998-12-31')} BETWEEN 40 AND 75")},
denom AS (SELECT member_id FROM enrolled WHERE member_id IN (SELECT member_id FROM diabetic)
  AND member_id NOT IN (SELECT member_id FROM cardio) AND member_id NOT IN (SELECT member_id FROM others))
{_statin_rates(['High and Moderate-Intensity Statin Medications', 'Low-Intensity Statin Medications'])}
{rate('SPD: Rate One', 'member_id IN (SELECT member_id FROM treated)', 'member_id IN (SELECT member_id FROM denom)')}
UNION ALL
{rate('SPD: Rate Two', 'member_id IN (SELECT member_id FROM adherence WHERE pdc > 0.8)', 'member_id IN (SELECT member_id FROM treated)')}""",
        )
    )


def _spc() -> str:
    one = "(CASE WHEN gender = 'M' THEN 'SPC: Rate One (Males 21-75)' ELSE 'SPC: Rate One (Females 40-75)' END)"
    two = "(CASE WHEN gender = 'F' THEN 'SPC: Rate Two (Females 40-75)' ELSE 'SPC: Rate Two (Males 21-75)' END)"
    treated, denom = "member_id IN (SELECT member_id FROM treated)", "member_id IN (SELECT member_id FROM denom)"
    adherent = "member_id IN (SELECT member_id FROM adherence WHERE pdc >= 0.8)"
    body = "\nUNION ALL\n".join(
        [
            rate(one, treated, denom),
            rate(two, adherent, treated),
            rate("SPC: Rate One (Total)", treated, denom),
            rate("SPC: Rate Two (Total)", adherent, treated),
        ]
    )
    a = age("1998-12-31")
    return _recursive(
        with_views(
            "member member_time diagnoses procedures rx_claims ndc ref",
            f"""{_statin_common(f"(gender = 'M' AND {a} BETWEEN 21 AND 75) OR (gender = 'F' AND {a} BETWEEN 40 AND 75)")},
denom AS (SELECT member_id FROM enrolled WHERE member_id IN (SELECT member_id FROM cardio)
  AND member_id NOT IN (SELECT member_id FROM others))
{_statin_rates(['High and Moderate-Intensity Statin Medications'])}
{body}""",
        )
    )


def _cdc() -> str:
    nonacute = ("Outpatient", "ED", "Nonacute Inpatient")
    retinal = "Diabetic Retinal Screening"
    kidney = " OR ".join(
        [
            code("hcpcs", ("Urine Protein Tests", "Nephropathy Treatment", "ESRD", "Kidney Transplant"), ("CPT", "CPT-CAT-II", "HCPCS")),
            code("revcode", ("ESRD", "Kidney Transplant"), ("UBREV", "UBTOB")),
            code("pos", "ESRD", ["POS"]),
            diag(("Nephropathy Treatment", "CKD Stage 4", "ESRD", "Kidney Transplant"), ICD),
            proc(("ESRD", "Kidney Transplant"), PCS),
            "specialty = '39'",
        ]
    )
    screened = f"{code('hcpcs', retinal)} AND specialty IN ('18', '41')"
    eye = " OR ".join(
        [
            f"({IN_1998} AND {screened})",
            f"(fromdate BETWEEN DATE '1997-01-01' AND DATE '1997-12-31' AND {screened} AND {diag('Diabetes Mellitus Without Complications')})",
            f"({IN_1998} AND {code('hcpcs', (retinal + ' With Eye Care Professional', retinal + ' Negative'))})",
            f"({IN_1998} AND {code('hcpcs', 'Unilateral Eye Enucleation')} AND (modifier = '50' OR modifier2 = '50'))",
        ]
    )
    left = f"SELECT member_id, fromdate FROM numbered WHERE {IN_1998} AND {proc('Unilateral Eye Enucleation Left')}"
    right = f"SELECT member_id FROM numbered WHERE {IN_1998} AND {proc('Unilateral Eye Enucleation Right')}"
    everyone = "TRUE"
    body = "\nUNION ALL\n".join(
        rate(name, f"member_id IN (SELECT member_id FROM {table})", everyone, "enrolled")
        for name, table in (("CDC: HBA1C", "tested"), ("CDC: EYE", "eyes"), ("CDC: NEP", "kidneys"))
    )
    return with_views(
        "member member_time diagnoses procedures rx_claims ndc ref",
        f""", diabetic AS (
  SELECT member_id FROM rx_claims x JOIN ndc d ON x.ndc = d.ndc_code WHERE medication_list = 'Diabetes Medications' AND {TWO_YEARS}
  UNION SELECT member_id FROM numbered WHERE {TWO_YEARS} AND {diag('Diabetes')}
    AND ({code('revcode', 'Acute Inpatient', ['UBREV'])} OR {code('hcpcs', 'Acute Inpatient', ['CPT'])})
  UNION (SELECT member_id FROM numbered WHERE {TWO_YEARS} AND {diag('Diabetes')}
    AND ({code('revcode', nonacute, ['UBREV'])} OR {code('hcpcs', nonacute, HCPCS)})
    GROUP BY member_id HAVING count(DISTINCT fromdate) >= 2))
{enrolled(f"date_start >= DATE '1998-01-01' AND date_end <= DATE '1998-12-31' AND cover_medical = 'Y' "
          f"AND {age('1998-12-31')} BETWEEN 18 AND 75 AND member_id IN (SELECT member_id FROM diabetic)")},
tested AS (SELECT member_id FROM numbered WHERE {IN_1998} AND {code('hcpcs', 'HbA1c Tests', ('CPT', 'CPT-CAT-II'))}),
kidneys AS (SELECT member_id FROM numbered WHERE {IN_1998} AND ({kidney})
  UNION SELECT member_id FROM rx_claims x JOIN ndc d ON x.ndc = d.ndc_code
    WHERE medication_list = 'ACE Inhibitor/ARB Medications' AND {IN_1998}),
lefts AS ({left}),
eyes AS (SELECT member_id FROM numbered WHERE {eye}
  UNION SELECT a.member_id FROM lefts a JOIN lefts b ON a.member_id = b.member_id AND b.fromdate - a.fromdate >= 14
  UNION (SELECT member_id FROM lefts INTERSECT {right}))
{body}""",
    )


def _mma() -> str:
    asthma = "row_id IN (SELECT row_id FROM diagnoses JOIN ref ON diag = code WHERE regexp_matches(value_set_name, 'Asthma'))"
    principal = (
        "row_id IN (SELECT n2.row_id FROM numbered n2 JOIN ref r ON n2.icddiag1 = r.code AND n2.icdversion = r.digits "
        "WHERE regexp_matches(value_set_name, 'Asthma'))"
    )
    excluded = (
        "row_id IN (SELECT row_id FROM diagnoses JOIN ref ON diag = code WHERE regexp_matches(value_set_name, "
        "'Emphysema|COPD|Obstructive Chronic Bronchitis|Chronic Respiratory Conditions|Cystic Fibrosis|Acute Respiratory Failure'))"
    )

    def visit(pattern: str) -> str:
        return (
            "revcode IN (SELECT code FROM ref WHERE code_system = 'UBREV' AND "
            f"regexp_matches(value_set_name, '{pattern}'))"
        )

    def special(year: int) -> str:
        return (
            f"SELECT member_id FROM rx WHERE year(fromdate) = {year} GROUP BY member_id "
            "HAVING count(DISTINCT description) = 2 AND bool_or(description = 'Leukotriene modifiers') "
            "AND bool_or(description = 'Antibody inhibitor')"
        )

    return _recursive(
        with_views(
            "member member_time diagnoses rx_claims ndc ref",
            f""", drugs AS (SELECT *, CASE WHEN description = 'Short-acting inhaled beta-2 agonists' THEN 'reliever' ELSE 'controller' END AS kind
  FROM ndc WHERE description IN ('Antiasthmatic combinations', 'Antibody inhibitor', 'Inhaled steroid combinations',
    'Inhaled corticosteroids', 'Leukotriene modifiers', 'Mast cell stabilizers', 'Methylxanthines', 'Short-acting inhaled beta-2 agonists')),
rx_raw AS (SELECT x.*, d.* FROM rx_claims x JOIN drugs d ON x.ndc = d.ndc_code),
oral AS (SELECT DISTINCT member_id, fromdate, dayssupply, drug_id, claimid, CAST(CASE WHEN dayssupply <= 30
    THEN round_even(dayssupply / 30, 0) ELSE floor(dayssupply / 30) END AS INTEGER) AS n FROM rx_raw WHERE route = 'oral'),
rx AS (
  SELECT r.member_id, r.ndc, r.fromdate, r.kind, r.drug_id, r.description, r.dayssupply FROM oral o
    JOIN (SELECT unnest(range(100)) AS i) g ON g.i < o.n JOIN rx_raw r USING (member_id, fromdate, dayssupply, drug_id, claimid)
  UNION ALL SELECT r.member_id, r.ndc, r.fromdate, r.kind, r.drug_id, r.description, r.dayssupply
    FROM (SELECT DISTINCT member_id, fromdate, drug_id FROM rx_raw WHERE route = 'inhalation') JOIN rx_raw r USING (member_id, fromdate, drug_id)
  UNION ALL SELECT member_id, ndc, fromdate, kind, drug_id, description, dayssupply
    FROM (SELECT DISTINCT * FROM rx_raw WHERE route = 'subcutaneous')),
people AS (SELECT DISTINCT member_id FROM member JOIN member_time USING (member_id)
  WHERE abs(year(dob) - 1998) BETWEEN 5 AND 64 AND cover_medical = 'Y'),
spans AS (SELECT member_id, date_start, date_end FROM member_time WHERE cover_medical = 'Y'
    AND date_end >= DATE '1998-01-01' AND date_start <= DATE '1998-12-31' AND member_id IN (SELECT member_id FROM people)
  UNION ALL SELECT member_id, DATE '1997-12-31', DATE '1997-12-31' FROM people
  UNION ALL SELECT member_id, DATE '1999-01-01', DATE '1999-01-01' FROM people),
gaps AS ({holes('spans')}),
excluded AS (SELECT member_id FROM gaps GROUP BY member_id HAVING max(he - hs + 1) >= 45 AND count(*) > 1
  UNION SELECT member_id FROM numbered WHERE fromdate <= DATE '1998-12-31' AND {excluded}
  UNION (SELECT member_id FROM rx WHERE {TWO_YEARS} GROUP BY member_id HAVING NOT bool_or(kind = 'controller'))),
events AS (SELECT DISTINCT member_id, ndc, fromdate, kind FROM rx),
counted AS (SELECT member_id, count(*) AS n FROM events GROUP BY member_id),
visits AS (SELECT DISTINCT member_id, fromdate FROM numbered WHERE {asthma} AND {visit('Outpatient|Observation')}),
med AS (SELECT DISTINCT member_id FROM numbered WHERE {asthma}
  AND ({visit('Outpatient|Observation|Acute Inpatient')} OR {visit(chr(92) + 'bED' + chr(92) + 'b')})),
persistent AS (SELECT member_id FROM numbered WHERE {principal}
    AND ({visit('Acute Inpatient')} OR {visit(chr(92) + 'bED' + chr(92) + 'b')})
  UNION (SELECT member_id FROM visits GROUP BY member_id HAVING count(*) >= 4
    INTERSECT SELECT member_id FROM counted WHERE n >= 2)
  UNION SELECT member_id FROM counted WHERE n >= 4
  UNION (SELECT member_id FROM rx WHERE member_id IN ({special(1997)} UNION {special(1998)})
    AND member_id IN (SELECT member_id FROM med) GROUP BY member_id HAVING count(*) >= 4)),
kept AS (SELECT member_id FROM people WHERE member_id IN (SELECT member_id FROM persistent)
  AND member_id NOT IN (SELECT member_id FROM excluded)),
fills AS (SELECT rx.member_id, rx.drug_id, rx.fromdate, CAST(rx.dayssupply AS INTEGER) AS days FROM rx
  JOIN rx_claims c ON c.member_id = rx.member_id AND c.ndc = rx.ndc AND c.fromdate = rx.fromdate AND c.dayssupply = rx.dayssupply
  WHERE rx.kind = 'controller' AND rx.dayssupply > 0 AND rx.fromdate BETWEEN DATE '1997-12-31' AND DATE '1998-12-31'
    AND rx.member_id IN (SELECT member_id FROM kept))
{supply_days('fills')},
denom AS (SELECT member_id FROM kept WHERE member_id IN (SELECT member_id FROM rx) AND member_id IN (SELECT member_id FROM med)),
numer AS (SELECT member_id FROM adherence WHERE pdc >= 0.75),
both_sides AS (SELECT member_id FROM denom UNION SELECT member_id FROM numer)
{rate('MMA', 'member_id IN (SELECT member_id FROM numer)', 'member_id IN (SELECT member_id FROM denom)', 'both_sides')}""",
        )
    )


def _cis() -> str:
    def doses(name: str, days: int, count: int) -> str:
        return (
            f"SELECT member_id FROM shots WHERE value_set_name = '{name}' AND fromdate - dob >= {days} "
            f"GROUP BY member_id HAVING count(DISTINCT fromdate) >= {count}"
        )

    def history(name: str) -> str:
        return f"SELECT member_id FROM histories WHERE value_set_name = '{name}'"

    rota_2 = "Rotavirus Vaccine (2 Dose Schedule) Administered"
    rota_3 = "Rotavirus Vaccine (3 Dose Schedule) Administered"
    mumps = f"({doses('Mumps Vaccine Administered', 0, 1)} UNION {history('Mumps')})"
    numerators = {
        "CIS - DTaP": doses("DTaP Vaccine Administered", 42, 4),
        "CIS - IPV": doses("Inactivated Polio Vaccine (IPV) Administered", 42, 3),
        "CIS - HiB": doses("Haemophilus Influenzae Type B (HiB) Vaccine Administered", 42, 3),
        "CIS - Pneumococcal Conjugate": doses("Pneumococcal Conjugate Vaccine Administered", 42, 4),
        "CIS - Influenza": doses("Influenza Vaccine Administered", 180, 2),
        # The extra dose is given to everybody who has a count.
        "CIS - Hepatitis B": f"{doses('Hepatitis B Vaccine Administered', 0, 2)} UNION {history('Hepatitis B')}",
        "CIS - Hepatitis A": f"{doses('Hepatitis A Vaccine Administered', 0, 1)} UNION {history('Hepatitis A')}",
        "CIS - VZV": f"{doses('Varicella Zoster (VZV) Vaccine Administered', 0, 1)} UNION {history('Varicella Zoster')}",
        "CIS - Rotavirus": f"{doses(rota_2, 42, 2)} UNION {doses(rota_3, 42, 3)} UNION "
        f"({doses(rota_2, 42, 1)} INTERSECT {doses(rota_3, 42, 2)})",
        "CIS - MMR": f"{doses('Measles, Mumps and Rubella (MMR) Vaccine Administered', 0, 1)} UNION "
        f"({doses('Measles/Rubella Vaccine Administered', 0, 1)} INTERSECT {mumps}) UNION "
        f"(({doses('Measles Vaccine Administered', 0, 1)} UNION {history('Measles')}) INTERSECT {mumps} "
        f"INTERSECT ({doses('Rubella Vaccine Administered', 0, 1)} UNION {history('Rubella')}))",
    }
    body = "\nUNION ALL\n".join(
        rate(name, f"member_id IN ({met})", "member_id IN (SELECT member_id FROM eligible)")
        for name, met in numerators.items()
    )
    return with_views(
        "member member_time diagnoses ref",
        f""", spans AS (SELECT member_id, date_start, date_end FROM member_time JOIN member USING (member_id)
  WHERE cover_medical = 'Y' AND dob + 730 BETWEEN DATE '1998-01-01' AND DATE '1998-12-31'),
gaps AS ({holes('spans')}),
gapped AS (SELECT member_id FROM gaps JOIN member USING (member_id) GROUP BY member_id
  HAVING count(*) > 1 OR bool_or(hs BETWEEN dob - 365 AND dob AND he - hs >= 45)),
eligible AS (SELECT DISTINCT member_id FROM spans WHERE member_id IN (SELECT member_id FROM gapped)),
eligible_claims AS (SELECT c.* FROM numbered c JOIN eligible USING (member_id) WHERE c.fromdate <= c.dob + 730),
shots AS (SELECT member_id, dob, fromdate, value_set_name FROM eligible_claims JOIN ref ON hcpcs = code),
histories AS (SELECT member_id, value_set_name FROM eligible_claims JOIN diagnoses USING (row_id) JOIN ref ON diag = code AND icdversion = digits)
{body}""",
    )


def _awv() -> str:
    def variant(name: str, sets, first: str, last: str, paid: str) -> str:
        until = min(last, paid)
        refs = f"(SELECT * FROM wells WHERE value_set_name IN ({_list(sets)}))"
        return f"""SELECT member_id, '{name}' AS comp_quality_short,
  CAST(CASE WHEN last_visit IS NULL THEN 0 ELSE 1 END AS INTEGER) AS comp_quality_numerator,
  CAST(CASE WHEN excluded THEN 0 ELSE 1 END AS INTEGER) AS comp_quality_denominator,
  CAST(last_visit AS VARCHAR) AS comp_quality_date_last,
  CASE WHEN last_visit IS NULL AND NOT excluded THEN '{last}' END AS comp_quality_date_actionable,
  CASE WHEN excluded THEN 'Member is excluded due to gaps in eligibility'
       WHEN last_visit IS NOT NULL THEN 'Most Recent Service: ' || strftime(last_visit, '%m/%d/%Y')
       ELSE 'No related services observed since: ' || strftime(DATE '{first}', '%m/%d/%Y') END AS comp_quality_comments
FROM (SELECT p.member_id, excluded, (SELECT max(fromdate) FROM numbered c WHERE c.member_id = p.member_id AND NOT excluded
    AND fromdate BETWEEN DATE '{first}' AND DATE '{last}'
    AND (hcpcs IN (SELECT code FROM {refs} WHERE code_system IN ('CPT', 'HCPCS'))
      OR row_id IN (SELECT d.row_id FROM diagnoses d JOIN numbered n2 USING (row_id) JOIN {refs} r
        ON d.diag = r.code AND n2.icdversion = r.padded AND r.code_system IN ('ICD9CM', 'ICD10CM')))) AS last_visit
  FROM (SELECT q.member_id, coalesce(max(he - hs + 1) > 45, FALSE) OR count(hs) > 1 AS excluded FROM people q
    LEFT JOIN ({holes(f'''(SELECT member_id, date_start, date_end FROM covered WHERE date_end >= DATE '{first}' AND date_start <= DATE '{until}'
      UNION ALL SELECT member_id, DATE '{first}' - 1, DATE '{first}' - 1 FROM people
      UNION ALL SELECT member_id, DATE '{until}' + 1, DATE '{until}' + 1 FROM people)''')}) USING (member_id) GROUP BY q.member_id) p)"""

    whole, medicare = ("Well-Care", "Well-Care-Custom"), ("Well-Care-Custom",)
    year, rolling, paid = ("1998-01-01", "1998-12-31"), ("1997-09-30", "1998-09-30"), "1998-09-30"
    return with_views(
        "member member_time diagnoses ref reference_awv",
        """, covered AS (SELECT DISTINCT member_id, date_start, date_end FROM member_time WHERE cover_medical = 'Y'),
people AS (SELECT DISTINCT member_id FROM covered JOIN member USING (member_id)),
wells AS (SELECT value_set_name, code, code_system, padded FROM ref WHERE value_set_name = 'Well-Care'
  UNION ALL SELECT value_set_name, code, code_system, NULL FROM reference_awv)
"""
        + "\nUNION ALL\n".join(
            [
                variant("AWV: Combined", whole, *year, "1998-12-31"),
                variant("AWV: Combined Rolling", whole, *rolling, paid),
                variant("AWV: Medicare", medicare, *year, paid),
                variant("AWV: Medicare Rolling", medicare, *rolling, paid),
            ]
        ),
    )


def measure_sql() -> dict[str, str]:
    return {
        "measure_pcp_7": _pcp(7),
        "measure_pcp_14": _pcp(14),
        "measure_mpm3": _mpm(),
        "measure_pbh": _pbh(),
        "measure_pcr": _pcr(),
        "measure_aab": _aab(),
        "measure_spd": _spd(),
        "measure_spc": _spc(),
        "measure_cdc": _cdc(),
        "measure_mma": _mma(),
        "measure_cis": _cis(),
        "measure_awv": _awv(),
    }
