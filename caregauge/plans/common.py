"""Steps that several measures share."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caregauge.operators.valuesets import ClaimNeed, CodeRule
from caregauge.sources.tables import table

HCPCS = ("CPT", "HCPCS")


#: Names under which shared passes stand among the input tables.
SHARED_TAGS, SHARED_FILLS = "shared tagged claims", "shared fills"
#: The asthma fills as counted for ``MMA``, which reads them twice.
COUNTED_FILLS = "counted asthma fills"
LISTED = "_listed"


def tagged_claims(dfs_input: Mapping[str, DataFrame], need: ClaimNeed) -> DataFrame:
    """Rows of ``need``: out of a shared pass if there is one, else from a pass of its own."""
    if SHARED_TAGS in dfs_input:
        return dfs_input[SHARED_TAGS].rows(need)
    return need.tag(table(dfs_input, "claims"))


@dataclass(frozen=True, eq=False)
class FillNeed:
    """Fills of the drugs that ``chosen`` selects from the drug list, of those that ``rows`` keeps."""

    chosen: Column
    rows: Column | None = None

    @property
    def condition(self) -> Column:
        return self.chosen if self.rows is None else self.chosen & self.rows


def listed_fills(rx_claims: DataFrame, ndc: DataFrame, chosen: Column) -> DataFrame:
    """Fills with each different row of the drug list once; ``_listed``: how often it stands there."""
    listed = ndc.where(chosen).groupBy(*ndc.columns).agg(F.count("*").alias(LISTED))
    clashing = set(rx_claims.columns) & set(ndc.columns) - {"ndc_code"}
    return rx_claims.join(listed.drop(*clashing), F.col("ndc") == F.col("ndc_code"))


def drug_fills(dfs_input: Mapping[str, DataFrame], need: FillNeed) -> DataFrame:
    """Fills of ``need``, one row for each row of the drug list that names their code."""
    if SHARED_FILLS in dfs_input:
        rows = dfs_input[SHARED_FILLS].where(need.condition)
        return rows.withColumn(LISTED, F.explode(F.sequence(F.lit(1).cast("long"), LISTED))).drop(LISTED)
    rx_claims = table(dfs_input, "rx_claims")
    if need.rows is not None:
        rx_claims = rx_claims.where(need.rows)
    return fills_of(rx_claims, table(dfs_input, "ndc"), need.chosen)


def drug_list_fills(dfs_input: Mapping[str, DataFrame], need: FillNeed) -> DataFrame:
    """As ``listed_fills``, out of a shared pass if there is one."""
    if SHARED_FILLS in dfs_input:
        return dfs_input[SHARED_FILLS].where(need.condition)
    rx_claims = table(dfs_input, "rx_claims")
    if need.rows is not None:
        rx_claims = rx_claims.where(need.rows)
    return listed_fills(rx_claims, table(dfs_input, "ndc"), need.chosen)


def fills_of(rx_claims: DataFrame, ndc: DataFrame, chosen: Column) -> DataFrame:
    """Pharmacy fills of the drugs that ``chosen`` selects from the drug list."""
    return rx_claims.join(
        ndc.where(chosen), rx_claims["ndc"] == ndc["ndc_code"], "inner"
    )


def on_list(*medication_lists: str) -> Column:
    return F.col("medication_list").isin(*medication_lists)


def member_flags(rows: DataFrame, flags: Mapping[str, Column]) -> DataFrame:
    """Any-row flags per member in one map-side combined aggregate."""
    return rows.groupBy("member_id").agg(
        *[F.bool_or(condition).alias(name) for name, condition in flags.items()]
    )


def two_or_more(*values: Column) -> Column:
    """Aggregate: at least two distinct non-null combinations of the values.

    There are two exactly when some value's smallest and largest differ, so no distinct
    set is kept per group, and plain dates and numbers need no sorted rows as structs would.
    """
    whole = reduce(and_, [value.isNotNull() for value in values])
    present = [F.when(whole, value) for value in values]
    return F.coalesce(reduce(or_, [F.min(p) != F.max(p) for p in present]), F.lit(False))


def flag(name: str) -> Column:
    """A joined flag, false where the join found nothing."""
    return F.coalesce(F.col(name), F.lit(False))


def attach(members: DataFrame, *sides: DataFrame) -> DataFrame:
    """Left-join member-level tables (one row per member each)."""
    for side in sides:
        members = members.join(side, "member_id", "left")
    return members


def marked(members: DataFrame, name: str) -> DataFrame:
    """Distinct member ids with a true flag column ``name``."""
    return members.select("member_id").distinct().withColumn(name, F.lit(True))


def visit_rules(
    tag: str, hcpcs_sets: Sequence[str], revcode_sets: Sequence[str], hcpcs_systems=HCPCS
) -> list[CodeRule]:
    """A visit recognised by procedure code or by revenue code."""
    return [
        CodeRule(tag, "hcpcs", tuple(hcpcs_sets), tuple(hcpcs_systems)),
        CodeRule(tag, "revcode", tuple(revcode_sets), ("UBREV",)),
    ]
