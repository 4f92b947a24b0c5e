"""All measures at once."""

from __future__ import annotations

import datetime
from collections import ChainMap
from collections.abc import Callable, Mapping
from functools import reduce
from operator import or_
from typing import TypeVar

from pyspark.sql import DataFrame

from caregauge.operators.output import combine_results
from caregauge.operators.valuesets import SharedTags
from caregauge.plans.aab import AAB
from caregauge.plans.awv import reported_variants, visits_needed, wellness_results
from caregauge.plans.base import QualityMeasure
from caregauge.plans.cdc import CDC
from caregauge.plans.cis import CIS
from caregauge.plans.common import COUNTED_FILLS, SHARED_FILLS, SHARED_TAGS, listed_fills
from caregauge.plans.mma import MMA
from caregauge.plans.mpm import MPM3
from caregauge.plans.pbh import PBH
from caregauge.plans.pcp import PCPFollowup
from caregauge.plans.pcr import PCR
from caregauge.plans.spc import SPC
from caregauge.plans.spd import SPD
from caregauge.sources.scratch import shuffles_dropped, stored
from caregauge.sources.tables import table

T = TypeVar("T")
# Reported follow-up cutoffs in days.
FOLLOW_UP_CUTOFFS = (7, 14)
ANNUAL_MEASURES = (MPM3, PBH, PCR, AAB, SPD, SPC, CDC, MMA, CIS)


def shared_inputs(
    dfs_input: Mapping[str, DataFrame],
    performance_yearstart: datetime.date,
    date_latestpaid: datetime.date,
) -> Mapping[str, DataFrame]:
    """The input tables, and what all measures read of claims and fills from one pass each.

    Claims are tagged once with the rules of all measures, fills meet the drug list once; both are
    written to the shared scratch folder, where each measure reads its rows. So are the counted asthma
    fills. The writes come one after the other, so that the shuffles of one are gone when the next begins.
    """
    measures = [measure() for measure in ANNUAL_MEASURES]
    needs = [m.claims_needed(dfs_input, performance_yearstart) for m in measures]
    variants = reported_variants(performance_yearstart, date_latestpaid)
    needs.append(visits_needed(dfs_input, variants))
    claims = table(dfs_input, "claims")
    chosen = [need for m in measures for need in m.fills_needed(performance_yearstart)]
    some_drug = reduce(or_, [need.chosen for need in chosen])
    fills = listed_fills(table(dfs_input, "rx_claims"), table(dfs_input, "ndc"), some_drug)
    fills = fills.where(reduce(or_, [need.condition for need in chosen]))
    with shuffles_dropped(claims.sparkSession):
        inputs = ChainMap({SHARED_FILLS: stored(fills, "drug-fills")}, dfs_input)
        inputs[COUNTED_FILLS] = stored(MMA().counted_fills(inputs), "counted-fills")
        inputs[SHARED_TAGS] = SharedTags(claims, [need for need in needs if need is not None]).stored()
    return inputs


def measure_calls(
    performance_yearstart: datetime.date,
    date_latestpaid: datetime.date,
    follow_up: Mapping[str, object] | None = None,
) -> Mapping[str, Callable[[Mapping[str, DataFrame]], DataFrame]]:
    """What makes the result of every measure out of the input tables, by name.

    ``follow_up``: ``source`` and ``columns`` of the follow-up measure.
    """
    py = performance_yearstart

    def annual(measure: type[QualityMeasure]):
        return lambda inputs: measure().calc_measure(inputs, py)

    def follow(cutoff: int):
        return lambda inputs: PCPFollowup().calc_measure(inputs, py, cutoff=cutoff, **(follow_up or {}))

    return {
        **{measure.__name__: annual(measure) for measure in ANNUAL_MEASURES},
        **{f"PCP{cutoff}": follow(cutoff) for cutoff in FOLLOW_UP_CUTOFFS},
        "AWV": lambda inputs: wellness_results(inputs, py, date_latestpaid),
    }


def of_each(results: Mapping[str, DataFrame], write: Callable[[str, DataFrame], T]) -> list[T]:
    """What ``write(name, result)`` returns for each measure. One runs at a time, and its shuffles are gone
    when the next begins, so that the disk holds those of one measure only."""
    with shuffles_dropped(next(iter(results.values())).sparkSession):
        return [write(name, result) for name, result in results.items()]


def measure_results(
    dfs_input: Mapping[str, DataFrame],
    performance_yearstart: datetime.date,
    date_latestpaid: datetime.date,
    follow_up: Mapping[str, object] | None = None,
) -> Mapping[str, DataFrame]:
    """Lazy result of every measure by name, over claims and fills that were read once."""
    inputs = shared_inputs(dfs_input, performance_yearstart, date_latestpaid)
    calls = measure_calls(performance_yearstart, date_latestpaid, follow_up)
    return {name: call(inputs) for name, call in calls.items()}


def run_all(
    dfs_input: Mapping[str, DataFrame],
    performance_yearstart: datetime.date,
    date_latestpaid: datetime.date,
    follow_up: Mapping[str, object] | None = None,
) -> DataFrame:
    """One stacked result of all measures, rows with a denominator only.

    Each measure is written to the shared scratch folder by jobs of its own: in one plan, Spark
    runs a partition of every measure in one task, whose memory is then the sum of all.
    ``run_batch`` does the same and can be started again.
    """
    results = measure_results(dfs_input, performance_yearstart, date_latestpaid, follow_up)
    return combine_results(of_each(results, lambda name, result: stored(result, f"rows-{name}")))
