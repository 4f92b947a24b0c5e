"""Contract of a measure."""

from __future__ import annotations

import datetime
from abc import ABC, abstractmethod
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame

from caregauge.operators.output import check_result
from caregauge.operators.valuesets import ClaimNeed
from caregauge.plans.common import FillNeed


class QualityMeasure(ABC):
    """A measure turns named input tables into result rows per member.

    Subclasses implement ``_calc_measure``. Results are lazy DataFrames; their
    columns are checked without reading any data.

    ``fixes`` names known defects of the published behaviour to repair (see
    ``FIXES`` of each measure); none is repaired unless asked for.
    """

    FIXES: frozenset[str] = frozenset()

    def __init__(self, fixes: Iterable[str] = ()) -> None:
        self.key_fields = ["member_id"]
        self.fixes = frozenset(fixes)
        unknown = self.fixes - self.FIXES
        if unknown:
            raise ValueError(f"{type(self).__name__} has no fixes named {sorted(unknown)}")

    def claims_needed(
        self, dfs_input: Mapping[str, DataFrame], performance_yearstart: datetime.date
    ) -> ClaimNeed | None:
        """The tagged claim rows that the measure reads, so that measures can share a pass."""
        return None

    def fills_needed(self, performance_yearstart: datetime.date) -> list[FillNeed]:
        """The pharmacy fills that the measure reads."""
        return []

    @abstractmethod
    def _calc_measure(
        self,
        dfs_input: Mapping[str, DataFrame],
        performance_yearstart: datetime.date,
        **kwargs: object,
    ) -> DataFrame:
        """Build the result plan."""

    def calc_measure(
        self,
        dfs_input: Mapping[str, DataFrame],
        performance_yearstart: datetime.date,
        **kwargs: object,
    ) -> DataFrame:
        """Result plan of the measure, checked against the output contract."""
        result = self._calc_measure(dfs_input, performance_yearstart, **kwargs)
        return check_result(result, self.key_fields)
