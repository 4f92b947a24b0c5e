"""Measure plans."""

from caregauge.plans.aab import AAB
from caregauge.plans.awv import AWV, wellness_results
from caregauge.plans.base import QualityMeasure
from caregauge.plans.batch import run_batch
from caregauge.plans.cdc import CDC
from caregauge.plans.cis import CIS
from caregauge.plans.mma import MMA
from caregauge.plans.mpm import MPM3
from caregauge.plans.pbh import PBH
from caregauge.plans.pcp import PCPFollowup
from caregauge.plans.pcr import PCR
from caregauge.plans.run import run_all
from caregauge.plans.spc import SPC
from caregauge.plans.spd import SPD

__all__ = [
    "AAB", "AWV", "CDC", "CIS", "MMA", "MPM3", "PBH", "PCPFollowup", "PCR", "QualityMeasure",
    "SPC", "SPD", "run_all", "run_batch", "wellness_results",
]
