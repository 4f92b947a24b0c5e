"""Helpers for coded columns."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def strip_dots(code: Column | str) -> Column:
    """Codes are matched without dots (``Z00.00`` is stored as ``Z0000``)."""
    return F.replace(F.col(code) if isinstance(code, str) else code, F.lit("."), F.lit(""))


def icd_version(code_system: Column | str, style: str = "icd") -> Column:
    """ICD version named by a code system.

    ``icd``: the digits as written, ICD systems only (``ICD9CM`` gives ``9``);
    ``padded``: ``09`` for ICD-9 and ``10`` for every other ICD system;
    ``digits``: the first digits of any system name.
    """
    system = F.col(code_system) if isinstance(code_system, str) else code_system
    digits = F.regexp_extract(system, r"\d+", 0)
    if style == "digits":
        return digits
    if style == "padded":
        digits = F.when(system.startswith("ICD9"), "09").otherwise("10")
    elif style != "icd":
        raise ValueError(f"unknown version style {style!r}")
    return F.when(system.contains("ICD"), digits)


def code_columns(df: DataFrame, stem: str) -> list[str]:
    """Numbered columns of one code family (``icddiag1``, ``icddiag2``, …) in order."""
    numbered = [
        (int(found.group(1)), name)
        for name in df.columns
        if (found := re.fullmatch(rf"{re.escape(stem)}(\d+)", name))
    ]
    return [name for _, name in sorted(numbered)]
