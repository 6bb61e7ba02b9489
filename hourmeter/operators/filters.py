"""Optional-filter helpers: a filter is added to the plan only when it is given."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourmeter.functions import exprs as X


def date_range(df: DataFrame, col: str, date_from=None, date_to=None) -> DataFrame:
    if date_from is not None:
        df = df.where(F.col(col) >= F.lit(date_from).cast("date"))
    if date_to is not None:
        df = df.where(F.col(col) <= F.lit(date_to).cast("date"))
    return df


def text_equals_ci(df: DataFrame, col: str, value: str | None) -> DataFrame:
    """lower(col) = lower(trim(value)) when value is not blank."""
    if X.blank(value):
        return df
    return df.where(F.lower(F.col(col)) == value.strip().lower())


def machine_type_is(df: DataFrame, col: str, value: str | None) -> DataFrame:
    norm = X.norm_machine_type_param(value)
    return df if norm is None else df.where(F.col(col) == norm)


def ref_is(df: DataFrame, col: str, value: str | None) -> DataFrame:
    return df if X.blank(value) else df.where(F.col(col) == value.strip().upper())
