"""Column helpers: null fill (P12, P13), casts (P14), feature selection (P15),
safe division (DAX ``DIVIDE``)."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEY_COLUMNS = ("CUST_NUM", "YEAR", "MONTH")


def fill_missing_numeric(df: DataFrame, value: int = -1) -> DataFrame:
    """Nulls of every numeric column become ``value``; strings keep null."""
    return df.fillna(value)


def cast_features(df: DataFrame, feature_cols: Sequence[str]) -> DataFrame:
    """Cast the features to double in one projection."""
    feats = set(feature_cols)
    return df.select(*[F.col(c).cast("double").alias(c) if c in feats else F.col(c) for c in df.columns])


def feature_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Numeric columns minus keys and targets, in frame order."""
    drop = set(KEY_COLUMNS) | set(exclude)
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in drop]


def safe_div(num: Column, den: Column, alternate: Column | float | None = None) -> Column:
    """``DIVIDE(num, den, alternate)``: null (or ``alternate``) when den is 0 or null."""
    q = F.when(den != 0, num.cast("double") / den.cast("double"))
    if alternate is None:
        return q
    alt = alternate if isinstance(alternate, Column) else F.lit(float(alternate))
    return F.coalesce(q, alt)
