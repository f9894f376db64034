"""Measures of one query's predicted set against its true set."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _cases(true_n: Column, pred_n: Column, value: Column) -> Column:
    """1 if both are empty, 0 if one is, else value."""
    return F.when((true_n == 0) & (pred_n == 0), 1.0).when((true_n == 0) | (pred_n == 0), 0.0).otherwise(value)


def precision(true_n: Column, pred_n: Column, common: Column) -> Column:
    return _cases(true_n, pred_n, common / pred_n)


def recall(true_n: Column, pred_n: Column, common: Column) -> Column:
    return _cases(true_n, pred_n, common / true_n)


def f_half(true_n: Column, pred_n: Column, common: Column) -> Column:
    """F-measure with beta 0.5: 1.25 P R / (0.25 P + R) = 1.25 common / (0.25 true + predicted)."""
    return _cases(true_n, pred_n, 1.25 * common / (0.25 * true_n + pred_n))


def ratio_or_nan(part: Column, whole: Column) -> Column:
    return F.when(whole == 0, F.lit(float("nan"))).otherwise(part / whole)
