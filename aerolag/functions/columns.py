"""Scalar expressions of the feature tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def hhmm_hour(hhmm: Column) -> Column:
    """Hour of an HHMM integer. 2400 is hour 24, NULL stays NULL."""
    return F.floor(hhmm / 100).cast("int")


def member_flag(value: Column, members: Iterable[int]) -> Column:
    """1 where ``value`` is one of ``members``, else 0; NULL gives 0."""
    return F.when(value.isin(list(members)), 1).otherwise(0)


def positive_flag(value: Column) -> Column:
    """1 where ``value`` is above zero, else 0; NULL gives 0."""
    return F.when(value > 0, 1).otherwise(0)


def pair_diff(left: Column, right: Column) -> Column:
    """``left - right`` as a double."""
    return (left - right).cast("double")


def total_delay(departure: Column, arrival: Column) -> Column:
    """Sum of both delays as a double; may be negative, NULL if either is."""
    return departure.cast("double") + arrival.cast("double")


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` as a double, 0 where ``whole`` is 0."""
    return F.when(whole == 0, F.lit(0.0)).otherwise(part.cast("double") / whole)


def hash_percent(seed: int, *key: Column) -> Column:
    """A number 0..99 that depends on the seed and the row's key only."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *key))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % 100
