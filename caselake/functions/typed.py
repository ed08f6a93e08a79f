"""Casts that never raise, and features derived from typed columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from caselake import constants as K


def parse_date(text: Column, fmt: str = K.DATE_FORMAT) -> Column:
    return F.try_to_date(text, fmt)


def days_between(start: Column, end: Column) -> Column:
    return F.datediff(end, start)


def bucketize(value: Column, bounds: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the first bound that ``value`` is below; NULL gets the last label."""
    if len(labels) != len(bounds) + 1:
        raise ValueError("bucketize needs one label more than bounds")
    label = F.lit(labels[-1])
    for bound, below in reversed(list(zip(bounds, labels))):
        label = F.when(value < F.lit(bound), F.lit(below)).otherwise(label)
    return label
