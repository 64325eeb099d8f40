"""Interval expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def overlap(a_start: Column, a_end: Column, b_start: Column, b_end: Column) -> Column:
    return F.least(a_end, b_end) - F.greatest(a_start, b_start)


def iou(a_start: Column, a_end: Column, b_start: Column, b_end: Column) -> Column:
    """Intersection over union of two intervals, 0 when they do not overlap."""
    shared = overlap(a_start, a_end, b_start, b_end)
    union = (a_end - a_start) + (b_end - b_start) - shared
    return F.when(shared > 0, shared / union).otherwise(F.lit(0.0))
