"""Angles on the sky."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def angular_separation(ra_1: Column, dec_1: Column, ra_2: Column, dec_2: Column) -> Column:
    """Great-circle distance in degrees by the law of cosines.

    Rounding can push the cosine past either end, where the angle is undefined.
    """
    cosine = F.sin(F.radians(dec_1)) * F.sin(F.radians(dec_2)) + F.cos(F.radians(dec_1)) * F.cos(
        F.radians(dec_2)
    ) * F.cos(F.radians(ra_1 - ra_2))
    return F.degrees(F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cosine))))
