"""Enum expressions: allow-list clamp and the road-surface rule."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from roadlake.schemas import FREEZING_F, NO_PRECIP_WORDS


def clamp_enum(c: Column, allowed, default: str) -> Column:
    """Keep ``c`` when it is one of ``allowed`` (case-sensitive), else
    ``default``; null also becomes the default."""
    return F.when(c.isin(*allowed), c).otherwise(F.lit(default))


def surface_status(precip: Column, pavement_f: Column) -> Column:
    """Road surface from precipitation text and pavement temperature:
    no precipitation -> dry; else pavement <= 32 F -> icy; else wet."""
    p = F.lower(F.coalesce(precip, F.lit("")))
    return (F.when(p.isin(*NO_PRECIP_WORDS), F.lit("dry"))
            .when(pavement_f <= FREEZING_F, F.lit("icy"))
            .otherwise(F.lit("wet")))
