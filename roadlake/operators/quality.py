"""Run quality: one-pass metrics, non-empty guard, quarantine counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


class EmptyOutputError(RuntimeError):
    """A clean job produced no rows (upstream delivered nothing usable)."""


def observe_clean(df: DataFrame, name: str = "clean") -> tuple[DataFrame, Observation]:
    """Attach metrics that are filled in by the next action on ``df`` (e.g.
    the write), so counting costs no extra pass: rows, rows without a day,
    distinct-free min/max day."""
    obs = Observation(name)
    m = df.observe(obs,
                   F.count(F.lit(1)).alias("out_rows"),
                   F.count_if(F.col("dt").isNull()).alias("null_dt_rows"),
                   F.min("dt").alias("min_dt"), F.max("dt").alias("max_dt"))
    return m, obs


def require_rows(df: DataFrame, what: str = "clean output") -> DataFrame:
    """Raise before anything is written when ``df`` is empty.  ``isEmpty``
    stops at the first row found, so the check is cheap at any size."""
    if df.isEmpty():
        raise EmptyOutputError(f"{what} produced 0 rows - check the landing files")
    return df


def landing_metrics(parsed: DataFrame, ts_col: str | None = "ts") -> DataFrame:
    """One-row metrics of parsed landing lines (from
    :func:`roadlake.operators.clean.parse_landing`): lines, malformed lines,
    records with a null or zero epoch."""
    aggs = [F.count(F.lit(1)).alias("raw_lines"),
            F.count_if(F.col("_malformed")).alias("malformed_lines")]
    if ts_col:
        aggs.append(F.count_if(~F.col("_malformed") &
                               (F.col(ts_col).isNull() | (F.col(ts_col) == 0)))
                    .alias("null_ts_rows"))
    return parsed.agg(*aggs)


def clean_run_metrics(flagged: DataFrame, ts_col: str | None = "ts",
                      day_col: str = "dt") -> DataFrame:
    """All run metrics in one aggregation over clean rows that still carry
    their malformed lines (``clean_*(..., flag_malformed=True)``): lines,
    malformed lines, records with a null/zero epoch, output rows, rows
    without a day, distinct days, first and last day."""
    ok = ~F.col("_malformed")
    okday = F.when(ok, F.col(day_col))
    aggs = [F.count(F.lit(1)).alias("raw_lines"),
            F.count_if(F.col("_malformed")).alias("malformed_lines")]
    if ts_col:
        aggs.append(F.count_if(ok & (F.col(ts_col).isNull() | (F.col(ts_col) == 0)))
                    .alias("null_ts_rows"))
    aggs += [F.count_if(ok).alias("rows"),
             F.count_if(ok & F.col(day_col).isNull()).alias("null_day_rows"),
             F.count_distinct(okday).alias("distinct_days"),
             F.min(okday).alias("first_day"), F.max(okday).alias("last_day")]
    return flagged.agg(*aggs)


def table_metrics(df: DataFrame, day_col: str = "dt") -> DataFrame:
    """One-row metrics of a zone table: rows, rows without a day, number of
    distinct days, first and last day."""
    return df.agg(F.count(F.lit(1)).alias("rows"),
                  F.count_if(F.col(day_col).isNull()).alias("null_day_rows"),
                  F.count_distinct(day_col).alias("distinct_days"),
                  F.min(day_col).alias("first_day"), F.max(day_col).alias("last_day"))


def day_counts(df: DataFrame, day_col: str = "dt") -> DataFrame:
    """Rows of every day (rows without a day are left out)."""
    return df.where(F.col(day_col).isNotNull()).groupBy(day_col).agg(F.count(F.lit(1)).alias("rows"))
