"""Landing -> clean: parse JSON lines, type, derive times and day keys.

One projection per feed; malformed lines are split off (``quarantine``)
instead of surviving as all-null rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadlake.functions.enums import clamp_enum
from roadlake.session import expr_cache
from roadlake.functions.time import (day_key, now_ts, parse_time,
                                     seconds_time)
from roadlake.schemas import (INCIDENT_CLEAN, INCIDENT_LANDING,
                              PRECIP_ALLOWED, PRECIP_DEFAULT, RWIS_CLEAN,
                              RWIS_LANDING, SURFACE_ALLOWED, SURFACE_DEFAULT,
                              WZDX_CLEAN, WZDX_LANDING)

CORRUPT = "_corrupt_record"


def parse_landing(lines: DataFrame, schema: T.StructType,
                  value_col: str = "value") -> DataFrame:
    """JSON lines -> typed columns of ``schema`` plus ``_malformed``.

    Empty or null lines are dropped.  A line is malformed when it is not a
    JSON object of the schema (``_corrupt_record`` set) or when every field
    is null (e.g. ``{}``)."""
    first, second = _parse_exprs(schema.json(), value_col)
    return lines.select(*first).where(F.col("j").isNotNull()).select(*second)


@expr_cache
def _parse_exprs(schema_json: str, value_col: str):
    schema = T.StructType.fromJson(__import__("json").loads(schema_json))
    parse_schema = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    j = F.from_json(F.col(value_col), parse_schema,
                    {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    names = [f.name for f in schema.fields]
    all_null = F.lit(True)
    for n in names:
        all_null = all_null & F.col(f"j.{n}").isNull()
    first = [j.alias("j"), F.col(value_col).alias("_line")]
    second = [*[F.col(f"j.{n}").alias(n) for n in names],
              (F.col(f"j.{CORRUPT}").isNotNull() | all_null).alias("_malformed"), "_line"]
    return first, second


def ensure_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Every field of ``schema`` present with its type: missing columns are
    added as typed nulls, others re-typed (ANSI-safe ``try_cast``)."""
    cols = []
    for f in schema.fields:
        if f.name in df.columns:
            c = F.col(f.name)
            actual = df.schema[f.name].dataType
            cols.append((c if actual == f.dataType else c.try_cast(f.dataType)).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    rest = [c for c in df.columns if c not in schema.fieldNames()]
    return df.select(*cols, *rest)


def _valid(lines: DataFrame, schema, keep_malformed: bool,
           observation=None, flag: bool = False, carry=()) -> DataFrame:
    p = parse_landing(lines, schema)
    if observation is not None:
        # counted in the same pass as whatever action consumes the result
        p = p.observe(observation, F.count(F.lit(1)).alias("lines"),
                      F.count_if(F.col("_malformed")).alias("malformed_lines"))
    if flag or "_malformed" in carry:
        keep_malformed = True          # flagged rows stay, marked by _malformed
    if not keep_malformed:
        p = p.where(~F.col("_malformed"))
    helpers = {"_line", "_malformed"} - set(carry) - ({"_malformed"} if flag else set())
    p = ensure_columns(p.drop(*helpers), schema)
    return p


def quarantine(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """Malformed landing lines with their text, for inspection/replay."""
    return parse_landing(lines, schema).where("_malformed").select(
        F.col("_line").alias("value"))


def _out(df: DataFrame, cols, flag: bool, carry=()) -> DataFrame:
    return df.select(*cols, *(["_malformed"] if flag else []), *carry)


def clean_rwis(lines: DataFrame, run_ts=None, keep_malformed: bool = False,
               observation=None,
               flag_malformed: bool = False, carry=()) -> DataFrame:
    """RWIS landing lines -> ``rwis_validated`` rows.

    ``event_time`` = epoch ms truncated to the second, or the run time when
    missing; ``dt`` its day; precipitation and surface clamped to their
    allow-lists.  ``observation`` (a ``pyspark.sql.Observation``) receives
    the line and malformed-line counts of the pass that consumes the
    result.  ``flag_malformed`` keeps malformed lines as rows marked by a
    boolean ``_malformed`` column (for one-pass run metrics); ``carry`` names
    helper columns (``_malformed``, ``_line``) that stay at the end."""
    d = _valid(lines, RWIS_LANDING, keep_malformed, observation, flag_malformed, carry)
    et = F.coalesce(seconds_time(F.col("ts")), now_ts(run_ts))
    return d.select(
        "station_id", et.alias("event_time"), day_key(et).alias("dt"),
        "air_temp_f", "pavement_temp_f",
        clamp_enum(F.col("precip_type"), PRECIP_ALLOWED, PRECIP_DEFAULT).alias("precip_type"),
        "wind_mph",
        clamp_enum(F.col("surface_status"), SURFACE_ALLOWED, SURFACE_DEFAULT).alias("surface_status"),
        *(["_malformed", "ts"] if flag_malformed else []), *carry,
    ).transform(lambda x: _out(x, RWIS_CLEAN.fieldNames() + (["ts"] if flag_malformed else []),
                               flag_malformed, carry))


def clean_incidents(lines: DataFrame, keep_malformed: bool = False,
                    observation=None, carry=()) -> DataFrame:
    """Incident landing lines -> ``incident_validated`` rows.

    ``event_time`` prefers the start time, then the creation time, then the
    ingest stamp (second precision); unparseable texts are skipped."""
    d = _valid(lines, INCIDENT_LANDING, keep_malformed, observation, carry=carry)
    et = F.coalesce(parse_time(F.col("start_time")), parse_time(F.col("create_time")),
                    seconds_time(F.col("ingest_ts")))
    return d.select(
        "event_id", et.alias("event_time"), day_key(et).alias("dt"), "closed",
        "county", "description", F.upper("direction").alias("direction"),
        "incident_type", "lat", "lon", "lanes_status", "traffic_alert",
        "traffic_alert_msg", *carry).select(*INCIDENT_CLEAN.fieldNames(), *carry)


def clean_wzdx(lines: DataFrame, run_ts=None, keep_malformed: bool = False,
               observation=None, carry=()) -> DataFrame:
    """Work-zone landing lines -> ``wzdx_validated`` rows (``dt`` is the
    ingest day)."""
    d = _valid(lines, WZDX_LANDING, keep_malformed, observation, carry=carry)
    it = F.coalesce(seconds_time(F.col("ingest_ts")), now_ts(run_ts))
    return d.select(
        "road_event_id", it.alias("ingest_time"), day_key(it).alias("dt"),
        parse_time(F.col("start_date")).alias("start_time"),
        parse_time(F.col("end_date")).alias("end_time"),
        "road_names", F.upper("direction").alias("direction"),
        "begin_lat", "begin_lon", "end_lat", "end_lon", *carry,
    ).select(*WZDX_CLEAN.fieldNames(), *carry)
