"""Column expressions (all built-in Spark functions, codegen-friendly)."""

from roadlake.functions.enums import clamp_enum, surface_status
from roadlake.functions.geo import haversine_km, line_endpoints, within_radius
from roadlake.functions.time import (day_key, duration_hours,
                                     epoch_ms_of_value, hour_bucket, now_ms,
                                     now_ts, parse_time, seconds_time)
from roadlake.functions.values import (digits_id, first_truthy, nonempty,
                                       text_to_float, to_bool, to_float,
                                       truthy, vfield, vstring)

__all__ = [
    "clamp_enum", "surface_status", "haversine_km", "line_endpoints",
    "within_radius", "day_key", "duration_hours", "epoch_ms_of_value",
    "hour_bucket", "now_ms", "now_ts", "parse_time", "seconds_time",
    "digits_id", "first_truthy", "nonempty", "text_to_float", "to_bool",
    "to_float", "truthy", "vfield", "vstring",
]
