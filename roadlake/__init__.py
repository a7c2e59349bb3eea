"""roadlake — a Spark-native road-operations analytics engine.

Three transport feeds (road-weather stations as ArcGIS JSON, work zones as
GeoJSON, traffic incidents as XML) are decoded, normalised, validated into
typed clean tables, curated into hourly/daily summaries and latest-state
tables, and answered by three cross-feed questions.  Every operator is a
``DataFrame -> DataFrame`` function built from Spark column expressions, so
Catalyst plans the whole chain; IO happens only in ``sources`` and ``sinks``.
"""

from roadlake.session import build_session, shared_dir

__all__ = ["build_session", "shared_dir"]
__version__ = "0.1.0"
