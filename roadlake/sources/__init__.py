"""Scans and raw-format decoders."""

from roadlake.sources.arcgis import arcgis_explode, arcgis_item_array, arcgis_item_count
from roadlake.sources.damaged import damaged_documents, document_problem, require_sound
from roadlake.sources.files import (read_landing_lines, read_landing_range, read_snapshots,
                                    read_table)
from roadlake.sources.geojson import (FeedPayloadError, geojson_explode, geojson_features,
                                      geojson_problem, problem_kind, validate_geojson)
from roadlake.sources.xml import (incident_count, incident_elements, read_incident_xml,
                                  xml_escape, xml_explode)

__all__ = [
    "arcgis_explode", "arcgis_item_array", "arcgis_item_count",
    "read_landing_lines", "read_landing_range", "read_snapshots", "read_table", "geojson_explode",
    "geojson_features", "geojson_problem", "problem_kind", "validate_geojson",
    "FeedPayloadError", "damaged_documents", "document_problem", "require_sound", "incident_count",
    "incident_elements", "read_incident_xml", "xml_escape", "xml_explode",
]
