"""Damaged snapshot documents: what is wrong with them, by feed.

A document is damaged when the feed's parser could not read it at all: text
that is no JSON (or, for incidents, no well-formed XML), and work-zone JSON
without a ``features`` list. An ArcGIS document of another shape is not
damaged, it has no items.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlake.sources.geojson import FeedPayloadError, problem_kind

#: Characters of a damaged document that are kept for inspection.
SNIPPET = 400


def _xml_kind(value: Column) -> Column:
    plain = F.regexp_replace(value, "^﻿", "")
    parsed = F.from_xml(plain, "_corrupt_record string, Incident array<string>",
                        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    return F.when(value.isNull() | parsed["_corrupt_record"].isNotNull(), F.lit("invalid_xml"))


def document_problem(feed: str, value: Column) -> Column:
    """``invalid_json``, ``invalid_xml``, ``unexpected_shape``, or null for a
    document that can be decoded."""
    if feed == "incidents":
        return _xml_kind(value)
    if feed == "wzdx":
        kind = problem_kind(value)
        return F.when(kind != "ok", kind)
    return F.when(F.try_parse_json(value).isNull(), F.lit("invalid_json"))


def damaged_documents(docs: DataFrame, feed: str, value_col: str = "value") -> DataFrame:
    """The damaged ones of ``docs`` as dead letters: their columns but the
    text, and feed, kind, snippet (first 400 characters) and n_chars."""
    keep = [c for c in docs.columns if c != value_col and c not in ("feed", "kind", "snippet", "n_chars")]
    v = F.col(value_col)
    return (docs.withColumn("_kind", document_problem(feed, v)).where(F.col("_kind").isNotNull())
            .select(*keep, F.lit(feed).alias("feed"), F.col("_kind").alias("kind"),
                    F.substring(v, 1, SNIPPET).alias("snippet"), F.length(v).cast("long").alias("n_chars")))


def require_sound(docs: DataFrame, feed: str, value_col: str = "value") -> DataFrame:
    """Raise :class:`FeedPayloadError` for the first damaged document found
    (only that row is fetched)."""
    bad = damaged_documents(docs, feed, value_col).select("kind", "snippet").first()
    if bad is not None:
        raise FeedPayloadError(f"{bad['kind']}; first {SNIPPET} chars: {bad['snippet']}")
    return docs
