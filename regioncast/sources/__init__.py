"""Input scans: positional readers for the reference's files, saved results,
CSV ingest, and stand-in views over the driver's tables."""

from regioncast.sources.files import (
    REFERENCE_FILES,
    by_position,
    ingest_csv,
    read_centres,
    read_daily_totals,
    read_doses_by_band,
    read_population,
    read_inputs,
    read_result,
)
from regioncast.sources import tables

__all__ = [
    "REFERENCE_FILES", "read_inputs", "by_position", "ingest_csv", "read_centres", "read_daily_totals", "read_doses_by_band",
    "read_population", "read_result", "tables",
]
