"""Ping sources: AIS CSV files, a date-partitioned Parquet store, and the
test fixture derived from the ``events`` table."""

from tracklens.sources.ais_csv import parse_ais, read_ais_csv
from tracklens.sources.fixture import pings_from_events
from tracklens.sources.store import read_pings, write_pings

__all__ = ["parse_ais", "read_ais_csv", "pings_from_events", "read_pings", "write_pings"]
