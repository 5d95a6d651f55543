"""Scans: landed trip files, weather payloads, the zone seed, lake tables,
and adapters that shape the driver's test tables like those sources."""
from kerbside.sources.trips import DATASETS, read_trips, trip_file_name, trip_file_path
from kerbside.sources.weather import month_bounds_columns, read_weather_payload
from kerbside.sources.zones import read_zone_seed
from kerbside.sources.lake import read_table, table_exists

__all__ = [
    "DATASETS", "read_trips", "trip_file_name", "trip_file_path",
    "month_bounds_columns", "read_weather_payload",
    "read_zone_seed", "read_table", "table_exists",
]
