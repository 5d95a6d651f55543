"""Writers: bronze append / month replace, layer refresh, views, day-partitioned fact."""
from kerbside.sinks.writers import (
    land_files,
    publish_view,
    write_bronze,
    write_day_partitioned,
    write_layer,
)

__all__ = ["land_files", "publish_view", "write_bronze", "write_day_partitioned", "write_layer"]
