"""kerbside: a Spark-native urban-mobility lakehouse.

Bronze landing, a distributed quality gate, a cleaned silver layer and a
gold star schema (trip fact, date / weather / SCD2 zone dimensions, a
zone-by-hour demand mart) plus the serving queries over it -- all written
as plain DataFrame operators that Catalyst plans and AQE tunes at run time.
"""

__version__ = "0.1.0"
