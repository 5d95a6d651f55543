"""All registered queries of the lakehouse with their SQL oracles."""
from __future__ import annotations

from kerbside.plans import extended, queries

QUERIES: dict[str, queries.Query] = {**queries.QUERIES, **extended.QUERIES}
ORACLE: dict[str, str] = {**queries.ORACLE, **extended.ORACLE}
