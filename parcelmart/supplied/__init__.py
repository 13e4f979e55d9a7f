"""Every operator shown on the supplied tables, each with the same question in SQL."""

from parcelmart.supplied import aggregates, joins, marts, rows, scalars  # noqa: F401
from parcelmart.supplied.registry import ORACLE, QUERIES  # noqa: F401
