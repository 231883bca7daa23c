"""Every operator as a query over the given tables, next to the SQL that states its result."""

from checks import columns, matching, reading, searching, storing  # noqa: F401
from checks.registry import ORACLES, QUERIES  # noqa: F401
