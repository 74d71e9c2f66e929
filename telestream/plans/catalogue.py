"""Every query of the library and the SQL it is held against."""

from . import grouping, reports, stream

QUERIES = grouping.QUERIES | stream.QUERIES | reports.QUERIES
ORACLES = grouping.ORACLES | stream.ORACLES | reports.ORACLES
