"""Every query by name, with its DuckDB form where there is one."""

from docroute.plans import arrivals, batches, closing, duplicates, evidence, gates, identify, pages, tracking

_PARTS = (identify, evidence, pages, batches, tracking, gates, duplicates, arrivals, closing)
QUERIES: dict = {name: q for part in _PARTS for name, q in part.QUERIES.items()}
ORACLES: dict = {name: q for part in _PARTS for name, q in part.ORACLES.items()}
