"""Queries over the driver's tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from . import canonical, contracts, control, files, values

MODULES = (values, control, files, canonical, contracts)

QUERIES = {name: query for module in MODULES for name, query in module.QUERIES.items()}
ORACLES = {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
