"""Every query of the library over the test tables, each beside SQL that gives the same rows."""

from __future__ import annotations

from catalogue import dedup, pages, scalars, similar, sites, snapshots, storage
from catalogue.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "dedup", "pages", "scalars", "similar", "sites", "snapshots", "storage"]
