"""Registered queries: every operator run over the whole test tables, with its SQL twin."""

from edupipe.catalog.registry import ORACLES, QUERIES
from edupipe.catalog import aggregates, arrays, cleaning, feedback, graph, kept, pages, quality, relational, sections, streams, tables_io, vectors

__all__ = ["ORACLES", "QUERIES"]
