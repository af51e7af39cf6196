"""Queries over the input tables; importing this package registers them all."""

from lamella.plans import catalog, changes, exchange, flows, lookups, packing, records, scoring, states, streams, tiling  # noqa: F401

QUERIES, ORACLES = catalog.QUERIES, catalog.ORACLES
