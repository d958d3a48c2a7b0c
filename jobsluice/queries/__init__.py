"""Registered queries: every operator over the given tables, with its SQL twin."""

from jobsluice.queries import labelling, listings, merges, pages, payloads, runs, sinks, site_runs, streams, texts  # noqa: F401
from jobsluice.queries.registry import REGISTRY  # noqa: F401
