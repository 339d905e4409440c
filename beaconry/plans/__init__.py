"""Registered queries over the test tables, each with its plain SQL twin."""

from beaconry.plans import aggregates, business, ingest, joins, quality, scalars, star, windows  # noqa: F401
from beaconry.plans.registry import REGISTRY  # noqa: F401
