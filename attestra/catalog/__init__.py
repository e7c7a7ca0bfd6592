"""All registered queries."""

from attestra.catalog import audits, claims, compounds, dups, flows, jobs, models, plans, reviews, texts  # noqa: F401
from attestra.catalog.registry import ORACLES, QUERIES  # noqa: F401
