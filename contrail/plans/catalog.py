"""All named queries."""

from contrail.plans import catalog_clean, catalog_marts, catalog_tables, catalog_tracks  # noqa: F401
from contrail.plans import catalog_more, catalog_state  # noqa: F401  # refer to the others
from contrail.plans.registry import QUERIES, SQL  # noqa: F401
