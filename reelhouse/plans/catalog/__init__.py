"""Registered queries: name, Spark plan over the driver's tables, and equivalent SQL."""

from reelhouse.plans.catalog import (  # noqa: F401
    analytics,
    joins,
    modelling,
    pages,
    quality,
    recommenders,
    scalars,
    sources,
)
from reelhouse.plans.catalog.registry import ORACLES, QUERIES  # noqa: F401
