"""Registered queries: every operator of the package over the given tables, with the SQL that
states the same result. Names are lower-case; callables take (spark, folder of parquet tables)."""

from stargrain.plans.catalogue import (  # noqa: F401  (each module registers its queries)
    alerts,
    areas,
    dates,
    dims,
    loads,
    merges,
    profiles,
    quality_checks,
    raw_reads,
)
from stargrain.plans.catalogue.base import ORACLES, QUERIES  # noqa: F401
