from strata.plans.catalog import (  # noqa: F401  (importing registers the queries)
    cleaning,
    evaluation,
    features,
    modelling,
    profiling,
    sampling,
    storage,
)
from strata.plans.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
