"""Every operator bound to the driver tables, each next to the SQL that checks it."""

from workloads import base
from workloads import (  # noqa: F401  (importing a module registers its queries)
    io_queries, profile_queries, relational_queries, statistic_queries, scalar_queries,
    impute_queries, feature_queries, split_queries, rule_queries, model_queries, ensemble_queries)

REGISTRY = base.REGISTRY
