"""All registered queries: importing this package fills ``REGISTRY``."""

from dataloom.plans.registry import REGISTRY, Entry, query  # noqa: F401
from dataloom.plans import (  # noqa: F401  (import order = section order)
    q_project,
    q_functions,
    q_joins,
    q_groups,
    q_nested,
    q_windows,
    q_sources,
    q_udfs,
    q_streaming,
    q_graphs,
    q_learn,
    q_stats,
    q_crash,
    q_jobs,
)
