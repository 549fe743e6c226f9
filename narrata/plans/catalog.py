"""All registered queries."""

from narrata.plans import queries_experiments, queries_features, queries_models, queries_newton, queries_text  # noqa: F401
from narrata.plans.registry import QUERIES, TWINS  # noqa: F401
