"""All registered queries; importing the modules fills the registry."""

from hedonic.plans import (  # noqa: F401
    flagship,
    q_cleaning,
    q_closed,
    q_evaluation,
    q_groups,
    q_models,
    q_profile,
    q_sinks,
    q_sources,
    q_splits,
)
from hedonic.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
