"""The model library: staging, intermediate and mart DataFrames."""

from rostrum.plans import staging  # isort: skip  # noqa: F401  (registers its models first)
from rostrum.plans import intermediate  # isort: skip  # noqa: F401
from rostrum.plans import marts  # isort: skip  # noqa: F401
from rostrum.plans.registry import MODELS, Models

__all__ = ["MODELS", "Models"]
