"""All registered queries; importing the modules fills the registry."""

from tributary.plans import (  # noqa: F401
    aggregations,
    deliveries,
    histories,
    joined,
    scalars,
    sketched,
    streams,
    texts,
    windowed,
)
from tributary.plans.registry import REGISTRY

__all__ = ["REGISTRY"]
