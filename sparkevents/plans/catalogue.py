"""All registered queries."""

from . import hit_queries, output_queries, scalar_queries, sensor_queries, stream_queries
from .registry import callables, oracles

__all__ = [
    "callables", "oracles", "hit_queries", "output_queries", "scalar_queries", "sensor_queries", "stream_queries",
]
