"""All named queries; importing this package registers them."""

from meterline.registry import (  # noqa: F401
    learning, maintenance, models, reports, scalars, scans, statements, storage, streams, topics,
)
from meterline.registry.book import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
