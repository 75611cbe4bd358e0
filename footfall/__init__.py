"""Footfall: shop clickstream and ad-click analytics written as Spark DataFrame jobs."""

from footfall.params import TaskParams
from footfall.session import build_session

__all__ = ["TaskParams", "build_session"]
