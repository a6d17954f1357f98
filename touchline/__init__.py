"""Touchline: historical sports and transfer analytics as plain Spark jobs."""

from touchline.session import build_session
from touchline.plans.warehouse import Warehouse

__all__ = ["Warehouse", "build_session"]
