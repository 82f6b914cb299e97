"""Warehouse and supply-chain analytics as Spark jobs."""

from stockyard.dataset import Dataset
from stockyard.session import build_session

__all__ = ["Dataset", "build_session"]
