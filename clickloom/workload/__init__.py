"""Registered queries over the provided tables, with their check SQL."""

from .oracles import ORACLES
from .queries import QUERIES

__all__ = ["ORACLES", "QUERIES"]
