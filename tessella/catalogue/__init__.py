"""Every operator as a query on the sample tables, with the SQL that checks it."""

from . import cleaning, evaluation, features, learning, retrieval, vectors
from .base import ORACLES, PUBLISHED, QUERIES

__all__ = ["ORACLES", "PUBLISHED", "QUERIES"]
