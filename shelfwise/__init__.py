"""Retail sell-out analytics as Spark DataFrame operators."""

from .settings import session

__all__ = ["session"]
