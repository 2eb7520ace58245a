"""Spatio-temporal demand analytics as PySpark DataFrame operators."""

from slotcast.spec import Spec

__all__ = ["Spec"]
