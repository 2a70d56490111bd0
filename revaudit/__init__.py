"""Prepare and audit customer-review tables on Spark."""

from revaudit.settings import Settings

__all__ = ["Settings"]
