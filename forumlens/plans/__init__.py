"""All registered queries."""

from forumlens.plans import accounts, behaviour, given, language, models, sinks, streams, tables, threads  # noqa: F401
from forumlens.plans.registry import CATALOG

__all__ = ["CATALOG"]
