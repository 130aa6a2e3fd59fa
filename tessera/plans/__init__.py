"""Registered queries of the library's operators on the given tables."""

from tessera.plans import accuracy, catalogues, fits, more, privacy, records, relational, releases, tabulation  # noqa: F401
from tessera.plans.base import ORACLES, QUERIES  # noqa: F401
