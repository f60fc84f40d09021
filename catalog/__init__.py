"""All queries of the catalog, by family."""

from catalog import cleaning, comparison, derivations, enforcement, files, privacy, profiles, whole  # noqa: F401
from catalog.registry import ORACLES, QUERIES  # noqa: F401
