"""The registered queries: ``QUERIES`` for Spark and ``ORACLES`` in DuckDB SQL."""

from pageloom.catalog import (  # noqa: F401  (importing a module registers its queries)
    archive_queries,
    extraction,
    libraries,
    manifests,
    network,
    publishing,
    scalars,
    tables,
)
from pageloom.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
