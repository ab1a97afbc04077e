"""Every registered query, with its DuckDB twin where SQL can say the same."""

from tessera.catalog import checks, finance, ingest, mining, olap, streams, text  # noqa: F401
from tessera.catalog.registry import QUERIES, TWINS

__all__ = ["QUERIES", "TWINS"]
