"""Query catalog (``catalog``, ``streams``) and the DuckDB oracle SQL (``oracle``)."""

from . import catalog, streams  # noqa: F401  (registers the streaming queries)
