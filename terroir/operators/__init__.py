"""DataFrame -> DataFrame operators."""

from terroir.operators import dedup, features, filters, joins, quality, schema, stats

__all__ = ["dedup", "features", "filters", "joins", "quality", "schema", "stats"]
