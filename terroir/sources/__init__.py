"""Sources, sinks and catalog access."""

from terroir.sources import catalog, delimited, sinks

__all__ = ["catalog", "delimited", "sinks"]
