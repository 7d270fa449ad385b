"""Column -> Column expressions."""

from terroir.functions import names, numeric, text

__all__ = ["names", "numeric", "text"]
