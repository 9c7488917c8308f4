"""Names of columns and tables as SQL identifiers."""

from __future__ import annotations


def quoted(*names: str) -> str:
    """Names as one SQL identifier, whatever characters they hold."""
    return ".".join("`" + name.replace("`", "``") + "`" for name in names)
