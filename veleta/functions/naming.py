"""Names of tables and columns (FN-NAME, SNK9, three-part names)."""

from __future__ import annotations

import re


def clean_identifier(name: str) -> str:
    """Runs of characters outside A-Z, a-z, 0-9 and _ become one underscore."""
    return re.sub(r"[^A-Za-z0-9_]+", "_", name)


def flat_name(name: str) -> str:
    """A dotted name as one plain table name."""
    return clean_identifier(name.replace(".", "_"))


def catalog_name(name: str) -> str:
    """`lakehouse.schema.table` for a session catalog that knows two levels only.

    Lakehouse and schema are joined with a double underscore to one database name.
    """
    parts = [clean_identifier(p) for p in name.split(".")]
    if len(parts) > 3:
        raise ValueError(f"expected at most three name parts: {name}")
    if len(parts) == 3:
        return f"{parts[0]}__{parts[1]}.{parts[2]}"
    return ".".join(parts)
