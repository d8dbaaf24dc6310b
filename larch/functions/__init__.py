"""Column expressions shared by the operators (all JVM-side built-ins)."""

from larch.functions.columns import (
    items_string,
    present,
    seeded_bucket,
    seeded_key,
)

__all__ = ["present", "seeded_bucket", "seeded_key", "items_string"]
