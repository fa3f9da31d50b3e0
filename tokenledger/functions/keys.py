"""Deterministic surrogate keys.

Each field becomes its length, a colon and its text (``-`` for NULL), so no
two different field lists share a text, whatever marks the fields hold.
Dates render as ISO text, booleans as true/false.  The oracle texts use the
same recipe, so ids compare across engines.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

def _part(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    text = c.cast("string")
    return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def hash_key(*cols) -> Column:
    """Hex SHA-256 of the key fields (NULL-safe, order-sensitive)."""
    return F.sha2(F.concat(*[_part(c) for c in cols]), 256)
