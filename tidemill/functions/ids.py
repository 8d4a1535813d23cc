"""Name-based identifiers as a native expression."""

from __future__ import annotations

import uuid

from pyspark.sql import Column
from pyspark.sql import functions as F


def _column(part: Column | str) -> Column:
    return F.col(part) if isinstance(part, str) else part


def joined_key(*parts: Column | str) -> Column:
    """``a:b:c`` over the parts' text; NULL if any part is NULL."""
    pieces = []
    for i, part in enumerate(parts):
        if i:
            pieces.append(F.lit(":"))
        pieces.append(_column(part).cast("string"))
    return F.concat(*pieces)


def deterministic_event_id(namespace: str, *parts: Column | str) -> Column:
    """UUID version 5 of the joined parts under ``namespace`` (RFC 4122, SHA-1)."""
    prefix = F.lit(bytearray(uuid.UUID(namespace).bytes))
    digest = F.sha1(F.concat(prefix, F.encode(joined_key(*parts), "UTF-8")))
    # The variant digit keeps its two low bits: x -> 8 + x mod 4.
    variant = F.translate(F.substring(digest, 17, 1), "0123456789abcdef", "89ab" * 4)
    return F.concat_ws(
        "-",
        F.substring(digest, 1, 8),
        F.substring(digest, 9, 4),
        F.concat(F.lit("5"), F.substring(digest, 14, 3)),
        F.concat(variant, F.substring(digest, 18, 3)),
        F.substring(digest, 21, 12),
    )
