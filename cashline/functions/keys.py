"""Hashed keys and change fingerprints."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SEPARATOR = "|"


def surrogate_key(*parts: Column | str) -> Column:
    """MD5 over the parts joined by a bar; NULL as soon as one part is NULL."""
    pieces: list[Column] = []
    for part in parts:
        text = (F.col(part) if isinstance(part, str) else part).cast("string")
        pieces += [F.lit(SEPARATOR), text] if pieces else [text]
    # concat gives NULL when any part is NULL, which concat_ws would hide.
    return F.md5(F.concat(*pieces))


def fingerprint(*attributes: str) -> Column:
    """Attributes joined by a bar; NULL and empty text count as the same value."""
    return F.concat_ws(
        SEPARATOR, *[F.coalesce(F.col(name).cast("string"), F.lit("")) for name in attributes]
    )
