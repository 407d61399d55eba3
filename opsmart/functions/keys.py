"""Row identity: a SHA-256 over '-'-joined parts, NULL if any part is NULL."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

STAMP = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def stamp_text(ts: Column) -> Column:
    """Fixed-width text of a timestamp; a plain cast trims trailing zeros."""
    return F.date_format(ts, STAMP)


def row_id(*parts: Column | str) -> Column:
    """Lower-case hex digest of the parts. ``concat_ws`` would skip NULLs, so
    plain ``concat`` is used: a missing part makes the whole id NULL."""
    pieces: list[Column] = []
    for i, part in enumerate(parts):
        if i:
            pieces.append(F.lit("-"))
        column = F.col(part) if isinstance(part, str) else part
        pieces.append(column.cast("string"))
    return F.sha2(F.concat(*pieces), 256)


def file_line_id(file: str = "_file", line: str = "_line") -> Column:
    return row_id(file, line)


def sync_line_id(synced: str = "_fivetran_synced", line: str = "_line") -> Column:
    return row_id(stamp_text(F.col(synced)), line)
