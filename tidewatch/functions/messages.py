"""Result messages (X-7).  Text is ours; the outcome column carries meaning."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def message(template: str, *cols: Column | str) -> Column:
    """``format_string`` over columns, e.g. ``message('user %d over %d', 'u', F.lit(3))``."""
    return F.format_string(template, *[F.col(c) if isinstance(c, str) else c for c in cols])
