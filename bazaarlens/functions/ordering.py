"""Sort keys with NULL treated as the largest value, in both directions.

Spark's defaults are the opposite (NULL smallest), so every ordering in this
package is spelled through these two helpers.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _column(key: Column | str) -> Column:
    return F.col(key) if isinstance(key, str) else key


def rising(key: Column | str) -> Column:
    """Ascending, NULL last."""
    return _column(key).asc_nulls_last()


def falling(key: Column | str) -> Column:
    """Descending, NULL first."""
    return _column(key).desc_nulls_first()
