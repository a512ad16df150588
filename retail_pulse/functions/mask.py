"""Phone-number masking."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def mask_phone(tel) -> Column:
    """Keep digits 1-3 and 8-11, mask 4-7 with ``****``.

    Numbers shorter than 11 characters are fully masked to ``****`` (a plain
    substring would leak e.g. ``123****``); NULL stays NULL.
    """
    t = F.col(tel) if isinstance(tel, str) else tel
    masked = F.concat(F.substring(t, 1, 3), F.lit("****"), F.substring(t, 8, 4))
    return F.when(t.isNull(), F.lit(None).cast("string")) \
        .when(F.length(t) >= 11, masked) \
        .otherwise(F.lit("****"))
