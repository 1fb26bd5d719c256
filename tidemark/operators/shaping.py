"""Plan-shape helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def computed_once(frame: DataFrame) -> DataFrame:
    """The same rows, with their columns computed before any filter that is added later.

    Spark moves a filter below a projection and repeats the projected expressions in it. For JSON
    parsing that doubles the work, so the row passes through inline(), which filters do not cross.
    """
    return frame.select(F.inline(F.array(F.struct(*frame.columns))))
