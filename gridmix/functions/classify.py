"""Classification of codes into categories (IN-lists inside CASE)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridmix.constants import CATEGORY_MAP, OTHER_CATEGORY


def classify(c, mapping: dict | None = None, default: str | None = OTHER_CATEGORY) -> Column:
    """Map a code column to a category: first list containing the code wins.

    ``mapping`` is ``{category: [codes...]}`` in priority order; codes in no
    list (and NULL codes) get ``default``.
    """
    mapping = mapping if mapping is not None else CATEGORY_MAP
    col = F.col(c) if isinstance(c, str) else c
    expr = None
    for category, codes in mapping.items():
        cond = col.isin(list(codes))
        expr = F.when(cond, F.lit(category)) if expr is None else expr.when(cond, F.lit(category))
    if expr is None:
        return F.lit(default)
    return expr.otherwise(F.lit(default)) if default is not None else expr
