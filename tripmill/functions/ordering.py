"""Total orders, so that first, latest and top mean the same rows on every run."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def by(*names: str) -> list[Column]:
    """Sort columns from names; a leading minus means descending. Nulls come last."""
    return [
        F.col(n[1:]).desc_nulls_last() if n.startswith("-") else F.col(n).asc_nulls_last()
        for n in names
    ]


def total_order(df: DataFrame, order: Sequence[str], skip: Iterable[str] = ()) -> list[Column]:
    """``order`` followed by every remaining sortable column of ``df``."""
    used = {n.lstrip("-") for n in order} | set(skip)
    rest = [name for name, kind in df.dtypes if name not in used and not kind.startswith("map")]
    return by(*order, *rest)
