"""Incremental rebuilds that equal a full one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.operators.episodes import touched


def upsert(old: DataFrame, new: DataFrame, key: str | list[str]) -> DataFrame:
    """All of ``new``, and the rows of ``old`` whose key it does not have."""
    keys = [key] if isinstance(key, str) else key
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new)


def update(stored: DataFrame, history: DataFrame, delta: DataFrame, key: str, build: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``stored`` after ``delta``: ``build`` runs again on all rows of the touched keys only.

    ``build`` must work within a key; then the result equals ``build`` on everything. All of
    ``delta`` is touched, so only ``history`` is joined. Joined both, they would lie by key on either
    side of the union, and Spark 4.1 then takes the union to lie by key, too, although adaptive
    execution has merged the two sides' partitions differently.
    """
    delta = delta.where(F.col(key).isNotNull())
    return upsert(stored, build(touched(history, delta, key).unionByName(delta)), key)


def unseen(codes: DataFrame, known: DataFrame, key: str = "code") -> DataFrame:
    """Distinct non-null codes that are not known yet."""
    return codes.select(key).where(F.col(key).isNotNull()).distinct().join(known.select(key), key, "left_anti")
