"""Tables whose columns may have any names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def positional(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with columns c0, c1, ... and the new name of each old one, so that no operator's own columns clash with them."""
    return docs.toDF(*[f"c{i}" for i in range(len(docs.columns))]), {c: f"c{i}" for i, c in enumerate(docs.columns)}


def restored(docs: DataFrame, names: dict[str, str]) -> DataFrame:
    """The columns of :func:`positional` under their old names; others go."""
    return docs.select(*[F.col(new).alias(old) for old, new in names.items()])
