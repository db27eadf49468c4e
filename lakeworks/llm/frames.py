"""Small helpers for frames whose further columns may have any name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEEP = ("doc_id", "text")


def aside(docs: DataFrame, keep: tuple[str, ...] = KEEP) -> DataFrame:
    """``docs`` with every column but ``keep`` renamed by its place, so that no name of theirs can clash."""
    return docs.select(*[F.col(f"`{c}`").alias(c if c in keep else f"_other{i}") for i, c in enumerate(docs.columns)])


def back(rows: DataFrame, docs: DataFrame, *added: str, keep: tuple[str, ...] = KEEP) -> DataFrame:
    """The columns of ``docs`` under their names, then the ``added`` ones (which replace columns of their names)."""
    new = {a.lower() for a in added}
    old = [(i, c) for i, c in enumerate(docs.columns) if c.lower() not in new]
    return rows.select(*[F.col(c if c in keep else f"_other{i}").alias(c) for i, c in old], *added)


def unused(docs: DataFrame, name: str) -> str:
    """``name``, with underscores behind it until ``docs`` has no such column."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name
