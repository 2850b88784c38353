"""Truncate-and-load of a catalog table, with the tables that depend on it.

A catalog knows no foreign keys, so the dependants are declared: table -> tables that refer
to it.  Loading a table empties it and, in cascade, every table that depends on it directly
or through others; definitions stay as they are.  The new rows and the empty versions are
written first.  Only when all of that has gone well do the names move, dependants before what
they refer to, so no reader finds a row whose parent is gone; a failing load changes nothing.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from graphlib import CycleError, TopologicalSorter

from pyspark.sql import DataFrame

from quayside.sinks.versions import prepare_rows


class DependencyCycle(ValueError):
    """The declared dependants refer to each other in a circle."""


def dependants(table: str, refers: Mapping[str, Sequence[str]]) -> list[str]:
    """Every table that depends on ``table``, those that nothing else depends on first."""
    found, todo = {table}, [table]
    while todo:
        for child in refers.get(todo.pop(), ()):
            if child not in found:
                found.add(child)
                todo.append(child)
    try:
        order = TopologicalSorter(
            {t: [c for c in refers.get(t, ()) if c in found] for t in found}).static_order()
        return [t for t in order if t != table]
    except CycleError as exc:
        raise DependencyCycle(" -> ".join(exc.args[1])) from exc


def truncate_load(
    df: DataFrame,
    table: str,
    refers: Mapping[str, Sequence[str]] | None = None,
    cascade: bool = True,
) -> list[str]:
    """Replace the rows of ``table`` by ``df`` under its own definition; empty its dependants.

    Columns are matched by name and values assigned as by an ANSI insert; a column that the
    table does not have, or a value that does not fit, is an error and nothing changes.
    Without ``cascade`` a dependant that holds rows is an error.  Returns the tables that
    were emptied.
    """
    spark = df.sparkSession
    children = dependants(table, refers or {})
    if not cascade:
        held = [t for t in children if spark.table(t).take(1)]
        if held:
            raise ValueError(f"tables that refer to {table} hold rows: {held}")
        children = []
    ready = []
    try:
        ready.append(prepare_rows(df, table))
        for child in children:
            ready.append(prepare_rows(None, child))
    except Exception:
        for publish in ready:
            publish.cancel()
        raise
    for publish in [*ready[1:], ready[0]]:
        publish()
    return children
