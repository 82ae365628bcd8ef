"""Checks that ride on the write they guard, so no gate scans its rows again.

A watch counts, while rows are written, how many there are and how many break each
condition. The files exist by then but no manifest names them: a failed gate raises, the
table keeps its version, and the unused files go with the next ``vacuum``.

The counting node is put right before the writer, after every shuffle. There a task's
counts are taken once, when it first succeeds; below a shuffle a stage that is run again
after a lost executor would be counted twice.

A condition that is null for a row counts as kept. Rows that break several conditions
count in each. An empty frame breaks nothing and has 0 rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from anagrove.sinks.versioned import VersionedTable

ROWS = "rows"
# Entry of a manifest's notes with the counts of the last gated commit.
NOTE = "gates"


class GateFailure(ValueError):
    """Rows that were written break a condition; ``counts`` has the rows per condition."""

    def __init__(self, counts: dict[str, int], examples: dict[str, str], reason: str):
        super().__init__(f"{reason}: {counts}, for example {examples}")
        self.counts, self.examples = counts, examples


class Watch:
    """Counts of one write. ``broken``: per name, a condition that is true for a row at fault."""

    def __init__(self, broken: dict[str, Column], example: Column | None = None):
        if ROWS in broken:
            raise ValueError(f"{ROWS} is the number of all rows")
        self.broken, self.example = broken, example
        self._seen: Observation | None = None

    def __call__(self, df: DataFrame) -> DataFrame:
        """The frame, counted when it is written; to be called on what goes into the writer."""
        self._seen = Observation()
        names = [F.count(F.lit(1)).alias(ROWS)]
        names += [F.count_if(condition).alias(name) for name, condition in self.broken.items()]
        if self.example is not None:
            shown = self.example.cast("string")
            names += [F.min(F.when(c, shown)).alias(f"_eg_{name}") for name, c in self.broken.items()]
        return df.observe(self._seen, *names)

    def _found(self) -> dict:
        if self._seen is None:
            raise RuntimeError("nothing was written under this watch")
        return self._seen.get

    @property
    def counts(self) -> dict[str, int]:
        found = self._found()
        return {name: int(found.get(name, 0) or 0) for name in (ROWS, *self.broken)}

    def require(self, rows: int | None = None) -> dict[str, int]:
        """The counts; raises if a condition is broken, or if ``rows`` were expected and others came."""
        counts, found = self.counts, self._found()
        at_fault = [name for name in self.broken if counts[name]]
        if at_fault:
            examples = {name: found.get(f"_eg_{name}") for name in at_fault if self.example is not None}
            raise GateFailure(counts, examples, f"broken {', '.join(at_fault)}")
        if rows is not None and counts[ROWS] != rows:
            raise GateFailure(counts, {}, f"{rows} rows were expected")
        return counts


def gated_commit(
    table: VersionedTable,
    df: DataFrame,
    broken: dict[str, Column],
    example: Column | None = None,
    rows: int | None = None,
    partial: Callable[[dict], bool] | None = None,
) -> int:
    """Replace the table's content by ``df`` if every gate holds; one pass over ``df``.

    ``rows``: the number of rows wanted, as another table's ``last_counts`` has it.
    ``partial`` picks the partitions to replace, by their values; all others stay, and
    rows that lie elsewhere join theirs. The counts are kept in the manifest.
    """
    base, watch = table.manifest(), Watch(broken, example)
    fresh = table.write(df, watch)
    counts = watch.require(rows)
    replaced = [p for p in base.entries if partial is None or partial(table.values_of(p))]
    return table.commit(base, [fresh], replaced, schema=df.schema, notes={NOTE: counts})


def last_counts(table: VersionedTable) -> dict[str, int]:
    """Counts of the newest gated commit, from the manifest: no row is read."""
    return table.manifest().notes.get(NOTE, {})


def require_equal_rows(*tables: VersionedTable) -> int:
    """Rows of the last gated commit, equal in all tables; raises otherwise."""
    counts = {table.path: last_counts(table).get(ROWS) for table in tables}
    if len(set(counts.values())) != 1 or None in counts.values():
        raise ValueError(f"row counts differ or are unknown: {counts}")
    return next(iter(counts.values()))
