"""Tables derived from facts, kept right when facts of the past change.

A step reads what the period before left, so a corrected past period makes every
later one wrong. Here facts and all that is derived from them stand on shelves by key.
A correction names its keys: their facts are put right, each derived table is made
again for these keys alone, and written with the other keys of their shelves as they
were. Other shelves are neither read nor written.

Facts are written first, then each table in turn. After a failure between two of them
the same correction, given again, leaves the tables as if there had been none.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import all_of
from tidemark.operators.late import WITHDRAWN
from tidemark.sources.schemas import Table
from tidemark.sources.store import ShelfStore

#: A table's rows from the rows, of the same keys, of facts and of tables before it.
Build = Callable[[dict[str, DataFrame]], DataFrame]


@dataclass(frozen=True)
class Derived:
    """A shelved table and how its rows are made."""

    table: Table
    build: Build


def _same(left: str, right: str, names: Sequence[str]) -> Column:
    return all_of([F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in names])


class RepairedTables:
    """Shelved facts and the shelved tables derived from them, in order."""

    def __init__(
        self, store: ShelfStore, key: str, facts: Table, derived: Sequence[Derived]
    ) -> None:
        """``key`` is what histories follow; the facts' declared key holds it."""
        self.store, self.key, self.facts, self.derived = store, key, facts, tuple(derived)

    def correct(self, rows: DataFrame) -> list[int]:
        """Add facts, replace those of the same declared key, or take them out.

        The first load is a correction of nothing. Where the optional column
        ``withdrawn`` is true, the row of that key goes. Of several rows of one key the
        greatest by its values counts. Gives the shelves that were rewritten.
        """
        marks = [WITHDRAWN] if WITHDRAWN in rows.columns else []
        names = [c for c in self.facts.schema.names if c != "shelf"]
        values = [c for c in [*names, *marks] if c not in self.facts.key]
        one = rows.groupBy(*self.facts.key).agg(F.max(F.struct(*values)).alias("_best"))
        told = one.select(*self.facts.key, "_best.*")
        new = self.store.on_shelves(told, self.key).checkpoint()
        shelves = self.store.touched(new)
        if shelves:
            self._write_facts(new, shelves, bool(marks))
            self._derive(new.select(self.key).distinct(), shelves)
        return shelves

    def _write_facts(self, new: DataFrame, shelves: list[int], marked: bool) -> None:
        old = self.store.read_shelves(self.facts, shelves).alias("o")
        kept = old.join(new.alias("n"), _same("o", "n", self.facts.key), "left_anti")
        if marked:
            new = new.where(~F.coalesce(WITHDRAWN, F.lit(False)))
        self.store.rewrite(
            self.facts, kept.unionByName(new.select(*self.facts.schema.names)), shelves
        )

    def _derive(self, keys: DataFrame, shelves: list[int]) -> None:
        keys = keys.checkpoint().alias("k")

        def of_keys(table: Table, how: str) -> DataFrame:
            rows = self.store.read_shelves(table, shelves).alias("r")
            return rows.join(keys, _same("r", "k", [self.key]), how)

        made = {self.facts.name: of_keys(self.facts, "left_semi")}
        for one in self.derived:
            fresh = self.store.on_shelves(one.build(made), self.key)
            rows = of_keys(one.table, "left_anti").unionByName(
                fresh.select(*one.table.schema.names)
            )
            self.store.rewrite(one.table, rows, shelves)
            made[one.table.name] = of_keys(one.table, "left_semi")
