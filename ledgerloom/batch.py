"""A batch: the six tables as DataFrames, with what is known about their skew and size."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame

from ledgerloom.schemas import TABLES
from ledgerloom.session import fresh_dir
from ledgerloom.skew import DEFAULT_POLICY, SkewPolicy, hot_keys, tasks_for


class Batch:
    """Six frames and their knowledge time. Size probes run at most once and steer strategy only."""

    def __init__(
        self,
        tables: Mapping[str, DataFrame],
        knowledge_time: int,
        policy: SkewPolicy = DEFAULT_POLICY,
    ) -> None:
        if set(tables) != set(TABLES):
            raise ValueError("a batch has exactly the six retail tables")
        self.tables = dict(tables)
        self.knowledge_time = knowledge_time
        self.policy = policy
        self._rows: dict[str, int] = {}
        self._hot: dict[tuple[str, ...], DataFrame | None] = {}
        self._kept: dict[str, DataFrame] = {}

    def __getitem__(self, table: str) -> DataFrame:
        return self.tables[table]

    def replace(self, **tables: DataFrame) -> Batch:
        kept = {name: self[name] for name in self.tables if name not in tables}
        return Batch({**kept, **tables}, self.knowledge_time, self.policy)

    def rows(self, table: str) -> int:
        if table not in self._rows:
            self._rows[table] = self[table].count()
        return self._rows[table]

    def hot(self, table: str, *keys: str) -> DataFrame | None:
        probe = (table, *keys)
        if probe not in self._hot:
            self._hot[probe] = hot_keys(self[table], keys, self.policy, self.rows(table))
        return self._hot[probe]

    def tasks(self, table: str) -> int | None:
        """Tasks that the table's rows should go to by key, None for a small table."""
        return tasks_for(self[table].sparkSession, self.rows(table))

    def kept(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A frame that several rules read, written to the shared folder on first use."""
        if name not in self._kept:
            frame = build()
            path = fresh_dir(frame.sparkSession, name)
            frame.write.parquet(path)
            self._kept[name] = frame.sparkSession.read.schema(frame.schema).parquet(path)
        return self._kept[name]
