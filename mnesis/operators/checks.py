"""Checks that run with the job: counted while the rows pass, so they cost no scan of their own and no plan drops them.

A check marks a place in a plan by observed metrics. When the block of ``Checks`` ends, after an action in it has run the
plan, what was counted is looked at, and a check that doesn't hold raises ``ValueError``. Metrics are counted whichever
columns the action reads:

    with Checks() as checks:
        stim = readers.stim_events(rows, checks)
        store.save(features.cut_epochs(stim, chunks, 0, 1000), root, "epochs")
"""

from __future__ import annotations

import threading
import uuid

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

#: Seconds that the end of a block waits for metrics of an action that has ended.
PATIENCE = 60


class Checks:
    def __init__(self):
        self.made: list[tuple[Observation, str, str]] = []

    def _observed(self, df: DataFrame, holds: Column, message: str) -> DataFrame:
        seen = Observation(f"check-{uuid.uuid4().hex}")
        self.made.append((seen, "holds", message))
        return df.observe(seen, F.coalesce(holds, F.lit(False)).alias("holds"))

    def some(self, df: DataFrame, message: str, where: Column | None = None) -> DataFrame:
        """df; it must have a row (for which ``where`` holds)."""
        return self._observed(df, F.count(F.lit(1) if where is None else F.when(where, 1)) > 0, message)

    def single(self, df: DataFrame, column: str, message: str | None = None) -> DataFrame:
        """df; the column must not have more than one value (null counts as none)."""
        holds = F.coalesce(F.min(column) == F.max(column), F.lit(True))
        return self._observed(df, holds, message or f"more than one {column}")

    def all(self, df: DataFrame, where: Column, message: str) -> DataFrame:
        """df; ``where`` must hold for every row."""
        return self._observed(df, F.count(F.when(~F.coalesce(where, F.lit(False)), 1)) == 0, message)

    def verify(self) -> None:
        """Raises for the first check that doesn't hold; an action must have run each."""
        made, self.made = self.made, []
        for seen, name, message in made:
            got: list[dict] = []
            asks = threading.Thread(target=lambda seen=seen, got=got: got.append(seen.get), daemon=True)  # waits for ever where nothing runs
            asks.start()
            asks.join(PATIENCE)
            if not got:
                raise ValueError(f"no action has run the check: {message}")
            if not got[0][name]:
                raise ValueError(message)

    def __enter__(self) -> Checks:
        return self

    def __exit__(self, kind, *_) -> None:
        if kind is None:
            self.verify()
