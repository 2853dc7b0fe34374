"""The removal state as a streaming operator (STR-03): durable misses per key."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from canonry.operators.changes import MISSES


class Removal(StatefulProcessor):
    """Rows of a key are (key, run, present); a run's rows come in one batch or later ones,
    in order. An absent row counts one complete run that missed the key."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.misses = handle.getValueState("misses", "n int")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        state = self.misses.get() if self.misses.exists() else (-1,)
        n, out = state[0], []
        for r in pd.concat(list(rows)).sort_values("run").itertuples(index=False):
            if r.present:
                if n >= MISSES:
                    out.append((key[0], r.run, "restored"))
                n = 0
            elif n >= 0:  # keys never seen can't be missed
                n += 1
                if n == MISSES:
                    out.append((key[0], r.run, "removed"))
        self.misses.update((n,))
        yield pd.DataFrame(out, columns=["key", "run", "event"])

    def close(self) -> None:
        pass


def removal_stream(rows: DataFrame) -> DataFrame:
    """Events of a stream of (key string, run int, present boolean).

    The state is one number per key, kept by the state store; late and repeated rows of an
    old run aren't expected here, because runs are landed whole.
    """
    return rows.groupBy("key").transformWithStateInPandas(
        statefulProcessor=Removal(), outputStructType="key string, run int, event string", outputMode="append", timeMode="none"
    )
