"""Watermarks of tables, kept up by a stream of audit events in place of being looked for in the whole audit."""
from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARKS = ("batch", "batchwindowstart", "batchwindowend")
STATE = "ingestiondt string, batch string, batchwindowstart string, batchwindowend string"
WIDTH = 15  # of numbers that are compared as texts, as in audit.padded()


def padded(x: str) -> str:
    return x.rjust(WIDTH, "0")[:WIDTH] if re.fullmatch(r"[0-9]+", x) else x


def unpadded(x: str | None) -> str | None:
    return (x.lstrip("0") or "0") if x is not None and re.fullmatch(r"[0-9]+", x) else x


def greatest(one: str | None, texts: pd.Series) -> str | None:
    found = [x for x in texts if isinstance(x, str)]
    return max([*found, one] if one is not None else found, default=None)


def advanced(key: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
    """A table's marks with those of the new events; the state is the four texts, whatever the number of events."""
    held = list(state.get) if state.exists else [None] * 4
    for b in batches:
        held[0] = greatest(held[0], b["ingestiondt"])
        for k, c in enumerate(MARKS, 1):
            held[k] = greatest(held[k], b[c].dropna().map(padded))
    state.update(tuple(held))
    yield pd.DataFrame([[key[0], held[0], *map(unpadded, held[1:])]], columns=["tablename", "ingestiondt", *MARKS])


def watermark_stream(events: DataFrame) -> DataFrame:
    """audit.watermarks() of all events so far, as updates of the tables that new events are about. Delete batches, empty
    windows and loads that ended in an unknown state don't count. Marks only grow, so events may come in any order and a
    batch that is run again changes nothing. A table's events of one micro-batch are in one task, batch by batch."""
    mine = events.where((F.coalesce("harddeletebatch", F.lit("n")) != "y") & (F.coalesce("loadstatus", F.lit("")) != "failedUnknown") & F.col("batchwindowend").isNotNull() & (F.col("batchwindowend") != "null"))
    rows = mine.select("tablename", "ingestiondt", *MARKS)
    return rows.groupBy("tablename").applyInPandasWithState(advanced, f"tablename string, {STATE}", STATE, "update", "NoTimeout")
