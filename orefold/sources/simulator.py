"""Client of an event simulator: one request for each key, with waits while it is busy.

The caller supplies fetch(key, attempt), which answers with a list of events (flat
dicts), or raises Busy to be asked again or Unknown for a key without events.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame

#: Seconds before the second and the third attempt, and between requests of one task.
WAITS = (2.0, 4.0)
PAUSE = 0.0


class Busy(Exception):
    """Too many requests: ask again later."""


class Unknown(Exception):
    """No such key, or none that has events."""


def attempt(fetch: Callable[[str, int], list[dict]], key: str, waits: tuple[float, ...] = WAITS) -> list[dict]:
    """The events of a key; none if it is unknown or still busy after the last wait."""
    for n in range(len(waits) + 1):
        try:
            return fetch(key, n)
        except Unknown:
            return []
        except Busy:
            if n < len(waits):
                time.sleep(waits[n])
    return []


def fetch_events(keys: DataFrame, key: str, fetch: Callable[[str, int], list[dict]], waits: tuple[float, ...] = WAITS, pause: float = PAUSE, tasks: int = 4) -> DataFrame:
    """key, number and event (a map of strings) of each distinct key; tasks bounds how many requests run at once."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for k in frame[key]:
                rows += [(k, i, {a: str(b) for a, b in e.items()}) for i, e in enumerate(attempt(fetch, k, waits))]
                time.sleep(pause)
            yield pd.DataFrame(rows, columns=[key, "number", "event"])

    from orefold.sources.landing import ship

    ship(keys.sparkSession)
    return keys.select(key).distinct().repartition(tasks, key).mapInPandas(run, f"{key} string, number int, event map<string,string>")
