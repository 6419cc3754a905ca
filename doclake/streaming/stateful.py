"""Stateful processors: keyed state with a map entry per page, value state and event-time timers.

A page costs one write of its own map entry, however many pages its document
has; nothing that grows with the document is rewritten per micro-batch.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

# the state store that map state and timers need
PROVIDER_KEY = "spark.sql.streaming.stateStore.providerClass"
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def in_page_order(keys) -> list[str]:
    """Distinct keys by the page number at the end of their names (none: last), then by name."""
    def order(key: str):
        number = re.search(r"[_-](\d+)\.[^./]*$", key)
        return (number is None, int(number[1]) if number else 0, key)
    return sorted(set(keys), key=order)


def _ms(t) -> int:
    """Epoch milliseconds of a (session-zone, here UTC) naive timestamp."""
    return int(pd.Timestamp(t).value // 1_000_000)


class _Timed(StatefulProcessor):
    """One pending timer per key, moved with every input; a timer must lie behind the watermark."""

    def _move_timer(self, handle: StatefulProcessorHandle, old: int, at: int, timers) -> int:
        if old:
            handle.deleteTimer(old)
        new = max(at, timers.getCurrentWatermarkInMs() + 1)
        handle.registerTimer(new)
        return new

    def close(self) -> None:
        pass


EAGER_OUT = "base_name string, pages array<string>, n_pages long, kind string, batch_end timestamp"


class EagerBatches(_Timed):
    """A base name seen alone passes at once; several pages wait for a gap; pages after that are late pages."""

    def __init__(self, gap_ms: int, horizon_ms: int):
        self.gap_ms, self.horizon_ms = gap_ms, horizon_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pages = handle.getMapState("pages", "object_key string", "seen boolean")
        self.info = handle.getValueState("info", "emitted boolean, latest long, timer long")

    @staticmethod
    def _row(base: str, keys: list[str], kind: str, latest: int) -> pd.DataFrame:
        return pd.DataFrame({"base_name": [base], "pages": [keys], "n_pages": [len(keys)], "kind": [kind],
                             "batch_end": [pd.Timestamp(latest, unit="ms")]})

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        known = self.info.exists()
        emitted, before, timer = self.info.get() if known else (False, 0, 0)
        keys, latest = set(), 0
        for b in rows:
            keys.update(b["object_key"])
            latest = max(latest, _ms(b["event_time"].max()))
        newest = max(before, latest)
        if emitted:
            yield self._row(key[0], in_page_order(keys), "late", latest)
        elif not known and len(keys) == 1:
            yield self._row(key[0], list(keys), "single", latest)
            emitted = True
        else:
            for k in keys:
                self.pages.updateValue((k,), (True,))
        wait = self.horizon_ms if emitted else self.gap_ms
        self.info.update((emitted, newest, self._move_timer(self.handle, timer, newest + wait, timerValues)))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        emitted, latest, _ = self.info.get()
        if emitted:  # nothing came within the horizon
            self.info.clear()
            return
        yield self._row(key[0], in_page_order(k[0] for k in self.pages.keys()), "batch", latest)
        self.pages.clear()
        self.info.update((True, latest, self._move_timer(self.handle, 0, latest + self.horizon_ms, timerValues)))


GATE_OUT = "document_id string, n_pages long, completed_at timestamp"


class CompletionGate(_Timed):
    """A document passes once, when text rows exist for all its pages."""

    def __init__(self, timeout_ms: int):
        self.timeout_ms = timeout_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.done = handle.getMapState("done", "page_ordinal long", "seen boolean")
        self.info = handle.getValueState("info", "n long, expected long, emitted boolean, timer long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        n, expected, emitted, timer = self.info.get() if self.info.exists() else (0, 0, False, 0)
        pages, latest = set(), None
        for b in rows:
            pages.update(int(p) for p in b["page_ordinal"])
            expected = max(expected, int(b["n_pages"].max()))
            latest = b["ts"].max() if latest is None else max(latest, b["ts"].max())
        if not emitted:
            for p in pages:
                if not self.done.containsKey((p,)):
                    self.done.updateValue((p,), (True,))
                    n += 1
            if n >= expected:
                emitted = True
                self.done.clear()  # the marker stays: a repeated page must not pass again
                yield pd.DataFrame({"document_id": [key[0]], "n_pages": [expected], "completed_at": [latest]})
        self.info.update((n, expected, emitted, self._move_timer(self.handle, timer, _ms(latest) + self.timeout_ms, timerValues)))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.done.clear()
        self.info.clear()
        return iter(())


def transformed(grouped, processor: StatefulProcessor, out: str) -> DataFrame:
    """A grouped stream through a processor with event-time timers, in append mode."""
    return grouped.transformWithStateInPandas(statefulProcessor=processor, outputStructType=out, outputMode="append",
                                              timeMode="EventTime")
