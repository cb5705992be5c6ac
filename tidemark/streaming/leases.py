"""Sessions of a scope that end by time: a lease that is not renewed, a connection that says nothing.

A scope has one active lease. A HELLO takes it if there is none, and gives it the next generation; a frame
renews it for LEASE_S; it ends when its connection closes or when nothing renews it in time, without
any frame having to come. A connection that is silent for IDLE_S is closed. What a connection of an earlier
generation does, also its late close, never touches a later one. A moment that is a deadline is too late.

The fold and the stream run the same step. The stream's clock is the watermark of its events, so it can be
turned by hand; timers wake a scope that no event reaches. A scope's state is its active lease and its open
connections. Rows of a scope at one time are taken in the order of ``n``.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import asdict, dataclass, field
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: Seconds of a lease without a renewal, and of a connection without a frame.
LEASE_S, IDLE_S = 30, 60
OUTCOMES = "scope string, at long, connection string, session string, generation long, outcome string"
NAMES = [x.split()[0] for x in OUTCOMES.split(", ")]


@dataclass
class Leases:
    """What is known of a scope: at are seconds."""

    generation: int = 0
    active: int = 0
    holder: str = ""
    until: int = 0
    #: session, generation and last frame of each open connection.
    open: dict[str, list[Any]] = field(default_factory=dict)

    def deadline(self) -> int | None:
        """The next moment at which something ends by itself."""
        own = [self.until] if self.active else []
        return min([*own, *(read + IDLE_S for _, _, read in self.open.values())], default=None)

    def advance(self, now: int) -> Iterator[tuple]:
        """What ends by itself up to now, in order of time: at, connection, session, generation and outcome."""
        while (end := self.deadline()) is not None and end <= now:
            if self.active and self.until == end:
                yield end, self.holder, self.open[self.holder][0], self.active, "expired"  # a connection outlives its lease
                self.active = 0
                continue
            for name in sorted(c for c, (_, _, read) in self.open.items() if read + IDLE_S == end):
                session, generation, _ = self.open.pop(name)
                yield end, name, session, generation, "idle"

    def _close(self, at: int, connection: str, lost: bool = False) -> tuple:
        session, generation, _ = self.open.pop(connection)
        mine = generation == self.active
        if mine:
            self.active = 0
        return at, connection, session, generation, "lost" if lost else "released" if mine else "stale"

    def step(self, at: int, connection: str, session: str, kind: str) -> Iterator[tuple]:
        """Take in a HELLO, a FRAME or a CLOSE of a connection; a HELLO on an open one closes it first."""
        yield from self.advance(at)
        if kind == "HELLO":
            if connection in self.open:
                yield self._close(at, connection)
            if self.active:
                yield at, connection, session, self.active, "conflict"
                return
            self.generation += 1
            self.active, self.holder, self.until = self.generation, connection, at + LEASE_S
            self.open[connection] = [session, self.generation, at]
            yield at, connection, session, self.generation, "granted"
        elif connection not in self.open:
            yield at, connection, session, 0, "closed"
        elif kind == "FRAME" and self.open[connection][1] == self.active:
            own = self.open[connection]
            self.until, own[2] = at + LEASE_S, at
            yield at, connection, own[0], own[1], "renewed"
        else:
            yield self._close(at, connection, kind == "FRAME")


def lease_outcomes(events: DataFrame) -> DataFrame:
    """OUTCOMES of events (scope, at, n, connection, session, kind), and of what ends by itself after the last one. A scope is read in order as a stream, of any length."""

    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, scope = Leases(), key[0].as_py()
        for batch in batches:
            rows = [x for row in zip(*(batch.column(c).to_pylist() for c in ("at", "connection", "session", "kind")), strict=True) for x in own.step(*row)]
            yield table(scope, rows)
        yield table(scope, list(own.advance(2**62)))

    def table(scope: str, rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*((scope, *r) for r in rows), strict=True)) or [[]] * 6, kinds, strict=True)], names=NAMES)

    rows = events.select("scope", "at", "n", "connection", "session", "kind").repartition("scope").sortWithinPartitions("scope", "at", "n")
    return rows.groupBy("scope").applyInArrow(run, OUTCOMES)


class Lessor(StatefulProcessor):
    """The step of a stream: a timer stands at the scope's next deadline."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.record = handle, handle.getValueState("leases", "state string")

    def _load(self) -> Leases:
        return Leases(**json.loads(self.record.get()[0])) if self.record.exists() else Leases()

    def _save(self, own: Leases) -> None:
        self.record.update((json.dumps(asdict(own)),))
        for old in list(self.handle.listTimers()):
            self.handle.deleteTimer(old)
        if (end := own.deadline()) is not None:
            self.handle.registerTimer(end * 1000)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        own = self._load()
        events = pd.concat(list(rows)).sort_values(["at", "n"])
        out = [(key[0], *x) for row in events[["at", "connection", "session", "kind"]].itertuples(index=False) for x in own.step(*row)]
        self._save(own)
        yield pd.DataFrame(out, columns=NAMES)

    def handleExpiredTimer(self, key: tuple, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        own = self._load()
        out = [(key[0], *x) for x in own.advance(expiredTimerInfo.getExpiryTimeInMs() // 1000)]
        self._save(own)
        yield pd.DataFrame(out, columns=NAMES)

    def close(self) -> None:
        pass


def lease_stream(events: DataFrame) -> DataFrame:
    """The same of a stream of events whose column time, a timestamp with a watermark, is at; sets the session's state store to RocksDB."""
    events.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    return events.groupBy("scope").transformWithStateInPandas(Lessor(), OUTCOMES, "append", "EventTime")
