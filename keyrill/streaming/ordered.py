"""Steps over the rows of a key in order of time, kept in Spark's own state.

Rows wait in list state until the watermark has passed them; a timer at the earliest then hands them over, sorted, to a step
the user passes in. So the order of arrival does not matter within the watermark's delay, and a step sees each row once. The rows of a key
that wait together are those of one delay. Rows that come later than the watermark are dropped by Spark.

Each call of Spark's state costs far more than a row does, so keys share their state and timer by hash, as one of BUCKETS groups: a
micro-batch costs some calls a group and not a key. A group's rows and the states of its keys are packed, to be stored at once.
"""

from __future__ import annotations

import pickle
import sys
from abc import ABC, abstractmethod
from collections.abc import Iterator
from operator import itemgetter

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from keyrill.operators.records import keyed

# Steps travel to the executors with the query, so they need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_DUE = T.StructType([T.StructField("at_ms", T.LongType())])
_PACKED = T.StructType([T.StructField("packed", T.BinaryType())])
ORDER = ("at_us", "side", "offset")
# fixed for the life of a checkpoint, as the number of state partitions is
BUCKETS = 1024
ROWS_PER_PACK = 10_000


class Step(ABC):
    """What is done with the rows of each key: a state, a step for each row, and a wake-up call if the state asks for one.

    `state` and `output` are schemas. Rows have `at_us`, their time in microseconds, `side` and `offset`, by which they are ordered, and
    the columns of the stream. Outputs are tuples.
    """

    state: str
    output: str

    @abstractmethod
    def start(self) -> tuple:
        """The state of a key without rows."""

    @abstractmethod
    def step(self, state: tuple, row: Row) -> tuple[tuple, list[tuple]]:
        """The state after a row, and what is sent on."""

    def wake_us(self, state: tuple) -> int | None:
        """When `expired` is due unless a row changes the state before; None for never."""
        return None

    def expired(self, state: tuple, at_us: int) -> tuple[tuple | None, list[tuple]]:
        """The state after the wake-up call (None: as if there never were rows), and what is sent on."""
        return state, []


class InOrder(StatefulProcessor):
    """Hands the rows of each key of a group to a step once the watermark has passed them."""

    def __init__(self, step: Step, rows: T.StructType) -> None:
        self.step, self.names, self.key = step, rows.names, rows.names.index("key")
        # read here: workers cannot parse schemas
        self.out = T.StructType.fromDDL(step.output).names

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", _PACKED)
        self.kept = handle.getListState("kept", _PACKED)
        self.due = handle.getValueState("due", _DUE)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        pick, new, earliest = None, [], None
        for row in rows:
            pick = pick or itemgetter(*(row.__fields__.index(name) for name in self.names))
            new.append(pick(tuple(row)))
            earliest = new[-1][0] if earliest is None else min(earliest, new[-1][0])
            if len(new) == ROWS_PER_PACK:
                self.waiting.appendList(_packed(new))
                new = []
        if new:
            self.waiting.appendList(_packed(new))
        self._call_at(earliest // 1000)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        until = timerValues.getCurrentWatermarkInMs()
        self.due.clear()
        kept = dict(_unpacked(self.kept))
        ready, rest = {}, []
        for row in _unpacked(self.waiting):
            if row[0] // 1000 <= until:
                ready.setdefault(row[self.key], []).append(row)
            else:
                rest.append(row)
        wake_us, make, out = self.step.wake_us, Row(*self.names), Row(*self.out)
        for name in {**kept, **ready}:
            state = kept.pop(name, None)
            state = self.step.start() if state is None else state
            rows = sorted(ready.pop(name, ()), key=itemgetter(0, 1, 2))
            done = 0
            while True:
                row = rows[done] if done < len(rows) else None
                wake = wake_us(state)
                if wake is not None and wake // 1000 <= until and (row is None or wake < row[0]):
                    state, sent = self.step.expired(state, wake)
                    state = self.step.start() if state is None else state
                elif row is not None:
                    state, sent = self.step.step(state, make(*row))
                    done += 1
                else:
                    break
                for values in sent:
                    yield out(*values)
            if state != self.step.start():
                kept[name] = state
        _store(self.waiting, rest)
        _store(self.kept, list(kept.items()))
        times = [min(row[0] for row in rest)] if rest else []
        times += [wake for wake in map(wake_us, kept.values()) if wake is not None]
        if times:
            self._call_at(min(times) // 1000)

    def _call_at(self, at_ms: int) -> None:
        """Have the group's one timer no later than this."""
        if self.due.exists():
            known = self.due.get()[0]
            if known <= at_ms:
                return
            self.handle.deleteTimer(known)
        self.handle.registerTimer(at_ms)
        self.due.update((at_ms,))

    def close(self) -> None:
        pass


def _packed(items: list[tuple]) -> list[tuple[bytes]]:
    return [(pickle.dumps(items[at : at + ROWS_PER_PACK], pickle.HIGHEST_PROTOCOL),) for at in range(0, len(items), ROWS_PER_PACK)]


def _unpacked(state) -> Iterator[tuple]:
    if state.exists():
        for (packed,) in state.get():
            yield from pickle.loads(packed)


def _store(state, items: list[tuple]) -> None:
    if items:
        state.put(_packed(items))
    else:
        state.clear()


def in_order(stream: DataFrame, step: Step) -> DataFrame:
    """The outputs of `step` over the rows of each key of a stream that has a watermark on `timestamp`.

    A `side` column orders rows of the same time; without one all are alike. Records without a key are left out.
    """
    rows = keyed(stream)
    if "side" not in rows.columns:
        rows = rows.withColumn("side", F.lit(0))
    rows = rows.withColumn("at_us", F.unix_micros("timestamp"))
    more = [name for name in rows.columns if name not in (*ORDER, "timestamp")]
    rows = rows.select("timestamp", F.col("at_us"), F.col("side").cast("int").alias("side"), F.col("offset").cast("bigint").alias("offset"), *more)
    schema = T.StructType([rows.schema[name] for name in (*ORDER, *more)])
    groups = rows.withColumn("_bucket", F.pmod(F.xxhash64("key"), F.lit(BUCKETS))).groupBy("_bucket")
    return groups.transformWithState(InOrder(step, schema), step.output, "append", "eventTime")


class AsOf(Step):
    """Records (side 1) with the values that their key's newest update (side 0) has for `fields`."""

    def __init__(self, record: T.StructType, table: T.StructType, deleted_when_null: str | None) -> None:
        self.names, self.fields, self.deleted = record.names, table.names, deleted_when_null
        held = T.StructType([T.StructField(f"_found_{f.name}", f.dataType) for f in table])
        self.state = held.toDDL()
        self.output = T.StructType([*record.fields, *held.fields]).toDDL()

    def start(self) -> tuple:
        return (None,) * len(self.fields)

    def step(self, state: tuple, row: Row) -> tuple[tuple, list[tuple]]:
        if row["side"] == 0:
            gone = self.deleted is not None and row[f"_new_{self.deleted}"] is None
            return self.start() if gone else tuple(row[f"_new_{name}"] for name in self.fields), []
        return state, [(*(row[name] for name in self.names), *state)]


class Fold(Step):
    """A fold whose result depends on the order of the values; sent on after each row, with the row's time and offset."""

    def __init__(self, value: str, initial: tuple, state: str, fold) -> None:
        self.value, self.initial, self.state, self.fold = value, initial, state, fold
        self.output = f"key string, at_us bigint, offset bigint, {state}"

    def start(self) -> tuple:
        return self.initial

    def step(self, state: tuple, row: Row) -> tuple[tuple, list[tuple]]:
        state = self.fold(state, row[self.value])
        return state, [(row["key"], row["at_us"], row["offset"], *state)]


class RunningTotal(Step):
    """The total of `value` after each row, with the row's time and offset; rows without a value are passed over."""

    def __init__(self, value: str, kind: str) -> None:
        self.value, self.state = value, f"total {kind}"
        self.output = f"key string, at_us bigint, offset bigint, {self.state}"

    def start(self) -> tuple:
        return (None,)

    def step(self, state: tuple, row: Row) -> tuple[tuple, list[tuple]]:
        amount = row[self.value]
        if amount is None:
            return state, []
        total = amount if state[0] is None else state[0] + amount
        return (total,), [(row["key"], row["at_us"], row["offset"], total)]


class Silence(Step):
    """An alarm for each key from which nothing came for a time, once per silence."""

    state = "key string, last_us bigint, records bigint"
    output = "key string, last_us bigint, alarm_us bigint, records bigint"

    def __init__(self, limit_us: int) -> None:
        self.limit_us = limit_us

    def start(self) -> tuple:
        return None, None, 0

    def step(self, state: tuple, row: Row) -> tuple[tuple, list[tuple]]:
        return (row["key"], row["at_us"], state[2] + 1), []

    def wake_us(self, state: tuple) -> int | None:
        return None if state[1] is None else state[1] + self.limit_us

    def expired(self, state: tuple, at_us: int) -> tuple[tuple | None, list[tuple]]:
        key, last, records = state
        return None, [(key, last, at_us, records)]


class AtTicks(Step):
    """The newest `value` of each key at every tick, as long as it is younger than the look-back."""

    state = "key string, at_us bigint, tick_us bigint, value double"
    output = "key string, tick_us bigint, value double"

    def __init__(self, tick_us: int, lookback_us: int) -> None:
        self.tick_us, self.lookback_us = tick_us, lookback_us

    def start(self) -> tuple:
        return None, None, None, None

    def step(self, state: tuple, row: Row) -> tuple[tuple, list[tuple]]:
        return (row["key"], row["at_us"], -(-row["at_us"] // self.tick_us) * self.tick_us, row["value"]), []

    def wake_us(self, state: tuple) -> int | None:
        return state[2]

    def expired(self, state: tuple, at_us: int) -> tuple[tuple | None, list[tuple]]:
        key, at, tick, value = state
        later = tick + self.tick_us
        return (key, at, later, value) if later < at + self.lookback_us else None, [(key, tick, value)]


class FilteredChanges(Step):
    """The change stream of a filtered table: a row with its value, or a null where a row that was there no longer passes.

    Rows carry `passes`, whether the update satisfies the filter; deletes do not.
    """

    state = "value string"
    output = "key string, value string, at_us bigint, offset bigint"

    def start(self) -> tuple:
        return (None,)

    def step(self, state: tuple, row: Row) -> tuple[tuple, list[tuple]]:
        new = row["value"] if row["passes"] else None
        if new is None and state[0] is None:
            return state, []
        return (new,), [(row["key"], new, row["at_us"], row["offset"])]
