"""Conversation turn reassembly with a stateful operator.

`dealt` makes arrivals (conv_id, turn, role, text, first, batch) of a table of
turns, one for every row and batch it comes in; `first` is the conversation's
smallest turn.

`reassemble` takes a stream of such arrivals, all of one batch in one
micro-batch and in any order, and gives a stream of events. Of a turn's
arrivals in a batch only the smallest payload (UTF-8 bytes of role|text, then
of role) counts. Its sequencer is keyed by conv_id. It files a turn that its
map state doesn't hold from an earlier batch (a later arrival is activity
only), and releases the gapless run from `first`; a released turn's text leaves
the state, its role stays. A timer wakes every open conversation once in each
later batch: `quiet` batches without an arrival close it, and so does batch
`end`. What arrives for a closed conversation is rejected.

Events: release and reject (turn, role, text), close (turn -1; unreleased: the
kept turns that were never released, ascending; n_missing: turns from `first`
to the largest kept one that aren't kept; n_breaks: kept turns whose kept
predecessor has the same role). A closed conversation keeps one small row.

`replay` deals a table of turns to batches, feeds them to the stream, started
anew for each batch on one checkpoint, and returns the events. Every batch has
a row without conv_id, so that empty batches run too and the timers count them.

Defined cases: turns without conv_id or turn belong nowhere and are dropped;
null role and text are empty; repeated turns of one batch are one arrival;
other columns are ignored; an empty table has no events. A lost executor's
micro-batch is run again from the checkpoint, with the same batch timestamp.
The state of a conversation is read turn by turn; only HELD arrivals are held
in memory at a time, and the numbers of the turns that are unreleased when it
closes, or that are rejected in a batch.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from .common import saved, scratch

ARRIVAL = "conv_id long, turn long, role string, text string, first long, batch int"
EVENT = "event string, conv_id long, turn long, batch int, role string, text string, unreleased array<long>, n_missing long, n_breaks long"
#: Fixed by the contract of the query.
BATCHES, QUIET = 10, 2
#: Turns of which the smallest payload so far is held in memory before it goes to the state.
HELD = 1000
#: transformWithState needs RocksDB. A commit uploads the changes, not the store; files have no room set aside for
#: growth (many small stores); a start has one micro-batch, so that timers run with a batch's data and never alone,
#: and a store that has committed it is of no more use to its executor. All stores of an executor share one cache and
#: write buffer. Spark never closes the RocksDB statistics of a store, so that an executor's native memory grows with
#: the stores it has opened: a start opens one a partition, no more.
SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "64",
    "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB": "4",
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}

_Event = Row("event", "conv_id", "turn", "batch", "role", "text", "unreleased", "n_missing", "n_breaks")


def _payload(role: str, text: str) -> tuple[bytes, bytes]:
    return f"{role}|{text}".encode(), role.encode()


def _least(rows, most: int):
    """The rows without most repeats: of every `most` turns at a time the smallest payloads."""
    held: dict = {}
    for r in rows:
        p = _payload(r.role, r.text)
        if r.turn not in held and len(held) == most:
            yield from (x for _, x in held.values())
            held = {}
        if r.turn not in held or p < held[r.turn][0]:
            held[r.turn] = p, r
    yield from (x for _, x in held.values())


class Sequencer(StatefulProcessor):
    def __init__(self, quiet: int, end: int | None):
        self.quiet, self.end, self.held = quiet, end, HELD

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # seen: timestamp of the last batch with an arrival; idle: batches since
        self.state = handle.getValueState("state", "closed boolean, first long, next long, most long, kept long, breaks long, batch int, idle int, seen long")
        # batch: that of the arrival kept
        self.turns = handle.getMapState("turns", "turn long", "role string, text string, batch int")

    def _alike(self, turn: int, role: str) -> int:
        """How many neighbours of a turn have the role."""
        near = (self.turns.getValue((t,)) for t in (turn - 1, turn + 1))
        return sum(x is not None and x[0] == role for x in near)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        state, conv, now = self.state.get(), key[0], timerValues.getCurrentProcessingTimeInMs()
        if state is not None and state[0]:
            yield from self._rejected(conv, rows)
            return
        _, first, after, most, kept, breaks, batch, _, _ = state or (False, None, None, None, 0, 0, None, 0, None)
        for r in _least(rows, self.held):
            batch, first, after = r.batch, r.first, r.first if after is None else after
            old = self.turns.getValue((r.turn,))
            if old is None:
                most, kept = r.turn if most is None else max(most, r.turn), kept + 1
            elif old[2] != r.batch or r.turn < after or _payload(*old[:2]) <= _payload(r.role, r.text):
                continue
            else:
                breaks -= self._alike(r.turn, old[0])
            self.turns.updateValue((r.turn,), (r.role, r.text, r.batch))
            breaks += self._alike(r.turn, r.role)
        while most is not None and after <= most and (held := self.turns.getValue((after,))) is not None:
            yield _Event("release", conv, after, batch, held[0], held[1], None, None, None)
            self.turns.updateValue((after,), (held[0], None, held[2]))
            after += 1
        self.state.update((False, first, after, most, kept, breaks, batch, 0, now))
        if state is None:
            self.handle.registerTimer(now + 1)

    def _rejected(self, conv: int, rows) -> Iterator[Row]:
        """A closed conversation's map is empty; it holds the turns of this batch until all have come."""
        for r in _least(rows, self.held):
            old = self.turns.getValue((r.turn,))
            if old is None or _payload(r.role, r.text) < _payload(*old[:2]):
                self.turns.updateValue((r.turn,), (r.role, r.text, r.batch))
        for t in sorted(t for (t,) in self.turns.keys()):
            role, text, batch = self.turns.getValue((t,))
            yield _Event("reject", conv, t, batch, role, text, None, None, None)
        self.turns.clear()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = timerValues.getCurrentProcessingTimeInMs()
        _, first, after, most, kept, breaks, batch, idle, seen = self.state.get()
        ended = self.end is not None and batch + idle + 1 >= self.end
        if seen == now or idle + 1 < self.quiet and not ended:
            if seen != now:
                self.state.update((False, first, after, most, kept, breaks, batch, idle + 1, seen))
            self.handle.registerTimer(now + 1)
            return
        left = [] if most is None or kept == after - first else sorted(t for (t,) in self.turns.keys() if t >= after)
        self.turns.clear()
        self.state.update((True, first, after, most, kept, breaks, batch, idle + 1, seen))
        missing = 0 if most is None else most - first + 1 - kept
        yield _Event("close", key[0], -1, batch + idle + 1, None, None, left, missing, breaks)


def reassemble(arrivals: DataFrame, quiet: int = QUIET, end: int | None = None) -> DataFrame:
    """The stream of events of a stream of arrivals; rows without conv_id or turn only mark that a batch is there."""
    rows = arrivals.where("conv_id is not null and turn is not null").fillna("", ["role", "text"])
    return rows.groupBy("conv_id").transformWithState(Sequencer(quiet, end), EVENT, "Append", "ProcessingTime")


def dealt(turns: DataFrame, batches: int = BATCHES) -> DataFrame:
    """The arrivals of a table of turns: batch by hash, some again as the user's five batches on."""
    rows = turns.where("conv_id is not null and turn is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    first = saved(rows.groupBy("conv_id").agg(F.min("turn").alias("first")))
    h = F.conv(F.substring(F.sha2(F.concat("conv_id", F.lit(":"), "turn"), 256), 1, 8), 16, 10).cast("long")
    again = F.when(h % 7 < 2, F.struct(((h + 5) % batches).cast("int").alias("batch"), F.lit("user").alias("role")))
    each = F.explode(F.filter(F.array(F.struct((h % batches).cast("int").alias("batch"), "role"), again), lambda x: x.isNotNull()))
    return rows.select("conv_id", "turn", "text", each.alias("a")).join(first, "conv_id").select("conv_id", "turn", "a.role", "text", "first", "a.batch")


def replay(turns: DataFrame, batches: int = BATCHES, quiet: int = QUIET) -> DataFrame:
    """Events of a table of turns; batch `batches` is the end, which closes what is open."""
    spark, folder = turns.sparkSession, scratch(turns.sparkSession)
    dealt(turns, batches).write.partitionBy("batch").parquet(f"{folder}/dealt")
    arrivals = spark.read.schema(ARRIVAL).parquet(f"{folder}/dealt")
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    try:
        for k, v in SETTINGS.items():
            spark.conf.set(k, v)
        for batch in range(batches + 1):
            mark = spark.range(1).select(*(F.lit(batch if n == "batch" else None).cast(t).alias(n) for n, t in (x.split() for x in ARRIVAL.split(", "))))
            arrivals.where(F.col("batch") == batch).unionByName(mark).write.mode("append").parquet(f"{folder}/fed")
            events = reassemble(spark.readStream.schema(ARRIVAL).parquet(f"{folder}/fed"), quiet, batches)
            events.writeStream.format("parquet").option("path", f"{folder}/events").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start().awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return spark.read.schema(EVENT).parquet(f"{folder}/events")


def digests(events: DataFrame) -> DataFrame:
    """Events with the sha256 of the payload, or of the unreleased turns."""
    said = F.when(F.col("event") == "close", F.array_join("unreleased", ",")).otherwise(F.concat("role", F.lit("|"), "text"))
    return events.select("event", F.sha2(said, 256).alias("sha256"), "conv_id", "turn", F.col("batch").cast("long").alias("batch"), "n_missing", "n_breaks")
