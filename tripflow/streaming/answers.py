"""ST1 per request: trips that arrive one per line are put together again and answered as a whole, in order.

A line is ``{"request_id", "pos", "n_trips", "sent_at", "trip"}`` (``trip`` as the client sent it; a request without
trips is one line with n_trips 0 and no pos). Lines of a request may be out of order, repeated, and spread over files
and micro-batches. The state of a request is its trips and which positions it holds (``transformWithState``, kept in RocksDB
and checkpointed to the shared folder):

* when all ``n_trips`` positions are there, the request leaves as one body and only its being answered is remembered;
* a repeated position is ignored: the line of the earlier batch counts, within a batch the smallest text;
* positions outside 0 .. n_trips - 1, and another n_trips than the first one, make the request ``malformed``;
* an event-time timer at ``sent_at`` + patience ends a request that is not complete: it leaves as ``incomplete``;
* lines for a request that has left are ignored while it is remembered (another patience); after that their event
  time is behind the watermark, and Spark drops them.

So each request leaves once, whatever is repeated or late. The stateless rest is the batch code: the same parsing,
validation and scoring, in ``foreachBatch``, a folder for each batch.

A request costs a few calls to the state, whatever its trips: rows rather than a pandas frame a request, its state read
and written as one value, trips that wait appended at once. A batch is read once, since a second look at it would run
the stateful step again.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tripflow.plans.scoring import REJECTED_STATUS, parse_requests, score_requests, validate_requests

LINE = "request_id bigint, pos int, n_trips int, sent_at timestamp, trip string"
ASSEMBLED = "request_id bigint, state string, n_received int, body string"
COMPLETE, INCOMPLETE, MALFORMED = "complete", "incomplete", "malformed"
#: The answer to a request that never came whole.
INCOMPLETE_STATUS = 408
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class RequestAssembler(StatefulProcessor):
    """One request's trips, by position, until all are there or its time is over."""

    def __init__(self, patience: dt.timedelta):
        self.patience_ms = int(patience.total_seconds() * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.trips = handle.getListState("trips", "pos int, trip string")
        self.head = handle.getValueState("head", "n_trips int, held array<int>, left boolean, ends bigint")

    def _leave(self, key, state: str, received: int, body: str | None, until: int) -> Row:
        self.head.update((0, [], True, until))
        self.handle.registerTimer(until)
        return Row(request_id=key[0], state=state, n_received=received, body=body)

    def _forget(self, head) -> None:
        """Drops the trips that wait, and the timer that would end the request."""
        if head is not None:
            if head[1]:
                self.trips.clear()
            self.handle.deleteTimer(head[3])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        head = self.head.get()
        if head is not None and head[2]:
            return
        lines = list(rows)
        # a timer must lie ahead of the watermark
        until = max(min(r.sent_ms for r in lines), timerValues.getCurrentWatermarkInMs() or 0) + self.patience_ms
        counts = sorted({-1 if r.n_trips is None else r.n_trips for r in lines})
        expected = counts[0] if head is None else head[0]
        held = [] if head is None else list(head[1])
        arrived: dict[int, str | None] = {}
        for r in lines:
            # within a batch the smallest text, none last
            if r.pos is not None and (r.pos not in arrived or arrived[r.pos] is None or r.trip is not None and r.trip < arrived[r.pos]):
                arrived[r.pos] = r.trip
        if expected < 0 or counts != [expected] or any(not 0 <= p < expected for p in arrived):
            self._forget(head)
            yield self._leave(key, MALFORMED, len(held), None, until)
            return
        known = set(held)
        new = [(p, arrived[p]) for p in sorted(arrived) if p not in known]
        received = len(held) + len(new)
        if received == expected:
            whole = dict(new)
            if held:
                whole.update((p, t) for p, t in self.trips.get())
            self._forget(head)
            body = '{"trips":[' + ",".join("null" if whole[p] is None else whole[p] for p in range(expected)) + "]}"
            yield self._leave(key, COMPLETE, received, body, until)
            return
        if new:
            self.trips.appendList(new)
        if new or head is None:
            self.head.update((expected, held + [p for p, _ in new], False, until if head is None else head[3]))
        if head is None:
            self.handle.registerTimer(until)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        _, held, left, _ = self.head.get()
        if left:
            self.head.clear()
            return
        if held:
            self.trips.clear()
        # the timer that expired goes by itself
        yield self._leave(key, INCOMPLETE, len(held), None, expiredTimerInfo.getExpiryTimeInMs() + self.patience_ms)

    def close(self) -> None:
        pass


def assemble_requests(lines: DataFrame, patience: dt.timedelta, delay: str) -> DataFrame:
    """``request_id, state, n_received, body`` of a stream of line texts (``value``); lines without a request_id, a
    sent_at or JSON are no request's and are left out."""
    line = F.from_json("value", LINE)
    parsed = lines.select(line.alias("l")).select("l.*").where("request_id is not null and sent_at is not null")
    timed = parsed.withWatermark("sent_at", delay).withColumn("sent_ms", F.unix_millis("sent_at"))
    return timed.groupBy("request_id").transformWithState(RequestAssembler(patience), ASSEMBLED, "Append", "EventTime")


def answer(batch: DataFrame, scorer, metadata: dict) -> DataFrame:
    """The answers of assembled requests, with the columns of ``score_requests``: whole ones as in batch, malformed
    ones rejected, incomplete ones with INCOMPLETE_STATUS; both without predictions."""
    # the state travels with the request: a batch that is read twice runs the stateful step twice
    scored = score_requests(validate_requests(parse_requests(batch.drop("n_received"))), scorer, metadata, more=("state",))
    return scored.withColumn(
        "status", F.when(F.col("state") == INCOMPLETE, INCOMPLETE_STATUS).when(F.col("state") == MALFORMED, REJECTED_STATUS).otherwise(F.col("status"))).drop("state")


def start_answers(spark: SparkSession, source_dir: str, sink_dir: str, checkpoint_dir: str, scorer, metadata: dict,
                  patience: dt.timedelta = dt.timedelta(minutes=10), delay: str = "10 minutes", max_files_per_trigger: int = 64, available_now: bool = True):
    """Start (or go on with) the stream: state, timers and offsets are in ``checkpoint_dir``, so a restarted one knows
    which requests are half there and which have been answered."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    lines = spark.readStream.option("maxFilesPerTrigger", max_files_per_trigger).text(source_dir)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        answer(batch, scorer, metadata).write.mode("overwrite").parquet(f"{sink_dir}/batch={batch_id}")

    writer = assemble_requests(lines, patience, delay).writeStream.outputMode("append").foreachBatch(write_batch).option(
        "checkpointLocation", checkpoint_dir)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()


def run_answers(spark: SparkSession, source_dir: str, sink_dir: str, checkpoint_dir: str, scorer, metadata: dict, **options):
    """Answer what is in ``source_dir`` now, and stop."""
    q = start_answers(spark, source_dir, sink_dir, checkpoint_dir, scorer, metadata, **options)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return q
