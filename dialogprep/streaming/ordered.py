"""Chat logs folded in event-time order: rows wait for the watermark, idle sessions give their history back."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from dialogprep.operators.chat import MAX_HISTORY, classify

#: A row with this time closes a log: it moves the watermark behind every row and is not folded.
END_OF_LOG = "9999-12-31 00:00:00"

#: ``transformWithState`` needs this state store.
STATE_STORE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}

_FIRST = -(1 << 63)


#: Sessions share the state of a bucket: what a micro-batch costs goes by buckets and rows, not by sessions.
BUCKETS = 512

#: New messages of one page: ``before`` messages of it came out earlier. Late rows come out in the same form.
_PAGES = "session bigint, no_session boolean, segment bigint, history_from bigint, before int, seqs array<bigint>, role array<string>, content array<string>, late boolean"


def _ordered_fold(max_history: int, idle_micros: int | None, first: int = _FIRST):
    """The processor. All it uses is local, so workers need no copy of this package."""
    key = [("no_session", pa.bool_()), ("session", pa.int64())]
    rows_of = pa.schema([*key, ("order", pa.int64()), ("ts", pa.int64()), ("role", pa.string()), ("line", pa.string()), *[(c, pa.bool_()) for c in ("is_exit", "is_reset", "joins")]])
    page_of = pa.schema([*key, ("role", pa.list_(pa.string())), ("content", pa.list_(pa.string()))])
    columns = ["session", "no_session", "segment", "history_from", "before", "seqs", "role", "content", "late"]
    rows_per_chunk, messages_per_frame = 1 << 16, 1 << 16
    unseen = (0, 0, first, False, None, 0)

    def chunks(table: pa.Table, rows: int = rows_per_chunk) -> list[tuple]:
        return [(batch.serialize().to_pybytes(),) for batch in table.combine_chunks().to_batches(max_chunksize=rows)]

    def whole(state, schema: pa.Schema) -> list[pa.RecordBatch]:
        return [pa.ipc.read_record_batch(pa.py_buffer(bytes(chunk)), schema) for (chunk,) in state.get()]

    def names(table: pa.Table) -> set[tuple]:
        return set(zip(table["no_session"].to_pylist(), table["session"].to_pylist(), strict=True))

    def tuples(table: pa.Table) -> Iterator[tuple]:
        return zip(*(column.to_pylist() for column in table.columns), strict=True)

    class OrderedFold(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            # the tombstones: what numbering and /exit need, kept for every session
            self.place = handle.getListState("place", "no_session boolean, session bigint, segment bigint, pos bigint, last bigint, closed boolean, latest bigint, in_page bigint")
            # Arrow batches of page_of and rows_of
            self.page = handle.getListState("page", "chunk binary")
            self.waiting = handle.getListState("waiting", "chunk binary")
            self.due = handle.getValueState("due", "due bigint")

        def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
            arrived = pa.Table.from_batches([pa.RecordBatch.from_pandas(frame, rows_of, preserve_index=False) for frame in rows], rows_of)
            passed, due = timerValues.getCurrentWatermarkInMs() * 1000, (self.due.get() or (None,))[0]
            earliest = pc.min(arrived["ts"]).as_py()
            if earliest >= passed and (due is None or due >= passed):
                self.waiting.appendList(chunks(arrived))
                fresh = names(arrived).difference(tuple(row)[:2] for row in self.place.get())
                if fresh:
                    self.place.appendList([(*name, *unseen) for name in fresh])
                self.wake(due, earliest if due is None else min(due, earliest))
                return
            yield from self.release(arrived, passed, due, due)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
            passed, due = timerValues.getCurrentWatermarkInMs() * 1000, (self.due.get() or (None,))[0]
            if due is not None and due < passed:
                yield from self.release(rows_of.empty_table(), passed, due, None)

        def wake(self, timer: int | None, due: int | None) -> None:
            """One timer for a bucket: ``timer`` gives way to ``due``."""
            if timer is not None and timer == due:
                return
            if timer is not None:
                self.handle.deleteTimer(timer // 1000 + 1)
            if due is None:
                self.due.clear()
            else:
                self.due.update((due,))
                self.handle.registerTimer(due // 1000 + 1)

        def release(self, arrived: pa.Table, passed: int, due: int, timer: int | None) -> Iterator[pd.DataFrame]:
            """Fold what the watermark has passed; set a timer for what it will pass next, or for the next idle session."""
            held = pa.Table.from_batches([*whole(self.waiting, rows_of), *arrived.to_batches()], rows_of)
            is_due = pc.less(held["ts"], passed)
            ready, rest = held.filter(is_due), held.filter(pc.invert(is_due))
            places = {row[:2]: list(row[2:]) for row in map(tuple, self.place.get())}
            pages = {row[:2]: row[2:] for row in tuples(pa.Table.from_batches(whole(self.page, page_of), page_of))}
            before = len(pages)
            if len(ready):
                yield from self.fold(ready, places, pages)
                if len(rest):
                    self.waiting.put(chunks(rest))
                else:
                    self.waiting.clear()
            still = names(rest)
            for name in still:
                places.setdefault(name, list(unseen))
            next_due = [pc.min(rest["ts"]).as_py()] if len(rest) else []
            gone = False
            for name, place in places.items() if idle_micros is not None else ():
                if not place[5] or place[4] is None or name in still:
                    continue
                if place[4] + idle_micros < passed:
                    pages.pop(name, None)
                    place[5], gone = 0, True
                else:
                    next_due.append(place[4] + idle_micros)
            if len(ready) or len(arrived) or gone:
                self.place.put([(*name, *place) for name, place in places.items()])
                if pages:
                    table = [(*name, *page) for name, page in pages.items()]
                    arrays = [pa.array(column, kind) for column, kind in zip(zip(*table, strict=True), page_of.types, strict=True)]
                    self.page.put(chunks(pa.Table.from_arrays(arrays, schema=page_of), 1 << 8))
                elif before:
                    self.page.clear()
            self.wake(timer, min(next_due, default=None))

        def fold(self, ready: pa.Table, places: dict, pages: dict) -> Iterator[pd.DataFrame]:
            told, size = [], 0
            for name, rows in groupby(sorted(tuples(ready), key=itemgetter(0, 1, 2, 3)), itemgetter(0, 1)):
                for page in self.of_session(name, rows, places, pages):
                    told.append(page)
                    size += len(page[6])
                    if size >= messages_per_frame:
                        yield pd.DataFrame(told, columns=columns, dtype=object)
                        told, size = [], 0
            if told:
                yield pd.DataFrame(told, columns=columns, dtype=object)

        @staticmethod
        def of_session(name: tuple, rows: Iterator[tuple], places: dict, pages: dict) -> Iterator[tuple]:
            """Fold a session's rows, which are in order; its new messages by page, and its late rows."""
            segment, pos, last, closed, latest, in_page = places.get(name, unseen)
            told, latest, behind = name[::-1], first if latest is None else latest, last
            roles, contents = pages.pop(name, None) or ([], [])
            before, seqs, late = len(roles), [], []
            for _, _, order, ts, role, line, is_exit, is_reset, joins in rows:
                if order < behind:
                    late.append((order, role, line))
                    if len(late) == max_history:
                        yield (*told, None, None, 0, *map(list, zip(*late, strict=True)), True)
                        late = []
                    continue
                last = order
                closed = closed or is_exit
                if closed:
                    continue
                paused = idle_micros is not None and ts != first and latest != first and ts - latest > idle_micros
                latest = max(latest, ts)
                if is_reset or paused or (joins and in_page % max_history == 0):
                    if seqs:
                        yield (*told, segment, pos - len(roles), before, seqs, roles, contents, False)
                    before, seqs, roles, contents = 0, [], [], []
                if is_reset:
                    segment, pos, in_page = segment + 1, 0, 0
                elif paused:
                    in_page = 0
                if joins:
                    seqs.append(order)
                    roles.append(role)
                    contents.append(line)
                    pos, in_page = pos + 1, in_page + 1
            if seqs:
                yield (*told, segment, pos - len(roles), before, seqs, roles, contents, False)
            if late:
                yield (*told, None, None, 0, *map(list, zip(*late, strict=True)), True)
            if closed:
                in_page = 0
            if in_page % max_history:
                pages[name] = (roles, contents)
            places[name] = [segment, pos, last, closed, None if latest == first else latest, in_page]

    return OrderedFold()


def _by_message(pages: DataFrame) -> DataFrame:
    """The rows of OUTPUT: each message with its page up to itself."""
    messages = F.arrays_zip("role", "content").alias("messages")
    rows = pages.select("session", "no_session", "segment", "history_from", "before", "late", messages, F.posexplode("seqs").alias("i", "seq"))
    at = F.col("before") + F.col("i")
    return rows.select(
        F.when(~F.col("no_session"), F.col("session")).alias("session"),
        "segment",
        (F.col("history_from") + at).alias("pos"),
        F.when(F.col("seq") != F.lit(_FIRST), F.col("seq")).alias("seq"),
        F.get(F.col("messages"), at)["role"].alias("role"),
        F.get(F.col("messages"), at)["content"].alias("line"),
        F.when(~F.col("late"), F.slice("messages", F.lit(1), at + 1)).alias("history"),
        "history_from",
        "late",
    )


def chat_history_in_order(log: DataFrame, delay: str, max_history: int = MAX_HISTORY, idle_seconds: int | None = None, buckets: int = BUCKETS) -> DataFrame:
    """``operators.chat.chat_history`` of a stream whose rows arrive in any order, up to ``delay`` late.

    ``log`` has a column ``ts`` beside those of a chat log, and ``ts`` grows with ``seq`` in a session. A row waits
    in list state until the watermark (the latest ``ts`` seen, less ``delay``) has passed its
    ``ts``; an event-time timer then folds all that are due in the order of their session's ``seq``. So whatever arrives within
    ``delay`` comes out as in the batch form, once. What comes later and behind a folded row has ``late`` set and
    joins nothing. A null ``ts`` waits for nothing. Rows of the null session are a session; a null ``seq`` sorts first.

    Sessions are dealt into ``buckets`` by hash, and one call folds all of a bucket that is due: a task holds what waits
    in one bucket, and there are at most as many tasks as buckets.
    State of a session is what waits, one page of at most ``max_history`` messages, and a tombstone: segment,
    position, last ``seq``, whether it is closed. With ``idle_seconds`` a pause longer than that starts a new page, as
    ``idle_seconds`` does in the batch form, and a timer deletes the page of a session that pauses; a closed
    session loses it at once. The tombstone stays, so that numbers go on and ``/exit`` holds.

    Run it with the settings in STATE_STORE. The last rows come out when the log is closed (``close_log``).
    """
    marked = log.withWatermark("ts", delay)
    marked = marked.where(F.col("ts").isNull() | (F.col("ts") < F.lit(END_OF_LOG).cast("timestamp")))
    rows = classify(marked, "ts").select(
        F.pmod(F.xxhash64("session"), F.lit(buckets)).alias("bucket"),
        # no nulls among numbers: pandas would make them floats
        F.col("session").isNull().alias("no_session"),
        F.coalesce(F.col("session").cast("bigint"), F.lit(0)).alias("session"),
        F.coalesce("seq", F.lit(_FIRST)).alias("order"),
        # a plain number: Spark would drop rows that are later than the watermark without a word
        F.coalesce(F.unix_micros(F.col("ts").cast("timestamp")), F.lit(_FIRST)).alias("ts"),
        "role",
        "line",
        "is_exit",
        "is_reset",
        "joins",
    )
    idle = None if idle_seconds is None else idle_seconds * 1_000_000
    pages = rows.groupBy("bucket").transformWithStateInPandas(_ordered_fold(max_history, idle), _PAGES, "append", "eventTime")
    return _by_message(pages)


def close_log(spark: SparkSession, path: str, schema: str, fmt: str = "parquet") -> None:
    """Adds the row that ends a log of files with the given columns, ``ts`` among them."""
    row = spark.range(1).select(F.lit(END_OF_LOG).cast("timestamp").alias("ts"))
    fields = spark.createDataFrame([], schema).schema
    row.select(*[(F.col("ts") if f.name == "ts" else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields]).write.mode("append").format(fmt).save(path)
