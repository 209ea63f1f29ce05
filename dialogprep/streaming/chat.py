"""Chat logs folded into histories as their lines arrive."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from dialogprep.operators.chat import MAX_HISTORY, chat_history, classify

OUTPUT = (
    "session bigint, segment bigint, pos bigint, seq bigint, role string, line string, "
    "history array<struct<role:string,content:string>>, history_from bigint, late boolean"
)
STATE = (
    "segment bigint, pos bigint, last_seq bigint, closed boolean, "
    "roles array<string>, lines array<string>"
)


#: Stands for a null ``seq``, which sorts before all others.
_FIRST = -(1 << 63)


def _folder(max_history: int, first: int = _FIRST):
    """The state function. All it uses is local, so workers need no copy of this package."""
    taken = ["seq", "role", "line", "is_exit", "is_reset", "joins"]
    columns = ["session", "segment", "pos", "seq", "role", "line", "history", "history_from", "late"]
    rows_per_frame = 4096

    def frame(rows: list[tuple]) -> pd.DataFrame:
        # Objects, because rows that are late have no segment and no position.
        return pd.DataFrame(rows, columns=columns, dtype=object)

    def fold(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        session = None if key[0] is None or key[0] != key[0] else int(key[0])
        if state.exists:
            segment, pos, last_seq, closed, roles, lines = state.get
            history = [{"role": r, "content": t} for r, t in zip(roles, lines)]
        else:
            segment, pos, last_seq, closed, history = 0, 0, None, False, []

        arrived = [row for b in batches for row in zip(*(b[c].tolist() for c in taken))]
        arrived.sort(key=lambda row: row[0])
        out = []
        for seq, role, line, is_exit, is_reset, joins in arrived:
            if last_seq is not None and seq <= last_seq:
                out.append((session, None, None, None if seq == first else seq, role, line, None, None, True))
            else:
                last_seq = seq
                if closed or is_exit:
                    closed = True
                elif is_reset:
                    segment, pos, history = segment + 1, 0, []
                elif joins:
                    if pos % max_history == 0:
                        history = []
                    history.append({"role": role, "content": line})
                    out.append((session, segment, pos, None if seq == first else seq, role, line, list(history), pos - pos % max_history, False))
                    pos += 1
            if len(out) == rows_per_frame:
                yield frame(out)
                out = []
        roles, lines = [m["role"] for m in history], [m["content"] for m in history]
        state.update((segment, pos, last_seq, closed, roles, lines))
        if out:
            yield frame(out)

    return fold


def chat_history_stream(
    log: DataFrame, max_history: int = MAX_HISTORY
) -> DataFrame:
    """``operators.chat.chat_history`` with state kept per session.

    Rows of a micro-batch are folded in ``seq`` order, so one task holds what a
    session sent within the batch: read the log with a limit per batch
    (``streaming.sources.read_stream``). A row not above the last
    ``seq`` seen comes out with ``late`` set and joins nothing. No session is
    forgotten: state holds its segment, position, last ``seq``, whether it is
    closed, and one page of at most ``max_history`` lines. ``history`` and
    ``history_from`` are those of the batch form. Rows of the null session are a
    session like any other; a null ``seq`` sorts first.
    """
    return (
        classify(log)
        .withColumn("seq", F.coalesce("seq", F.lit(_FIRST)))
        .groupBy("session")
        .applyInPandasWithState(
            _folder(max_history),
            OUTPUT,
            STATE,
            "append",
            GroupStateTimeout.NoTimeout,
        )
    )


def accepted(folded: DataFrame) -> DataFrame:
    return folded.where(~F.col("late")).drop("late")


def late_rows(folded: DataFrame) -> DataFrame:
    return folded.where("late").select("session", "seq", "role", "line")


def settled(folded: DataFrame, log: DataFrame, max_history: int = MAX_HISTORY) -> DataFrame:
    """The drained stream as ``operators.chat.chat_history`` of ``log``, the log it was read from, has it.

    A late row may move each row of its session, so sessions with late rows are
    folded again from the log; the others are as the stream folded them.
    """
    again = late_rows(folded).select(F.col("session").alias("_again")).distinct()
    same = F.col("session").eqNullSafe(F.col("_again"))
    kept = accepted(folded).join(again, same, "left_anti")
    repaired = chat_history(log.join(again, same, "left_semi"), max_history)
    return kept.unionByName(repaired.select(*[F.col(c).cast(kept.schema[c].dataType) for c in kept.columns]))
