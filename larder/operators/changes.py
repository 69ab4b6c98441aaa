"""History from a feed of changes that arrive late and out of order, on two time axes.

A change says what holds from its event time on, or that the key is gone. What held when follows from the set of all
changes known, whatever order they came in: a late change splits the interval it falls into. What was
known when is kept beside it: intervals that a batch replaces are closed on the axis of arrivals, never deleted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from larder.operators.history import dedup_latest

EVENT, ARRIVAL, GONE = "event_time", "arrival", "is_deleted"


def valid_history(changes: DataFrame, keys: Sequence[str], attributes: Sequence[str]) -> DataFrame:
    """Keys, attributes, valid_from, valid_to (NULL: still holds) after all ``changes``.

    ``changes`` has the keys, the attributes, ``event_time``, ``arrival`` and ``is_deleted``. Of several changes of a key
    at one event time the last arrival counts; of equal ones a delete, then the highest attributes. A change that changes nothing and a delete of what is
    not there leave no trace; a key may come back. A missing key is a key of its own; changes without an event
    time are left out (:func:`undated_changes`). The ranking keeps one row per key, event time and task before the
    shuffle; the windows then sort one key's changes in one task, spilling where they are many.
    """
    columns = [*keys, EVENT, ARRIVAL, GONE, *attributes]
    dated = changes.where(f"{EVENT} is not null").select(*columns)
    last = dedup_latest(dated, [*keys, EVENT], [ARRIVAL, GONE])
    in_time = W.partitionBy(*keys).orderBy(EVENT)
    state = F.when(~F.col(GONE), F.struct(*attributes))
    before = F.lag("_state").over(in_time)
    moved = last.withColumn("_state", state).withColumn("_before", before).where("not (_state <=> _before)")
    closed = moved.withColumn("valid_to", F.lead(EVENT).over(in_time)).where("_state is not null")
    return closed.select(*keys, *attributes, F.col(EVENT).alias("valid_from"), "valid_to")


def undated_changes(changes: DataFrame) -> DataFrame:
    """Changes that say nothing about any time."""
    return changes.where(f"{EVENT} is null")


def merge_arrivals(known: DataFrame, changes: DataFrame, keys: Sequence[str], attributes: Sequence[str], arrival) -> DataFrame:
    """The two-axis history after the batch ``arrival``: that of ``changes`` up to then.

    ``known`` has keys, attributes, valid_from, valid_to, known_from, known_to. Only keys with a change in the batch are made
    again. Their intervals that no longer hold get ``known_to``, new ones ``known_from``; all others pass as they are.
    A batch merged once more changes nothing.
    """
    upto = changes.where(F.col(ARRIVAL) <= F.lit(arrival))
    touched = upto.where(F.col(ARRIVAL) == F.lit(arrival)).select(*[F.col(k).alias(f"_t_{k}") for k in keys]).distinct()

    def of_touched(df: DataFrame, how: str) -> DataFrame:
        return df.join(touched, [F.col(k).eqNullSafe(F.col(f"_t_{k}")) for k in keys], how)

    now = valid_history(of_touched(upto, "left_semi"), keys, attributes)
    facts = [*keys, *attributes, "valid_from", "valid_to"]
    open_rows = known.where("known_to is null")
    old = of_touched(open_rows, "left_semi").select(*facts, "known_from", F.lit(True).alias("_old"))
    new = now.select(*[F.col(c).alias(f"_n_{c}") for c in facts], F.lit(True).alias("_new"))
    met = old.join(new, [F.col(c).eqNullSafe(F.col(f"_n_{c}")) for c in facts], "full_outer")
    stamp = F.lit(arrival)
    kept = met.select(
        *[F.when(F.col("_old"), F.col(c)).otherwise(F.col(f"_n_{c}")).alias(c) for c in facts],
        F.when(F.col("_old"), F.col("known_from")).otherwise(stamp).cast(known.schema["known_from"].dataType).alias("known_from"),
        F.when(F.col("_new"), F.lit(None)).otherwise(stamp).cast(known.schema["known_to"].dataType).alias("known_to"),
    )
    rest = of_touched(open_rows, "left_anti").unionByName(known.where("known_to is not null"))
    return kept.unionByName(rest.select(*kept.columns))


def empty_history(changes: DataFrame, keys: Sequence[str], attributes: Sequence[str]) -> DataFrame:
    """A two-axis history with nothing known, to merge the first batch into."""
    none = changes.where("false").select(
        *keys, *attributes, F.col(EVENT).alias("valid_from"), F.col(EVENT).alias("valid_to"),
        F.col(ARRIVAL).alias("known_from"), F.col(ARRIVAL).alias("known_to"),
    )
    return none


def known_at(history: DataFrame, arrival) -> DataFrame:
    """The history as it was known after the batch ``arrival``."""
    at = F.lit(arrival)
    rows = history.where((F.col("known_from") <= at) & (F.col("known_to").isNull() | (F.col("known_to") > at)))
    return rows.drop("known_from", "known_to")
