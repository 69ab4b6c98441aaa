"""Facts joined to the version of a dimension that was valid at their time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Days of a time bucket.
BUCKET_DAYS = 180


def join_valid(
    facts: DataFrame, versions: DataFrame, on: dict[str, str], at: str, columns: Sequence[str],
    valid_from: str = "valid_from", valid_to: str = "valid_to", days: int = BUCKET_DAYS,
) -> DataFrame:
    """All ``facts`` with ``columns`` of the version valid on the day of ``at`` (from its first day up to, not
    including, its last; no last day: still valid).

    ``on`` maps fact columns to key columns. Versions are spread over the time buckets they touch, within the days that facts have,
    so key and bucket are an equi-key and the days are compared only inside: the work is linear in facts and in
    touched buckets, and adaptive execution splits the facts of a hot key. The spread versions are merged and never broadcast:
    they are many times what their files' size makes Spark expect. A fact without a valid version, or with a NULL key
    or time, keeps NULLs; a fact in several overlapping versions is repeated, which histories of this package never cause.
    """
    taken = {c.lower() for c in facts.columns}
    if clash := [c for c in columns if c.lower() in taken]:
        raise ValueError(f"facts have columns {clash} already")
    day = F.col(at).cast("date")

    def bucket(d):
        return F.floor(F.unix_date(d) / days)

    span = facts.agg(F.struct(F.min(day).alias("a"), F.max(day).alias("b"))).scalar()
    known = versions.select(
        *[F.col(d).alias(f"_key{i}") for i, d in enumerate(on.values())],
        F.col(valid_from).cast("date").alias("_from"), F.col(valid_to).cast("date").alias("_to"), *columns,
    )
    first, last = F.greatest(F.col("_from"), span["a"]), F.least(F.date_sub("_to", 1), span["b"])  # nulls don't count
    spread = known.withColumns({"_first": first, "_last": last}).where("_first <= _last")
    spread = spread.withColumn("_bucket", F.explode(F.sequence(bucket(F.col("_first")), bucket(F.col("_last")))))
    spread = spread.drop("_first", "_last")
    here = facts.withColumns({"_day": day, "_at_bucket": bucket(day)})
    same = [F.col(f) == F.col(f"_key{i}") for i, f in enumerate(on)]
    same += [F.col("_at_bucket") == F.col("_bucket"), F.col("_day") >= F.col("_from")]
    same.append(F.col("_to").isNull() | (F.col("_day") < F.col("_to")))
    return here.join(spread.hint("merge"), same, "left").select(*facts.columns, *columns)
