"""Jobs with their settings: product build, backfill and daily load."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, field, fields
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.plans.builder import build_products
from larder.sources.landing import write_rows
from larder.sources.partitioned import write_partitions

ENV_PREFIX = "LARDER_"


@dataclass(frozen=True)
class JobSettings:
    start_date: date = date(2024, 1, 1)
    end_date: date = field(default_factory=date.today)
    seed: int = 42
    output: str = "./data"
    n_products: int = 2000
    country: str = "AU"

    def __post_init__(self):
        if self.country != "AU":
            raise ValueError(f"country {self.country!r} is not supported")
        if self.end_date < self.start_date:
            raise ValueError(f"end {self.end_date} lies before start {self.start_date}")

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None) -> JobSettings:
        """Settings from variables such as ``LARDER_SEED``; unset ones keep their default."""
        env = os.environ if env is None else env
        given = {}
        for f in fields(cls):
            text = env.get(ENV_PREFIX + f.name.upper())
            if text is not None:
                kind = str(f.type)
                parse = date.fromisoformat if kind == "date" else int if kind == "int" else str
                given[f.name] = parse(text)
        return cls(**given)


def job_products(spark: SparkSession, n: int = 2000, seed: int = 42, output: str = "./data") -> str:
    """Build the products and write them as ``dim_product.parquet`` below ``output``."""
    return write_rows(build_products(spark, n, seed), f"{output}/dim_product.parquet")


def dated(events: DataFrame, ts: str = "ts") -> DataFrame:
    return events.withColumn("event_date", F.col(ts).cast("date"))


#: Partition column that names the source of rows without a time; rows of a day hold ``BY_DAY`` there.
UNDATED_OF, BY_DAY = "undated_of", "-"


def job_backfill(
    events: DataFrame, start: date, end: date, output: str, ts: str = "ts", source: str = "events"
) -> str:
    """Load the days start..end; a repeated run replaces just those days.

    A day is one partition and is replaced as a whole; a day the source has no rows for keeps what
    it had. Rows without a time belong to no day: every load puts all those of its source into a partition that
    bears the source's name, so a load replaces only its own and none is lost. ``source`` names what is loaded, such as a
    file of a daily delivery; two sources must not share a name. The range is tested on the timestamp itself, so
    it reaches the scan of the source.
    """
    if source == BY_DAY:
        raise ValueError(f"a source can't be named {BY_DAY!r}")
    wanted = events.filter(
        F.col(ts).isNull()
        | ((F.col(ts) >= F.lit(start).cast("date")) & (F.col(ts) < F.date_add(F.lit(end), 1)))
    )
    of = F.when(F.col(ts).isNull(), F.lit(source)).otherwise(F.lit(BY_DAY))
    rows = dated(wanted, ts).withColumn(UNDATED_OF, of)
    return write_partitions(rows, output, ["event_date", UNDATED_OF])


def job_daily(events: DataFrame, day: date, output: str, ts: str = "ts", source: str = "events") -> str:
    """Load one day."""
    return job_backfill(events, day, day, output, ts, source)
