"""Mixing sources to target weights by systematic sampling.

Every source gets a target number of words: its weight's share of the total asked for, at most
``max_repeat`` times its own words, the excess shared again by weight. A document's expected copies
are target / source words. Prefix sums of them run through each source in order of size class and
hash, start at one random offset drawn from the source's name and the seed, and a document is
emitted once for every integer its step crosses. Running through sizes in order keeps the words
taken close to the target: neighbours of one size replace each other.

Defined cases: null text has no words, and a document without words is taken like any other of its
source but adds nothing; the null source is a source, last in order; rows repeated with one id are
rows of their own, with equal sizes, so it doesn't matter which of them is which; a null id hashes
as the empty text; an empty table gives an empty result. Sampling depends on ids, sources, sizes and
the seed alone, so reruns agree.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.common import WORD, drop_written, fresh, materialize, whole

#: Cells of one source: size classes times these.
HASH_DIGITS = 2


def n_words(text: str) -> Column:
    return F.regexp_count(whole(text), F.lit(WORD)).cast("bigint")


def targets(sources: DataFrame, weights: Sequence[int], share: tuple[int, int], max_repeat: int) -> DataFrame:
    """One row per source with its weight and target; ``sources`` has source and source_size.

    Sources are filled in order of size over weight: the first that isn't full at the level reached
    sets the level of all that follow. Runs over one row per source.
    """
    up, down = share
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.array(*[F.lit(w) for w in weights])[((F.row_number().over(by_name) - 1) % len(weights)).cast("int")]
    s = sources.withColumn("weight", weight).withColumn("cap", max_repeat * F.col("source_size"))
    fill = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    before, after = fill.rowsBetween(Window.unboundedPreceding, -1), fill.rowsBetween(0, Window.unboundedFollowing)
    s = (
        s.withColumn("full", F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("rest", F.sum("weight").over(after))
        .withColumn("total", F.sum("source_size").over(every))
        .withColumn("level", (up * F.col("total") - down * F.col("full")).cast("double") / (down * F.col("rest")).cast("double"))
        .withColumn("place", F.row_number().over(fill))
    )
    fits = F.when(F.col("weight") * F.col("level") <= F.col("cap"), F.col("place"))
    s = s.withColumn("first", F.min(fits).over(every))
    level = F.max(F.when(F.col("place") == F.col("first"), F.col("level"))).over(every)
    target = F.least(F.col("cap").cast("double"), F.col("weight") * F.coalesce(level, F.lit(float("inf"))))
    return s.select("source", "source_size", "weight", target.alias("target"))


def _key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), source), F.lit("null"))


def with_copies(
    docs: DataFrame,
    weights: Sequence[int] = (3, 1, 2),
    share: tuple[int, int] = (3, 2),
    max_repeat: int = 2,
    seed: str = "mix",
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    out: str = "_mix",
) -> DataFrame:
    """``docs`` and a struct ``out``: size, source_size, target, copies. ``share``: of all words, as a fraction.

    A hot source is dealt out by size class and hash prefix: row numbers are taken inside such a cell,
    and the cells' counts (a bounded number per source) are summed up before. Documents are shuffled once.
    """
    order = F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))))
    size = n_words(text)
    bits = F.bin(size)
    kind = F.concat(F.lpad(F.length(bits).cast("string"), 2, "0"), F.lit("."), F.substring(bits, 2, 3))
    mark, cell, place = (fresh(docs, name) for name in ("mark", "cell", "place"))
    marked = docs.withColumn(
        mark,
        F.struct(
            _key(F.col(source)).alias("key"), F.col(source).alias("source"), size.alias("size"), kind.alias("kind"),
            order.alias("hash"), F.substring(order, 1, HASH_DIGITS).alias("bucket"), F.col(doc_id).alias("id"),
        ),
    )
    m, c = F.col(mark), F.col(cell)
    cells = materialize(
        marked.groupBy(m.key.alias("key"), m.source.alias("source"), m.kind.alias("kind"), m.bucket.alias("bucket"))
        .agg(F.count("*").alias("n"), F.sum(m.size).alias("words")),
        "mix-cells",
    )
    goal = targets(cells.groupBy("source").agg(F.sum("words").alias("source_size")), weights, share, max_repeat)
    goal = goal.select(_key(F.col("source")).alias("key"), "source_size", "target")
    run = Window.partitionBy("key").orderBy("kind", "bucket").rowsBetween(Window.unboundedPreceding, -1)
    placed = materialize(
        cells.select("key", "kind", "bucket", F.coalesce(F.sum("n").over(run), F.lit(0)).alias("ahead")).join(goal, "key"),
        "mix-placed",
    )
    drop_written(cells)
    placed = placed.select(F.struct("*").alias(cell))  # grows with sources and input, so it is never broadcast
    joined = marked.join(placed.hint("merge"), (m.key == c.key) & (m.kind == c.kind) & (m.bucket == c.bucket))
    inside = Window.partitionBy(m.key, m.kind, m.bucket).orderBy(m.hash, m.id)
    rank = (c.ahead + F.row_number().over(inside)).cast("double")
    rate = F.when(c.source_size > 0, c.target / c.source_size.cast("double")).otherwise(0.0)
    start = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}|"), c.key)), 1, 8), 16, 10).cast("double") / float(2**32)
    copies = F.floor(rate * F.col(place) + start) - F.floor(rate * (F.col(place) - 1) + start)
    mixed = F.struct(m.size.alias("size"), c.source_size.alias("source_size"), c.target.alias("target"), copies.cast("bigint").alias("copies"))
    ranked = joined.withColumn(place, rank)
    return ranked.select(*[F.col(f"`{x}`") for x in docs.columns], mixed.alias(out))


def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken, columns as they were."""
    out, nth = fresh(docs, "mix"), fresh(docs, "nth")
    taken = with_copies(docs, out=out, **options).where(F.col(out).copies > 0)
    again = taken.withColumn(nth, F.explode(F.sequence(F.lit(1), F.col(out).copies.cast("int"))))
    return again.select(*[F.col(f"`{c}`") for c in docs.columns])
