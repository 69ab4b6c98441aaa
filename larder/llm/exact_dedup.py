"""Exact deduplication against a persistent digest index.

The index is a table bucketed and sorted by digest, one row per distinct normalised text. A load
digests its own rows, finds by a sort-merge anti-join which digests the index lacks, appends those,
and reports for every row which row of its text stays.

Defined cases: a null text is the empty text; all empty or white-space-only texts are equal. A null
id sorts after every number. Of rows repeated with one id and one text exactly one is kept. A text
that an earlier load brought keeps that load's row, so no row of the new load is kept. Empty tables
give empty results and leave the index as it is. Columns other than the id and the text are carried
by ``keep_documents`` and ignored otherwise; their names may clash with those made here.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm.common import WHITE, drop_written, fresh, materialize, whole


def normalized(text: Column) -> Column:
    return F.translate(whole(text), WHITE, "")


def digest(text: Column) -> Column:
    return F.sha2(normalized(text), 256)


class DigestIndex:
    """One row per distinct text: digest, keep_id, and the load and row that brought it."""

    def __init__(self, spark: SparkSession, name: str, buckets: int = 64):
        self.spark, self.name, self.buckets = spark, name, buckets
        spark.sql(
            f"create table if not exists {name} (digest string, keep_id bigint, keep_row bigint, load string)"
            f" using parquet clustered by (digest) sorted by (digest) into {buckets} buckets"
        )

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def drop(self) -> None:
        self.spark.sql(f"drop table if exists {self.name}")

    def add(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
        """Append the texts of ``docs`` that are new; one row per row of ``docs`` comes back:
        doc_id, keep_id, group_size, kept, text_sha256, n_chars.

        Digests are computed once and written with a row number that tells repeated rows apart.
        Groups are aggregated before they are shuffled, so a text that a third of all rows share
        costs a row for each task. The last join is by digest with a plain read of both sides, so
        adaptive execution can split the rows of such a text.
        """
        load = uuid.uuid4().hex
        rows = materialize(
            docs.select(
                F.col(doc_id).cast("bigint").alias("doc_id"),
                F.char_length(whole(text)).cast("bigint").alias("n_chars"),
                digest(F.col(text)).alias("digest"),
                F.monotonically_increasing_id().alias("row_no"),
            ),
            "digests",
        )
        best = F.min(
            F.struct((-F.col("n_chars")).alias("len"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_no")
        )
        groups = materialize(
            rows.groupBy("digest").agg(best.alias("best"), F.count("*").alias("group_size"))
            .select("digest", F.col("best.doc_id").alias("keep_id"), F.col("best.row_no").alias("keep_row"), "group_size"),
            "digest-groups",
        )
        new = groups.join(self.read().select("digest").hint("merge"), "digest", "left_anti")
        (
            new.select("digest", "keep_id", "keep_row", F.lit(load).alias("load"))
            .write.format("parquet").bucketBy(self.buckets, "digest").sortBy("digest")
            .mode("append").saveAsTable(self.name)
        )
        known = groups.select("digest", "group_size").join(self.read(), "digest")
        decided = materialize(known, "digest-decided")
        drop_written(groups)
        return rows.join(decided, "digest").select(
            "doc_id",
            "keep_id",
            "group_size",
            ((F.col("load") == load) & (F.col("row_no") == F.col("keep_row"))).alias("kept"),
            F.col("digest").alias("text_sha256"),
            "n_chars",
        )


def exact_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``DigestIndex.add`` into a new index, for a table that stands alone."""
    index = DigestIndex(docs.sparkSession, f"digest_index_{uuid.uuid4().hex}")
    out = index.add(docs, doc_id, text)
    index.drop()  # what comes back reads only written tables
    return out


def keep_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, all columns as they were.

    Rows are found again by id, length and digest; where several rows share all three, they differ at most
    in other columns, and the first of them is taken.
    """
    kept = exact_duplicates(docs, doc_id, text).where("kept")
    key = F.struct(
        F.col(doc_id).cast("bigint").alias("id"), F.char_length(whole(text)).cast("bigint").alias("n"),
        digest(F.col(text)).alias("d"),
    )
    own = fresh(docs, "key")
    want = kept.select(F.to_json(F.struct(F.col("doc_id").alias("id"), F.col("n_chars").alias("n"), F.col("text_sha256").alias("d"))).alias(own))
    found = docs.withColumn(own, F.to_json(key)).join(want, own, "left_semi")
    return found.dropDuplicates([own]).select(*[F.col(f"`{c}`") for c in docs.columns])
