"""What several operators of this package share."""

from __future__ import annotations

import gc
import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.session import remove, scratch

#: The six white-space characters of the contracts, and words as what lies between them.
WHITE = " \t\n\x0b\f\r"
WORD = r"[^\x20\x09-\x0D]+"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back: cuts lineage, survives executors."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_at = path
    return out


def drop_written(*written: DataFrame) -> None:
    """Delete tables of ``materialize`` that nothing will read again."""
    for df in written:
        remove(df.sparkSession, df.written_at)


def fresh(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` doesn't have yet."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole(text: str | Column) -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def fold(doc_id: str | Column, parts: int) -> Column:
    """crc32 of the id's text, modulo ``parts``; a null id counts as the empty text."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(c.cast("string"), F.lit(""))) % parts


def worker_state(owner: str) -> dict:
    """A dict that lives in the worker process, for what is costly to build. There is one: an operator that asks for its own
    frees what another one left behind, since Spark hands a worker on from one operator to the next."""
    kept = sys.modules.setdefault("_larder_llm_state", types.ModuleType("_larder_llm_state")).__dict__
    if kept.get("owner") != owner:
        kept.update(owner=owner, state={})
        gc.collect()
    return kept["state"]


def handing_back(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A task's function that gives back the memory Arrow holds in reserve when it ends: its worker lives on beside those of the next stage."""

    def whole(batches: Iterator) -> Iterator:
        yield from run(batches)
        pa.default_memory_pool().release_unused()

    return whole


#: Bytes of text for each bucket, and buckets beyond which a bucket's share grows as the number does.
BUCKET_BYTES, MANY = 4 << 20, 1 << 15


def text_bytes(docs: DataFrame, text: str = "text") -> int:
    return docs.agg(F.sum(F.octet_length(text).cast("bigint"))).first()[0] or 0


def shuffle_width(spark: SparkSession, size: int = 0, least: int = 48) -> int:
    """How many buckets an operator deals the packed rows of ``size`` bytes of text to: one for each 4 MB up to 128 GB;
    of more text both the buckets and what one holds grow with the square root (110 MB at 100 TB)."""
    wanted = size // BUCKET_BYTES
    if wanted > MANY:
        wanted = int((wanted * MANY) ** 0.5)
    return max(least, int(spark.conf.get("spark.sql.shuffle.partitions")), wanted)


def dealt(packed: DataFrame, width: int, bucket: str = "bucket") -> DataFrame:
    """Rows by bucket, to a task for each where there are more buckets than the session's shuffle partitions."""
    few = width <= max(48, int(packed.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return packed if few else packed.repartition(width, bucket)


#: A-Z in lower case, every other byte as it is.
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    """Words between white space, A-Z in lower case (bytes.split() knows just those six characters)."""
    return text.translate(LOWER).split()


class WordHashes(dict):
    """64-bit hashes of words; forgets all when it holds too many."""

    most = 200_000

    def __missing__(self, word: bytes) -> int:
        import xxhash

        h = xxhash.xxh3_64_intdigest(word)
        if len(self) >= self.most:
            self.clear()
        self[word] = h
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix64(x: np.ndarray) -> np.ndarray:
    """A fixed one-to-one scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
