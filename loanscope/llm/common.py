"""Helpers that several operators share."""

import re
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanscope.sources.scratch import checkpointed, work_folder

#: Rows of this fold are never learnt from.
FOLDS, HELD_OUT = 4, 2


@contextmanager
def work_tables(spark: SparkSession) -> Iterator[Callable[[str, DataFrame], DataFrame]]:
    """A function that writes a frame as Parquet in a work folder and reads it back; the folder goes in the end."""
    with work_folder(spark) as folder:

        def written(name: str, df: DataFrame) -> DataFrame:
            df.write.parquet(f"{folder}/{name}")
            return spark.read.parquet(f"{folder}/{name}")

        yield written


def held_out(doc_id: Column | str) -> Column:
    """True for rows of the held-out fold; a missing id is in none."""
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == HELD_OUT, F.lit(False))


def hash_bucket(key: Column | str, buckets: int) -> Column:
    """Number of the equal part of all values that a hexadecimal hash falls into; in the order of the hashes."""
    return F.shiftright(F.conv(F.substring(key, 1, 8), 16, 10).cast("long") * buckets, 32)


def quoted(name: str) -> Column:
    """A top-level column of any name."""
    return F.col("`" + name.replace("`", "``") + "`")


def kept_rows(docs: DataFrame, keeps: Callable[[pa.Array], np.ndarray]) -> DataFrame:
    """The rows of ``docs``, with all their columns of any name, for whose texts ``keeps`` is true."""

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(keeps(batch.column("row").field("text"))))

    rows = docs.select(F.struct(*map(quoted, docs.columns)).alias("row"))
    return rows.mapInArrow(kept, rows.schema).select("row.*")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def texts(column: pa.Array | pa.ChunkedArray) -> Iterator[str]:
    """The texts of a column one at a time, a missing one as the empty text."""
    for value in column:
        yield value.as_py() or ""


def encoded(column: pa.Array | pa.ChunkedArray) -> Iterator[bytes]:
    """The same in UTF-8."""
    for value in column:
        buffer = value.as_buffer()
        yield b"" if buffer is None else buffer.to_pybytes()


def runs(*keys: np.ndarray) -> list[tuple[int, int]]:
    """Start and end of each run of rows with equal keys."""
    n = len(keys[0])
    if not n:
        return []
    change = np.zeros(n - 1, dtype=bool)
    for key in keys:
        change |= key[1:] != key[:-1]
    starts = [0, *(np.flatnonzero(change) + 1).tolist()]
    return list(zip(starts, [*starts[1:], n]))


#: Bytes of a text split into words at a time.
STRETCH = 1 << 20
_BLANK = re.compile(rb"[\x20\x09-\x0D]")


def word_blocks(text: bytes) -> Iterator[list[bytes]]:
    """The words of a UTF-8 text, those of about STRETCH bytes at a time.

    Words are what the six ASCII blanks part, which is what ``bytes.split`` does.
    """
    start = 0
    while start < len(text):
        blank = _BLANK.search(text, start + STRETCH) if len(text) - start > STRETCH else None
        end = blank.start() if blank else len(text)
        yield text[start:end].split()
        start = end


#: Rows of ids that may be sent to every task.
BROADCAST_ROWS = 200_000


def counted_broadcast(ids: DataFrame) -> DataFrame:
    """A small table of ids for a join, marked for broadcast if a count says that it is small."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids


#: Of the ids of a class, how many times as many as wanted are looked up at first, and how many more.
SAMPLED, SLACK = 4, 1000


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, per_class: int, max_bytes: int, seed: int = 0
) -> DataFrame:
    """``doc_id``, ``text`` and ``label`` of a bounded sample of rows to learn from.

    Of each value of the label column, 0 and 1, the ``per_class`` ids with the
    smallest seeded hash are taken, among those that ``docs`` has with a text of 1
    to ``max_bytes`` bytes. Ids of the held-out fold and ids with contradicting
    labels are not used; of rows that share an id, the smallest text is.

    Only ids whose hash lies below a threshold are looked up, which leaves a few
    times ``per_class`` of each class; it is raised until there are enough.
    """
    order = F.xxhash64(F.lit(seed), F.col("doc_id"))
    agreed = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.min(label).alias("label"), F.max(label).alias("most")
    )
    agreed = agreed.where((F.col("label") == F.col("most")) & F.col("label").isin(0, 1) & ~held_out("doc_id"))
    agreed = agreed.select("doc_id", "label", order.alias("place"))
    sizes = {r["label"]: r["count"] for r in agreed.groupBy("label").count().collect()}
    short = docs.select("doc_id", "text").where(F.octet_length("text").between(1, max_bytes))
    wanted = SAMPLED * per_class + SLACK
    while True:
        shares = {value: min(1.0, wanted / n) for value, n in sizes.items()}
        limit = F.lit((1 << 63) - 1)
        for value, share in shares.items():
            if share < 1:
                limit = F.when(F.col("label") == value, int((share - 0.5) * ((1 << 64) - 4096))).otherwise(limit)
        found = short.join(counted_broadcast(agreed.where(F.col("place") <= limit)), "doc_id")
        found = checkpointed(found.groupBy("doc_id", "label", "place").agg(F.min("text").alias("text")))
        got = {r["label"]: r["count"] for r in found.groupBy("label").count().collect()}
        if all(share == 1 or got.get(value, 0) >= per_class for value, share in shares.items()):
            break
        wanted *= SAMPLED**2
    picked = [found.where(F.col("label") == value).orderBy("place", "doc_id").limit(per_class) for value in (0, 1)]
    return picked[0].union(picked[1]).select("doc_id", "label", "text").orderBy(order, "doc_id")
