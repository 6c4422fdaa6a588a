"""Shards that each hold every source in its share of the whole.

Rows of a source are shuffled by a seeded hash and ranked. Row ``r`` of the
``n`` rows of its source gets the fraction ``(r + u) / n``, with an offset ``u``
between 0 and 1 that a hash gives the source, so that sources of one size do not
move in step. All rows sorted by fraction interleave the sources evenly, and
cutting that order into equal stretches gives shards whose row counts differ by
at most one.

Both rankings work in buckets: counts per bucket give each bucket its offset,
and rows are ranked inside a bucket only, in the first ranking inside a part of
the rows of one id. The first ranking takes its buckets
from the hash, so a source with a third of all rows is dealt over as many tasks
as any other rows; the second takes them from the fraction, which is even for
every source. Texts do not move: only the carried columns do.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanscope.llm.common import hash_bucket, quoted
from loanscope.sources.scratch import checkpointed

ROW_BYTES = 16


def assign_shards(
    docs: DataFrame,
    n_shards: int,
    seed: int = 0,
    carry: tuple[str, ...] = ("doc_id",),
    buckets: int = 4096,
) -> DataFrame:
    """The ``carry`` columns of every row with ``size``, ``text_crc32``, ``shard`` and ``slot``.

    ``size`` is the UTF-8 length of the text plus 16 and ``text_crc32`` its
    unsigned CRC-32; a missing text counts as empty. A missing source is a
    source of its own. Rows that agree in id, text and source are
    interchangeable; each still gets its own slot. ``slot`` counts from 0 in
    every shard without gaps. With fewer rows than shards some shards stay
    empty, and an empty table gives an empty result.

    ``buckets`` bounds the rows ranked together to about one part in as many,
    of the largest source and of the table; rows of one id are divided by their
    texts into as many parts, so only those that agree in both stay together.
    """
    if n_shards < 1:
        raise ValueError("n_shards must be positive")
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.struct(*map(quoted, carry)).alias("carried"),
        (F.octet_length(text).cast("long") + ROW_BYTES).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("stratum"),
        F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("doc_id").cast("string"))).alias("shuffle_key"),
    ).withColumn("bucket", hash_bucket("shuffle_key", buckets))
    # Rows of one id come in parts by their texts.
    rows = rows.withColumn("part", F.shiftright(F.col("text_crc32") * buckets, 32))
    part = ("stratum", "bucket", "shuffle_key", "part")

    counts = rows.groupBy("stratum", "bucket").count()
    stratum = Window.partitionBy("stratum")
    of_buckets = counts.select(
        "stratum",
        "bucket",
        (F.sum("count").over(stratum.orderBy("bucket")) - F.col("count")).alias("before_bucket"),
        F.sum("count").over(stratum).alias("n_stratum"),
    )
    counts = rows.groupBy(*part).count()
    up_to = F.sum("count").over(Window.partitionBy("stratum", "bucket").orderBy("shuffle_key", "part"))
    offsets = counts.withColumn("before", up_to - F.col("count")).join(of_buckets, ["stratum", "bucket"])
    offsets = offsets.select(*part, (F.col("before") + F.col("before_bucket")).alias("before"), "n_stratum")
    ties = ("shuffle_key", "part", "size", "text_crc32")
    in_bucket = Window.partitionBy(*part).orderBy(*ties)
    offset = (hash_bucket(F.md5(F.concat_ws("|", F.lit(str(seed)), "stratum")), 1 << 16) + 0.5) / (1 << 16)
    fraction = (F.col("before") + F.row_number().over(in_bucket) - 1 + offset) / F.col("n_stratum")
    ranked = checkpointed(
        rows.join(offsets, [*part])
        .withColumn("fraction", fraction)
        .withColumn("bucket", F.least(F.floor(F.col("fraction") * buckets), F.lit(buckets - 1)))
        .drop("before", "n_stratum")
    )

    counts = ranked.groupBy("bucket").count()
    # At most ``buckets`` rows, so these two windows may see them all at once.
    offsets = counts.select(
        "bucket",
        (F.sum("count").over(Window.orderBy("bucket")) - F.col("count")).alias("before"),
        F.sum("count").over(Window.partitionBy()).alias("n_rows"),
    )
    in_bucket = Window.partitionBy("bucket").orderBy("fraction", "stratum", *ties)
    return (
        ranked.join(offsets, "bucket")
        .withColumn("position", F.col("before") + F.row_number().over(in_bucket) - 1)
        .withColumn("shard", F.expr(f"position * {n_shards} DIV n_rows").cast("int"))
        .withColumn("slot", F.expr(f"position - (shard * n_rows + {n_shards - 1}) DIV {n_shards}"))
        .select("carried.*", "size", "text_crc32", "shard", "slot")
    )


def write_shards(docs: DataFrame, path: str, n_shards: int, seed: int = 0) -> None:
    """Writes all columns of ``docs`` as Parquet, a folder per shard, in slot order."""
    placed = assign_shards(docs, n_shards, seed, tuple(docs.columns)).drop("size", "text_crc32")
    placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
