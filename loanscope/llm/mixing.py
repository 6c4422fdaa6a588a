"""Sources mixed to target weights by temperature, and the mixture realised as draws of documents.

A source with share ``p`` of all tokens gets the weight ``p ** a`` over the sum
of these: exponent 1 keeps the shares, 0 makes all sources equal. The exponent is
bisected so that the weights reach a target entropy without repeating any source
more often than allowed. A source is then drawn in blocks: whole permutations of
its documents, and at the end the part of one more that its budget still pays for.

Everything is DataFrame operations. The search for the exponent is an aggregate
over one row per source and round. Where the last block of a source ends is found
in two steps, by token sums of hash buckets and then inside the one bucket it ends
in, so no source is ever sorted as a whole.
"""

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanscope.llm.common import hash_bucket, quoted
from loanscope.sources.scratch import checkpointed

WORDS = r"[^\x20\x09-\x0D]+"
#: Exponents are whole numbers of this part of 1.
STEP = 1_000_000
#: Exponents tried in one round, a row each per source: a round does the work of six halvings.
TRIED = 64
#: Least and largest exponent.
LOW, HIGH = 0, STEP
#: With up to so many sources their quotas, some 100 bytes each, are broadcast; with more they are shuffled.
BROADCAST_SOURCES = 100_000
#: Decimals of a weight; beyond these, engines round sums differently.
WEIGHT_DIGITS = 9


def count_tokens(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``source`` and ``n_tokens`` of every row. Tokens are words; a missing text has none."""
    return docs.select("doc_id", "source", _n_tokens())


def _n_tokens() -> Column:
    return F.coalesce(F.regexp_count("text", F.lit(WORDS)), F.lit(0)).cast("long").alias("n_tokens")


def _search(sources: DataFrame, holds) -> int:
    """Smallest exponent, in steps, for which ``holds`` is true and stays so above; HIGH if there is none.

    ``holds`` gives a condition from an exponent, the sum of all ``p ** a``, the
    sum of ``p ** a * ln p`` and the largest ``p ** (a - 1)``.
    """
    low, high = LOW - 1, HIGH  # holds above, not at ``low``
    share, a = F.col("share"), F.col("step") / STEP
    while high - low > 1:
        width = -(-(high - low) // TRIED)
        tried = list(range(low + width, high, width))
        steps = F.explode(F.array(*[F.lit(m) for m in tried])).alias("step")
        power = F.pow(share, a)
        found = sources.where("share > 0").select("share", steps).groupBy("step").agg(
            F.sum(power).alias("z"), F.sum(power * F.log(share)).alias("g"), F.max(F.pow(share, a - 1)).alias("most")
        )
        fits = {r["step"]: holds(r["step"] / STEP, r["z"], r["g"], r["most"]) for r in found.collect()}
        first = next((m for m in tried if fits[m]), None)
        high, low = (high, tried[-1]) if first is None else (first, max(low, first - width))
    return high


def mixture(
    counted: DataFrame,
    entropy: float | None = 0.95,
    max_repeats: float | None = 4.0,
    budget: float | None = 1.0,
) -> DataFrame:
    """Per source of ``count_tokens``: ``tokens``, the ``exponent``, its ``weight`` and its ``target`` of tokens.

    ``entropy`` is a fraction of the entropy of equal weights. The exponent is
    the largest with at least that entropy, or larger if some source would
    otherwise be drawn more than ``max_repeats`` times; both at once give the
    larger one, none of them 1. Where even exponent 1 does not do, it is 1.
    ``budget`` is the number of tokens to draw as a multiple of all tokens.
    ``None`` makes it just large enough that every source is drawn once in full,
    so that the weights come from repeating and no document is lost; the repeats
    of the others, not the budget, are then what ``max_repeats`` limits.

    Sources without a token have weight 0. An empty table has no sources.
    """
    totals = checkpointed(counted.groupBy("source").agg(F.sum("n_tokens").alias("tokens")))
    whole = totals.agg(F.sum("tokens"), F.count(F.when(F.col("tokens") > 0, 1)), F.max("tokens")).first()
    total, n_sources, largest = whole[0] or 0, whole[1], whole[2]
    shared = totals.withColumn("share", F.col("tokens") / F.lit(float(max(1, total))))
    exponent = STEP
    if n_sources > 1:
        exponent = LOW if entropy is not None or max_repeats is not None else STEP
        if entropy is not None:
            least = entropy * math.log(n_sources)
            # Entropy falls with the exponent: the largest that keeps it is one below the first that does not.
            below = _search(shared, lambda a, z, g, _: math.log(z) - a * g / z < least)
            exponent = max(LOW, below - 1) if below < HIGH else HIGH
        if max_repeats is not None:
            top = largest / total

            def bearable(a: float, z: float, _: float, most: float) -> bool:
                # Repeats of a source are weight * budget / tokens. Without a budget the largest source, which
                # a smaller exponent cuts most, is drawn once.
                return most * budget / z <= max_repeats if budget is not None else most / top ** (a - 1) <= max_repeats

            exponent = max(exponent, _search(shared, bearable))
    a = F.lit(exponent / STEP)
    power = F.when(F.col("share") > 0, F.pow("share", a)).otherwise(0.0)
    norm = shared.agg(F.sum(power)).first()[0] or 1.0
    weight = F.round(power / F.lit(float(norm)), WEIGHT_DIGITS)
    if budget is None:
        tokens_drawn = F.lit(total and largest / round((largest / total) ** (exponent / STEP) / norm, WEIGHT_DIGITS))
    else:
        tokens_drawn = F.lit(float(total * budget))
    target = F.floor(weight * tokens_drawn)
    if budget is None:
        target = F.greatest(target, F.col("tokens"))  # rounding must not cost a document
    return shared.select("source", "tokens", a.alias("exponent"), weight.alias("weight"), target.alias("target"))


def draw(
    counted: DataFrame, plan: DataFrame, seed: int = 0, docs: DataFrame | None = None, buckets: int = 4096
) -> DataFrame:
    """One row per draw: ``doc_id``, ``source``, ``n_tokens``, ``weight``, ``block`` and ``draw_key``.

    With ``docs``, the table that was counted, its rows with all their columns
    come instead. ``plan`` is what ``mixture`` gives. Of a source, the blocks
    before the last are whole permutations, and the last one holds the documents
    first in its permutation as long as their tokens together stay within what is
    left of the target. Documents that agree in source and id have one place in
    a permutation and are drawn together or not at all. A source without tokens
    is drawn once. ``draw_key`` orders the draws of a block at random; sorted by
    block and key, sources are mixed throughout.

    ``buckets`` bounds the part of a source that is sorted at once.
    """
    stratum = F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("stratum")
    target, tokens = F.col("target"), F.greatest("tokens", F.lit(1))
    quotas = plan.select(
        stratum,
        "weight",
        F.when(F.col("tokens") > 0, F.floor((target - target % tokens) / tokens)).otherwise(1).alias("whole_blocks"),
        F.when(F.col("tokens") > 0, target % tokens).otherwise(0).alias("left_over"),
    )

    few = plan.count() <= BROADCAST_SOURCES

    def small(per_source: DataFrame) -> DataFrame:
        return F.broadcast(per_source) if few else per_source

    def placed(rows: DataFrame, per_source: DataFrame) -> DataFrame:
        """Rows with the place of their document in the last block."""
        rows = rows.join(small(per_source), "stratum").withColumn("last_key", _key(seed, F.col("whole_blocks")))
        return rows.withColumn("bucket", hash_bucket("last_key", buckets))

    lean = placed(_documents(counted.select(stratum, "doc_id", "n_tokens")), quotas).where("left_over > 0")
    sums = lean.groupBy("stratum", "bucket", "left_over").agg(F.sum("n_tokens").alias("in_bucket"))
    up_to = F.sum("in_bucket").over(Window.partitionBy("stratum").orderBy("bucket"))
    # The bucket in which a source passes its target, and what is left of the target for it.
    rest = F.col("left_over") - F.col("up_to") + F.col("in_bucket")
    end = F.min(F.struct(F.col("bucket").alias("end_bucket"), rest.alias("rest"))).alias("end")
    ends = checkpointed(
        sums.withColumn("up_to", up_to).where("up_to > left_over").groupBy("stratum").agg(end).select("stratum", "end.*")
    )
    inside = lean.join(small(ends), "stratum").where("bucket = end_bucket")
    so_far = F.sum("n_tokens").over(Window.partitionBy("stratum").orderBy("last_key"))
    fitting = inside.withColumn("so_far", so_far).where("so_far <= rest")
    cuts = fitting.groupBy("stratum").agg(F.max("last_key").alias("cut"))
    limits = checkpointed(quotas.join(ends, "stratum", "left").join(cuts, "stratum", "left").drop("rest"))

    if docs is None:
        rows = counted.select(stratum, "doc_id", F.struct("source", "n_tokens").alias("row"))
    else:
        rows = docs.select(stratum, "doc_id", F.struct(*map(quoted, docs.columns)).alias("row"))
    in_end = (F.col("bucket") == F.col("end_bucket")) & (F.col("last_key") <= F.col("cut"))
    in_last = F.coalesce((F.col("bucket") < F.col("end_bucket")) | in_end, F.lit(False))
    n_blocks = F.col("whole_blocks") + in_last.cast("int")
    blocks = F.filter(F.sequence(F.lit(0).cast("long"), n_blocks), lambda b: b < n_blocks)
    drawn = placed(rows, limits).withColumn("block", F.explode(blocks))
    if docs is not None:
        return drawn.select("row.*")
    return drawn.select("doc_id", "row.*", "weight", "block", _key(seed, F.col("block")).alias("draw_key"))


def _documents(rows: DataFrame) -> DataFrame:
    """One row per document, the rows that agree in source and id, so that a window sees an id once."""
    return rows.groupBy("stratum", "doc_id").agg(F.sum("n_tokens").alias("n_tokens"))


def _key(seed: int, block: Column) -> Column:
    """Place of a document in the permutation of a block."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), block.cast("string"), F.col("doc_id").cast("string")))


def mix(docs: DataFrame, entropy: float = 0.95, max_repeats: float = 4.0, budget: float = 1.0, seed: int = 0) -> DataFrame:
    """The draws that make a mixture of ``docs`` of the given budget."""
    counted = checkpointed(count_tokens(docs))
    return draw(counted, mixture(counted, entropy, max_repeats, budget), seed)


def repeat_to_weights(docs: DataFrame, entropy: float = 0.95, max_repeats: float = 4.0, seed: int = 0) -> DataFrame:
    """The rows of ``docs`` with their columns, all of them and some repeatedly, so that sources reach their weights."""
    counted = checkpointed(count_tokens(docs))
    return draw(counted, mixture(counted, entropy, max_repeats, None), seed, docs)
