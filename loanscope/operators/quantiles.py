"""Exact interpolated quantiles without collecting a column in one task.

``percentile`` and ``median`` keep every distinct value of the column in a
single aggregation buffer. Here each pass counts the values per interval, finds
the interval that holds the wanted rank from running totals, and the next pass
looks only inside that interval. Counts combine on the map side, so what is
shuffled is bounded by the number of intervals, whatever the data.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanscope.functions.statistics import without_nan

# The first pass cuts every octave into 2**12 parts, each under 2**-12.5 of its
# values, and two splits by 2**21 follow: beyond 2**-54 of the value no two
# doubles differ, so the last interval holds a single value.
_PARTS_PER_OCTAVE = 1 << 12
_SPLIT = 1 << 21
_SPLITS = 2

# Interval number that grows with v: sign, octave, part of the octave. A log2 lies
# in -1074..1024; infinity is cut off at 1025 and so gets an interval of its own.
_OCTAVE_PART = f"""
    CASE WHEN v = 0 THEN 0
         ELSE CAST(signum(v) AS INT) * (CAST(floor(least(log2(abs(v)), 1025D) * {_PARTS_PER_OCTAVE}) AS INT)
                                        + 1100 * {_PARTS_PER_OCTAVE})
    END"""

# Interval number of v in lo..hi cut into equal parts; 0 if lo = hi.
_EQUAL_PART = f"""
    CASE WHEN hi > lo THEN CAST(least(floor((v - lo) / (hi - lo) * {_SPLIT}), {_SPLIT - 1}) AS INT)
         ELSE 0
    END"""


def _count_parts(rows: DataFrame, part: str, *keys: str) -> DataFrame:
    return rows.groupBy(*keys, F.expr(part).alias("part")).agg(
        F.count(F.lit(1)).alias("n"), F.min("v").alias("first"), F.max("v").alias("last")
    )


def exact_quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]) -> DataFrame:
    """One row ``(column_name, probability, value)`` per column and probability.

    Linear interpolation between neighbours; NULL and NaN count as missing; a
    column without values gives no row.
    """
    rows = (
        df.select(*[without_nan(F.col(c)).alias(c) for c in columns])
        .unpivot([], list(columns), "column_name", "v")
        .where("v IS NOT NULL")
    )

    # A target is the value below or above the wanted position in one column; its
    # rank counts from the start of the interval lo..hi that holds it. The windows
    # come before the explodes, which would multiply the rows they add up.
    listed = ", ".join(f"{float(p)}D" for p in probabilities)
    state = (
        _count_parts(rows, _OCTAVE_PART, "column_name")
        .selectExpr(
            "column_name", "n", "first AS lo", "last AS hi",
            "sum(n) OVER (PARTITION BY column_name ORDER BY part) - n AS before",
            "sum(n) OVER (PARTITION BY column_name) - 1 AS top_rank",
        )
        .selectExpr("*", f"explode(array({listed})) AS probability")
        .selectExpr("*", "probability * top_rank AS position")
        .selectExpr("*", "explode(array_distinct(array(floor(position), ceil(position)))) AS target")
        .selectExpr("column_name", "probability", "position", "target", "target - before AS rank", "lo", "hi", "n")
        .where("rank >= 0 AND rank < n")
        .drop("n")
    )

    targets = ["column_name", "probability", "position", "target"]
    for _ in range(_SPLITS):
        # At most two rows per column and probability, so safe to broadcast.
        near = rows.join(F.broadcast(state), "column_name").where("v BETWEEN lo AND hi")
        state = (
            _count_parts(near, _EQUAL_PART, *targets, "rank")
            .selectExpr(
                *targets, "n", "first AS lo", "last AS hi",
                f"rank - (sum(n) OVER (PARTITION BY {', '.join(targets)} ORDER BY part) - n) AS rank",
            )
            .where("rank >= 0 AND rank < n")
            .drop("n")
        )

    # min and max are the values at the lower and the upper rank; between equal ones, infinite or not, lies no other.
    return (
        state.groupBy("column_name", "probability")
        .agg(F.min("lo").alias("lo"), F.max("lo").alias("hi"), F.max(F.expr("position - floor(position)")).alias("part"))
        .selectExpr("column_name", "probability", "CASE WHEN lo = hi THEN lo ELSE lo + (hi - lo) * part END AS value")
    )
