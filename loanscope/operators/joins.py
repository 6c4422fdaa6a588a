"""Join with a lookup table."""

from pyspark.sql import DataFrame


def join_lookup(df: DataFrame, lookup: DataFrame, on, how: str = "inner") -> DataFrame:
    """Join that broadcasts ``lookup`` only while its size allows it.

    No broadcast hint is given, because a hint would skip the size check. Spark
    broadcasts a side whose size is under
    ``spark.sql.autoBroadcastJoinThreshold``, measured again at run time by
    adaptive execution. Beyond it the join shuffles on the key, and adaptive
    execution splits the partitions of a hot key.
    """
    return df.join(lookup, on, how)
