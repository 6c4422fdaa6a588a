"""Allow and block rules on hosts and paths, applied by a sort-merge range join.

A host with its labels reversed, ``www.example.com`` as ``com.example.www.``,
sorts between its own domain and the next one. A rule for ``example.com`` so
covers the interval of keys that start with ``com.example.``, and intervals of
rules are nested or apart, never crossing. Urls and rules go to the same key
ranges, are sorted by key, and one sweep over each range keeps the rules whose
interval is open on a stack, outermost first. A url is compared with the paths
of the open rules only.
"""

from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Keys sampled for each key range.
SAMPLE_PER_RANGE = 20


def url_parts(url: str = "url") -> tuple:
    """Host and path columns: empty for a missing url and for one without ``://``."""
    has_host = F.coalesce(F.contains(F.col(url), F.lit("://")), F.lit(False))
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.when(has_host, host).otherwise(""), F.when(has_host, path).otherwise("")


def canonical_key(host: str) -> F.Column:
    """Host labels in reverse order, each closed by a dot."""
    return F.concat(F.array_join(F.reverse(F.split(F.col(host), r"\.")), "."), F.lit("."))


def apply_rules(
    urls: DataFrame, rules: DataFrame, id_column: str = "page_id", default: str = "allow", ranges: int | None = None
) -> DataFrame:
    """``id_column``, ``host``, ``path``, ``rule`` and ``verdict`` of every row of ``urls``.

    ``rules`` has ``host``, ``path`` and ``verdict``. A rule fits its host and
    all subdomains of it where the path starts with the rule's. Of several that
    fit, the one with the longest host and path together wins, then the one with
    the longer host; of equal rules with both verdicts ``block`` wins. Without a
    rule, ``rule`` is null and the verdict ``default``. A rule without a host or
    verdict fits nothing; a missing path fits every path. Rule hosts are
    compared in lower case. Repeated rows come out alike, a missing id stays
    missing, no urls give no rows, no rules the default for all; other columns are
    not looked at.

    ``ranges`` key ranges are cut at the quantiles of a random sample. A host
    that fills several ranges is dealt over all of them. The sample decides
    where rows are worked on, never the result.
    """
    spark = urls.sparkSession
    if ranges is None:
        ranges = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    host, path = url_parts()
    rows = urls.select(F.col(id_column).alias("id"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("key", canonical_key("host"))
    usable = rules.where("host <> '' AND verdict IS NOT NULL").select(
        F.translate("host", UPPER, LOWER).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict"
    )
    usable = usable.distinct().withColumn("key", canonical_key("host"))

    cuts = _cuts(rows, ranges)
    rule_schema = "range int, key string, is_url boolean, id {0}, host string, path string, verdict string".format(
        urls.schema[id_column].dataType.simpleString()
    )
    placed_urls = rows.mapInArrow(_UrlRanges(cuts), rule_schema)
    placed_rules = usable.mapInArrow(_RuleRanges(cuts, placed_urls.schema), rule_schema)
    swept = (
        placed_urls.union(placed_rules)
        .repartition(ranges, "range")
        .sortWithinPartitions("range", "key", "is_url")
        .mapInArrow(
            _Sweep(default), f"id {urls.schema[id_column].dataType.simpleString()}, host string, path string, rule string, verdict string"
        )
    )
    return swept.withColumnRenamed("id", id_column)


def _cuts(rows: DataFrame, ranges: int) -> list[str]:
    """Up to ``ranges - 1`` keys that cut the rows about evenly; a frequent key occurs several times."""
    n = rows.count()
    wanted = ranges * SAMPLE_PER_RANGE
    keys = rows.select("key") if n <= wanted else rows.select("key").sample(wanted / n, seed=1)
    sample = sorted(r[0] for r in keys.collect())
    return [sample[len(sample) * i // ranges] for i in range(1, ranges)] if sample else []


class _UrlRanges:
    """Gives each url its key range; rows of a key that spans several are dealt by their hash."""

    def __init__(self, cuts: list[str]):
        self.cuts = cuts

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places: dict[str, tuple[int, int]] = {}
        for batch in batches:
            ranges = []
            for i, key in zip(batch.column("id").to_pylist(), batch.column("key").to_pylist()):
                place = places.get(key)
                if place is None:
                    if len(places) > 100_000:
                        places.clear()
                    place = places[key] = (bisect_left(self.cuts, key), bisect_right(self.cuts, key))
                first, last = place
                ranges.append(first if first == last else first + crc32(str(i).encode()) % (last - first + 1))
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ranges, pa.int32()), batch.column("key"), pa.array([True] * n, pa.bool_()),
                    batch.column("id"), batch.column("host"), batch.column("path"), pa.nulls(n, pa.string()),
                ],
                names=["range", "key", "is_url", "id", "host", "path", "verdict"],
            )


class _RuleRanges:
    """Copies each rule to every key range that its interval touches."""

    def __init__(self, cuts: list[str], schema):
        from pyspark.sql.pandas.types import to_arrow_schema

        self.cuts, self.schema = cuts, to_arrow_schema(schema)

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rule in batch.to_pylist():
                first = bisect_left(self.cuts, rule["key"])
                # "/" follows "." directly, so this key ends the interval of all keys with the prefix.
                last = bisect_right(self.cuts, rule["key"][:-1] + "/")
                rows = [rule | {"range": r, "is_url": False, "id": None} for r in range(first, last + 1)]
                yield pa.RecordBatch.from_pylist(rows, schema=self.schema)


class _Level:
    """The rules of one host, by path."""

    def __init__(self, key: str, host: str):
        self.key, self.host, self.paths, self.lengths = key, host, {}, []

    def add(self, path: str, verdict: str) -> None:
        if self.paths.get(path) != "block":
            self.paths[path] = verdict
        if len(path) not in self.lengths:
            self.lengths.append(len(path))
            self.lengths.sort(reverse=True)

    def longest(self, path: str) -> str | None:
        return next((path[:n] for n in self.lengths if path[:n] in self.paths), None)


class _Sweep:
    """One pass over rules and urls in key order, with the open rules on a stack."""

    def __init__(self, default: str):
        self.default = default

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stack: list[_Level] = []
        current = None
        for batch in batches:
            kept, rule_column, verdict_column = [], [], []
            columns = [batch.column(c).to_pylist() for c in ("range", "key", "is_url", "host", "path", "verdict")]
            for row, (key_range, key, is_url, host, path, verdict) in enumerate(zip(*columns)):
                if key_range != current:
                    stack, current = [], key_range
                while stack and not key.startswith(stack[-1].key):
                    stack.pop()
                if not is_url:
                    if not stack or stack[-1].key != key:
                        stack.append(_Level(key, host))
                    stack[-1].add(path, verdict)
                    continue
                best = None
                for depth, level in enumerate(stack):
                    found = level.longest(path)
                    if found is not None:
                        best = max(best or (0, 0), (len(level.host) + len(found), depth + 1))
                        if best == (len(level.host) + len(found), depth + 1):
                            rule, verdict = level.host + found, level.paths[found]
                kept.append(row)
                rule_column.append(None if best is None else rule)
                verdict_column.append(self.default if best is None else verdict)
            if kept:
                rows = batch.take(pa.array(kept))
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column("id"), rows.column("host"), rows.column("path"),
                        pa.array(rule_column, pa.string()), pa.array(verdict_column, pa.string()),
                    ],
                    names=["id", "host", "path", "rule", "verdict"],
                )
