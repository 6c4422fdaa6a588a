"""CSV records with line breaks inside quotes, one file read by many tasks.

Spark's reader gives such a file to one task, since only a scan from its start
tells whether a quote opens or closes. Here files are read as lines, in splits. A
line takes the reader from one state, outside or inside quotes, to another; so
does a split, as the composition of its lines. A first pass finds the two end
states of every split, running composition over the splits of a file gives the
state in which each begins, and a second pass, which knows it, joins lines into
records. Only records that cross the end of a split are shuffled.

Both passes work in Arrow batches: lines without a quote, nearly all, are found at
once, and the others are matched by a regular expression that needs no
backtracking. Fields are parsed by Spark's own ``from_csv``.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanscope.sources.formats import CSV

#: What is wrong with a record.
TOO_SHORT, TOO_LONG, UNCLOSED = "too_short", "too_long", "unclosed"

# --- The grammar of a line: fields, doubled quotes, text after a closing quote up to the comma ---
_QUOTED = r'"[^"]*(?:""[^"]*)*"[^,]*'
_OPEN = r'"[^"]*(?:""[^"]*)*'
_FIELDS = rf'(?:(?:{_QUOTED}|[^",][^,]*)?,)*'
#: A line that ends inside quotes, if it begins outside or inside them.
_OPENS = rf"^{_FIELDS}{_OPEN}$"
_STAYS = rf'^[^"]*(?:""[^"]*)*(?:$|"[^,]*,{_FIELDS}{_OPEN}$)'

_SUMMARY = "file string, start long, outside int, inside int, header string"
_FRAGMENTS = "file string, start long, place int, record string, closed boolean"


def _states(lines: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """End state of each line, 1 inside quotes, if it begins outside and if it begins inside."""
    outside, inside = np.zeros(len(lines), np.int8), np.ones(len(lines), np.int8)
    quoted = pc.indices_nonzero(pc.match_substring(lines, '"'))
    if len(quoted):
        some, at = lines.take(quoted), quoted.to_numpy()
        # Line breaks other than the separator are part of a value.
        outside[at] = pc.match_substring_regex(some, "(?s)" + _OPENS).to_numpy(zero_copy_only=False)
        inside[at] = pc.match_substring_regex(some, "(?s)" + _STAYS).to_numpy(zero_copy_only=False)
    return outside, inside


def _splits(batch: pa.RecordBatch) -> Iterator[tuple[str, int, pa.Array]]:
    """The lines of a batch by split: file, start and lines."""
    starts, files = batch.column("start").to_numpy(), batch.column("file")
    change = np.flatnonzero(np.diff(starts)) + 1
    if batch.num_rows > 1:
        other_file = pc.indices_nonzero(pc.not_equal(files.slice(1), files.slice(0, batch.num_rows - 1))).to_numpy()
        change = np.union1d(change, other_file.astype(np.int64) + 1)
    edges = [0, *change.tolist(), batch.num_rows]
    for first, end in zip(edges, edges[1:]):
        if end > first:
            yield files[first].as_py(), int(starts[first]), batch.column("value").slice(first, end - first)


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per split: where it ends if it begins outside or inside quotes, and the first line of a file."""
    key, ends, header = None, (0, 1), None

    def row():
        columns = [[key[0]], [key[1]], [ends[0]], [ends[1]], [header]]
        kinds = [pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.string()]
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
        return pa.RecordBatch.from_arrays(arrays, names=["file", "start", "outside", "inside", "header"])

    for batch in batches:
        for file, start, lines in _splits(batch):
            if (file, start) != key:
                if key is not None:
                    yield row()
                key, ends = (file, start), (0, 1)
                header = lines[0].as_py() if start == 0 else None
            outside, inside = _states(lines)
            # Only the lines that are not the identity matter.
            for i in np.flatnonzero((outside != 0) | (inside != 1)).tolist():
                ends = tuple(int(inside[i]) if e else int(outside[i]) for e in ends)
    if key is not None:
        yield row()


class _Join:
    """Joins the lines of each split into records.

    A record is closed if it ends outside quotes. The first fragment of a split
    that begins inside quotes has place 0 and belongs to a record begun before;
    other records that may cross the end of the split have place 1; those of
    place 2 are whole.
    """

    def __init__(self, begins: dict[tuple[str, int], int], header: str | None):
        self.begins, self.header = begins, header

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, held, place = None, 0, [], 2
        for batch in batches:
            out: list[tuple] = []
            for file, start, lines in _splits(batch):
                if (file, start) != key:
                    if held:
                        out.append((*key, min(place, 1), "\n".join(held), False))
                    key, held = (file, start), []
                    if key not in self.begins:
                        raise RuntimeError("the files were split otherwise than in the pass before; run the scan again")
                    state = self.begins[key]
                    place = 0 if state else 2
                    if start == 0 and self.header is not None:
                        if lines[0].as_py().rstrip("\r") != self.header:
                            raise ValueError(f"{file} has another header")
                        lines = lines.slice(1)
                outside, inside = _states(lines)
                # Runs of lines that leave the state as it is, outside quotes, are whole records.
                busy = np.flatnonzero((outside != 0) | (inside != 1))
                done, values = 0, None
                while done < len(lines):
                    if not state:
                        at = np.searchsorted(busy, done)
                        end = int(busy[at]) if at < len(busy) else len(lines)
                        if end > done:
                            yield self._whole(*key, lines.slice(done, end - done))
                            done = end
                            continue
                    values = values or lines.to_pylist()
                    held.append(values[done])
                    state = int(inside[done]) if state else int(outside[done])
                    done += 1
                    if not state:
                        out.append((*key, place, "\n".join(held), True))
                        held, place = [], 2
            yield self._rows(out)
        if held:
            yield self._rows([(*key, min(place, 1), "\n".join(held), False)])

    @staticmethod
    def _rows(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.string(), pa.int64(), pa.int32(), pa.string(), pa.bool_()]
        arrays = [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]
        return pa.RecordBatch.from_arrays(arrays, names=["file", "start", "place", "record", "closed"])

    @staticmethod
    def _whole(file: str, start: int, lines: pa.Array) -> pa.RecordBatch:
        n = len(lines)
        arrays = [
            pa.array([file]).take(pa.array(np.zeros(n, np.int64))), pa.array(np.full(n, start)),
            pa.array(np.full(n, 2, np.int32)), lines, pa.array(np.ones(n, bool)),
        ]
        return pa.RecordBatch.from_arrays(arrays, names=["file", "start", "place", "record", "closed"])


def read_records(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """``file``, ``record`` and ``closed`` of every record of CSV files, without their header lines.

    ``closed`` is false for a record whose quotes are still open where its file
    ends. Files must share one header line. Empty lines outside quotes are no
    records. What a split adds to a record begun before it comes with that record;
    a record is held whole by one task.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value"
    )
    # A row per split: bounded by the input's size over the size of a split.
    summary = lines.mapInArrow(_summaries, _SUMMARY).toArrow().to_pylist()
    first_lines = [r["header"] for r in summary if r["header"] is not None]
    crlf = any(line.endswith("\r") for line in first_lines)
    headers = {line.rstrip("\r") for line in first_lines} if header else set()
    if len(headers) > 1:
        raise ValueError("the files have different headers")
    begins, state, file = {}, 0, None
    for r in sorted(summary, key=lambda r: (r["file"], r["start"])):
        state = 0 if r["file"] != file else state
        file = r["file"]
        begins[file, r["start"]] = state
        state = r["inside"] if state else r["outside"]
    parts = lines.mapInArrow(_Join(begins, next(iter(headers), None)), _FRAGMENTS)
    if not any(begins.values()):  # no record crosses the end of a split
        return _cleaned(parts.select("file", "record", "closed"), crlf)
    whole = parts.where("place = 2").select("file", "record", "closed")
    # Pieces of a record stand in consecutive splits, the first of them in place 1 or, closed, in none.
    pieces = parts.where("place < 2")
    order = Window.partitionBy("file").orderBy("start", "place")
    numbered = pieces.withColumn("number", F.sum((F.col("place") == 1).cast("int")).over(order))
    crossing = numbered.groupBy("file", "number").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "place", "record"))), lambda x: x["record"]), "\n").alias("record"),
        F.max("closed").alias("closed"),
    )
    return _cleaned(whole.unionByName(crossing.select("file", "record", "closed")), crlf)


def _cleaned(records: DataFrame, crlf: bool) -> DataFrame:
    """Without empty lines; in files whose first line ends so, a carriage return and line feed are one line end."""
    if crlf:
        record = F.replace("record", F.lit("\r\n"), F.lit("\n"))
        record = F.when(F.col("closed"), F.regexp_replace(record, r"\r\z", "")).otherwise(record)
        records = records.withColumn("record", record)
    return records.where("record <> ''")


def n_fields(record: Column) -> Column:
    """Number of fields of a record: commas outside quotes and one."""
    # One regular expression, as the plan repeats what is used more than once: only the commas that part fields stay.
    commas = F.regexp_replace(record, r'(?s)(?<![^,])"[^"]*+(?:""[^"]*+)*+(?:"|\z)|[^,"]++|"', "")
    return F.length(commas) + 1


def parse_records(records: DataFrame, columns: list[str]) -> DataFrame:
    """The records with their ``columns`` as text in a struct ``row``, and ``rule``: what is wrong with a record, if anything."""
    # The number of fields stands here once, for the same reason.
    by_size = F.array(F.lit(TOO_SHORT), F.lit(None), F.lit(TOO_LONG))
    place = F.signum(n_fields(F.col("record")) - len(columns)).cast("int") + 1
    rule = F.when(~F.col("closed"), UNCLOSED).otherwise(F.get(by_size, place))
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    options = {k: str(v) for k, v in CSV.items()} | {"multiLine": "true", "mode": "PERMISSIVE", "maxCharsPerColumn": "-1"}
    return records.withColumns({"rule": rule, "row": F.from_csv("record", schema.simpleString(), options)})


def read_split_csv(spark: SparkSession, path: str, columns: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """All well-formed rows of CSV files as text columns, and the others as ``file``, ``rule`` and ``record``.

    Reads the same rows as Spark's reader with ``multiLine``, but in splits, and
    sets aside what that reader would fill up or cut: records with fewer or more
    fields than the header, and those whose quotes are not closed. With
    ``columns`` the files have no header line, and these are the names.
    """
    names = columns or spark.read.options(**CSV).csv(path).columns
    parsed = parse_records(read_records(spark, path, header=columns is None), names)
    good = parsed.where("rule IS NULL").select("row.*")
    return good, parsed.where("rule IS NOT NULL").select("file", "rule", "record")
