"""Near-duplicate texts by SimHash, with an exact search for close fingerprints.

Fingerprints are mapped to the bit counts of their 32 two-bit segments. The
Manhattan distance of two such vectors never exceeds the number of differing
bits, so it is a lower bound to search by. The segments fall into blocks, enough
of them that two fingerprints within the limit are at distance 0 or 1 in some
block. The vector of a block is a cell of a grid; each fingerprint lies in its
own cell and asks in that cell and in the cells one step up in one coordinate,
which meets every pair at distance 0 or 1. What meets in a cell is compared bit
by bit.

A cell reports a spanning forest of its links, not all its pairs, and a cell
with very many fingerprints is divided between tasks. Linked fingerprints become
components by alternating star steps, in which every fingerprint only looks at
the smallest of its neighbours.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanscope.llm.common import encoded, quoted, runs, word_blocks
from loanscope.sources.scratch import checkpointed

SEED = 42
BITS, SEGMENT = 64, 2
SEGMENTS = BITS // SEGMENT
#: Every other bit; used to count the bits of all segments at once.
EVEN_BITS = 0x5555555555555555


def fingerprint(text: bytes, shingle: int) -> int:
    """SimHash of a UTF-8 text: the bits set in over half of the hashes of its shingles."""
    votes, n_hashes, carried = np.zeros(BITS, dtype=np.int64), 0, []
    for block in word_blocks(text.lower()):  # bytes.lower knows A-Z only, as wanted
        words = carried + block
        if len(words) < shingle:
            carried = words
            continue
        votes += _votes(words, shingle)
        n_hashes += len(words) - shingle + 1
        carried = words[len(words) - shingle + 1 :]
    if not n_hashes and carried:
        votes, n_hashes = _votes(carried, len(carried)), 1
    return int.from_bytes(np.packbits(2 * votes > n_hashes).tobytes(), "big")


def _votes(words: list[bytes], shingle: int) -> np.ndarray:
    """How many of the shingles' hashes have each bit set, the highest bit first."""
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    spans = zip(starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1 :].tolist())
    digests = b"".join([xxhash.xxh64_digest(joined[a:b], SEED) for a, b in spans])
    bits = np.unpackbits(np.frombuffer(digests, dtype=np.uint8).reshape(-1, 8), axis=1)
    return bits.sum(axis=0, dtype=np.int64)


def fingerprints(docs: DataFrame, shingle: int = 3, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns and the 64-bit ``fp`` of every row, as a signed long.

    Only A-Z are lower-cased, and words are what ASCII blanks part. A text with
    fewer words than a shingle is one shingle; one without words, or a missing
    one, has fingerprint zero.
    """
    schema = docs.select(*keep).schema.add("fp", "long")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t, shingle) for t in encoded(batch.column("text_"))], dtype=np.uint64)
            columns = [batch.column(c) for c in keep]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(fps.view(np.int64))], names=[*keep, "fp"])

    return docs.select(*keep, F.col("text").alias("text_")).mapInArrow(hashed, schema)


def _cells(max_distance: int) -> Column:
    """Of column ``fp``: every cell it lies in (kind 0) or asks in (kind 1), as an array of structs."""
    blocks = (max_distance + 2) // 2
    even = F.lit(EVEN_BITS)
    odd = F.shiftrightunsigned("fp", 1)
    ones, twos = F.col("fp").bitwiseXOR(odd).bitwiseAND(even), F.col("fp").bitwiseAND(odd).bitwiseAND(even)
    counts = ones.bitwiseOR(F.shiftleft(twos, 1))  # the two bits of each segment added up, without a carry
    entries = []
    for block in range(blocks):
        first, end = block * SEGMENTS // blocks, (block + 1) * SEGMENTS // blocks
        cell = F.shiftrightunsigned(counts, SEGMENT * first)
        if end - first < SEGMENTS:
            cell = cell.bitwiseAND(F.lit((1 << SEGMENT * (end - first)) - 1))

        def entry(kind: int, at: Column, block: int = block) -> Column:
            return F.struct(F.lit(block).alias("block"), at.alias("cell"), F.lit(kind).alias("kind"))

        entries += [entry(0, cell), entry(1, cell)]
        for segment in range(end - first):
            here = F.shiftrightunsigned(cell, SEGMENT * segment).bitwiseAND(F.lit(3))
            # A full segment has no cell one step up. The step itself never carries into the next segment.
            up = cell.bitwiseXOR(F.shiftleft(here.bitwiseXOR(here + 1), SEGMENT * segment))
            entries.append(F.when(here < SEGMENT, entry(1, up)))
    return F.filter(F.array(*entries), lambda e: e.isNotNull())


def close_pairs(fps: DataFrame, max_distance: int = 3, chunk_rows: int = 4096) -> DataFrame:
    """Links ``a``, ``b`` between the distinct ``fp`` of a table that differ in at most ``max_distance`` bits.

    Not all such pairs come out, but enough that whatever is linked is connected.
    A cell with more than ``chunk_rows`` fingerprints is compared in parts of
    about that size; every fingerprint asks in all parts, so none is missed.
    """
    entries = fps.select("fp", F.explode(_cells(max_distance)).alias("e")).select("e.*", "fp")
    crowded = checkpointed(
        entries.where("kind = 0").groupBy("block", "cell").count().where(F.col("count") > chunk_rows)
    )
    if crowded.isEmpty():
        entries = entries.withColumn("chunk", F.lit(0))
    else:
        parts = crowded.select("block", "cell", F.ceil(F.col("count") / chunk_rows).cast("int").alias("parts"))
        own = F.array(F.pmod(F.hash("fp"), F.col("parts")))
        every = F.sequence(F.lit(0), F.col("parts") - 1)
        chunks = F.when(F.col("parts").isNull(), F.array(F.lit(0))).when(F.col("kind") == 0, own).otherwise(every)
        entries = entries.join(parts, ["block", "cell"], "left").withColumn("chunk", F.explode(chunks)).drop("parts")
    key = ["block", "cell", "chunk"]
    placed = entries.repartition(*key).sortWithinPartitions(*key, "kind")
    return placed.select(*key, "kind", "fp").mapInArrow(_Compare(max_distance), "a long, b long")


class _Compare:
    """Compares what meets in a cell: rows come by cell, first those that lie there, then those that ask."""

    def __init__(self, max_distance: int):
        self.max_distance = max_distance

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, homes = None, None
        for batch in batches:
            keys = [batch.column(c).to_numpy() for c in ("block", "cell", "chunk")]
            asks = batch.column("kind").to_numpy() == 1
            fps = batch.column("fp").to_numpy().view(np.uint64)
            found: list[tuple[int, int]] = []
            groups = runs(*keys)
            for place, (start, end) in enumerate(groups):
                edge = place in (0, len(groups) - 1)
                # Two rows of a cell inside the batch are one fingerprint that meets itself.
                if not edge and (asks[start] or end - start <= 2):
                    continue
                key = tuple(int(k[start]) for k in keys)
                if key != current:
                    current, homes = key, _Homes(self.max_distance)
                own = asks[start:end]
                homes.add(fps[start:end][~own])
                found += homes.ask(fps[start:end][own])
            pairs = np.array(found, dtype=np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])


class _Homes:
    """The fingerprints of one cell, joined up as links between them are found."""

    BLOCK = 512

    def __init__(self, max_distance: int):
        self.max_distance = max_distance
        self.fps = np.empty(0, dtype=np.uint64)
        self.root: list[int] = []

    def add(self, fps: np.ndarray) -> None:
        if len(fps):
            self.root += range(len(self.root), len(self.root) + len(fps))
            self.fps = np.concatenate([self.fps, fps])

    def _find(self, i: int) -> int:
        while self.root[i] != i:
            self.root[i] = i = self.root[self.root[i]]
        return i

    def ask(self, fps: np.ndarray) -> list[tuple[int, int]]:
        """Of each asking fingerprint one link, and those that join up fingerprints here not joined before."""
        out = []
        for first in range(0, len(fps) if len(self.fps) else 0, self.BLOCK):
            block = fps[first : first + self.BLOCK]
            apart = np.bitwise_count(block[:, None] ^ self.fps[None, :])
            rows, columns = np.nonzero((apart <= self.max_distance) & (apart > 0))
            previous = -1
            for row, column in zip(rows.tolist(), columns.tolist()):
                if row != previous:
                    previous, anchor = row, column
                    out.append((int(block[row]), int(self.fps[column])))
                elif (x := self._find(anchor)) != (y := self._find(column)):
                    self.root[y] = x
                    out.append((int(block[row]), int(self.fps[column])))
        return out


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``root`` of every node of a link except the roots; the root is the smallest node.

    Rounds of a large and a small star step, until a round changes nothing. The
    number of rounds grows with the logarithm of the longest chain.
    """
    low, high = F.least(a, b), F.greatest(a, b)
    edges = checkpointed(links.where(F.col(a) != F.col(b)).select(high.alias("node"), low.alias("root")).distinct())
    state = _state(edges)
    while state[0]:
        both = edges.union(edges.select("root", "node"))
        smallest = both.groupBy("node").agg(F.min("root").alias("low"))
        # Large step: larger neighbours move to the smallest of the neighbours and the node itself.
        larger = both.where("root > node").join(smallest, "node")
        large = larger.select(F.col("root").alias("node"), F.least("low", "node").alias("root")).distinct()
        # Small step: smaller neighbours and the node itself move to the smallest of them.
        smallest = large.groupBy("node").agg(F.min("root").alias("low"))
        moved = large.join(smallest, "node")
        small = moved.select(F.col("root").alias("node"), F.col("low").alias("root")).where("node > root")
        edges = checkpointed(small.union(smallest.select("node", "low")).distinct())
        before, state = state, _state(edges)
        if state == before:
            break
    return edges


def _state(edges: DataFrame) -> tuple[int, int]:
    """Number of edges and a sum over them, which stays when the edges do."""
    digest = F.sum(F.xxhash64("node", "root").cast("decimal(20,0)"))
    return tuple(edges.agg(F.count("*"), digest).first())


def near_duplicates(
    docs: DataFrame, shingle: int = 3, max_distance: int = 3, keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """The ``keep`` columns, ``fp``, ``root`` and ``component_id`` of every row of ``docs``.

    ``component_id`` is the smallest ``doc_id`` that links lead to, the row's own
    included; it is null if all ids there are missing. ``root`` is the smallest
    fingerprint there. Rows with equal fingerprints are linked, those without
    words among themselves as well.
    """
    rows = checkpointed(fingerprints(docs, shingle, keep))
    # The cells of a fingerprint take far more room than it does, hence not the few tasks its own size asks for.
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    distinct = checkpointed(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")).repartition(tasks, "fp"))
    roots = components(close_pairs(distinct, max_distance))
    ends = roots.select("root").distinct().select(F.col("root").alias("fp"), "root")
    members = roots.select(F.col("node").alias("fp"), "root").union(ends)
    # Only linked fingerprints are grouped, and written before the join, which can then split a large group.
    ids = members.join(distinct, "fp").groupBy("root").agg(F.min("first_id").alias("smallest_id"))
    linked = members.join(checkpointed(ids), "root")
    labels = distinct.join(linked, "fp", "left").select(
        "fp",
        F.coalesce("root", "fp").alias("root"),
        F.when(F.col("root").isNull(), F.col("first_id")).otherwise(F.col("smallest_id")).alias("component_id"),
    )
    return rows.join(labels, "fp").select(*keep, "fp", "root", "component_id")


def hex_fingerprint(fp: str = "fp") -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def has_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(has_map(f.dataType) for f in kind)
    if isinstance(kind, T.ArrayType):
        return has_map(kind.elementType)
    return isinstance(kind, (T.MapType, T.VariantType))


def deduplicate(docs: DataFrame, shingle: int = 3, max_distance: int = 3) -> DataFrame:
    """The rows of ``docs``, with all their columns, less all but one of each group.

    The row with the smallest ``doc_id`` stays. If several rows of a group have
    that id, or none has an id, the one with the smallest hash of its columns
    stays, and of equal rows one. Columns may have any name and type; helpers stand
    beside one struct of them all. Texts are shuffled once, to meet the ids that stay.
    """
    # Maps have neither a hash nor an order, their sorted entries as text have.
    row = F.struct(*[quoted(c) for c in docs.columns])
    values = [F.to_json(F.struct(quoted(f.name).alias("v"))) if has_map(f.dataType) else quoted(f.name) for f in docs.schema]
    marked = docs.select("doc_id", "text", F.xxhash64(*values).alias("row_hash"), row.alias("row"))
    labelled = near_duplicates(marked.drop("row"), shingle, max_distance, ("doc_id", "row_hash"))
    stays = labelled.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    stays = stays.groupBy("root").agg(F.min("row_hash").alias("kept_hash"), F.first("component_id").alias("kept_id"))
    # The hash alone is the join key, so that the window below needs no second shuffle of the texts.
    same_id = F.coalesce(F.col("doc_id") == F.col("kept_id"), F.col("doc_id").isNull() & F.col("kept_id").isNull())
    kept = marked.drop("text").join(stays.drop("root"), (F.col("row_hash") == F.col("kept_hash")) & same_id, "left_semi")
    first = Window.partitionBy("row_hash", "doc_id").orderBy("row_hash")
    return kept.withColumn("copy", F.row_number().over(first)).where("copy = 1").select("row.*")
