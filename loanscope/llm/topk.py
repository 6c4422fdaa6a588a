"""Exact top-k by inner product, with a KD-tree per shard.

Vectors are dealt into shards by a hash. Each shard builds a tree of median
splits with tight bounding boxes; for a query, a box bounds the product from
above, so a best-first walk stops once no box can reach the kth score. A query
first walks the shard it lies in. The kth score found there goes with it to all
other shards, where most boxes then fall at once.

A shard's vectors come to its task first and its queries follow in a stream, so
a task holds one tree and one batch of queries, however many there are.
"""

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanscope.llm.common import runs
from loanscope.sources.scratch import checkpointed

LEAF = 64
BLOCK = 256
FOUND = "query_id long, query_key long, vec_id long, score long"
LONG = (-(2**63), 2**63 - 1)


class KdTree:
    """Points in leaves of at most LEAF, with the tight box of every node."""

    def __init__(self, points: np.ndarray, ids: np.ndarray):
        self.lo: list[np.ndarray] = []
        self.hi: list[np.ndarray] = []
        self.children: list[tuple[int, int] | None] = []
        self.span: list[tuple[int, int]] = []
        order = np.arange(len(points))
        todo = [(0, len(points), -1, 0)] if len(points) else []
        while todo:
            start, end, parent, side = todo.pop()
            own = order[start:end]
            lo, hi = points[own].min(axis=0), points[own].max(axis=0)
            node = len(self.span)
            self.lo.append(lo)
            self.hi.append(hi)
            self.span.append((start, end))
            self.children.append(None)
            if parent >= 0:
                pair = self.children[parent] or (0, 0)
                self.children[parent] = (node, pair[1]) if side == 0 else (pair[0], node)
            width = hi - lo
            if end - start > LEAF and len(width) and width.max() > 0:
                axis, middle = int(width.argmax()), (end - start) // 2
                order[start:end] = own[np.argpartition(points[own, axis], middle)]
                todo += [(start + middle, end, node, 1), (start, start + middle, node, 0)]
        self.points, self.ids = points[order], ids[order]
        dims = points.shape[1]
        self.lo, self.hi = (np.array(x, dtype=points.dtype).reshape(-1, dims) for x in (self.lo, self.hi))

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Of every query and node, no point of the node scores higher."""
        zero = queries.dtype.type(0) if queries.dtype != object else 0
        return np.maximum(queries, zero) @ self.hi.T + np.minimum(queries, zero) @ self.lo.T

    def search(self, query: np.ndarray, bounds: np.ndarray, own_id: int, k: int, least: int | None):
        """Ids and scores of the k best, ties to the smaller id, leaving out scores below ``least``."""
        heap = [(-bounds[0], 0)] if len(self.span) else []
        ids, scores = np.empty(0, np.int64), np.empty(0, self.points.dtype)
        while heap:
            bound, node = heapq.heappop(heap)
            if least is not None and -bound < least:
                break
            if (pair := self.children[node]) is not None:
                for child in pair:
                    if least is None or bounds[child] >= least:
                        heapq.heappush(heap, (-bounds[child], child))
                continue
            start, end = self.span[node]
            found = self.points[start:end] @ query
            keep = self.ids[start:end] != own_id
            if least is not None:
                keep &= found >= least
            if keep.any():
                ids = np.concatenate([ids, self.ids[start:end][keep]])
                scores = np.concatenate([scores, found[keep]])
                if len(ids) >= k:
                    best = np.lexsort((ids, -scores))[:k]
                    ids, scores = ids[best], scores[best]
                    least = scores[-1] if least is None else max(least, scores[-1])
        return ids, scores


def _matrix(vectors: pa.Array, dims: int | None = None) -> np.ndarray:
    """Vectors as rows, short ones filled with zeros, ones longer than ``dims`` cut to it."""
    lengths = np.diff(vectors.offsets.to_numpy())
    values = vectors.flatten().to_numpy(zero_copy_only=False)
    dims = int(lengths.max(initial=0)) if dims is None else dims
    if len(lengths) and (lengths == dims).all():
        return values.reshape(len(lengths), dims)
    out = np.zeros((len(lengths), dims), dtype=np.int64)
    start = 0
    for row, length in enumerate(lengths.tolist()):
        out[row, : min(dims, length)] = values[start : start + min(dims, length)]
        start += length
    return out


def _exact_type(*matrices: np.ndarray):
    """A number type in which every product of rows is exact."""
    largest = [max((abs(int(m.max(initial=0))), abs(int(m.min(initial=0))))) for m in matrices]
    most = largest[0] * largest[1] * max(1, matrices[0].shape[1])
    return np.float64 if most < 2**53 else np.int64 if most < 2**63 else object


class _Search:
    def __init__(self, k: int):
        self.k = k

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, parts, ids, tree, matrix = None, [], [], None, None
        for batch in batches:
            shards = batch.column("shard").to_numpy()
            is_query = batch.column("is_query").to_numpy(zero_copy_only=False)
            for start, end in runs(shards, is_query):
                rows = batch.slice(start, end - start)
                if shards[start] != shard:
                    shard, parts, ids, tree = int(shards[start]), [], [], None
                if not is_query[start]:
                    parts.append(rows.column("vector"))
                    ids.append(rows.column("vec_id").to_numpy())
                    continue
                if tree is None:
                    matrix = _matrix(pa.concat_arrays(parts)) if parts else np.zeros((0, 0), np.int64)
                    parts = []
                for first in range(0, rows.num_rows, BLOCK):
                    block = rows.slice(first, BLOCK)
                    queries = _matrix(block.column("vector"), matrix.shape[1])
                    kind = _exact_type(matrix, queries)
                    if tree is None or tree.points.dtype != kind:
                        tree = KdTree(matrix.astype(kind), np.concatenate(ids) if ids else np.empty(0, np.int64))
                    yield self._block(tree, block, queries.astype(kind))

    def _block(self, tree: KdTree, block: pa.RecordBatch, queries: np.ndarray) -> pa.RecordBatch:
        bounds = tree.bounds(queries)
        query_ids, keys = block.column("vec_id").to_pylist(), block.column("query_key").to_pylist()
        out: list[list] = [[], [], [], []]
        for row, least in enumerate(block.column("least").to_pylist()):
            ids, scores = tree.search(queries[row], bounds[row], query_ids[row], self.k, least)
            out[0] += [query_ids[row]] * len(ids)
            out[1] += [keys[row]] * len(ids)
            out[2] += ids.tolist()
            out[3] += [min(max(int(s), LONG[0]), LONG[1]) for s in scores]
        names = ["query_id", "query_key", "vec_id", "score"]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=names)


def _shard(shards: int) -> Column:
    """Shard of a row. Rows of one id are dealt out by their vectors."""
    return F.pmod(F.xxhash64("vec_id", "vector"), F.lit(shards)).cast("int")


def top_k(
    vectors: DataFrame, k: int = 10, scale: float = 1024.0, query_every: int = 100, shard_rows: int = 8192
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` of the k best for every query.

    Components become ``floor(scale * x)``, x as double. Queries are the rows
    whose ``vec_id`` is divisible by ``query_every``; the candidates of a query
    are all rows with another id. Rows take no part if the id or the vector is
    missing or a component is missing, NaN or infinite. Shorter vectors count as
    filled up with zeros. Rows that repeat id and vector are one query, and as
    candidates one each. Scores beyond a long are its ends. Ties go to the
    smaller id; a query with fewer than k candidates gets them all.

    ``shard_rows`` is the size of a tree, so the number of shards follows the table.
    Only rows that agree in id and vector are in one shard however many they are.
    """
    component = F.transform("embedding", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    finite = F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf")))
    )
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & finite)
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), component.alias("vector"))
    shards = max(1, -(-rows.count() // shard_rows))
    rows = rows.withColumn("shard", _shard(shards))
    nothing = F.lit(None).cast("long")
    points = rows.select("shard", F.lit(False).alias("is_query"), "vec_id", nothing.alias("query_key"), nothing.alias("least"), "vector")
    queries = rows.where(F.col("vec_id") % query_every == 0).withColumn("query_key", F.xxhash64("vector"))
    queries = queries.dropDuplicates(["vec_id", "query_key"])

    def searched(asked: DataFrame) -> DataFrame:
        columns = ["shard", F.lit(True).alias("is_query"), "vec_id", "query_key", "least", "vector"]
        both = points.union(asked.select(*columns)).repartition(shards, "shard")
        return both.sortWithinPartitions("shard", "is_query").mapInArrow(_Search(k), FOUND)

    found = checkpointed(searched(queries.withColumn("least", nothing)))
    if shards > 1:
        least = found.groupBy("query_id", "query_key").agg(F.when(F.count("*") >= k, F.min("score")).alias("least"))
        asked = queries.join(
            least.withColumnRenamed("query_id", "vec_id"), ["vec_id", "query_key"], "left"
        ).withColumnRenamed("shard", "home")
        others = F.filter(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: s != F.col("home"))
        found = found.union(searched(asked.withColumn("shard", F.explode(others))))
    best = Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
