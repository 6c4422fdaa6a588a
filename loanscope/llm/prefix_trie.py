"""The prefix trie of conversations, in double arrays.

A conversation is the path of its turns. Equal paths are counted first, so a
conversation that many have alike is one path. The paths, in the order of their
turns' digests, are cut into shards at paths picked from a bounded sample; a hot
first turn is cut like any other stretch of the order. Each shard packs its paths
into a double array: turns get dense ids, in the order in which they first come
up level by level, and the child of the node in slot ``s`` by turn ``t`` lies in
slot ``BASE[s] + t``, whose ``CHECK`` is ``s``. The paths then traverse the array
to put their members where they end, and sums run up along ``CHECK``, a level at
a time.

Only a node on the path of a cut can lie in several shards. What a shard knows of
these upper nodes, bounded by their number, is merged over all shards: members
add up, children and leaves are counted once, and every upper node adds to all
above it. All other nodes are whole in their shard.
"""

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanscope.llm.common import work_tables
from loanscope.sources.scratch import checkpointed

#: A turn in a path: its MD5 and the UTF-8 length of its text.
DIGEST, STEP = 16, 20
#: Turns of a conversation, and ids of members, that are gathered at a time.
TURN_BUCKET, ID_BUCKET = 4096, 1 << 16
#: Turns of a cut at most; paths that agree in so many stay together.
CUT_TURNS = 64
#: Paths of a shard as planned, and paths looked at for each cut.
SHARD_PATHS, SAMPLED = 20_000, 32
NO_MEMBERS = hashlib.sha256(b"").hexdigest()

_FOUND = (
    "key binary, parent_key binary, last_bytes long, conv_id long, depth long, parent_conv_id long, n_convs long, "
    "n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
)


# --- Conversations as paths ---


def ordered_turns(turns: DataFrame) -> DataFrame:
    """``conv_id``, ``place`` (from 1), ``n_turns`` and ``turn_hex`` of every turn.

    Turns go by ``turn``, missing ones first, then by role and text. The turns of
    one conversation are ranked in parts of ``TURN_BUCKET`` turn numbers, so a
    very long one is not sorted by one task; it comes out the same.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    length = F.octet_length(text)
    # Role and text cannot run into each other: the length of the role goes first.
    digest = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))
    rows = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").alias("turn"),
        F.floor(F.col("turn") / TURN_BUCKET).cast("long").alias("bucket"),
        role.alias("role"),
        F.concat(digest, F.lpad(F.hex(length), 2 * (STEP - DIGEST), "0")).alias("turn_hex"),
        text.alias("text"),
    )
    rows = rows.withColumn("bucket", F.coalesce("bucket", F.lit(-(1 << 60))))
    counts = rows.groupBy("conv_id", "bucket").agg(F.count("*").alias("n"))
    whole = Window.partitionBy("conv_id")
    offsets = counts.select(
        "conv_id", "bucket",
        (F.sum("n").over(whole.orderBy("bucket")) - F.col("n")).alias("before"),
        F.sum("n").over(whole).alias("n_turns"),
    )
    in_bucket = Window.partitionBy("conv_id", "bucket").orderBy(F.asc_nulls_first("turn"), "role", "text")
    ranked = rows.withColumn("place", F.row_number().over(in_bucket).cast("long")).drop("text", "role", "turn")
    ranked = ranked.join(offsets, ["conv_id", "bucket"])
    return ranked.select("conv_id", (F.col("place") + F.col("before")).alias("place"), "n_turns", "turn_hex")


def rebuilt(turns: DataFrame, family: int = 5, most_shared: int = 9) -> DataFrame:
    """``conv_id``, ``place`` and ``turn_hex`` of ordered turns, the first ones taken from the family's conversation.

    Conversation ``c`` starts with the first ``h`` turns of ``c - c % family`` and
    goes on with its own after its first ``h``, with ``h`` the unsigned CRC-32 of
    its decimal number modulo ``most_shared``. A conversation that ends up
    without a turn has one row, its place null.
    """
    c = F.col("conv_id")
    h = F.crc32(c.cast("string")) % most_shared
    own = turns.where(F.col("place") > h).select("conv_id", F.lit(1).alias("part"), "place", "turn_hex")
    ids = turns.where("place = 1").select("conv_id", (c - c % family).alias("base"), h.alias("h"))
    shared = turns.where(F.col("place") < most_shared).select(
        F.col("conv_id").alias("base"), F.col("place").alias("base_place"), F.col("turn_hex").alias("base_hex")
    )
    first = ids.join(shared, (ids["base"] == shared["base"]) & (F.col("base_place") <= F.col("h")), "left").select(
        "conv_id", F.lit(0).alias("part"), F.col("base_place").alias("place"), F.col("base_hex").alias("turn_hex")
    )
    return first.union(own)


def paths(turns: DataFrame) -> DataFrame:
    """``conv_id`` and ``path`` of every conversation: its turns by part and place, ``STEP`` bytes each.

    Gathered in parts of ``TURN_BUCKET`` turns first, then by conversation.
    """
    at = F.struct("part", "place", "turn_hex")
    parts = turns.groupBy("conv_id", "part", F.floor(F.col("place") / TURN_BUCKET).alias("bucket")).agg(
        F.array_sort(F.collect_list(F.when(F.col("place").isNotNull(), at))).alias("at")
    )
    piece = F.array_join(F.transform("at", lambda x: x["turn_hex"]), "")
    piece = F.struct("part", "bucket", piece.alias("hex")).alias("piece")
    pieces = parts.select("conv_id", piece).groupBy("conv_id").agg(F.array_sort(F.collect_list("piece")).alias("pieces"))
    whole = F.array_join(F.transform("pieces", lambda x: x["hex"]), "")
    return pieces.select("conv_id", F.unhex(whole).alias("path"))


class _Members:
    """SHA-256 of the joined parts of each path's member list; parts come in order, a path at a time."""

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, None
        for batch in batches:
            done: list[tuple] = []
            for own, part in zip(batch.column("path_key").to_pylist(), batch.column("ids").to_pylist()):
                if own != key:
                    if digest:
                        done.append((key, digest.hexdigest()))
                    key, digest = own, hashlib.sha256(part.encode())
                else:
                    digest.update(b"," + part.encode())
            yield self._batch(done)
        yield self._batch([(key, digest.hexdigest())] if digest else [])

    @staticmethod
    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array([r[i] for r in rows], pa.string()) for i in (0, 1)]
        return pa.RecordBatch.from_arrays(columns, names=["path_key", "ends_sha256"])


def distinct_paths(members: DataFrame) -> DataFrame:
    """``path``, ``conv_id`` (the smallest), ``n_convs`` and ``ends_sha256`` of every distinct path.

    The list of members is put together from parts of at most ``ID_BUCKET`` ids and
    hashed as a stream.
    """
    keyed = members.withColumn("path_key", F.md5("path"))
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda x: x.cast("string")), ",")
    parts = keyed.groupBy("path_key", F.floor(F.col("conv_id") / ID_BUCKET).alias("bucket")).agg(ids.alias("ids"))
    streams = parts.repartition("path_key").sortWithinPartitions("path_key", "bucket").select("path_key", "ids")
    hashes = streams.mapInArrow(_Members(), "path_key string, ends_sha256 string")
    counts = keyed.groupBy("path_key").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.first("path").alias("path")
    )
    return counts.join(hashes, "path_key").select("path", "conv_id", "n_convs", "ends_sha256")


# --- Shards and their double arrays ---


def cut_paths(distinct: DataFrame, shard_paths: int) -> list[bytes]:
    """Ascending paths of at most ``CUT_TURNS`` turns; a path belongs to the shard after the cuts up to it.

    Picked from about ``SAMPLED`` paths a shard; they decide how even the shards are, nothing else.
    """
    n = distinct.count()
    shards = -(-n // shard_paths)
    if shards < 2:
        return []
    share = min(1.0, SAMPLED * shards / n)
    low = F.conv(F.substring(F.md5("path"), 1, 8), 16, 10).cast("long") < int(share * (1 << 32))
    sample = distinct.where(low).select(F.substring("path", 1, CUT_TURNS * STEP).alias("cut")).toArrow()
    picked = sorted(sample.column("cut").to_pylist())
    places = [len(picked) * i // shards for i in range(1, shards)] if picked else []
    return sorted({picked[p] for p in places if picked[p]})


class DoubleArray:
    """The trie of sorted distinct paths. Slots are numbers in ``base``, ``check`` and ``level``; the root's is 0."""

    #: Free slots tried for several children before the array is made longer.
    TRIES = 64

    def __init__(self, lengths: np.ndarray, ids: np.ndarray, offsets: np.ndarray):
        """``ids`` holds the dense ids of all paths one after another, path ``p`` from ``offsets[p]`` on."""
        self.lengths, self.ids, self.offsets = lengths, ids, offsets
        self.base, self.check = np.zeros(1, np.int64), np.full(1, -1, np.int64)
        self.level = np.zeros(1, np.int64)
        self.first_free = 1
        self.n_levels = int(lengths.max(initial=0)) + 1
        state = np.zeros(len(lengths), np.int64)  # slot that each path has reached
        for level in range(1, self.n_levels):
            rows = np.flatnonzero(lengths >= level)
            turn = ids[offsets[rows] + level - 1]
            # Sorted paths: equal (slot, turn) stand together.
            new = np.append(True, (np.diff(state[rows]) != 0) | (np.diff(turn) != 0))
            parents, turns = state[rows][new], turn[new]
            slots = self._add(parents, turns, level)
            state[rows] = slots[np.cumsum(new) - 1]

    def _reserve(self, size: int) -> None:
        more = max(size, 2 * len(self.check)) - len(self.check)
        if size > len(self.check):
            self.base = np.append(self.base, np.zeros(more, np.int64))
            self.check = np.append(self.check, np.full(more, -2, np.int64))
            self.level = np.append(self.level, np.full(more, -1, np.int64))

    def _free(self, n: int) -> np.ndarray:
        """The first ``n`` free slots."""
        near = np.flatnonzero(self.check[self.first_free : self.first_free + 64 * n] == -2)
        if len(near) >= n:
            return near[:n] + self.first_free
        free = np.flatnonzero(self.check[self.first_free :] == -2)
        if len(free) < n:
            self._reserve(len(self.check) + n)
            free = np.flatnonzero(self.check[self.first_free :] == -2)
        return free[:n] + self.first_free

    def _add(self, parents: np.ndarray, turns: np.ndarray, level: int) -> np.ndarray:
        """Slots for children, given in groups of one parent each."""
        starts = np.flatnonzero(np.append(True, np.diff(parents) != 0))
        ends = np.append(starts[1:], len(parents))
        slots = np.empty(len(parents), np.int64)
        for start, end in zip(starts[ends - starts > 1].tolist(), ends[ends - starts > 1].tolist()):
            base = self._fit(np.sort(turns[start:end]))
            slots[start:end] = base + turns[start:end]
            self._take(parents[start:end], slots[start:end], base, level)
        single = starts[ends - starts == 1]
        if len(single):
            slots[single] = self._free(len(single))
            self._take(parents[single], slots[single], slots[single] - turns[single], level)
        return slots

    def _take(self, parents, slots, base, level) -> None:
        self.base[parents], self.check[slots], self.level[slots] = base, parents, level
        while self.first_free < len(self.check) and self.check[self.first_free] != -2:
            self.first_free += 1

    def _fit(self, turns: np.ndarray) -> int:
        """A base at which the slots of all turns are free."""
        span = int(turns[-1] - turns[0]) + 1
        for slot in self._free(self.TRIES).tolist():
            if slot + span > len(self.check):
                self._reserve(slot + span)
            if (self.check[slot + turns - turns[0]] == -2).all():
                return slot - int(turns[0])
        end = int(np.flatnonzero(self.check != -2)[-1]) + 1
        self._reserve(end + span)
        return end - int(turns[0])

    def step(self, slots: np.ndarray, turns: np.ndarray) -> np.ndarray:
        """The children of the slots by the turns."""
        children = self.base[slots] + turns
        assert (self.check[children] == slots).all()
        return children

    def ends(self) -> np.ndarray:
        """The slot of each path's end."""
        state = np.zeros(len(self.lengths), np.int64)
        for level in range(1, self.n_levels):
            rows = np.flatnonzero(self.lengths >= level)
            state[rows] = self.step(state[rows], self.ids[self.offsets[rows] + level - 1])
        return state

    def levels(self) -> list[np.ndarray]:
        """The slots in use by level, the root first."""
        used = np.flatnonzero(self.level >= 0)
        order = used[np.argsort(self.level[used], kind="stable")]
        return np.split(order, np.searchsorted(self.level[order], np.arange(1, self.n_levels)))


def _numbered(paths: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lengths, dense turn ids and offsets of the paths; ids in order of first appearance, level by level."""
    lengths = np.array([len(p) // STEP for p in paths], np.int64)
    offsets = np.cumsum(lengths) - lengths
    turns = np.frombuffer(b"".join(paths), dtype=f"V{STEP}")
    if not len(turns):
        return lengths, np.empty(0, np.int64), offsets
    depth = np.arange(len(turns)) - np.repeat(offsets, lengths)
    words = turns.view(np.uint8).reshape(-1, STEP)
    halves = [words[:, :8].copy().view(">u8").ravel(), words[:, 8:16].copy().view(">u8").ravel()]
    length = words[:, 16:].copy().view(">u4").ravel()
    order = np.lexsort((np.arange(len(turns)), depth, length, *halves))
    fresh = np.append(True, (np.diff(halves[0][order]) != 0) | (np.diff(halves[1][order]) != 0) | (np.diff(length[order]) != 0))
    group = np.cumsum(fresh) - 1
    first = order[fresh]  # the shallowest and there the first place of each distinct turn
    rank = np.empty(len(first), np.int64)
    rank[np.lexsort((first, depth[first]))] = np.arange(len(first))
    ids = np.empty(len(turns), np.int64)
    ids[order] = rank[group]
    return lengths, ids, offsets


class _Shards:
    """Builds the trie of each shard and reports its nodes; those on a cut with their keys, to be merged."""

    def __init__(self, cuts):
        self.cuts = cuts

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts = self.cuts.value
        shard, held = None, []
        for batch in batches:
            shards = batch.column("shard").to_numpy()
            edges = np.append(0, np.flatnonzero(np.diff(shards)) + 1)
            for start, end in zip(edges.tolist(), [*edges[1:].tolist(), len(shards)]):
                if end > start and shards[start] != shard:
                    if held:
                        yield self._shard(cuts, shard, held)
                    shard, held = int(shards[start]), []
                if end > start:
                    held.append(batch.slice(start, end - start))
        if held:
            yield self._shard(cuts, shard, held)

    def _shard(self, cuts: list[bytes], shard: int, held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held)
        paths = rows.column("path").to_pylist()
        lengths, ids, offsets = _numbered(paths)
        trie = DoubleArray(lengths, ids, offsets)
        ends, size = trie.ends(), len(trie.check)
        levels = trie.levels()

        convs, first = np.zeros(size, np.int64), np.full(size, np.iinfo(np.int64).max)
        convs[ends] = rows.column("n_convs").to_numpy()
        first[ends] = rows.column("conv_id").to_numpy()
        path_of = np.full(size, -1, np.int64)  # a path through the node
        path_of[ends] = np.arange(len(paths))
        for level in levels[:0:-1]:
            up = trie.check[level]
            np.add.at(convs, up, convs[level])
            np.minimum.at(first, up, first[level])
            path_of[up] = path_of[level]

        used = np.concatenate(levels)
        depth, through = trie.level, path_of
        # The upper nodes: those on the paths of the cuts at both ends of the shard.
        upper = np.zeros(size, bool)
        upper[0] = True
        number = {paths[p][STEP * d : STEP * d + STEP]: i for p, d, i in self._turns(paths, lengths, ids)} if cuts else {}
        for cut in {*cuts[max(0, shard - 1) : shard], *cuts[shard : shard + 1]} if cuts else ():
            slot = 0
            for at in range(0, len(cut), STEP):
                turn = number.get(cut[at : at + STEP])
                child = None if turn is None else int(trie.base[slot]) + turn
                if child is None or not 0 <= child < size or trie.check[child] != slot:
                    break
                slot = child
                upper[slot] = True

        children = np.bincount(trie.check[used[used > 0]], minlength=size)
        own_children = np.bincount(trie.check[used[(used > 0) & ~upper[used]]], minlength=size)
        last = np.zeros(size, np.int64)
        inner = used[used > 0]
        last[inner] = [int.from_bytes(paths[p][STEP * d - 4 : STEP * d], "big") for p, d in zip(through[inner].tolist(), depth[inner].tolist())]
        leaves = ((children == 0) & ~upper).astype(np.int64)
        saved = np.where(upper, 0, (convs - 1) * last)
        for level in levels[:0:-1]:
            np.add.at(leaves, trie.check[level], leaves[level])
            np.add.at(saved, trie.check[level], saved[level])

        hashes = rows.column("ends_sha256").to_pylist()
        end_hash = dict(zip(ends.tolist(), hashes))
        slots = used.tolist()
        up = trie.check[used]
        key = [paths[through[s]][: STEP * int(depth[s])] if upper[s] else None for s in slots]
        parent_key = [paths[through[s]][: STEP * int(depth[s] - 1)] if s and upper[trie.check[s]] else None for s in slots]
        whole = ~upper[up] & (used > 0)
        parent = pa.array(np.where(whole, first[up], 0), pa.int64(), mask=~whole)
        columns = [
            pa.array(key, pa.binary()), pa.array(parent_key, pa.binary()), pa.array(last[used]),
            pa.array(first[used]), pa.array(depth[used]), parent, pa.array(convs[used]),
            pa.array(np.where(upper, own_children, children)[used]), pa.array(leaves[used]), pa.array(saved[used]),
            pa.array([end_hash.get(s, None if upper[s] else NO_MEMBERS) for s in slots], pa.string()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in _FOUND.split(", ")])

    @staticmethod
    def _turns(paths, lengths, ids) -> Iterator[tuple[int, int, int]]:
        """A path, a place in it and the id there, for every distinct turn."""
        _, first = np.unique(ids, return_index=True)
        owner = np.repeat(np.arange(len(paths)), lengths)
        before = np.cumsum(lengths) - lengths
        for at in first.tolist():
            p = int(owner[at])
            yield p, at - int(before[p]), int(ids[at])


def _dealt(distinct: DataFrame, cuts) -> DataFrame:
    """The distinct paths with their ``shard``."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        points = cuts.value
        for batch in batches:
            shards = [bisect_right(points, p) for p in batch.column("path").to_pylist()]
            yield batch.append_column("shard", pa.array(shards, pa.int32()))

    return distinct.mapInArrow(deal, "path binary, conv_id long, n_convs long, ends_sha256 string, shard int")


def _merged(parts: DataFrame, step: int = STEP) -> DataFrame:
    """The upper nodes, each once, from what the shards know of them."""
    upper = parts.groupBy("key").agg(
        F.first("parent_key").alias("parent_key"),
        F.max("last_bytes").alias("last_bytes"), F.max("depth").alias("depth"), F.min("conv_id").alias("conv_id"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        F.coalesce(F.max("ends_sha256"), F.lit(NO_MEMBERS)).alias("ends_sha256"),
    )
    upper = checkpointed(upper)
    kids = upper.where("depth > 0").groupBy(F.col("parent_key").alias("key")).agg(F.count("*").alias("kids"))
    upper = upper.join(kids, "key", "left").withColumn("n_children", F.col("n_children") + F.coalesce("kids", F.lit(0)))
    # Each upper node adds what is its own, a leaf or saved tokens, to itself and to all above it.
    own = upper.select(
        F.explode(F.expr(f"transform(sequence(0L, depth), d -> substring(key, 1, CAST(d * {step} AS INT)))")).alias("key"),
        (F.col("n_children") == 0).cast("long").alias("own_leaves"),
        ((F.col("n_convs") - 1) * F.col("last_bytes")).alias("own_saved"),
    )
    own = own.groupBy("key").agg(F.sum("own_leaves").alias("own_leaves"), F.sum("own_saved").alias("own_saved"))
    parents = upper.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    return (
        upper.join(own, "key")
        .join(parents, "parent_key", "left")
        .withColumn("n_leaves", F.col("n_leaves") + F.col("own_leaves"))
        .withColumn("saved_tokens", F.col("saved_tokens") + F.col("own_saved"))
    )


NODE = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def trie_nodes(members: DataFrame, shard_paths: int = SHARD_PATHS) -> DataFrame:
    """Every node of the trie of ``conv_id`` and ``path``, as ``prefix_trie`` describes them."""
    context = members.sparkSession.sparkContext
    with work_tables(members.sparkSession) as written:
        distinct = written("paths", distinct_paths(members))
        points = cut_paths(distinct, shard_paths)
        cuts = context.broadcast(points)
        dealt = _dealt(distinct, cuts).repartition(len(points) + 1, "shard").sortWithinPartitions("shard", "path")
        found = written("nodes", dealt.mapInArrow(_Shards(cuts), _FOUND))
        upper = checkpointed(_merged(found.where("key IS NOT NULL")))
        parents = upper.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("above"))
        lower = found.where("key IS NULL")
        below_upper = lower.where("parent_key IS NOT NULL").join(parents, "parent_key")
        below_upper = below_upper.withColumn("parent_conv_id", F.col("above"))
        inside = lower.where("parent_key IS NULL")
        return checkpointed(upper.select(*NODE).union(below_upper.select(*NODE)).union(inside.select(*NODE)))


def prefix_trie(conversations: DataFrame, shard_paths: int = SHARD_PATHS) -> DataFrame:
    """The nodes of the trie of rebuilt conversations.

    Turns are ordered by ``turn``, missing ones first, then by role and text, and
    rebuilt by families as ``rebuilt`` says. A row per distinct sequence of first
    turns, from the textless root on: ``conv_id`` (the smallest of its members,
    the conversations that begin with it), ``depth``, ``parent_conv_id`` (null of
    the root), ``n_convs``, ``n_children``, ``n_leaves`` (childless nodes in its
    subtree, itself included), ``saved_tokens`` (over its subtree, a node's members
    less one times the UTF-8 bytes of its last text) and ``ends_sha256``, of the
    ascending decimal ids, joined by commas, of the conversations that end there.

    Missing roles and texts are empty, rows without a conversation take no part,
    repeated rows are turns of their own, other columns are not looked at. An
    empty table has no nodes. A conversation is one row of ``STEP`` bytes a turn,
    however long its texts are; a task holds the paths of one shard.
    """
    return trie_nodes(paths(rebuilt(checkpointed(ordered_turns(conversations)))), shard_paths)
