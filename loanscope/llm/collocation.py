"""Frequent phrases and how strongly their words hold together, by dynamic itemset counting.

The texts are dealt into shards that are scanned in a cycle, one shard a step.
Words are counted from the first step on. A longer phrase becomes active as soon
as both its subphrases, without its last and without its first word, have reached
the threshold, wherever the cycle stands; it is then counted for exactly one full
cycle, so over every shard once. Phrases of all lengths are counted side by side,
and the scans end when no phrase is left in the middle of its cycle. A phrase
without occurrences between its activation and its first sighting lost nothing,
so it need not be listed before it is seen: only what a shard holds is counted.

The step from which on the phrases of a bucket count as frequent stands in a
table of ``2**bucket_bits`` bytes, whatever the size of the corpus. Two phrases in
one bucket share the earlier step of both. That activates some longer phrase too
early or in vain, never too late, and its step is the same in every scan, so all
counts stay exact; the threshold itself is applied to the exact counts.

Texts are cut into words once, into blocks of word numbers. A scan works on these
in numpy and reports every active phrase of a block once, as 128 bits of hash with
its count; a last scan gives the frequent ones their words.
"""

import ctypes
import re
import zlib
from array import array
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanscope.llm.common import encoded
from loanscope.sources.scratch import checkpointed, work_folder

#: Words of a block, over which a scan counts before Spark does.
BLOCK_WORDS = 1 << 20
#: Rows that a scan hands over at a time.
BATCH_ROWS = 1 << 16
#: Of the blocks, one part in so many names most frequent phrases, the others only what these lack.
NAMING_PARTS = 16
#: Parts of a language ranked on their own before the language is.
RANK_PARTS = 64
MAX_WORDS = 4
NEVER = 255
# --- Fixed values: what ends a piece, what parts words, the language of rows without one ---
PIECE_ENDS, BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
NO_LANGUAGE = "und"
_PIECE_END = re.compile(b"[" + re.escape(PIECE_ENDS) + b"]")
_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_SIMPLER = bytes.maketrans(PIECE_ENDS + BLANKS + _UPPER, b"\n" * len(PIECE_ENDS) + b" " * len(BLANKS) + _UPPER.lower())
#: Bytes of a text cut at a time.
STRETCH = 1 << 20

_BLOCKS = "shard int, lang string, n long, part int, words binary, codes binary"
_COUNTS = "h1 long, h2 long, kind int, n long"
_NAMES = "h1 long, h2 long, lang string, phrase string"
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)
_M1, _M2, _M3 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def _mixed(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, in the place of the values."""
    h ^= h >> np.uint64(30)
    h *= _M1
    h ^= h >> np.uint64(27)
    h *= _M2
    h ^= h >> np.uint64(31)
    return h


def _stretches(text: bytes) -> Iterator[bytes]:
    """A long text in parts that end where a piece does."""
    start = 0
    while len(text) - start > STRETCH:
        end = _PIECE_END.search(text, start + STRETCH)
        if end is None:
            break
        yield text[start : end.start()]
        start = end.end()
    yield text[start:]


class _Numbers(dict):
    """Numbers of words, the next one for a new word."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def _give_back() -> None:
    """Freed memory goes back to the system."""
    pa.default_memory_pool().release_unused()
    if _TRIM:
        _TRIM(0)


def _frugal(rows: Callable) -> Callable:
    """A worker gives memory back when its task ends: Spark keeps the worker and needs the memory meanwhile."""

    @wraps(rows)
    def run(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from rows(self, batches)
        _give_back()

    return run


def _packed(data: bytes) -> bytes:
    return zstandard.ZstdCompressor().compress(data)


def _unpacked(column: pa.Array, row: int) -> bytes:
    return zstandard.ZstdDecompressor().decompress(column[row].as_buffer())


class _Blocks:
    """Rows of ``shard``, ``lang`` and ``text`` as blocks: the distinct words and their numbers in order.

    Number 0 stands between pieces, so a phrase is a run of other numbers. Words and
    numbers are compressed here, since Spark holds many blocks at once and tasks one.
    """

    def __init__(self, block_words: int):
        self.block_words = block_words

    @_frugal
    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_blocks: dict[tuple[int, str], tuple[_Numbers, array]] = {}
        held = 0
        for batch in batches:
            keys = zip(batch.column("shard").to_pylist(), batch.column("lang").to_pylist())
            for key, text in zip(keys, encoded(batch.column("text"))):
                for part in _stretches(text):
                    if key not in open_blocks:
                        open_blocks[key] = _Numbers({b"\n": 0}), array("i", [0])
                    numbers, codes = open_blocks[key]
                    before = len(codes)
                    words = part.translate(_SIMPLER).replace(b"\n", b" \n ").split(b" ")
                    codes.extend(map(numbers.__getitem__, filter(None, words)))
                    codes.append(0)
                    held += len(codes) - before
                    if len(codes) >= self.block_words:
                        held -= len(codes)
                        yield self._block(key, *open_blocks.pop(key))
                if held >= 2 * self.block_words:  # many languages: the largest block goes
                    key = max(open_blocks, key=lambda k: len(open_blocks[k][1]))
                    held -= len(open_blocks[key][1])
                    yield self._block(key, *open_blocks.pop(key))
        for key, block in open_blocks.items():
            yield self._block(key, *block)

    @staticmethod
    def _block(key: tuple[int, str], numbers: _Numbers, codes: array) -> pa.RecordBatch:
        numbered = np.array(codes, "<i4")
        data = numbered.tobytes()
        part = zlib.crc32(data) % NAMING_PARTS
        values = [[key[0]], [key[1]], [int(np.count_nonzero(numbered))], [part], [_packed(b" ".join(numbers))], [_packed(data)]]
        kinds = [pa.int32(), pa.string(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]
        names = ["shard", "lang", "n", "part", "words", "codes"]
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], names=names)


def _phrases(table: np.ndarray, step: int, lang: str, words: list[bytes], codes: bytes) -> Iterator[tuple]:
    """By length: the numbers of a block, where its phrases active at the step begin, by place their two hashes
    and the step from which on they are. The next length takes the place of these."""
    codes = np.frombuffer(codes, "<i4").astype(np.int64)
    seed = xxhash.xxh64_intdigest(lang.encode())
    words = np.frombuffer(b"".join([xxhash.xxh128_digest(w, seed) for w in words]), "<u8").reshape(-1, 2)
    words1, words2 = np.ascontiguousarray(words.T)
    mask = np.uint64(len(table) - 1)
    at = np.flatnonzero(codes)
    h1, h2 = words1[codes], words2[codes]
    starts = np.full(len(codes) + 1, NEVER, dtype=np.int16)
    starts[at] = 0
    yield codes, 1, at, h1, h2, starts
    # By place the step from which on the phrase there is both active and frequent.
    ready = np.full_like(starts, NEVER)
    ready[at] = table[words1 & mask][codes[at]]
    for length in range(2, MAX_WORDS + 1):
        at = at[codes[at + length - 1] != 0]
        # A phrase not active yet has no longer one that is.
        active = np.maximum(ready[at], ready[at + 1])
        at, active = at[active <= step], active[active <= step]
        last = codes[at + length - 1]
        h1[at] = _mixed(h1[at] * _M2 + words1[last])
        h2[at] = _mixed(h2[at] * _M3 + words2[last])
        del last
        starts[:] = NEVER
        starts[at] = active
        yield codes, length, at, h1, h2, starts
        if length < MAX_WORDS:
            ready[:] = NEVER
            ready[at] = np.maximum(active, table[h1[at] & mask])


def _content(batch: pa.RecordBatch, row: int) -> tuple[str, list[bytes], bytes]:
    """Language, words and numbers of a block."""
    words = _unpacked(batch.column("words"), row).split(b" ")
    return batch.column("lang")[row].as_py(), words, _unpacked(batch.column("codes"), row)


def _table(content) -> np.ndarray:
    return np.frombuffer(zlib.decompress(content.value), dtype=np.uint8)


class _Scan:
    """Counts the active phrases of the blocks of one shard."""

    def __init__(self, content, step: int, cycle: int):
        self.content, self.step, self.cycle = content, step, cycle

    @_frugal
    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _table(self.content)
        for batch in batches:
            for row in range(batch.num_rows):
                for numbers, length, at, h1, h2, starts in _phrases(table, self.step, *_content(batch, row)):
                    now = at[starts[at] + self.cycle > self.step]
                    if len(now):
                        places, n = _distinct(numbers, now, length, int(numbers.max()) + 1)
                        for i in range(0, len(places), BATCH_ROWS):
                            first = places[i : i + BATCH_ROWS]
                            kind = length * 256 + starts[first].astype(np.int32)
                            columns = [h1[first].view(np.int64), h2[first].view(np.int64), kind]
                            columns.append(n[i : i + BATCH_ROWS].astype(np.int64))
                            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["h1", "h2", "kind", "n"])


class _Names:
    """The words of the phrases whose bucket holds a frequent one."""

    def __init__(self, content, frequent, step: int):
        self.content, self.frequent, self.step = content, frequent, step

    @_frugal
    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, frequent = _table(self.content), _table(self.frequent)
        mask = np.uint64(len(table) - 1)
        for batch in batches:
            for row in range(batch.num_rows):
                lang, words, codes = _content(batch, row)
                for numbers, length, at, h1, h2, _ in _phrases(table, self.step, lang, words, codes):
                    at = at[frequent[h1[at] & mask] > 0]
                    if len(at):
                        places, _ = _distinct(numbers, at, length, len(words))
                        for i in range(0, len(places), BATCH_ROWS):
                            first = places[i : i + BATCH_ROWS]
                            runs = numbers[first[:, None] + np.arange(length)].tolist()
                            texts = pa.array([b" ".join([words[c] for c in run]) for run in runs], pa.string())
                            columns = [pa.array(h1[first].view(np.int64)), pa.array(h2[first].view(np.int64))]
                            columns += [pa.array([lang] * len(first), pa.string()), texts]
                            yield pa.RecordBatch.from_arrays(columns, names=["h1", "h2", "lang", "phrase"])


def _grouped(key: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray]:
    """The places of keys below ``room`` in the order of the keys, and where in this order a new key begins."""
    bits = len(key).bit_length()
    if room <= 1 << (62 - bits):  # plain numbers sort many times faster than places by their keys do
        key = key << bits
        key |= np.arange(len(key), dtype=np.int32)
        key.sort()
        order = key & ((1 << bits) - 1)
        key >>= bits
    else:
        order = np.argsort(key, kind="stable")
        key = key[order]
    return order, np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))


def _distinct(codes: np.ndarray, at: np.ndarray, length: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """One place and the number of places of every distinct phrase that begins at the places ``at``."""
    key = codes[at]
    room = size
    for i in range(1, length):
        if room * size > 1 << (62 - len(at).bit_length()):  # number what there is anew
            order, new = _grouped(key, room)
            ranks = np.zeros(len(at), np.int64)
            ranks[new[1:]] = 1
            key[order] = np.cumsum(ranks, out=ranks)
            room = len(new)
            del order, new, ranks
        key *= size
        key += codes[at + i]
        room *= size
    order, new = _grouped(key, room)
    return at[order[new]], np.diff(new, append=len(at))


def phrase_counts(docs: DataFrame, folder: str, threshold: int = 30, shards: int = 2, bucket_bits: int = 24) -> DataFrame:
    """``lang``, ``phrase``, ``n_words`` and ``n`` of words and phrases, those with at least ``threshold`` occurrences.

    A row of 0 words besides these, its phrase null, gives the number of all words
    of a language. Tables between the steps, and the result, lie in ``folder``.
    """
    if not 1 <= shards <= 60 or not 1 <= bucket_bits <= 31:
        raise ValueError("shards must lie in 1..60, bucket_bits in 1..31")
    spark = docs.sparkSession

    def written(name: str, df: DataFrame, *by: str) -> DataFrame:
        df.write.partitionBy(*by).option("compression", "zstd").parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    def sent(values: np.ndarray):
        return spark.sparkContext.broadcast(zlib.compress(values.tobytes(), 1))

    rows = docs.select(
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(shards)).cast("int").alias("shard"),
        F.coalesce("lang", F.lit(NO_LANGUAGE)).alias("lang"),
        "text",
    )
    blocks = written("blocks", rows.where("text <> ''").mapInArrow(_Blocks(BLOCK_WORDS), _BLOCKS), "shard")
    table = np.full(1 << bucket_bits, NEVER, dtype=np.uint8)
    frequent = np.zeros(1 << bucket_bits, dtype=np.uint8)
    open_counts, finished, last, step = None, [], 0, 0
    enough, n_words = f"n >= {threshold}", F.shiftright("kind", 8)
    while step < last + shards:
        content = sent(table)
        seen = blocks.where(F.col("shard") == step % shards).select("lang", "words", "codes")
        counted = seen.mapInArrow(_Scan(content, step, shards), _COUNTS).withColumn("now", F.col("n"))
        if open_counts is not None:
            counted = counted.unionByName(open_counts.withColumn("now", F.lit(0).cast("long")))
        sums = counted.groupBy("h1", "h2", "kind").agg(F.sum("n").alias("n"), F.sum("now").alias("now"))
        done = F.col("kind").bitwiseAND(F.lit(255)) + shards <= step + 1
        # What is counted over a full cycle and rare goes.
        sums = sums.withColumn("done", done.cast("int")).where(f"done = 0 OR {enough}")
        sums = written(f"counts{step}", sums, "done")
        finished.append(sums.where("done = 1"))
        open_counts = sums.where("done = 0").drop("now", "done")
        # At most two rows a bucket of the table come to the driver.
        crossed = sums.where(f"{enough} AND n - now < {threshold}")
        bucket = F.col("h1").bitwiseAND(F.lit((1 << bucket_bits) - 1)).alias("bucket")
        found = crossed.select(bucket, (n_words < MAX_WORDS).alias("shorter")).distinct().toArrow()
        buckets = found.column("bucket").to_numpy()
        frequent[buckets] = 1
        buckets = buckets[found.column("shorter").to_numpy(zero_copy_only=False)]
        buckets = buckets[table[buckets] == NEVER]
        step += 1
        if len(buckets):
            table[buckets] = step
            last = step
        content.destroy()  # the step is written
    counts = finished[0]
    for more in finished[1:]:
        counts = counts.unionByName(more)
    counts = written("frequent", counts.select("h1", "h2", n_words.alias("n_words"), "n"))

    def named(name: str, some: DataFrame, wanted: np.ndarray) -> DataFrame:
        content, marks = sent(table), sent(wanted)
        found = some.select("lang", "words", "codes").mapInArrow(_Names(content, marks, step), _NAMES)
        found = written(name, found.groupBy("h1", "h2", "lang", "phrase").agg(F.count("*").alias("n_blocks")))
        content.destroy()
        marks.destroy()
        return found

    # A frequent phrase stands in many blocks: a part of them names nearly all.
    names = named("names", blocks.where("part = 0"), frequent)
    lacking = counts.join(names, ["h1", "h2"], "left_anti").select(bucket).distinct().toArrow()
    frequent[:] = 0
    frequent[lacking.column("bucket").to_numpy()] = 1
    rest = named("more_names", blocks.where("part > 0"), frequent)
    names = names.unionByName(rest).select("h1", "h2", "lang", "phrase").distinct()
    found = counts.join(names, ["h1", "h2"]).select("lang", "phrase", "n_words", "n")
    totals = blocks.groupBy("lang").agg(F.sum("n").alias("n")).where("n > 0")
    totals = totals.select("lang", F.lit(None).cast("string").alias("phrase"), F.lit(0).alias("n_words"), "n")
    return written("phrases", found.unionByName(totals))


def collocations(
    docs: DataFrame,
    threshold: int = 30,
    per_lang: int = 2000,
    overlap: int = 80,
    shards: int = 2,
    bucket_bits: int = 24,
) -> DataFrame:
    """The best phrases of every language: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n`` and ``score``.

    A-Z count as lower case. ``a`` is how often a phrase of two to four words
    occurs within a piece of text, overlaps included; ``l`` and ``r`` the same of
    the two parts into which its weakest cut divides it, ``score`` is
    ``floor(2000000 * a / (l + r))`` there, the earliest of equally weak cuts, and
    ``n`` counts the words of the language. A phrase needs ``threshold``
    occurrences, and no longer such phrase that holds it may have ``overlap``
    percent of its occurrences or more. Ranks go by score, occurrences and then
    the phrase in the order of its UTF-8 bytes.

    Missing texts are empty, rows without a language are those of ``und``. Repeated
    rows count as often as they come, whatever their ids; other columns are not
    looked at. An empty table has no phrases. A text is held whole by its task.
    """
    with work_folder(docs.sparkSession) as folder:
        counts = phrase_counts(docs, folder, threshold, shards, bucket_bits)
        totals = counts.where("phrase IS NULL").select("lang", "n")
        counts = counts.where("phrase IS NOT NULL").select("lang", "phrase", "n_words", F.col("n").alias("a"))
        candidates = counts.where("n_words > 1")

        # The shorter phrases inside a longer one, by their place and length.
        words = F.split("phrase", " ", -1)
        inner = F.explode(
            F.expr(
                "flatten(transform(sequence(2, n_words - 1), len -> transform(sequence(1, n_words - len + 1), "
                "i -> array_join(slice(split(phrase, ' ', -1), i, len), ' '))))"
            )
        )
        longer = candidates.where("n_words > 2").select("lang", inner.alias("phrase"), "a")
        longer = longer.groupBy("lang", "phrase").agg(F.max("a").alias("most"))
        kept = candidates.join(longer, ["lang", "phrase"], "left")
        hundred, limit = F.lit(100).cast("decimal(10,0)"), F.lit(overlap).cast("decimal(10,0)")
        kept = kept.where(F.col("most").isNull() | (hundred * F.col("most") < limit * F.col("a"))).drop("most")

        cuts = kept.select("lang", "phrase", "n_words", "a", words.alias("words"), F.explode(F.expr("sequence(1, n_words - 1)")).alias("k"))
        cuts = cuts.select(
            "lang", "phrase", "a", "k",
            F.array_join(F.slice("words", F.lit(1), F.col("k")), " ").alias("left"),
            F.array_join(F.slice("words", F.col("k") + 1, F.col("n_words")), " ").alias("right"),
        )
        part = counts.select("lang", F.col("phrase").alias("left"), F.col("a").alias("l"))
        cuts = cuts.join(part, ["lang", "left"])
        part = counts.select("lang", F.col("phrase").alias("right"), F.col("a").alias("r"))
        cuts = cuts.join(part, ["lang", "right"])
        exact = "CAST(2000000 AS DECIMAL(7,0)) * CAST(a AS DECIMAL(19,0)) DIV (CAST(l AS DECIMAL(19,0)) + CAST(r AS DECIMAL(19,0)))"
        scored = cuts.withColumn("score", F.expr(exact).cast("long"))
        weakest = F.min(F.struct("score", "k", "l", "r")).alias("cut")
        scored = scored.groupBy("lang", "phrase", "a").agg(weakest).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")

        order = [F.desc("score"), F.desc("a"), "phrase"]
        part = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))
        in_part = F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))
        best = scored.withColumn("part", part).withColumn("rank", in_part).where(F.col("rank") <= per_lang)
        rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
        best = best.withColumn("rank", rank.cast("long")).where(F.col("rank") <= per_lang)
        return checkpointed(best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
