"""Documents packed into sequences of bounded length, in their order.

The documents of a partition are one stream of tokens. Windows cut it where a
document or a sentence ends, so that padding plus the charges for truncation are
smallest. With the cheapest way ``f`` to reach a place, a window from ``i`` to
``j`` costs

    f(j) = charge(j) + min over i of  f(i) + SEQUENCE_COST + padding(j - i)

Padding is ``width - (j - i)``, so the smallest ``f(i) + i`` among the places at
most ``width`` before ``j`` decides: a queue kept monotone gives it in constant
time. Windows whose length is a power of two are not padded; these few
transitions are looked up beside the queue.

Inside a sentence a stream is cut only where a sentence is longer than
``LONG_SENTENCE`` tokens and in the last window of a block, at a higher charge.
A block is about ``block_tokens`` of a stream, solved as a whole, and bounds what
a task holds besides its longest document. Nothing is shuffled.
"""

import hashlib
import json
import re
from array import array
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from loanscope.llm.common import texts

WIDTH = 2048
END_ID = 1
BLOCK_TOKENS = 1 << 20
#: Charges in tokens of padding: a sequence, a cut between the sentences of a document, one inside a sentence.
SEQUENCE_COST, SENTENCE_COST, INSIDE_COST = 16, 4, 48
#: Sentences longer than this may be cut inside, at every ``INSIDE_STEP``-th token.
LONG_SENTENCE, INSIDE_STEP = 128, 32
#: Characters of texts tokenised at a time.
STRETCH = 1 << 20
DOCUMENT, SENTENCE, INSIDE = 0, 1, 2
KINDS = ["document", "sentence", "inside"]
# --- Fixed values: marks that end a sentence, marks that may follow them, line ends ---
STOPS, CLOSERS, LINE_ENDS = ".!?。！？…", "\"')]}»”’", "\n\r"
# --- Fixed value: the words of a byte-level vocabulary ---
WORDS = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: What only the tokenizer's own library reads: characters that another release of Unicode may class anew, and long runs.
_ODD = re.compile(r"[^\t\n\r\x20-\x7EÀ-ÖØ-öø-ÿ]")
LONG_RUN = 200


def _is_plain(text: str) -> bool:
    if _ODD.search(text):
        return False
    lengths = [*map(len, text.split())]
    return max(lengths, default=0) < LONG_RUN and len(text) - sum(lengths) - len(lengths) < LONG_RUN


def _byte_pairs(rules: dict):
    """The same vocabulary for a quicker library, where it has that library's form: byte-level words, merges in id order."""
    model, words = rules["model"], rules.get("pre_tokenizer") or {}
    plain = words.get("type") == "ByteLevel" and not words.get("add_prefix_space") and words.get("use_regex", True)
    if model.get("type") != "BPE" or not plain or rules.get("normalizer") or model.get("dropout"):
        return None
    # Every byte stands as a character: printable ones as themselves, the others from 256 on.
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    byte_of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}
    vocabulary = model["vocab"]
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    ids = [vocabulary["".join(m)] for m in merges]
    if ids != sorted(set(ids)) or (ids and ids[0] < 256) or any(c not in vocabulary for c in byte_of):
        return None
    ranks = {bytes(byte_of[c] for c in t): vocabulary[t] for t in [*byte_of, *("".join(m) for m in merges)]}
    return tiktoken.Encoding("bytes", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})


class Vocabulary:
    """A tokenizer and, of each of its tokens, what it says about sentences."""

    def __init__(self, content: str):
        self.tokenizer = Tokenizer.from_str(content)
        self.tokenizer.encode_special_tokens = True  # their names in a text are ordinary text
        self.fast = _byte_pairs(json.loads(content))
        size = self.tokenizer.get_vocab_size()
        pieces = [self.tokenizer.decode([i], skip_special_tokens=False) for i in range(size)]
        self.stops = np.array([p.rstrip(CLOSERS)[-1:] in STOPS and p.rstrip(CLOSERS) != "" for p in pieces])
        self.line_ends = np.array([p[-1:] != "" and p[-1:] in LINE_ENDS for p in pieces])
        self.blanks = np.array([p[:1].isspace() and p[0] not in LINE_ENDS for p in pieces])

    def encode(self, stretch: list[str]) -> list[np.ndarray]:
        """The ids of each text, and the end id."""
        plain = [self.fast is not None and _is_plain(t) for t in stretch]
        slow = [t for t, p in zip(stretch, plain) if not p]
        rest = iter(self.tokenizer.encode_batch_fast(slow, add_special_tokens=False))
        out = []
        for text, is_plain in zip(stretch, plain):
            ids = array("I", self.fast.encode_ordinary(text) if is_plain else next(rest).ids)
            ids.append(END_ID)
            out.append(np.frombuffer(ids, dtype=np.uint32))
        return out

    def sentence_ends(self, ids: np.ndarray) -> np.ndarray:
        """Places after which a sentence ends, as numbers of tokens before them."""
        ends = self.line_ends[ids[:-1]] | (self.stops[ids[:-1]] & self.blanks[ids[1:]])
        return np.flatnonzero(ends) + 1


_loaded: dict[str, Vocabulary] = {}


def load(content: str) -> Vocabulary:
    """The vocabulary, kept by the worker."""
    digest = hashlib.sha256(content.encode()).hexdigest()
    if digest not in _loaded:
        _loaded.clear()
        _loaded[digest] = Vocabulary(content)
    return _loaded[digest]


def places(sentences: np.ndarray, documents: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Where a block may be cut, ascending from 0 to its end, and the kind of each place."""
    total = int(documents[-1])
    natural = np.union1d(np.append(sentences, 0), documents)
    long = np.flatnonzero(np.diff(natural) > min(LONG_SENTENCE, width))
    step = min(INSIDE_STEP, width)
    inside = [np.arange(natural[i] + step, natural[i + 1], step) for i in long.tolist()]
    inside.append(np.arange(max(0, total - width), total))
    at = np.union1d(natural, np.concatenate(inside))
    kinds = np.full(len(at), INSIDE, dtype=np.int8)
    kinds[np.searchsorted(at, natural)] = SENTENCE
    kinds[np.searchsorted(at, np.append(documents, 0))] = DOCUMENT
    return at, kinds


def best_cuts(at: np.ndarray, kinds: np.ndarray, width: int) -> tuple[list[int], int]:
    """Indices of the places at which windows end in the cheapest division, and its cost.

    Of equally cheap windows that end in a place the longest is taken, one without padding last.
    """
    charge = (np.array([0, SENTENCE_COST, INSIDE_COST])[kinds] + SEQUENCE_COST).tolist()
    starts, ends = [], []
    for power in (1 << k for k in range(width.bit_length())):
        if power < width:
            end = np.searchsorted(at, at + power)
            hit = np.flatnonzero(at[np.minimum(end, len(at) - 1)] == at + power)
            starts.append(hit)
            ends.append(end[hit])
    starts, ends = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (starts, ends))
    order = np.lexsort((starts, ends))
    exact = iter([*zip(ends[order].tolist(), starts[order].tolist()), (len(at), 0)])
    exact_end, exact_start = next(exact)

    place = at.tolist()
    cost, back = [0], [0]
    queue = deque([(0, 0)])  # cost plus place, index; ascending in both
    for j in range(1, len(place)):
        here = place[j]
        while here - place[queue[0][1]] > width:
            queue.popleft()
        least, start = queue[0]
        least += width - here
        while exact_end == j:
            if cost[exact_start] < least:
                least, start = cost[exact_start], exact_start
            exact_end, exact_start = next(exact)
        least += charge[j]
        cost.append(least)
        back.append(start)
        key = least + here
        while queue and queue[-1][0] > key:
            queue.pop()
        queue.append((key, j))
    cuts, j = [], len(place) - 1
    while j:
        cuts.append(j)
        j = back[j]
    return cuts[::-1], cost[-1]


class _Pack:
    def __init__(self, vocabulary, width: int, block_tokens: int):
        self.vocabulary, self.width, self.block_tokens = vocabulary, width, block_tokens

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = load(self.vocabulary.value)
        sequence = TaskContext.get().partitionId() << 32
        ids, rows, tokens = [], [], 0
        for batch in batches:
            column, first = batch.column("doc_id"), 0
            for encoded in self._encoded(vocabulary, batch.column("text")):
                for one in encoded:
                    ids.append(one)
                    rows.append((column, first))
                    first += 1
                    tokens += len(one)
                    if tokens >= self.block_tokens:
                        sequence, found = self._block(vocabulary, ids, rows, sequence)
                        yield from found
                        ids, rows, tokens = [], [], 0
        if ids:
            yield from self._block(vocabulary, ids, rows, sequence)[1]

    @staticmethod
    def _encoded(vocabulary: Vocabulary, column: pa.Array) -> Iterator[list[np.ndarray]]:
        chunk, size = [], 0
        for text in texts(column):
            chunk.append(text)
            size += len(text)
            if size >= STRETCH:
                yield vocabulary.encode(chunk)
                chunk, size = [], 0
        if chunk:
            yield vocabulary.encode(chunk)

    def _block(self, vocabulary, ids, rows, sequence):
        """The number of the next sequence and the pieces of a block in order."""
        lengths = np.array([len(one) for one in ids], dtype=np.int64)
        documents = np.cumsum(lengths)
        before = documents - lengths
        sentences = np.concatenate([vocabulary.sentence_ends(one) + b for one, b in zip(ids, before.tolist())])
        at, kinds = places(sentences, documents, self.width)
        cuts, _ = best_cuts(at, kinds, self.width)
        windows = at[cuts]
        ends = np.union1d(windows, documents)
        starts = np.append(0, ends[:-1])
        document = np.searchsorted(documents, ends)
        window = np.searchsorted(windows, ends)
        kind = np.full(len(ends), DOCUMENT)
        kind[np.searchsorted(ends, windows)] = kinds[cuts]
        doc_ids = pa.concat_arrays([column.slice(row, 1) for column, row in rows])
        columns = {
            "doc_id": doc_ids.take(pa.array(document)),
            "start": starts - before[document],
            "length": ends - starts,
            "doc_tokens": lengths[document],
            "sequence_id": sequence + window,
            "offset": starts - np.append(0, windows)[window],
        }
        arrays = [c if isinstance(c, pa.Array) else pa.array(c, pa.int64()) for c in columns.values()]
        arrays.append(pa.array([KINDS[k] for k in kind.tolist()], pa.string()))
        stream = np.concatenate(ids).astype("<u4")
        return sequence + len(windows), self._batches([*columns, "ends_at"], arrays, stream, starts, ends)

    def _batches(self, names, arrays, stream, starts, ends) -> Iterator[pa.RecordBatch]:
        """The pieces with their ids, those of about a block at a time."""
        groups = starts // max(self.block_tokens, self.width)
        first = 0
        while first < len(starts):
            end = int(np.searchsorted(groups, groups[first], "right"))
            place = np.append(starts[first:end], ends[end - 1]) - starts[first]
            data = stream[starts[first] : ends[end - 1]].tobytes()
            offsets = pa.py_buffer((4 * place).astype("<i4").tobytes())
            own = pa.BinaryArray.from_buffers(pa.binary(), end - first, [None, offsets, pa.py_buffer(data)])
            yield pa.RecordBatch.from_arrays([*(a.slice(first, end - first) for a in arrays), own], names=[*names, "ids"])
            first = end


PIECES = (
    "doc_id {}, start long, length long, doc_tokens long, sequence_id long, offset long, ends_at string, ids binary"
)


def pack(docs: DataFrame, tokenizer: str, width: int = WIDTH, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """The pieces of all documents in sequences of at most ``width`` tokens.

    A document is the ids of its whole text and the id 1 after them; a missing
    text counts as empty and is that id alone. A row per piece: ``doc_id``,
    ``start`` (ids of the document before it), ``length``, ``doc_tokens``,
    ``sequence_id``, ``offset`` (ids of the sequence before it), ``ends_at``
    (``document``, ``sentence`` or ``inside`` a sentence) and ``ids``, little-endian
    unsigned 32-bit integers. Sequences are padded to ``width`` unless their
    length is a power of two.

    Every partition of ``docs`` is a stream in its order, so documents that stand
    together stay together; give a table in files or sorted within partitions to
    fix that order. Sequence ids are the partition's number times 2**32 plus a
    number within it. Repeated rows and equal ids are packed one by one, other
    columns are not looked at, a missing id stays missing, an empty table has no
    pieces. A very long text is held as a whole by its task with its tokens.

    ``tokenizer`` is the content of the tokenizer's JSON file, a bounded vocabulary.
    """
    if width < 1:
        raise ValueError("width must be positive")
    content = docs.sparkSession.sparkContext.broadcast(tokenizer)
    schema = PIECES.format(docs.schema["doc_id"].dataType.simpleString())
    return docs.select("doc_id", "text").mapInArrow(_Pack(content, width, block_tokens), schema)
