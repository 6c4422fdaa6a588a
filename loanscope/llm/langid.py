"""Language of a text by prediction by partial matching over its bytes.

Each language has a tree of byte contexts of up to ``max_order`` bytes with the
counts of the byte that follows. A byte not seen after a context escapes to the
context one byte shorter, with the probability of method C, and takes its share
there among the bytes not seen after the longer one; below order 0 all bytes are
equal. A text costs each language a number of bits, and the language that
encodes it in the fewest wins.

The statistics are frozen after training, so the code length of every byte after
every context is known beforehand. Each language has a table of them for its own
contexts, of its own bounded size: other languages take no room from it. Scoring
finds the longest context of each byte by walking a language's tree for all bytes
of a batch together, and adds up table entries per text.
"""

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanscope.llm.common import SAMPLED, SLACK, held_out
from loanscope.sources.scratch import checkpointed

UNDETERMINED = "und"
LETTER = re.compile(r"[^\W\d_]")
#: Bytes scored at a time.
BATCH_BYTES = 1 << 20
#: Bound of a language's table of code lengths; its tree takes as much again.
LANGUAGE_BYTES = 24_000_000


class ContextTrees:
    """Code lengths in bits of each symbol after each context of each language.

    A language keeps its most frequent contexts, of those seen twice, as far as its equal part of
    ``table_bytes`` goes; without that bound, of ``LANGUAGE_BYTES``. ``left_out`` counts those that did not fit.
    """

    def __init__(self, samples: dict[str, list[str]], max_order: int = 4, table_bytes: int | None = None, most_bytes: int | None = None):
        self.languages, self.max_order = sorted(samples), max_order
        if not self.languages:
            return
        data = {name: [t.lower().encode() for t in texts] for name, texts in samples.items()}
        seen = sorted(set(b"".join(t for texts in data.values() for t in texts)))
        # Symbol of each byte; those never seen share the last one, which also stands between texts.
        self.n_symbols = len(seen) + 1
        self.symbol_of = np.full(256, self.n_symbols - 1, dtype=np.uint8 if self.n_symbols <= 256 else np.uint16)
        self.symbol_of[seen] = np.arange(len(seen))
        own_bytes = LANGUAGE_BYTES if table_bytes is None else table_bytes // len(self.languages)
        n_contexts = max(2, own_bytes // (4 * self.n_symbols))
        self.left_out: dict[str, int] = {}
        roots, children, bits = [0], [], []
        for name in self.languages:
            symbols, _ = self._joined(data[name])
            own_children, parent, levels, self.left_out[name] = self._grow(symbols, n_contexts)
            size = sum(c.nbytes for c in children) + sum(b.nbytes for b in bits) + 2 * own_children.nbytes
            if most_bytes is not None and size > most_bytes:
                raise ValueError(f"the trees take more than {most_bytes} bytes; take fewer languages or a smaller language_bytes")
            bits.append(self._measure(symbols, own_children, parent, levels))
            children.append(np.where(own_children > 0, own_children + np.int32(roots[-1]), 0).astype(np.int32))
            roots.append(roots[-1] + len(parent))
        self.roots, self.children, self.bits = roots[:-1], np.concatenate(children), np.concatenate(bits)

    def _joined(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of the texts, a separator before each, and where each text's separator is."""
        joined = np.frombuffer(b"\x00" + b"\x00".join(texts), dtype=np.uint8)
        starts = np.cumsum([0, *(len(t) + 1 for t in texts[:-1])])
        symbols = self.symbol_of[joined]
        symbols[starts] = self.n_symbols - 1
        return symbols, starts

    def _grow(self, s: np.ndarray, n_contexts: int) -> tuple[np.ndarray, np.ndarray, list[int], int]:
        """Chooses the most frequent contexts. A context's suffixes are at least as frequent, so they come along.

        Gives the children and the parent of each node, where each order's nodes start, and how many were left out.
        """
        base, separator = self.n_symbols, self.n_symbols - 1
        frequent = []
        for order in range(1, self.max_order + 1):
            # A context is a number whose lowest digit is the byte just before, plus one.
            windows = [s[order - 1 - d : len(s) - 1 - d].astype(np.int64) for d in range(order)]
            inside = np.all([w != separator for w in windows], axis=0) & (s[order:] != separator)
            codes = sum((w + 1) * (base + 1) ** d for d, w in enumerate(windows))[inside]
            for code, count in zip(*(x.tolist() for x in np.unique(codes, return_counts=True))):
                if count > 1:
                    frequent.append((-count, order, code))
        chosen = sorted(frequent)[: n_contexts - 1]
        node_of = {0: 0}
        children = np.zeros((len(chosen) + 1, base), dtype=np.int32)
        parents = np.zeros(len(chosen) + 1, dtype=np.int32)
        levels = [0, 1]
        for _, order, code in sorted(chosen, key=lambda c: (c[1], c[2])):
            if order == len(levels):
                levels.append(len(node_of))
            last, parent = divmod(code, (base + 1) ** (order - 1))
            node_of[code] = node = len(node_of)
            parents[node] = node_of[parent]
            children[node_of[parent], last - 1] = node
        return children, parents, [*levels, len(node_of)], len(frequent) - len(chosen)

    def _contexts(self, children: np.ndarray, root: int, symbols: np.ndarray) -> np.ndarray:
        """Of each symbol but the first ``max_order``, the node of the longest context before it."""
        n = len(symbols) - self.max_order
        here = np.full(n, root, dtype=np.int32)
        alive = np.ones(n, dtype=bool)
        for back in range(1, self.max_order + 1):
            below = children[here, symbols[self.max_order - back : self.max_order - back + n]]
            alive &= below > 0
            here = np.where(alive, below, here)
        return here

    def _measure(self, s: np.ndarray, children: np.ndarray, parent: np.ndarray, levels: list[int]) -> np.ndarray:
        base, separator = self.n_symbols, self.n_symbols - 1
        lead = np.full(self.max_order, separator, dtype=self.symbol_of.dtype)
        nodes = self._contexts(children, 0, np.concatenate([lead, s]))
        own = s != separator
        counts = np.bincount(nodes[own].astype(np.int64) * base + s[own], minlength=len(parent) * base)
        counts = counts.reshape(-1, base).astype(np.float64)
        orders = [slice(*ends) for ends in zip(levels[:-1], levels[1:]) if ends[0] < ends[1]]
        for nodes_of in orders[:0:-1]:  # a longer context counts for its shorter ones
            np.add.at(counts, parent[nodes_of], counts[nodes_of])
        bytes_of = np.ones(base)
        bytes_of[separator] = 256 - separator  # all bytes never seen share a place, each with the chance there
        chances = np.full_like(counts, 1 / 256)
        for nodes_of in orders:
            chances[nodes_of] = _escape(counts[nodes_of], chances[parent[nodes_of]], bytes_of)
        return -np.log2(chances).astype(np.float32)

    def code_lengths(self, texts: Iterator[str]) -> np.ndarray:
        """Bits that each text takes in each language."""
        out, waiting, size = [], [], 0
        for text in texts:
            data = text.lower().encode()
            if len(data) > BATCH_BYTES:
                out += [*self._batch(waiting), self._long(data)]
                waiting, size = [], 0
                continue
            waiting.append(data)
            size += len(data)
            if size > BATCH_BYTES:
                out += [*self._batch(waiting)]
                waiting, size = [], 0
        out += [*self._batch(waiting)]
        return np.array(out).reshape(-1, len(self.languages))

    def _batch(self, texts: list[bytes]) -> np.ndarray:
        if not texts:
            return np.empty((0, len(self.languages)))
        symbols, starts = self._joined(texts)
        lead = np.full(self.max_order, self.n_symbols - 1, dtype=symbols.dtype)
        behind, out = np.concatenate([lead, symbols]), np.empty((len(texts), len(self.languages)))
        for language, root in enumerate(self.roots):
            bits = self.bits[self._contexts(self.children, root, behind), symbols]
            bits[starts] = 0
            out[:, language] = np.add.reduceat(bits, starts, dtype=np.float64)
        return out

    def _long(self, data: bytes) -> np.ndarray:
        """A long text in stretches, each with the end of the one before as its context."""
        total = np.zeros(len(self.languages))
        before = np.full(self.max_order, self.n_symbols - 1, dtype=self.symbol_of.dtype)
        for start in range(0, len(data), BATCH_BYTES):
            own = self.symbol_of[np.frombuffer(data[start : start + BATCH_BYTES], dtype=np.uint8)]
            symbols = np.concatenate([before, own])
            for language, root in enumerate(self.roots):
                total[language] += self.bits[self._contexts(self.children, root, symbols), own].sum(dtype=np.float64)
            before = symbols[len(symbols) - self.max_order :]
        return total

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """Language and probability of each text, all languages being equally likely beforehand."""
        if not self.languages:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts))
        lengths = self.code_lengths(texts)
        best = lengths.argmin(axis=1)
        behind = np.minimum(lengths - lengths.min(axis=1, initial=np.inf, keepdims=True), 1000)
        scores = 1 / np.exp2(-behind).sum(axis=1)
        has_letter = np.array([LETTER.search(t) is not None for t in texts], dtype=bool)
        names = [self.languages[b] if has else UNDETERMINED for b, has in zip(best, has_letter)]
        return names, np.where(has_letter, scores, 0.0)


def _escape(counts: np.ndarray, shorter: np.ndarray, bytes_of: np.ndarray) -> np.ndarray:
    """Chances of every byte after some contexts, a row each, given those after the contexts one byte shorter."""
    seen = counts > 0
    distinct, total = seen.sum(axis=1, keepdims=True), counts.sum(axis=1, keepdims=True)
    left_over = np.where(seen, 0, shorter * bytes_of).sum(axis=1, keepdims=True)
    share = np.maximum(total + distinct, 1)
    chances = np.where(seen, counts / share, shorter * (distinct / share / np.maximum(left_over, 1e-300)))
    return np.where(distinct > 0, chances, shorter)


def train(
    docs: DataFrame,
    per_language: int = 400,
    max_bytes: int = 32_768,
    seed: int = 0,
    language_bytes: int = LANGUAGE_BYTES,
    max_languages: int = 1000,
    sample_bytes: int = 1 << 28,
    model_bytes: int = 1 << 29,
) -> ContextTrees:
    """Trees for the values of column ``lang``, from at most ``per_language`` texts of each.

    The texts with the smallest seeded hash of their id are taken, of those with 1
    to ``max_bytes`` bytes. Rows without a language or an id and those of the
    held-out fold are not learnt from; of rows that share id and language, the
    smallest text is. A language's table takes at most ``language_bytes``, however
    many languages there are. More than ``max_languages`` values of ``lang``, more
    than ``sample_bytes`` of text or a model over ``model_bytes`` raise a
    ``ValueError``: what comes to the driver and goes to the workers is bounded by
    these, whatever the column holds.
    """
    order = F.xxhash64(F.lit(seed), F.col("doc_id"))
    usable = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
    usable = usable.select("doc_id", "lang", "text", order.alias("place"))
    counts = usable.groupBy("lang").count().limit(max_languages + 1).collect()
    if len(counts) > max_languages:
        raise ValueError(f"column lang has more than {max_languages} values; are they languages?")
    short = usable.where(F.octet_length("text").between(1, max_bytes))
    wanted = SAMPLED * per_language + SLACK
    while True:
        # Few rows of a language lie below its limit, so the window below is small however large the language is.
        shares = [(r["lang"], min(1.0, wanted / r["count"])) for r in counts]
        limits = docs.sparkSession.createDataFrame(
            [(lang, int((share - 0.5) * ((1 << 64) - 4096)) if share < 1 else (1 << 63) - 1) for lang, share in shares],
            "lang string, most long",
        )
        # A row per language, max_languages at most.
        near = short.join(F.broadcast(limits), "lang").where(F.col("place") <= F.col("most"))
        near = checkpointed(near.groupBy("doc_id", "lang", "place").agg(F.min("text").alias("text")))
        found = {r["lang"]: r["count"] for r in near.groupBy("lang").count().collect()}
        if all(share == 1 or found.get(lang, 0) >= per_language for lang, share in shares):
            break
        wanted *= SAMPLED**2
    first = F.row_number().over(Window.partitionBy("lang").orderBy("place", "doc_id"))
    picked = near.withColumn("first", first).where(F.col("first") <= per_language).select("doc_id", "lang", "text")
    size = picked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if size > sample_bytes:
        raise ValueError(f"the texts to learn from take {size} bytes, more than {sample_bytes}; take fewer or shorter ones")
    samples: dict[str, list[str]] = {}
    for row in picked.orderBy("lang", "doc_id").collect():
        samples.setdefault(row["lang"], []).append(row["text"])
    return ContextTrees(samples, table_bytes=language_bytes * len(samples), most_bytes=model_bytes)


def identify(docs: DataFrame, model: ContextTrees) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred`` and ``score`` of every row.

    A missing or empty text and one without a letter are ``und`` with score 0.
    Repeated rows come out alike, an empty table gives none, columns besides id and
    text are not looked at. A very long text is scored in stretches, whole.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def identified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = [], []
            for first in range(0, batch.num_rows, 512):
                texts = [t or "" for t in batch.column("text").slice(first, 512).to_pylist()]
                some_names, some_scores = shared.value.predict(texts)
                names += some_names
                scores.append(some_scores)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("held_out"), pa.array(names, pa.string()),
                    pa.array(np.concatenate(scores) if scores else [], pa.float64()),
                ],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, held_out boolean, lang_pred string, score double"
    return docs.select("doc_id", held_out("doc_id").alias("held_out"), "text").mapInArrow(identified, schema)
