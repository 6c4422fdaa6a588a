"""Quality rules: fixed limits on repetition and length, then boosted trees over document statistics.

The trees are fitted here by gradient boosting on a bounded labelled sample and
flattened into arrays of nodes, so that a batch of documents moves through all
trees together, one level at a time. Statistics that only ever speak against a
document are held to that: a higher value never raises its score.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanscope.llm.common import kept_rows, labelled_sample, word_blocks

# Fixed values of the base rules.
MIN_WORDS, MAX_REPEATED_PERCENT, WINDOW = 50, 50, 3
SYMBOLS = b"#*$%&|<>"
BLANKS = b"\x20\x09\x0a\x0b\x0c\x0d"

UPPER, LOWER, DIGITS = (bytes(range(a, b + 1)) for a, b in ((65, 90), (97, 122), (48, 57)))
STOPS, MARKS = b".,;:", b"!?"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: Statistics the trees see, and the direction in which each may move the score (0: either).
FEATURES = {
    "words": 0, "word_length": 0, "symbols_per_word": -1, "dup_line_share": -1, "repeat_share": -1,
    "distinct_share": 0, "upper_share": 0, "digit_share": -1, "stops_per_word": 0, "marks_per_word": -1,
    "words_per_line": 0,
}


def _count(text: bytes, characters: bytes) -> int:
    return len(text) - len(text.translate(None, characters))


def statistics(text: str) -> tuple[list[int], list[float]]:
    """The counts of the base rules and the statistics of the trees, of one whole text."""
    data = text.encode()
    numbers: dict[bytes, int] = {}
    parts = [
        np.fromiter([numbers.setdefault(w, len(numbers)) for w in words], np.int64, len(words))
        for words in word_blocks(data)
    ]
    words = np.concatenate(parts) if parts else np.empty(0, np.int64)
    lines = [line for line in data.split(b"\n") if line.strip()]
    n_dup_lines = len(lines) - len(set(lines))
    n_words, n_repeat = len(words), _repeated(words, len(numbers))
    word_chars, n_symbols = len(text) - _count(data, BLANKS), _count(data, SYMBOLS)
    upper, lower = _count(data, UPPER), _count(data, LOWER)
    some = max(1, n_words)
    return [n_words, word_chars, n_symbols, n_dup_lines, n_repeat], [
        n_words, word_chars / some, n_symbols / some, n_dup_lines / max(1, len(lines)), n_repeat / some,
        len(numbers) / some, upper / max(1, upper + lower), _count(data, DIGITS) / max(1, word_chars),
        _count(data, STOPS) / some, _count(data, MARKS) / some, n_words / max(1, len(lines)),
    ]


def _repeated(words: np.ndarray, n_distinct: int) -> int:
    """Words inside windows that occur twice or more, their first occurrences included."""
    if len(words) <= WINDOW:
        return 0
    n = len(words) - WINDOW + 1
    keys, size = words[:n], n_distinct
    for i in range(1, WINDOW):
        if size >= 2**62 // max(1, n_distinct):  # renumber before the product leaves 64 bits
            distinct, keys = np.unique(keys, return_inverse=True)
            size = len(distinct)
        keys, size = keys * n_distinct + words[i : n + i], size * n_distinct
    order = np.argsort(keys, kind="stable")
    same = np.flatnonzero(keys[order[1:]] == keys[order[:-1]])
    if not len(same):
        return 0
    again = np.zeros(len(words), dtype=bool)
    starts = np.union1d(order[same], order[same + 1])
    for i in range(WINDOW):
        again[starts + i] = True
    return int(again.sum())


def base_failed(counts: np.ndarray) -> np.ndarray:
    n_words, n_repeat = counts[:, 0], counts[:, 4]
    return (n_words < MIN_WORDS) | (100 * n_repeat > MAX_REPEATED_PERCENT * n_words)


class BoostedTrees:
    """Trees as arrays: of node i its feature, threshold, children and value; a leaf is its own child."""

    def __init__(self, depth: int = 3, n_trees: int = 60, rate: float = 0.2, n_bins: int = 64, ridge: float = 1.0):
        self.depth, self.n_trees, self.rate, self.n_bins, self.ridge = depth, n_trees, rate, n_bins, ridge
        self.feature, self.threshold, self.left, self.right, self.value = ([] for _ in range(5))
        self.roots: list[int] = []
        self.start = 0.0

    def _node(self, value: float) -> int:
        i = len(self.value)
        for column, x in zip((self.feature, self.threshold, self.left, self.right, self.value), (0, np.inf, i, i, value)):
            column.append(x)
        return i

    def fit(self, x: np.ndarray, y: np.ndarray, direction: np.ndarray) -> "BoostedTrees":
        """Logistic loss, both classes weighing the same. ``direction`` is -1, 0 or 1 per feature."""
        weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
        quantiles = np.linspace(0, 1, self.n_bins + 1)[1:-1]
        cuts = [np.unique(np.quantile(column, quantiles, method="higher")) for column in x.T]
        bins = np.column_stack([np.searchsorted(c, column, side="left") for c, column in zip(cuts, x.T)])
        total = np.zeros(len(y))
        for _ in range(self.n_trees):
            p = 1 / (1 + np.exp(-total))
            slope, curve = (y - p) * weight, p * (1 - p) * weight
            root = self._node(0.0)
            self.roots.append(root)
            self._grow(root, np.arange(len(y)), bins, cuts, slope, curve, direction, -np.inf, np.inf, 0, total)
        columns = ("feature", "threshold", "left", "right", "value", "roots")
        for name, kind in zip(columns, (np.int32, np.float64, np.int32, np.int32, np.float64, np.int32)):
            setattr(self, name, np.array(getattr(self, name), dtype=kind))
        return self

    def _grow(self, node, rows, bins, cuts, slope, curve, direction, low, high, depth, total) -> None:
        """Splits a node as far as that helps. Values stay within ``low`` and ``high``."""

        def best_value(g, h):
            return np.clip(g / (h + self.ridge), low, high)

        def gain(g, h, v):
            return g * v - 0.5 * (h + self.ridge) * v * v

        g, h = slope[rows].sum(), curve[rows].sum()
        value = float(best_value(g, h))
        self.value[node] = self.rate * value
        best = (1e-6, None)
        for j in range(bins.shape[1] if depth < self.depth else 0):
            if not len(cuts[j]):
                continue
            gs = np.bincount(bins[rows, j], slope[rows], len(cuts[j]) + 1).cumsum()[:-1]
            hs = np.bincount(bins[rows, j], curve[rows], len(cuts[j]) + 1).cumsum()[:-1]
            left, right = best_value(gs, hs), best_value(g - gs, h - hs)
            gains = gain(gs, hs, left) + gain(g - gs, h - hs, right) - gain(g, h, value)
            gains[(hs < 0.01) | (h - hs < 0.01) | (direction[j] * (right - left) < 0)] = 0
            cut = int(gains.argmax())
            if gains[cut] > best[0]:
                best = (gains[cut], (j, cut, left[cut], right[cut]))
        if best[1] is None:
            total[rows] += self.rate * value
            return
        j, cut, left, right = best[1]
        middle = (left + right) / 2
        # Below a split on a directed feature neither side may cross the middle.
        bounds = {-1: ((middle, high), (low, middle)), 0: ((low, high),) * 2, 1: ((low, middle), (middle, high))}[int(direction[j])]
        self.feature[node], self.threshold[node] = j, cuts[j][cut]
        goes_left = bins[rows, j] <= cut
        self.left[node], self.right[node] = self._node(0.0), self._node(0.0)
        for child, side, bound in zip((self.left[node], self.right[node]), (goes_left, ~goes_left), bounds):
            self._grow(child, rows[side], bins, cuts, slope, curve, direction, *bound, depth + 1, total)

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 of every row."""
        if not len(self.roots):
            return np.full(len(x), 0.5)
        at = np.broadcast_to(self.roots, (len(x), len(self.roots)))
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            at = np.where(x[rows, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
        return 1 / (1 + np.exp(-self.value[at].sum(axis=1)))


def _measured(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    both = [statistics(t.as_py() or "") for t in column]
    counts = np.array([b[0] for b in both], dtype=np.int64).reshape(-1, len(COUNTS))
    return counts, np.array([b[1] for b in both], dtype=np.float64).reshape(-1, len(FEATURES))


def train(docs: DataFrame, labels: DataFrame, per_class: int = 2000, max_bytes: int = 65_536) -> BoostedTrees:
    """Trees for column ``quality`` of ``labels``, from at most ``per_class`` texts of each class.

    The statistics are computed on the executors; the driver gets a few thousand
    rows of numbers. Without texts of both classes there are no trees, every
    score is 0.5, and the base rules alone decide.
    """

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = pa.array(list(_measured(batch.column("text"))[1]), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("label"), values], names=["label", "x"])

    sample = labelled_sample(docs, labels, "quality", per_class, max_bytes)
    rows = sample.select(F.col("label").cast("int").alias("label"), "text").mapInArrow(measured, "label int, x array<double>").collect()
    y = np.array([r["label"] for r in rows], dtype=np.float64)
    if len(set(y)) < 2:
        return BoostedTrees()
    return BoostedTrees().fit(np.array([r["x"] for r in rows]), y, np.array(list(FEATURES.values())))


def _verdicts(model: BoostedTrees, column: pa.Array, threshold: float):
    counts, x = _measured(column)
    failed = base_failed(counts)
    return counts, failed, ~failed & (model.scores(x) >= threshold)


def apply_rules(docs: DataFrame, model: BoostedTrees, threshold: float = 0.5) -> DataFrame:
    """``doc_id``, the five counts, ``base_failed`` and ``kept`` of every row.

    A missing or empty text has no words and fails the base rules. Repeated rows come out alike, a missing id stays
    missing, an empty table gives none, other columns are not looked at. Texts of any length are counted whole.
    """

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, failed, kept = _verdicts(model, batch.column("text"), threshold)
            columns = [batch.column("doc_id"), *(pa.array(c) for c in counts.T), pa.array(failed), pa.array(kept)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *COUNTS, "base_failed", "kept"])

    counts = ", ".join(f"{c} long" for c in COUNTS)
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {counts}, base_failed boolean, kept boolean"
    return docs.select("doc_id", "text").mapInArrow(judged, schema)


def keep_passing(docs: DataFrame, model: BoostedTrees, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs``, with all their columns, that pass the base rules and the trees; a missing text does not."""
    return kept_rows(docs, lambda column: _verdicts(model, column, threshold)[2])
