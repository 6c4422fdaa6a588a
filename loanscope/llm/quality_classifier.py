"""A quality score from how well a text compresses with dictionaries of good and of bad text.

Two zstandard dictionaries are built, from blocks of good and of bad labelled
texts; lines that occur in both say nothing and are left out. A text is
compressed in blocks of its own with either, of two sizes, so that the dictionaries
count for all of a long text as they do for a short one. The difference of the two
sizes, once over what both take and once over what the text takes uncompressed,
goes through a logistic curve fitted on labelled texts that are not in the
dictionaries, which makes it a probability. Nothing else of a text is looked at.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanscope.llm.common import encoded, held_out, kept_rows, labelled_sample

BLOCKS, DICTIONARY_BYTES, LEVEL = (2048, 512), 112_640, 3
#: Segment length and match length by which passages are picked for a dictionary.
SEGMENT, MATCH = 200, 8
#: Bytes of a compressed block that are not the text's, and a constant that keeps differences of short texts small.
FRAME_BYTES, SOFTENING = 13, 20
INPUTS = 2 * len(BLOCKS)
#: Weight that keeps the curve finite where the classes part cleanly.
RIDGE = 0.1


def blocks(text: bytes, size: int = BLOCKS[0]) -> list[bytes]:
    return [text[i : i + size] for i in range(0, len(text), size)] or [b""]


def build_dictionary(texts: list[bytes], common: set[bytes]) -> bytes:
    """A dictionary of texts of one class, without their ``common`` lines and repeated blocks."""
    own = (b"\n".join(line for line in t.split(b"\n") if line not in common) for t in texts)
    parts = list(dict.fromkeys(b for t in own for b in blocks(t) if b))
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, parts, k=SEGMENT, d=MATCH).as_bytes()
    except zstandard.ZstdError:  # too little text to choose from: all of it
        return b"".join(parts)[:DICTIONARY_BYTES]


class CompressionClassifier:
    """Two dictionaries and a fitted curve."""

    def __init__(self, good: bytes, bad: bytes):
        self.good, self.bad = good, bad
        self.mean, self.spread, self.weights = np.zeros(INPUTS), np.ones(INPUTS), np.zeros(INPUTS + 1)
        self._open()

    def _open(self) -> None:
        def compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
            data = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
            return zstandard.ZstdCompressor(level=LEVEL, dict_data=data)

        self.compressors = compressor(self.good), compressor(self.bad)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "compressors"}

    def __setstate__(self, state):
        self.__dict__ |= state
        self._open()

    def features(self, text: bytes) -> tuple[float, ...]:
        good, bad = self.compressors
        found: list[float] = []
        for size in BLOCKS:
            with_good = with_bad = 0
            for block in blocks(text, size):
                with_good += len(good.compress(block)) - FRAME_BYTES
                with_bad += len(bad.compress(block)) - FRAME_BYTES
            difference = with_bad - with_good
            found += [difference / (with_bad + with_good + SOFTENING), difference / (len(text) + SOFTENING)]
        return tuple(found)

    def fit(self, texts: list[bytes], labels: np.ndarray, rounds: int = 30) -> None:
        """Logistic regression by Newton steps; both classes weigh the same."""
        x = np.array([self.features(t) for t in texts])
        self.mean, self.spread = x.mean(axis=0), x.std(axis=0) + 1e-9
        x = np.column_stack([np.ones(len(x)), (x - self.mean) / self.spread])
        weight = np.where(labels == 1, 0.5 / labels.mean(), 0.5 / (1 - labels.mean()))
        ridge = np.diag([0.0, *[RIDGE] * INPUTS])
        self.weights = np.zeros(INPUTS + 1)
        for _ in range(rounds):
            p = _logistic(x @ self.weights)
            slope = x.T @ ((labels - p) * weight) - ridge @ self.weights
            curve = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge + 1e-9 * np.eye(INPUTS + 1)
            step = np.linalg.solve(curve, slope)
            self.weights = self.weights + step / max(1.0, np.abs(step).max() / 2)

    def scores(self, texts: Iterator[bytes]) -> np.ndarray:
        x = np.array([self.features(t) for t in texts]).reshape(-1, INPUTS)
        return _logistic(self.weights[0] + (x - self.mean) / self.spread @ self.weights[1:])


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def train(docs: DataFrame, labels: DataFrame, per_class: int = 1500, max_bytes: int = 32_768) -> CompressionClassifier:
    """A classifier for column ``quality`` of ``labels``, from at most ``per_class`` short texts of each class.

    The first half of the sample makes the dictionaries and the second the
    curve. Rows of the held-out fold are not used, nor texts over ``max_bytes``, of
    which a class has others enough. If a class has fewer than two
    texts there is nothing to learn, and every score is 0.5.
    """
    rows = labelled_sample(docs, labels, "quality", per_class, max_bytes).collect()
    texts = {label: [r["text"].encode() for r in rows if r["label"] == label] for label in (0, 1)}
    if min(map(len, texts.values())) < 2:
        return CompressionClassifier(b"", b"")
    learn = {label: t[: len(t) // 2] for label, t in texts.items()}
    lines = {label: {line for t in ts for line in t.split(b"\n")} for label, ts in learn.items()}
    common = lines[0] & lines[1]
    model = CompressionClassifier(build_dictionary(learn[1], common), build_dictionary(learn[0], common))
    rest = {label: t[len(t) // 2 :] for label, t in texts.items()}
    model.fit(rest[0] + rest[1], np.repeat([0.0, 1.0], [len(rest[0]), len(rest[1])]))
    return model


def score(docs: DataFrame, model: CompressionClassifier) -> DataFrame:
    """``doc_id``, ``held_out`` and ``score`` of every row; a missing text counts as empty.

    An empty text has the score of the curve at its features, as any other text, and
    repeated rows have equal scores; other columns are not looked at.
    """

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = pa.array(model.scores(encoded(batch.column("text"))), pa.float64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), scores], names=["doc_id", "held_out", "score"]
            )

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, held_out boolean, score double"
    return docs.select("doc_id", held_out("doc_id").alias("held_out"), "text").mapInArrow(scored, schema)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """Scores of ``docs`` from a classifier trained on them, with ``predicted`` 1 from ``threshold`` on."""
    scored = score(docs, train(docs, labels))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, model: CompressionClassifier, threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose score reaches ``threshold``; a missing text is scored as an empty one."""
    return kept_rows(docs, lambda texts: model.scores(encoded(texts)) >= threshold)
