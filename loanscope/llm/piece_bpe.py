"""Encoding and decoding with a SentencePiece BPE vocabulary, through a table of prefixes.

Merging always leaves one last token for a prefix of the text, whatever follows.
That token is the longest vocabulary match ending there that is compatible with
the last token of the prefix before it: merging just the two together gives the
two back. An automaton finds the matches, compatibility of a pair is merged
once and remembered, and the ids come out by walking the table backwards. The
work is linear in the text, with no queue of merges.

No piece continues over the start of a run of spaces, nor over a character that
is in no longer piece, so a text falls apart at such places into chunks that are
encoded on their own, and frequent chunks only once per worker.
"""

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
#: Chunks a worker remembers, the longest of them, and the characters split at a time.
REMEMBERED, REMEMBERED_LENGTH, STRETCH = 200_000, 48, 1 << 20
#: Pairs a worker remembers.
REMEMBERED_PAIRS = 200_000

SCHEMA = "doc_id {0}, n_tokens long, ids_sha256 string, decoded_sha256 string"


class PieceBpe:
    """A BPE vocabulary with byte fallback. Spaces stand for the piece separator throughout."""

    def __init__(self, model: bytes):
        vocabulary = sentencepiece.SentencePieceProcessor(model_proto=model)
        self._check(vocabulary)
        self.bos, self.eos = vocabulary.bos_id(), vocabulary.eos_id()
        self.bytes_of: list[bytes] = []
        self.byte_ids = [0] * 256
        self.ids: dict[str, int] = {}
        self.scores: dict[str, float] = {}
        for i in range(vocabulary.vocab_size()):
            piece = vocabulary.id_to_piece(i)
            text = b""
            if vocabulary.is_byte(i):
                value = int(piece[1:-1], 16)
                self.byte_ids[value], text = i, bytes([value])
            elif vocabulary.is_unknown(i):
                text = " ⁇ ".encode()
            elif not vocabulary.is_control(i):
                surface = piece.replace(SPACE, " ")
                self.ids[surface], self.scores[surface] = i, vocabulary.get_score(i)
                text = surface.encode()
            self.bytes_of.append(text)
        # Every character that occurs in a piece has a number, whether or not it is a piece.
        self.surfaces = dict(enumerate(sorted({c for p in self.ids for c in p} | set(self.ids))))
        self.numbers = {surface: n for n, surface in self.surfaces.items()}
        self.packed = {n: self._pack(surface) for n, surface in self.surfaces.items()}
        self.matches = ahocorasick.Automaton()
        # Of each longer piece that merging ends in: its score and the two parts merged last.
        self.parts: dict[str, tuple[float, str, str]] = {}
        for n, surface in self.surfaces.items():
            if len(surface) > 1 and len(merged := self.merge(surface, stop=2)) == 2:
                self.parts[surface] = (self.scores[surface], *merged)
                self.matches.add_word(surface, (len(surface), n))
        self.matches.make_automaton()
        self.pairs: dict[tuple[int, int], bool] = {}
        self.chunks: dict[str, bytes] = {}
        longer = [p for p in self.ids if len(p) > 1]
        spaces_lead = not any(re.search("[^ ] ", p) for p in longer)
        alone = "" if any("\n" in p for p in longer) else "\n"
        # A chunk: spaces and what follows them, up to the next space or line end.
        self.split = re.compile(f" *[^ {alone}]+| +|\n") if spaces_lead else re.compile("(?s).+")
        self.cut = re.compile("(?<=[^ ]) |(?<=\n)" if alone else "(?<=[^ ]) ") if spaces_lead else None

    @staticmethod
    def _check(vocabulary) -> None:
        probe = "  ﬁ a\n é "
        if vocabulary.normalize(probe) != (SPACE + probe).replace(" ", SPACE):
            raise ValueError("only models that leave the text as it is and put a space in front are supported")

    def merge(self, text: str, stop: int = 1) -> list[str]:
        """Plain merging of a short text: the best-scored adjacent pair first, the leftmost of equals.

        Goes on until no pair is a piece or ``stop`` symbols are left; with two
        left that together are no piece, to the end.
        """
        symbols = list(text)
        while len(symbols) > 1:
            best, at = None, -1
            for i in range(len(symbols) - 1):
                score = self.scores.get(symbols[i] + symbols[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                return symbols if stop == 1 else []
            if len(symbols) == stop:
                break
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
        return symbols

    def _pack(self, token: str) -> bytes:
        """Ids of a token as bytes: one if it is a piece, else those of its UTF-8 bytes."""
        known = self.ids.get(token)
        ids = [self.byte_ids[b] for b in token.encode()] if known is None else [known]
        return np.array(ids, dtype="<u4").tobytes()

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging the two tokens' text gives the two tokens."""
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) >= REMEMBERED_PAIRS:
                self.pairs.clear()
            known = self.pairs[left, right] = self._stay_apart(self.surfaces[left], self.surfaces[right])
        return known

    def _stay_apart(self, left: str, right: str) -> bool:
        """Undoes the merges inside two tokens, the latest first, looking for an earlier one across the border.

        Parts that meet at the border would have been merged if that ranks
        before the merge just undone, which is by score and then from the left.
        """
        parts, limit, wins_ties = self.parts, float("-inf"), True
        while True:
            across = self.scores.get(left + right)
            if across is not None and (across > limit or (wins_ties and across == limit)):
                return False
            in_left, in_right = parts.get(left), parts.get(right)
            if in_left is None and in_right is None:
                return True
            if in_right is None or (in_left is not None and in_left[0] < in_right[0]):
                limit, _, left = in_left
                wins_ties = False
            else:
                limit, right, _ = in_right
                wins_ties = True

    def encode_chunk(self, chunk: str) -> bytes:
        """Ids of a text without the space in front, packed."""
        # Of the prefix of each length, the last token and its length; at first, the last character.
        # A character that is in no piece has no number and goes with every neighbour.
        last = [None, *map(self.numbers.get, chunk)]
        length_of = [1] * len(last)
        pairs, decided = self.pairs, -1
        for end, (length, token) in self.matches.iter(chunk):  # of one end, the longest match first
            if end == decided:
                continue
            left = last[end + 1 - length]
            if left is not None:
                known = pairs.get((left, token))
                if not (self.compatible(left, token) if known is None else known):
                    continue
            last[end + 1], length_of[end + 1], decided = token, length, end
        out = []
        end = len(chunk)
        while end:
            token = last[end]
            out.append(self._pack(chunk[end - 1]) if token is None else self.packed[token])
            end -= length_of[end]
        out.reverse()
        return b"".join(out)

    def _packed(self, chunk: str) -> bytes:
        packed = self.chunks.get(chunk)
        if packed is None:
            packed = self.encode_chunk(chunk)
            if len(chunk) <= REMEMBERED_LENGTH:
                if len(self.chunks) >= REMEMBERED:
                    self.chunks.clear()
                self.chunks[chunk] = packed
        return packed

    def _stretches(self, text: str) -> Iterator[str]:
        """The text in pieces of about STRETCH characters, cut between chunks."""
        start = 0
        while self.cut is not None and len(text) - start > STRETCH:
            found = self.cut.search(text, start + STRETCH)
            if found is None:
                break
            yield text[start : found.start()]
            start = found.start()
        yield text[start:]

    def encode(self, text: str) -> Iterator[np.ndarray]:
        """Ids of the whole text in order, with begin and end ids, an array per stretch."""
        yield np.array([self.bos], dtype="<u4")
        if text:
            packed = self._packed
            for stretch in self._stretches(" " + text.replace(SPACE, " ")):
                yield np.frombuffer(b"".join([packed(c) for c in self.split.findall(stretch)]), dtype="<u4")
        yield np.array([self.eos], dtype="<u4")

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        """UTF-8 of the ids, with the space that encoding puts in front still there."""
        pieces = self.bytes_of
        return b"".join([pieces[i] for i in ids.tolist()])

    def decode(self, ids: np.ndarray) -> str:
        return self.decode_bytes(ids).removeprefix(b" ").decode("utf-8", "replace")


_loaded: dict[bytes, PieceBpe] = {}


def load(model: bytes) -> PieceBpe:
    """The vocabulary, kept by the worker with what it remembers."""
    digest = hashlib.sha256(model).digest()
    if digest not in _loaded:
        _loaded.clear()
        _loaded[digest] = PieceBpe(model)
    return _loaded[digest]


def _digests(bpe: PieceBpe, text: str) -> tuple[int, str, str]:
    n_tokens, ids_hash, text_hash, at_start = 0, hashlib.sha256(), hashlib.sha256(), True
    for ids in bpe.encode(text):
        n_tokens += len(ids)
        ids_hash.update(ids.tobytes())
        decoded = bpe.decode_bytes(ids)
        if at_start and decoded:
            decoded, at_start = decoded.removeprefix(b" "), False
        text_hash.update(decoded)
    return n_tokens, ids_hash.hexdigest(), text_hash.hexdigest()


def token_digests(docs: DataFrame, model: bytes) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` of every row.

    Ids are hashed as little-endian unsigned 32-bit integers, begin and end ids
    included; the decoded text is hashed in UTF-8. A missing text counts as the
    empty one, which has the begin and end ids only. Repeated rows stay repeated.
    ``model`` is the content of the model file, a bounded vocabulary.
    """
    model_bytes = docs.sparkSession.sparkContext.broadcast(model)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(model_bytes.value)
        for batch in batches:
            rows = [_digests(bpe, t.as_py() or "") for t in batch.column("text")]
            n_tokens, ids_hash, text_hash = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array(n_tokens, pa.int64()),
                    pa.array(ids_hash, pa.string()), pa.array(text_hash, pa.string()),
                ],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    schema = SCHEMA.format(docs.schema["doc_id"].dataType.simpleString())
    return docs.select("doc_id", "text").mapInArrow(digest, schema)


def token_ids(docs: DataFrame, model: bytes) -> DataFrame:
    """``doc_id`` and the ``ids`` of every row, for writing training files."""
    model_bytes = docs.sparkSession.sparkContext.broadcast(model)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(model_bytes.value)
        for batch in batches:
            for row, text in enumerate(batch.column("text")):
                ids = np.concatenate(list(bpe.encode(text.as_py() or ""))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(row, 1), pa.array([ids], pa.list_(pa.int32()))], names=["doc_id", "ids"]
                )

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids array<int>"
    return docs.select("doc_id", F.col("text")).mapInArrow(encode, schema)
