"""SentencePiece encoding and decoding: an Aho-Corasick automaton over the pieces drives a single-pass Viterbi.

The automaton reads a text once and names, at each position, all pieces that end
there (the state's own piece and those along its output links). Each of them relaxes
the best score of its end from the best score of its start, which is final by then.
A character that no piece covers costs the unknown penalty and becomes byte pieces.

Pieces never go from another character on to a word mark, which is checked when a
model is loaded, nor from a letter on to most other characters, which is looked up
then; so no segmentation crosses such a place, and the runs between them are solved
one by one. A worker remembers the runs that it has solved, up to a bound.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomtrace.llm.batches import kept, map_batches, slices

MARK = "▁"
#: An unknown character scores this much less than the worst piece.
UNKNOWN_PENALTY = 10.0
#: Runs that a worker remembers, and characters of a run that is remembered at most.
REMEMBERED, REMEMBERED_CHARS = 200_000, 64

#: Model file that queries use where no other is named.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def load_model(path: str, spark: SparkSession | None = None) -> bytes:
    """The bytes of a model file; with a session from any store that Spark reads."""
    if spark is None or "://" not in path:
        with open(path, "rb") as file:
            return file.read()
    return bytes(spark.read.format("binaryFile").load(path).select("content").first().content)


class Codec:
    """Encoder and decoder of one model, made from the bytes of its file.

    Segmentations maximise the sum of the pieces' scores, as unigram models define
    it; where two are equal the one whose last piece starts first wins. A word mark
    stands for a space and one is put before the text; a literal word mark in a text
    becomes byte pieces, so that every text comes back unchanged.
    """

    def __init__(self, model: bytes):
        from sentencepiece import SentencePieceProcessor

        processor = SentencePieceProcessor(model_proto=model)
        size = processor.get_piece_size()
        self.pieces = [processor.id_to_piece(i) for i in range(size)]
        self.bytes = {int(self.pieces[i][1:-1], 16): i for i in range(size) if processor.is_byte(i)}
        if len(self.bytes) != 256:
            raise ValueError("the model has no byte pieces: it cannot give every text back")
        self.automaton = ahocorasick.Automaton()
        scores = []
        for i, piece in enumerate(self.pieces):
            if not (processor.is_byte(i) or processor.is_control(i) or processor.is_unknown(i) or processor.is_unused(i)):
                if re.search(f"[^{MARK}]{MARK}", piece):
                    raise ValueError(f"piece {i} goes on over a word mark")
                scores.append(processor.get_score(i))
                self.automaton.add_word(piece, (len(piece), processor.get_score(i), i))
        self.automaton.make_automaton()
        self.unknown = min(scores) - UNKNOWN_PENALTY
        of_byte = {i: bytes([b]) for b, i in self.bytes.items()}
        self.raw = [of_byte.get(i) or p.replace(MARK, " ").encode() for i, p in enumerate(self.pieces)]
        self.single = {p for p in self.automaton if len(p) == 1}
        self.solved = _Solved(self)
        # A run ends before a word mark, and where a letter or digit meets another
        # character unless some piece goes on there.
        goes_on = {b for p in self.automaton for a, b in itertools.pairwise(p) if re.match(r"\w", a) and not re.match(r"\w", b)} - {MARK}
        inner = r"[\w" + "".join(map(re.escape, sorted(goes_on))) + "]*"
        self.runs = re.compile(rf"(?:{MARK}+|[^{MARK}]){inner}(?:(?<!\w)[^\w{MARK}]{inner})*")

    def segment(self, run: str) -> list[int]:
        """The ids of the best segmentation of ``run``, in which word marks stand for spaces."""
        n = len(run)
        worst = float("-inf")
        best, start_of, piece_of = [0.0] + [worst] * n, [0] * (n + 1), [-1] * (n + 1)
        if self.single.issuperset(run):  # then no unknown character is ever better
            for last, (length, score, i) in self.automaton.iter(run):
                score += best[last + 1 - length]
                if score > best[last + 1]:
                    best[last + 1], start_of[last + 1], piece_of[last + 1] = score, last + 1 - length, i
        else:
            at = 0  # the scores of positions up to here are final
            for last, (length, score, i) in itertools.chain(self.automaton.iter(run), [(n, (0, worst, -1))]):
                while at < last:
                    at += 1
                    if best[at - 1] + self.unknown > best[at]:
                        best[at], start_of[at], piece_of[at] = best[at - 1] + self.unknown, at - 1, -1
                if length and score + best[last + 1 - length] > best[last + 1]:
                    best[last + 1], start_of[last + 1], piece_of[last + 1] = score + best[last + 1 - length], last + 1 - length, i
        ids: list[int] = []
        end = n
        while end:
            if piece_of[end] >= 0:
                ids.append(piece_of[end])
            else:
                ids += [self.bytes[b] for b in reversed(self._literal(run[start_of[end] : end]))]
            end = start_of[end]
        ids.reverse()
        return ids

    @staticmethod
    def _literal(char: str) -> bytes:
        return (MARK if char == _HIDDEN else char).encode("utf-8", "surrogatepass")

    def pack(self, text: str) -> bytes:
        """Ids of ``text`` as 32-bit integers; an empty text has none."""
        if not text:
            return b""
        parts = []
        for part in text.split(_HIDDEN):  # the stand-in itself becomes bytes
            marked = part.replace(MARK, _HIDDEN).replace(" ", MARK)
            if parts:
                parts.append(array("i", [self.bytes[b] for b in _HIDDEN.encode()]).tobytes())
            else:
                marked = MARK + marked
            parts.append(b"".join(map(self.solved.__getitem__, self.runs.findall(marked))))
        return b"".join(parts)

    def encode(self, text: str) -> list[int]:
        """Ids of ``text``."""
        return array("i", self.pack(text)).tolist()

    def decode(self, ids: list[int]) -> str:
        """The text of ``ids``; byte pieces that aren't UTF-8 become U+FFFD."""
        raw = self.raw
        joined = b"".join(map(raw.__getitem__, ids))
        return (joined[1:] if joined[:1] == b" " else joined).decode("utf-8", "replace")


class _Solved(dict):
    """Packed ids of runs; the oldest half goes when it grows over its bound."""

    def __init__(self, owner: Codec):
        super().__init__()
        self.owner, self.older = owner, {}

    def __missing__(self, run: str) -> bytes:
        packed = self.older.get(run)
        if packed is None:
            packed = array("i", self.owner.segment(run)).tobytes()
        if len(run) <= REMEMBERED_CHARS:
            if len(self) >= REMEMBERED // 2:
                self.older = dict(self)
                self.clear()
            self[run] = packed
        return packed


#: Stands for a literal word mark while a text is encoded; no piece has this noncharacter.
_HIDDEN = "\U0010fffe"


@kept
def codec(model: bytes) -> Codec:
    return Codec(model)


def _flat(parts: list[bytes]) -> pa.ListArray:
    offsets = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(p) // 4 for p in parts], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(parts), np.int32)))


def encode(docs: DataFrame, model: bytes, text: str = "text", into: str = "pieces") -> DataFrame:
    """``docs`` with the array of piece ids of its column ``text`` in a new last column ``into``.

    A null text gives null, an empty one an empty array. Other columns pass through;
    ``into`` must not be one of them. The model, of a bounded size, travels with the tasks.
    """
    if into in docs.columns:
        raise ValueError(f"there is a column {into} already")

    def scan(batches: Iterator[pa.RecordBatch]):
        own = codec(model)
        for batch, _, _ in slices(batches, text):
            column = batch.column(batch.schema.get_field_index(text))
            parts = _flat([own.pack(t or "") for t in column.to_pylist()])
            if column.null_count:
                parts = pa.array([None if gone else p for gone, p in zip(column.is_null().to_pylist(), parts.to_pylist(), strict=True)], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, parts], names=[*batch.schema.names, into])

    return map_batches(docs, scan, _with(docs, into, "array<int>"), ("codec",))


def decode(frame: DataFrame, model: bytes, pieces: str = "pieces", into: str = "decoded") -> DataFrame:
    """``frame`` with the text of its array of ids ``pieces`` in a new last column ``into``; null gives null."""
    if into in frame.columns:
        raise ValueError(f"there is a column {into} already")

    def scan(batches: Iterator[pa.RecordBatch]):
        own = codec(model)
        for batch in batches:
            texts = [None if ids is None else own.decode(ids) for ids in batch.column(batch.schema.get_field_index(pieces)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, into])

    return map_batches(frame, scan, _with(frame, into, "string"), ("codec",))


def _with(frame: DataFrame, name: str, kind: str):
    from pyspark.sql.types import StructType

    return StructType(frame.schema.fields + frame.select(F.lit(None).cast(kind).alias(name)).schema.fields)


def round_trips(docs: DataFrame, model: bytes) -> DataFrame:
    """(doc_id, n_chars, n_pieces, pieces_md5, decoded_md5, exact) of every row of ``docs``: encoded, decoded and compared.

    ``pieces_md5`` is taken over the ids as little-endian 32-bit integers. A null text
    counts as empty. Encoding and decoding meet in one pass, so that ids of the whole
    corpus need not leave the worker. Repeated rows come out as often as they are there,
    very long texts are encoded whole, and other columns are not read, whatever their
    names; segmentations of one score go as ``Codec`` says. No row: no row.
    """
    def scan(batches: Iterator[pa.RecordBatch]):
        own = codec(model)
        for batch, _, _ in slices(batches):
            rows: list[tuple] = []
            for text in batch.column("text").to_pylist():
                text = text or ""
                packed = own.pack(text)
                back = own.decode(array("i", packed))
                rows.append((len(text), len(packed) // 4, hashlib.md5(packed).hexdigest(), hashlib.md5(back.encode("utf-8", "replace")).hexdigest(), back == text))
            columns = list(zip(*rows, strict=True))
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                names=["doc_id", "n_chars", "n_pieces", "pieces_md5", "decoded_md5", "exact"],
            )

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_batches(source, scan, "doc_id long, n_chars long, n_pieces long, pieces_md5 string, decoded_md5 string, exact boolean", ("codec",))
