"""Texts to piece ids and back, exactly as a merge-type piece model gives them.

A merge-type model starts from single characters and joins, as long as it can, the two neighbours
whose union is the best piece (the leftmost of equals). The result is found here without playing the
merges through a text. Two facts make that possible. A run of pieces is what merging gives if, and
only if, each piece merges to itself and so does each pair of neighbours: the first merge across a
border would happen in the pair alone too. And a prefix of a text has one such run only, so that a
position from which the search failed once fails always.

A text is walked from left to right. One pass of an Aho-Corasick automaton gives the longest piece
that starts at each position; it is taken if it agrees with its left neighbour, which is tried by
merging the two once and remembered. Else the next shorter piece is tried, and if none is left the
walk steps back and marks the position in a bit field, so that it is never entered again: no text,
however long and unbroken, is walked more than once per position and piece.

Texts are cut before the walk where the vocabulary proves that no piece lies across: between a letter
and anything else but the blank before it, if no piece holds the two side by side. Parts that
come again are remembered by each task up to ``KEPT`` of them, which changes no result. Characters
without a piece become the ids of their bytes. Decoding takes the bytes of all ids at once.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence
from pathlib import Path

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from sentencepiece import sentencepiece_model_pb2

from spanwatch.llm.common import kept_in_worker

KEPT = 150_000  # parts remembered by a task
KEPT_PAIRS = 400_000  # pairs of neighbours remembered by a task
KEPT_LENGTH = 64  # of characters: longer parts are not remembered
SENT_BYTES = 4_000_000  # of text in one batch of results

# Fixed values of piece models: the sign for a blank, kinds of pieces, and what cannot be decoded.
BLANK = "▁"
PLANE = 0xFFFF
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
REPLACED = "�".encode()


def is_letter(char: str) -> bool:
    """Letters of the first plane; patterns look these up in one table."""
    return char.isalpha() and ord(char) <= PLANE


def letters() -> str:
    """All such letters, as ranges for a character class."""
    found, start = [], None
    for code in range(PLANE + 2):
        letter = code <= PLANE and is_letter(chr(code))
        if letter and start is None:
            start = code
        elif not letter and start is not None:
            found.append(f"{chr(start)}-{chr(code - 1)}")
            start = None
    return "".join(found)


class Known(dict):
    """Results by part of a text, made on demand; the last ``most`` parts met are there, at most twice as many."""

    def __init__(self, make, most: int):
        super().__init__()
        self.make, self.most = make, most
        self.before: dict = {}

    def __missing__(self, part: str):
        value = self.before.get(part)
        if value is None:
            value = self.make(part)
        if len(part) <= KEPT_LENGTH:
            if len(self) >= self.most:
                self.before = dict(self)
                self.clear()
            self[part] = value
        return value


class PieceModel:
    """A merge-type piece model with byte fallback, from the bytes of its file."""

    def __init__(self, model: bytes):
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        rules = proto.normalizer_spec
        plain = rules.name == "identity" and not rules.precompiled_charsmap and not rules.remove_extra_whitespaces
        kinds = {p.type for p in proto.pieces}
        if proto.trainer_spec.model_type != 2 or not proto.trainer_spec.byte_fallback:
            raise ValueError("not a merge-type model with byte fallback")
        if not (plain and rules.add_dummy_prefix) or kinds - {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("text rules or kinds of pieces that are not supported")
        self.scores = {p.piece: p.score for p in proto.pieces if p.type == NORMAL}
        self.ids = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == NORMAL}
        self.byte_ids = {int(p.piece[1:-1], 16): i for i, p in enumerate(proto.pieces) if p.type == BYTE}
        self.unknown = proto.trainer_spec.unk_surface
        self.bytes = [self._bytes(p, self.unknown) for p in proto.pieces]
        self.is_byte = np.array([p.type == BYTE for p in proto.pieces])
        self.is_control = np.array([p.type == CONTROL for p in proto.pieces])
        self.agree: dict[tuple[str, str], bool] = {}
        # Pieces that merging can give, with the next shorter such piece each of them begins with.
        valid = {p for p in self.scores if len(p) > 1 and self.merge(p) == [p]}
        self.shorter = {p: next((p[:n] for n in range(len(p) - 1, 1, -1) if p[:n] in valid), p[0]) for p in valid}
        self.automaton = ahocorasick.Automaton()
        for piece in valid:
            self.automaton.add_word(piece, piece)
        if valid:
            self.automaton.make_automaton()
        self.parts = re.compile(self._cutter(valid), re.DOTALL).findall
        self.coded = Known(self._coded, KEPT)
        self.known = Known(self._part, KEPT)

    @classmethod
    def bytes_of(cls, model: bytes) -> list[bytes]:
        """What each id of a model is in a text."""
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        return [cls._bytes(p, proto.trainer_spec.unk_surface) for p in proto.pieces]

    @staticmethod
    def _bytes(piece, unknown: str) -> bytes:
        if piece.type == BYTE:
            return bytes([int(piece.piece[1:-1], 16)])
        if piece.type == CONTROL:
            return b""
        return (unknown if piece.type == UNKNOWN else piece.piece.replace(BLANK, " ")).encode()

    @staticmethod
    def _cutter(pieces) -> str:
        """A pattern of parts that no piece reaches across, proven from the pieces."""
        pairs = [pair for p in pieces for pair in zip(p, p[1:])]
        if any(b == BLANK != a for a, b in pairs):
            return ".+"
        if any(BLANK != a and is_letter(a) != is_letter(b) for a, b in pairs):
            return f"{BLANK}*[^{BLANK}]+|{BLANK}+"
        return f"{BLANK}*[{letters()}]+|{BLANK}*[^{BLANK}{letters()}]+|{BLANK}+"

    def merge(self, text: str) -> list[str]:
        """The pieces of a short text by plain merging."""
        score, none = self.scores.get, -math.inf
        parts = list(text)
        joined = [score(a + b, none) for a, b in zip(parts, parts[1:])]
        while joined:
            best = max(joined)
            if best == none:
                break
            i = joined.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del joined[i]
            if i < len(joined):
                joined[i] = score(parts[i] + parts[i + 1], none)
            if i:
                joined[i - 1] = score(parts[i - 1] + parts[i], none)
        return parts

    def agrees(self, left: str, right: str) -> bool:
        """Whether two pieces stay as they are when they are merged side by side."""
        pair = (left, right)
        found = self.agree.get(pair)
        if found is None:
            if len(self.agree) >= KEPT_PAIRS:
                self.agree.clear()
            found = self.agree[pair] = self.merge(left + right) == [left, right]
        return found

    def walk(self, part: str) -> list[str]:
        """The pieces of a part by backtracking over longest matches."""
        size = len(part)
        if size == 1:
            return [part]
        longest = list(part)
        if len(self.shorter):
            for end, piece in self.automaton.iter(part):
                start = end + 1 - len(piece)
                longest[start] = piece
        failed = bytearray(size // 8 + 1)
        out: list[str] = []
        at, piece, left, shorter, agree = 0, longest[0], "", self.shorter, self.agree
        while True:
            end = at + len(piece)
            fits = not failed[end >> 3] >> (end & 7) & 1
            if fits and left:
                fits = agree.get((left, piece))
                if fits is None:
                    fits = self.agrees(left, piece)
            if fits:
                out.append(piece)
                if end == size:
                    return out
                at, left, piece = end, piece, longest[end]
            elif len(piece) > 1:
                piece = shorter[piece]
            else:
                # No piece fits here: nothing may end here again.
                while True:
                    failed[at >> 3] |= 1 << (at & 7)
                    piece = out.pop()
                    at -= len(piece)
                    if len(piece) > 1:
                        left, piece = out[-1] if out else "", shorter[piece]
                        break

    def ids_of(self, pieces: list[str]) -> list[int]:
        """Ids of pieces, or of the bytes of characters without one."""
        ids = list(map(self.ids.get, pieces))
        if None in ids:
            ids = [i for p, own in zip(pieces, ids) for i in ([own] if own is not None else map(self.byte_ids.get, p.encode()))]
        return ids

    def _coded(self, piece: str) -> bytes:
        return np.array(self.ids_of([piece]), np.int32).tobytes()

    def _part(self, part: str) -> bytes:
        return b"".join(map(self.coded.__getitem__, self.walk(part)))

    def encode(self, text: str | None) -> bytes:
        """Ids of a text in four bytes each; none for null and the empty text."""
        if not text:
            return b""
        return b"".join(map(self.known.__getitem__, self.parts(BLANK + text.replace(" ", BLANK))))

    def decode(self, ids: Sequence[int]) -> str:
        return self.decode_all(pa.array([ids], pa.list_(pa.int32())))[0].as_py()

    def decode_all(self, ids: pa.ListArray) -> pa.StringArray:
        """Texts of lists of ids; null for null. Bytes that are no UTF-8 become U+FFFD one by one."""
        flat = ids.flatten().to_numpy(zero_copy_only=False)
        taken = pa.array(self.bytes, pa.large_binary()).take(pa.array(flat))
        places = np.frombuffer(taken.buffers()[1], np.int64, len(flat) + 1, taken.offset * 8) if len(flat) else [0]
        data = memoryview(taken.buffers()[2] or b"") if len(flat) else memoryview(b"")
        ends = np.cumsum(pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False))
        out, start = [], 0
        for end, null in zip(ends.tolist(), ids.is_null().to_pylist(), strict=True):
            text = None if null else self._text(flat[start:end], data[places[start] : places[end]])
            out.append(text)
            start = end
        return pa.array(out, pa.string())

    def _text(self, ids: np.ndarray, data: memoryview) -> bytes:
        control = self.is_control[ids]
        # The blank before the first piece is not of the text; control pieces may come before it.
        spoken = ids[~control][:1]
        drop = len(spoken) and not self.is_byte[spoken[0]] and data[:1] == b" " and self.bytes[spoken[0]] != self.unknown.encode()
        if control.any() and self.is_byte[ids].any():
            # Control pieces part the bytes of a character.
            runs = np.split(ids, np.flatnonzero(control))
            text = b"".join(_repaired(b"".join(self.bytes[i] for i in run)) for run in runs)
            return text[1:] if drop else text
        text = bytes(data[1:] if drop else data)
        try:
            text.decode()
        except UnicodeDecodeError:
            return _repaired(text)
        return text


def _repaired(data: bytes) -> bytes:
    """UTF-8 in which each byte that belongs to no character is U+FFFD."""
    out, at = [], 0
    while at < len(data):
        try:
            out.append(data[at:].decode().encode())
            break
        except UnicodeDecodeError as error:
            out += [data[at : at + error.start], REPLACED]
            at += error.start + 1
    return b"".join(out)


def loaded(model: bytes) -> PieceModel:
    """The model of a worker process."""
    return kept_in_worker("pieces", model, lambda: PieceModel(model))


def slices(batch: pa.RecordBatch, text: str, most: int = SENT_BYTES) -> Iterator[pa.RecordBatch]:
    """A batch in parts of about ``most`` bytes of text; a longer text is a part of its own."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if held and held + size > most:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if len(sizes) > start:
        yield batch.slice(start)


def encode(documents: DataFrame, model: str, decoded: bool = False) -> DataFrame:
    """``documents`` with the ids of ``text`` as ``ids``; with ``decoded`` their text as ``decoded``.

    ``model`` is the path of a piece model, read by the driver and sent to the tasks: a vocabulary,
    whose size does not depend on the documents. Ids come without begin and end marks. Null and
    empty texts have an empty list, and the empty text again. Rows stay as they are, repeated ones,
    null ids and further columns included; a column that has the name of a result is replaced. A text
    is one row and so one task's; very long ones are cut into parts where that is proven harmless.
    """
    documents = documents.drop("ids", *(["decoded"] if decoded else []))
    sent = documents.sparkSession.sparkContext.broadcast(Path(model).read_bytes())
    fields = [*documents.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType()))]
    if decoded:
        fields.append(T.StructField("decoded", T.StringType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = loaded(sent.value)
        for batch in batches:
            for part in slices(batch, "text"):
                found = [pieces.encode(t.as_py()) for t in part.column("text")]
                ends = np.cumsum([0, *map(len, found)]) // 4
                flat = np.frombuffer(b"".join(found), np.int32)
                ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))
                del found
                more = [ids, pieces.decode_all(ids)] if decoded else [ids]
                names = [*part.schema.names, "ids", "decoded"][: part.num_columns + len(more)]
                yield pa.RecordBatch.from_arrays([*part.columns, *more], names=names)

    return documents.mapInArrow(run, T.StructType(fields))


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """``encoded`` with the text of its ``ids`` as ``decoded``, which is replaced if it is there; null for null."""
    encoded = encoded.drop("decoded")
    sent = encoded.sparkSession.sparkContext.broadcast(Path(model).read_bytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = loaded(sent.value)
        for batch in batches:
            text = pieces.decode_all(batch.column("ids").cast(pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays([*batch.columns, text], names=[*batch.schema.names, "decoded"])

    return encoded.mapInArrow(run, T.StructType([*encoded.schema.fields, T.StructField("decoded", T.StringType())]))


def digests(documents: DataFrame, model: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every row."""
    found = encode(documents.select("doc_id", "text"), model, decoded=True)
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return found.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(listed, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
