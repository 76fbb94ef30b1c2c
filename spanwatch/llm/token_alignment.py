"""Two tokenizers side by side: where their tokens end together, and how often which ids do.

Tokens of both vocabularies are laid over the bytes of blank + text. Offsets where a token of each ends
cut them into groups; the two last tokens of a group are a link. The count of a pair of ids is the
number of links of all documents that hold it.

Documents are encoded once; their ids are a written table of two or four bytes a token, from which both
passes align anew with a few array operations for many documents together.

Counts are dense vectors without keys. The tokens of a link end together, so the bytes of one are a
suffix of the other's: the vocabularies alone bound the distinct pairs (``most_pairs``, a few hundred
thousand, whatever the input). A first pass counts each task's pairs. The distinct ones, united in a
tree, are given a minimal perfect hash: in each of its levels a key goes to one place of a bit array, and
keys that share a place go on to the next level; a key's index is the number of taken places before
its own. Each task's counts become a vector by that index, and the vectors are summed in a tree. The
keys in index order are kept beside it, so that a key that was never hashed is told apart. A second
pass aligns the documents again and looks their links up.
"""

from __future__ import annotations

import json
import uuid
from collections import Counter
from collections.abc import Iterator
from pathlib import Path
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame

from spanwatch.llm.bpe import PATTERN
from spanwatch.llm.common import kept_in_worker, settle
from spanwatch.llm.piece_bpe import PieceModel, slices
from spanwatch.sources.stages import stage_folder

FAN_IN = 32
GAMMA = 2  # places of a level for each key that reaches it
LEAST = 64  # places of a level
SENT_BYTES = 1_500_000  # of text in one batch of results


NOTHING = np.array([], np.int64)


def _byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def _byte_level(file: dict) -> tuple[tiktoken.Encoding, list[bytes]]:
    """The merges of a byte-level vocabulary as ranks, and the bytes of each id; special tokens are plain text."""
    byte_of = _byte_of()
    spelt = lambda token: bytes(byte_of[c] for c in token)
    model, rule = file["model"], file["pre_tokenizer"]
    special = {t["content"] for t in file["added_tokens"]}
    ranks = {spelt(t): i for t, i in model["vocab"].items() if t not in special}
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    made = [model["vocab"][a + b] for a, b in merges]
    if rule["type"] != "ByteLevel" or rule["add_prefix_space"] or file["normalizer"] or made != sorted(set(made)):
        raise ValueError("not a byte-level vocabulary whose ids follow its merges")
    out = [b""] * (max(model["vocab"].values()) + 1)
    for token, i in ranks.items():
        out[i] = token
    return tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}), out


class Aligned(NamedTuple):
    """Groups of many documents, one after the other."""

    keys: np.ndarray  # of the links, one for each group
    n_groups: np.ndarray  # of each document
    ends_a: np.ndarray  # places of the last tokens of groups among all of A
    ends_b: np.ndarray


class Pair:
    """Two vocabularies: a byte-level one (A) and a piece model (B)."""

    def __init__(self, byte_level: bytes, pieces: bytes):
        self.a, self.a_bytes = _byte_level(json.loads(byte_level))
        self.b = sentencepiece.SentencePieceProcessor(model_proto=pieces)
        self.b_bytes = PieceModel.bytes_of(pieces)
        sides = self.a_bytes, self.b_bytes
        self.a_table, self.b_table = (pa.array(t, pa.large_binary()) for t in sides)
        self.a_length, self.b_length = (np.array([len(t) for t in side], np.int64) for side in sides)
        self.shift = len(self.b_bytes)
        self.width = "<u2" if max(map(len, sides)) <= 1 << 16 else "<u4"
        # Each id as text, with each of the signs that may follow it.
        signed = lambda side, sign: [f"{i}{sign}" for i in range(len(side))]
        own = [signed(self.a_bytes, sign) for sign in ",|"] + [signed(self.b_bytes, sign) for sign in (",", ";", "")]
        self.told = pa.array([t for side in own for t in side], pa.large_binary())

    def encode(self, texts: list[str | None]) -> tuple[list[bytes], list[bytes]]:
        """Ids of A and B; none for null, the empty text, and one that is not given back byte for byte."""
        there = [t for t in texts if t]
        a = [self.a.encode_to_numpy(" " + t, disallowed_special=()) for t in there]
        b = [np.array(ids, np.int64) for ids in self.b.encode(there, num_threads=1)]
        data = [(" " + t).encode() for t in there]
        whole = np.logical_and(_gives(a, self.a_table, data), _gives(b, self.b_table, data))
        coded = iter([(x.astype(self.width).tobytes(), y.astype(self.width).tobytes()) if w else (b"", b"") for x, y, w in zip(a, b, whole)])
        rows = [next(coded) if t else (b"", b"") for t in texts]
        return [r[0] for r in rows], [r[1] for r in rows]

    def align(self, a: np.ndarray, b: np.ndarray, n_a: np.ndarray) -> Aligned:
        """Groups of documents whose tokens are joined; ``n_a`` of them are each one's in A.

        Both sides of a document have the same bytes, so it ends in a group of its own.
        """
        at_a, at_b = np.cumsum(self.a_length[a]), np.cumsum(self.b_length[b])
        found = np.searchsorted(at_b, at_a)
        ends_a = np.flatnonzero(at_b[found] == at_a) if len(at_b) else np.zeros(0, np.int64)
        ends_b = found[ends_a]
        of_doc = np.searchsorted(ends_a, np.append(0, np.cumsum(n_a)))
        return Aligned(a[ends_a] * self.shift + b[ends_b], np.diff(of_doc), ends_a, ends_b)

    def tell(self, a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, groups: Aligned) -> pa.StringArray:
        """Groups of each document as ``a1,a2|b1;a3|b2,b3``."""
        code_a, code_b = a.copy(), b + 2 * len(self.a_bytes)
        code_a[groups.ends_a] += len(self.a_bytes)
        code_b[groups.ends_b] += self.shift
        last = np.cumsum(n_b)[n_b > 0] - 1
        code_b[last] += self.shift
        # Tokens of a group follow those of the groups before it, A's before B's.
        ends = lambda n, places: np.append(0, np.cumsum(np.bincount(places, minlength=n)))[:-1]
        if len(a):
            group_a, group_b = ends(len(a), groups.ends_a), ends(len(b), groups.ends_b)
            codes = np.empty(len(a) + len(b), np.int64)
            codes[np.arange(len(a)) + np.append(0, groups.ends_b + 1)[group_a]] = code_a
            codes[np.arange(len(b)) + (groups.ends_a + 1)[group_b]] = code_b
        else:
            codes = np.zeros(0, np.int64)
        taken = self.told.take(pa.array(codes))
        starts = _places(taken)[np.append(0, np.cumsum(n_a + n_b))]
        data = taken.buffers()[2] or pa.py_buffer(b"")
        return pa.Array.from_buffers(pa.large_string(), len(n_a), [None, pa.py_buffer(starts.tobytes()), data]).cast(pa.string())

    def most_pairs(self) -> int:
        """How many pairs of ids can end together: the bytes of one are a suffix of the other's."""
        a, b = Counter(filter(None, self.a_bytes)), Counter(filter(None, self.b_bytes))
        below = lambda one, other, start: sum(
            n * other[t[i:]] for t, n in one.items() for i in range(start, len(t))
        )
        return below(a, b, 0) + below(b, a, 1)


def loaded(byte_level: bytes, pieces: bytes) -> Pair:
    """The vocabularies of a worker process."""
    return kept_in_worker("pair", (byte_level, pieces), lambda: Pair(byte_level, pieces))


def _mixed(keys: np.ndarray, level: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = keys.astype(np.uint64) + np.uint64((level + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))


class PerfectHash:
    """A minimal perfect hash of distinct keys, with the keys in the order of their index."""

    def __init__(self, levels: list[np.ndarray], keys: np.ndarray):
        self.levels, self.keys, self.size = levels, keys, len(keys)
        self.taken = [np.cumsum(level) for level in levels]

    @classmethod
    def of(cls, keys: np.ndarray) -> PerfectHash:
        """``keys`` are distinct."""
        keys = np.asarray(keys, np.int64)
        levels, left = [], keys
        while len(left):
            size = max(LEAST, GAMMA * len(left))
            place = (_mixed(left, len(levels)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(place, minlength=size) == 1
            levels.append(alone)
            left = left[~alone[place]]
        made = cls(levels, keys.copy())
        made.keys[made._index(keys)] = keys
        return made

    def _index(self, keys: np.ndarray) -> np.ndarray:
        """A place for every key; one that was never hashed gets any, or -1."""
        out = np.full(len(keys), -1, np.int64)
        walk, before = np.arange(len(keys)), 0
        for number, level in enumerate(self.levels):
            place = (_mixed(keys[walk], number) % np.uint64(len(level))).astype(np.int64)
            here = level[place]
            out[walk[here]] = before + self.taken[number][place[here]] - 1
            walk, before = walk[~here], before + int(self.taken[number][-1])
        return out

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Index of each key, -1 for one that was not hashed."""
        found = self._index(np.asarray(keys, np.int64))
        if self.size:
            found[self.keys[found] != keys] = -1
        return found


def _places(values: pa.LargeBinaryArray) -> np.ndarray:
    """Where values begin in their buffer, and where the last one ends."""
    return np.frombuffer(values.buffers()[1], np.int64, len(values) + 1, 8 * values.offset) if len(values) else np.zeros(1, np.int64)


def _gives(ids: list[np.ndarray], table: pa.Array, wanted: list[bytes]) -> list[bool]:
    """Whether the bytes of ids are those wanted."""
    taken = table.take(pa.array(np.concatenate([np.zeros(0, np.int64), *ids]).astype(np.int64)))
    starts = _places(taken)[np.cumsum([0, *map(len, ids)])]
    data = memoryview(taken.buffers()[2] or b"").cast("B")
    return [data[a:b] == w for a, b, w in zip(starts, starts[1:], wanted)]


def encoded(documents: DataFrame, byte_level: str, pieces: str) -> DataFrame:
    """``doc_id, a, b``: ids of both vocabularies in two or four bytes each, a written table."""
    sent = _vocabularies(documents, byte_level, pieces)
    kind = dict(documents.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = loaded(*sent.value)
        for batch in batches:
            for some in slices(batch, "text", SENT_BYTES):
                a, b = pair.encode(some.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["doc_id", "a", "b"]
                )

    return settle(documents.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, a binary, b binary"), "token-ids")


def _ids(column: pa.Array, width: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all rows joined, and how many are of each."""
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), width).astype(np.int64), np.array([len(r) for r in rows], np.int64) // int(width[2])


def _vectors(tokens: DataFrame, sent) -> DataFrame:
    """``keys, counts``: what each task counted, keys in order, one row for a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = loaded(*sent.value)
        keys, counts = NOTHING, NOTHING
        for batch in batches:
            for some in slices(batch, "a", SENT_BYTES):
                (a, n_a), (b, _) = (_ids(some.column(c), pair.width) for c in (0, 1))
                new, times = np.unique(pair.align(a, b, n_a).keys, return_counts=True)
                keys, counts = _summed(np.append(keys, new), np.append(counts, times))
        yield pa.record_batch([pa.array([keys.tobytes()]), pa.array([counts.tobytes()])], names=["keys", "counts"])

    return tokens.select("a", "b").mapInArrow(run, "keys binary, counts binary")


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    distinct, place = np.unique(keys, return_inverse=True)
    out = np.zeros(len(distinct), np.int64)
    np.add.at(out, place, counts)
    return distinct, out


def _tree(rows: DataFrame, column: str, join, name: str) -> bytes:
    """All values of a binary column joined two by two, ``FAN_IN`` to a task and level."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            for value in batch.column(0):
                value = np.frombuffer(value.as_py(), np.int64)
                held = value if held is None else join(held, value)
        if held is not None:
            yield pa.record_batch([pa.array([held.tobytes()])], names=[column])

    rows = settle(rows.select(column).mapInArrow(run, f"{column} binary"), name)
    n = rows.count()
    while n > 1:
        n = -(-n // FAN_IN)
        rows = settle(rows.repartition(n).mapInArrow(run, f"{column} binary"), name)
        n = min(n, rows.count())
    first = rows.first()
    return bytes(first[0]) if first else b""


class Counts(NamedTuple):
    """Counts of all pairs of ids, by their perfect hash."""

    index: PerfectHash
    counts: np.ndarray
    best: np.ndarray  # by index: whether no other pair of the same B id counts more
    shift: int


def _with_best(index: PerfectHash, counts: np.ndarray, shift: int) -> Counts:
    highest = np.zeros(shift, np.int64)
    if index.size:
        np.maximum.at(highest, index.keys % shift, counts)
    return Counts(index, counts, counts == highest[index.keys % shift], shift)


def _vocabularies(documents: DataFrame, byte_level: str, pieces: str):
    return documents.sparkSession.sparkContext.broadcast((Path(byte_level).read_bytes(), Path(pieces).read_bytes()))


def pair_counts(tokens: DataFrame, byte_level: str, pieces: str) -> Counts:
    """How often which ids are linked in all of ``tokens``, a table of ``encoded``.

    What reaches the driver, and later each task, is one row for each distinct pair, at most
    ``Pair.most_pairs`` for any input.
    """
    sent = _vocabularies(tokens, byte_level, pieces)
    counted = settle(_vectors(tokens, sent), "pairs")
    index = PerfectHash.of(np.frombuffer(_tree(counted, "keys", np.union1d, "pair-keys"), np.int64))
    shift = loaded(*sent.value).shift
    hashed = tokens.sparkSession.sparkContext.broadcast((index.levels, index.keys))

    def dense(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, out = PerfectHash(*hashed.value), None
        for batch in batches:
            out = np.zeros(index.size, np.int64) if out is None else out
            for keys, counts in zip(batch.column(0), batch.column(1), strict=True):
                place = index.find(np.frombuffer(keys.as_py(), np.int64))
                if (place < 0).any():
                    raise RuntimeError("a pair that was not hashed")
                out[place] += np.frombuffer(counts.as_py(), np.int64)
        if out is not None:
            yield pa.record_batch([pa.array([out.tobytes()])], names=["vector"])

    total = np.frombuffer(_tree(counted.mapInArrow(dense, "vector binary"), "vector", np.add, "pair-counts"), np.int64)
    return _with_best(index, total, shift)


def counts_table(spark, counts: Counts) -> DataFrame:
    """The counts as rows ``a_id, b_id, n``."""
    keys = counts.index.keys
    rows = pa.table({"a_id": keys // counts.shift, "b_id": keys % counts.shift, "n": counts.counts})
    path = f"{stage_folder(spark)}/spanwatch/pair-table-{uuid.uuid4().hex}"
    spark.createDataFrame(rows).write.parquet(path)
    return spark.read.parquet(path)


COLUMNS = "n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"


def align_documents(tokens: DataFrame, counts: Counts, byte_level: str, pieces: str) -> DataFrame:
    """Groups of every document of ``tokens``, a table of ``encoded``, and what the counts say of its links.

    Rows: ``doc_id, n_a, n_b`` (tokens), ``n_groups, n_links``, ``n_best`` (links that count as much as any
    of their B id), ``count_sum`` (of the links' counts) and ``groups`` as ``a1,a2|b1;a3|b2,b3``. A link that
    was not counted, because it is in no counted document, counts zero.
    """
    kind = dict(tokens.dtypes)["doc_id"]
    sent = _vocabularies(tokens, byte_level, pieces)
    plain = (counts.index.levels, counts.index.keys, counts.counts, counts.best)
    table = tokens.sparkSession.sparkContext.broadcast(plain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, (levels, keys, counts, best) = loaded(*sent.value), table.value
        index, total, is_best = PerfectHash(levels, keys), np.append(counts, 0), np.append(best, False)
        for batch in batches:
            for some in slices(batch, "a", SENT_BYTES):
                (a, n_a), (b, n_b) = (_ids(some.column(c), pair.width) for c in (1, 2))
                found = pair.align(a, b, n_a)
                at = index.find(found.keys)
                ends = np.append(0, np.cumsum(found.n_groups))
                of_doc = lambda values: np.diff(np.append(0, np.cumsum(values))[ends])
                columns = [n_a, n_b, found.n_groups, found.n_groups, of_doc(is_best[at]), of_doc(total[at])]
                columns = [*map(pa.array, columns), pair.tell(a, b, n_a, n_b, found)]
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), *columns], names=["doc_id", *(c.split()[0] for c in COLUMNS.split(", "))]
                )

    return tokens.select("doc_id", "a", "b").mapInArrow(run, f"doc_id {kind}, {COLUMNS}")


def alignments(documents: DataFrame, byte_level: str, pieces: str) -> DataFrame:
    """Encode ``documents`` (``doc_id, text``), count all pairs of ids, then align every document.

    Rows as of ``align_documents``, as often as they come, with null ids too. Null and empty texts, and
    texts that a vocabulary does not give back byte for byte, have zeros and the empty string. Further
    columns are not read; an empty table gives no row.
    """
    tokens = encoded(documents, byte_level, pieces)
    return align_documents(tokens, pair_counts(tokens, byte_level, pieces), byte_level, pieces)
