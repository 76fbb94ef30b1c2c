"""Token ids in training order: a keyed permutation of all sequences, in shards of fixed stride.

The tokens of all documents, each closed by an end mark, form one stream in the order of the input
files; it is cut into sequences of ``length`` ids, so that no sequence but the last is padded.
Sequence i gets the global slot P(i), where P is a Feistel network over the smallest even number of
bits that holds all numbers, walked along its cycles until it falls below their count: a permutation
of exactly the sequences, without a table, a sort or a random number per row, and invertible.

The stream is never gathered. Each input split is encoded once and written with the place of every
document in the split's own stream; the splits' lengths (one short row per split reaches the driver)
then give each split its place in the whole stream. A second pass reads the ids, not the texts, and
deals each document's pieces to the shards of their slots, so the only shuffle is that of the tokens,
which are compressed for it. Places are written beside the ids: a task that runs again, or an
executor that is lost, changes neither.

A shard holds ``per_shard`` consecutive slots in slot order, one Parquet file, uncompressed and
without dictionary, in rows of constant width. Reading from any slot on needs its shard and row only:
``slot // per_shard`` and ``slot % per_shard``.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanwatch.llm.bpe import Encoder
from spanwatch.sources.stages import stage_folder

LENGTH = 2_048
PER_SHARD = 4_096
ROUNDS = 6
KEY = 20_240_601
SENT_BYTES = 2_000_000  # of tokens in one batch of documents or pieces


def _round(half: np.ndarray, key: int, turn: int, bits: int) -> np.ndarray:
    """A keyed mixing function of one half."""
    h = half + np.uint64((key * 0x9E3779B97F4A7C15 + turn * 0xD1B54A32D192ED03) % (1 << 64))
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (h ^ (h >> np.uint64(31))) & np.uint64((1 << bits) - 1)


def _network(x: np.ndarray, key: int, bits: int, back: bool) -> np.ndarray:
    mask = np.uint64((1 << bits) - 1)
    left, right = x >> np.uint64(bits), x & mask
    for turn in range(ROUNDS):
        if back:
            left, right = right ^ _round(left, key, ROUNDS - 1 - turn, bits), left
        else:
            left, right = right, left ^ _round(right, key, turn, bits)
    return left << np.uint64(bits) | right


def permute(index: np.ndarray, count: int, key: int = KEY, back: bool = False) -> np.ndarray:
    """Slots of sequence numbers below ``count``; with ``back`` the numbers of slots."""
    bits = max(1, ((count - 1).bit_length() + 1) // 2) if count else 1
    out = np.asarray(index, np.uint64).copy()
    walk = np.arange(len(out))
    with np.errstate(over="ignore"):
        while len(walk):
            out[walk] = _network(out[walk], key, bits, back)
            walk = walk[out[walk] >= np.uint64(count)]
    return out.astype(np.int64)


def _encoded(documents: DataFrame, ranks) -> DataFrame:
    """``part, at, n, doc_id, tokens``: documents with end marks and their places in their split's stream."""
    spark, kind = documents.sparkSession, dict(documents.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, at = Encoder(ranks.value), TaskContext.get().partitionId(), 0
        end = np.array([encoder.size], "<u2").tobytes()
        for batch in batches:
            places, sizes, docs, tokens, held = [], [], [], [], 0

            def rows(kind: pa.DataType) -> pa.RecordBatch:
                columns = [
                    pa.array([part] * len(docs), pa.int32()),
                    pa.array(places, pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array(docs, kind),
                    pa.array(tokens, pa.binary()),
                ]
                return pa.record_batch(columns, names=["part", "at", "n", "doc_id", "tokens"])

            texts = (t.as_py() for t in batch.column(1))
            for doc, ids in zip(batch.column(0).to_pylist(), encoder.batch(texts), strict=True):
                if not ids:
                    continue
                places.append(at)
                sizes.append(len(ids) // 2 + 1)
                docs.append(doc)
                tokens.append(ids + end)
                at += sizes[-1]
                held += len(ids)
                if held >= SENT_BYTES:
                    yield rows(batch.column(0).type)
                    places, sizes, docs, tokens, held = [], [], [], [], 0
            if docs:
                yield rows(batch.column(0).type)

    fields = f"part int, at long, n long, doc_id {kind}, tokens binary"
    path = f"{stage_folder(spark)}/spanwatch/shard-tokens-{uuid.uuid4().hex}"
    found = documents.select("doc_id", F.col("text").cast("string")).mapInArrow(run, fields)
    (
        found.write.option("compression", "zstd")
        .option("parquet.compression.codec.zstd.level", "6")
        .option("parquet.enable.dictionary", "false")
        .parquet(path)
    )
    return spark.read.schema(fields).parquet(path)


def _split_sizes(encoded: DataFrame) -> list[tuple[int, int]]:
    """Number and tokens of each split, in order; the ids are not read."""
    rows = encoded.groupBy("part").agg(F.sum("n").alias("n")).collect()
    return sorted((r["part"], r["n"]) for r in rows)


def _pieces(encoded: DataFrame, sizes: list[tuple[int, int]], length: int, per_shard: int, key: int) -> DataFrame:
    """``shard, slot, start, doc_id, tokens``: a document's part of a sequence, from place ``start``.

    ``tokens`` are compressed.
    """
    count = -(-sum(n for _, n in sizes) // length)
    begins, begin = {}, 0
    for part, n in sizes:
        begins[part] = begin
        begin += n
    sent = encoded.sparkSession.sparkContext.broadcast(begins)
    kind = dict(encoded.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor().compress
        docs, own, starts, cut, held = [], [], [], [], 0

        def rows(kind: pa.DataType) -> pa.RecordBatch:
            slots = permute(np.array(own), count, key)
            out = pa.record_batch(
                [
                    pa.array(slots // per_shard),
                    pa.array(slots),
                    pa.array(starts, pa.int32()),
                    pa.array(docs, kind),
                    pa.array(cut, pa.binary()),
                ],
                names=["shard", "slot", "start", "doc_id", "tokens"],
            )
            for column in (docs, own, starts, cut):
                column.clear()
            return out

        for batch in batches:
            places = zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True)
            for (part, at, size, doc), ids in zip(places, batch.column(4), strict=True):
                at, ids = at + sent.value[part], memoryview(ids.as_buffer())
                first = at // length
                for number in range(first, (at + size - 1) // length + 1):
                    a, b = max(at, number * length), min(at + size, (number + 1) * length)
                    docs.append(doc)
                    own.append(number)
                    starts.append(a - number * length)
                    cut.append(pack(ids[2 * (a - at) : 2 * (b - at)]))
                held += len(ids)
                if held >= SENT_BYTES:
                    yield rows(batch.column(3).type)
                    held = 0
            if docs:
                yield rows(batch.column(3).type)
                held = 0

    return encoded.mapInArrow(run, f"shard long, slot long, start int, doc_id {kind}, tokens binary")


def _rows(length: int, end: int):
    """Pieces in order of slot and start to whole sequences, padded with end marks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        held: list[tuple] = []  # pieces of the sequence that is open

        def close(pieces: list[tuple]) -> tuple:
            ids = b"".join(unpack(p[4]) for p in pieces)
            n = len(ids) // 2
            ids += np.full(length - n, end, "<u2").tobytes()
            return pieces[0][0], pieces[0][1], n, ids, [p[3] for p in pieces], [p[2] for p in pieces]

        def table(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
            shard, slot, n, ids, docs, starts = zip(*rows, strict=True)
            return pa.record_batch(
                [
                    pa.array(shard, pa.int64()),
                    pa.array(slot, pa.int64()),
                    pa.array(n, pa.int32()),
                    pa.array(ids, pa.binary()),
                    pa.array(docs, pa.list_(kind)),
                    pa.array(starts, pa.list_(pa.int32())),
                ],
                names=["shard", "slot", "n_tokens", "tokens", "doc_ids", "doc_starts"],
            )

        kind = pa.int64()
        for batch in batches:
            out, kind = [], batch.column(3).type
            for piece in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and held[0][1] != piece[1]:
                    out.append(close(held))
                    held = []
                held.append(piece)
            if out:
                yield table(out, kind)
        if held:
            yield table([close(held)], kind)

    return run


def write_shards(
    documents: DataFrame,
    path: str,
    vocabulary: str,
    length: int = LENGTH,
    per_shard: int = PER_SHARD,
    key: int = KEY,
) -> DataFrame:
    """Write all tokens of ``documents`` (``doc_id, text``) to ``path``; the written table.

    ``vocabulary`` is a rank file with ids below 65,536; the id after its last ends a document.
    Rows: ``shard, slot, n_tokens`` (without padding), ``tokens`` (``length`` little-endian ids of
    two bytes), ``doc_ids`` and ``doc_starts``, the documents in a sequence and where each begins or
    goes on. Null and empty texts have no tokens and appear nowhere. Repeated rows are written as
    often as they come; rows with a null id are written under null. An empty table writes no shard.
    Further columns are not read.
    """
    spark = documents.sparkSession
    ranks = spark.sparkContext.broadcast(Path(vocabulary).read_bytes())
    end = Encoder(ranks.value).size
    kind = dict(documents.dtypes)["doc_id"]
    fields = f"slot long, n_tokens int, tokens binary, doc_ids array<{kind}>, doc_starts array<int>"
    encoded = _encoded(documents, ranks)
    sizes = _split_sizes(encoded)
    shards = -(-sum(n for _, n in sizes) // (length * per_shard)) or 1
    width = min(shards, int(spark.conf.get("spark.sql.shuffle.partitions")))
    (
        _pieces(encoded, sizes, length, per_shard, key)
        .repartition(width, "shard")
        .sortWithinPartitions("shard", "slot", "start", "doc_id")
        .mapInArrow(_rows(length, end), f"shard long, {fields}")
        .sortWithinPartitions("shard", "slot")
        .write.mode("overwrite")
        .option("compression", "uncompressed")
        .option("parquet.enable.dictionary", "false")
        .partitionBy("shard")
        .parquet(path)
    )
    return read_shards(spark, path, kind)


def read_shards(spark: SparkSession, path: str, id_type: str = "bigint") -> DataFrame:
    fields = f"slot long, n_tokens int, tokens binary, doc_ids array<{id_type}>, doc_starts array<int>"
    return spark.read.schema(f"{fields}, shard long").parquet(path)


def read_from(spark: SparkSession, path: str, slot: int, per_shard: int = PER_SHARD, id_type: str = "bigint") -> DataFrame:
    """The sequences from ``slot`` on: shards before it are not opened."""
    return read_shards(spark, path, id_type).filter((F.col("shard") >= slot // per_shard) & (F.col("slot") >= slot))
