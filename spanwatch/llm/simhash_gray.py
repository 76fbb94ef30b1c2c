"""SimHash near-duplicates with a hierarchical index in Gray order.

Fingerprints have 64 bits. Two that differ in at most 3 bits agree in one of four blocks of 16, so
distinct fingerprints are dealt to groups by (block, bits of the block). A group above
``GROUP_ROWS`` is dealt again, by four blocks of the bits it does not share yet, until it is small
enough or fewer than four bits are left (then it has at most 8 members); this holds for any data,
loses no pair, and leaves no group that grows with the input.

Inside a group fingerprints are sorted by Gray rank, which puts similar bit patterns side by side.
Runs of eight become a node, runs of eight nodes an upper node, up to a root. A node knows the bits
in which all fingerprints below it agree. The search compares nodes from the root down: the
differences between the agreed bits of two nodes are a lower bound for all pairs below, which
accumulates on the way down as more bits are agreed on, and a pair of nodes above 3 is dropped
whole. A node whose bits are all agreed on but for 3 links its members without looking at pairs.
Groups yield the edges of stars, at most one per member, never all their pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanwatch.llm.common import settle, small
from spanwatch.llm.components import components

SEED = 42
SHINGLE = 3
RADIUS = 3
FANOUT = 8
GROUP_ROWS = 1_024
SLICE_ROWS = 8_192
PAIRS = 16_384

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """The signed 64-bit SimHash of UTF-8 text; 0 for null or a text without words."""
    words = text.translate(_LOWER).split() if text else []
    n = len(words) - shingle + 1
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if n <= 1:
        return int(np.uint64(digest(b" ".join(words), SEED)).astype(np.int64))
    over = np.zeros(64, np.int64)
    for at in range(0, n, 65_536):
        runs = zip(*(words[at + k : min(at + 65_536, n) + k] for k in range(shingle)), strict=True)
        hashes = np.fromiter((digest(b" ".join(r), SEED) for r in runs), np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        over += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * over > n, bitorder="little").view(np.int64)[0])


def fingerprints(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, fp`` (signed long) per row of ``documents``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pc.cast(batch.column(1), pa.binary())
            found = pa.array((fingerprint(t.as_py()) for t in texts), pa.int64())
            yield pa.record_batch([batch.column(0), found], names=["doc_id", "fp"])

    kind = dict(documents.dtypes)[doc_id]
    picked = documents.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    return picked.mapInArrow(run, f"doc_id {kind}, fp long")


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _blocks(fixed: int) -> list[int]:
    """Masks of the bits not in ``fixed``, in four blocks of nearly the same size."""
    left = [b for b in range(63, -1, -1) if not fixed >> b & 1]
    cuts = [len(left) * k // (RADIUS + 1) for k in range(RADIUS + 2)]
    return [sum(1 << b for b in left[i:j]) for i, j in zip(cuts, cuts[1:], strict=False)]


def _groups(prints: DataFrame, group_rows: int) -> DataFrame:
    """``mask, value, fp``: every pair within the radius shares a group; groups of one are left out."""
    spark = prints.sparkSession
    done: list[DataFrame] = []
    masks = [0]
    rows = prints.select("fp", F.lit(0).cast("long").alias("mask"))
    while True:
        # At most four to the power of the depth rows, whatever the data.
        finer = [(_signed(m), _signed(m | b)) for m in masks for b in _blocks(m)]
        finer = F.broadcast(spark.createDataFrame(finer, "mask long, finer long"))
        dealt = rows.join(finer, "mask").select(
            "fp", F.col("finer").alias("mask"), F.col("fp").bitwiseAND(F.col("finer")).alias("value")
        )
        sizes = dealt.groupBy("mask", "value").agg(F.count(F.lit(1)).alias("n"))
        large = settle(sizes.filter(F.col("n") > group_rows), "simhash-large")
        masks = [r["mask"] % (1 << 64) for r in large.select("mask").distinct().collect()]
        # Groups that share all but a few bits are as small as they can be.
        masks = [m for m in masks if 64 - m.bit_count() > RADIUS + 1]
        if not masks:
            return _union([*done, dealt])
        large = large.filter(F.col("mask").isin([_signed(m) for m in masks])).select("mask", "value")
        done.append(dealt.join(large, ["mask", "value"], "left_anti"))
        rows = settle(
            dealt.join(large, ["mask", "value"], "left_semi").select("fp", "mask").distinct(), "simhash-deal"
        )


def _union(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def gray_rank(prints: np.ndarray) -> np.ndarray:
    """Place of unsigned 64-bit patterns in the reflected Gray sequence."""
    rank = prints.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def _levels(group: np.ndarray, prints: np.ndarray) -> list[tuple[np.ndarray, ...]]:
    """Nodes by level, leaves first: (agreed mask, pattern, first child, end of children)."""
    n = len(prints)
    levels = [(np.full(n, ~np.uint64(0)), prints, np.arange(n), np.arange(1, n + 1))]
    while True:
        same, pattern = levels[-1][:2]
        size = len(pattern)
        starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        if len(starts) == size:
            return levels
        place = np.arange(size) - np.repeat(starts, np.diff(np.r_[starts, size]))
        first = np.flatnonzero(place % FANOUT == 0)
        every = np.bitwise_and.reduceat(pattern, first)
        some = np.bitwise_or.reduceat(pattern, first)
        agreed = np.bitwise_and.reduceat(same, first) & ~(every ^ some)
        levels.append((agreed, every & agreed, first, np.r_[first[1:], size]))
        group = group[first]


def _child_pairs(a: np.ndarray, b: np.ndarray, first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of children of the node pairs; of a node with itself each pair once."""
    left, right = np.arange(FANOUT)[:, None], np.arange(FANOUT)[None, :]
    i = first[a][:, None, None] + left
    j = first[b][:, None, None] + right
    i, j = np.broadcast_arrays(i, j)
    ok = (i < end[a][:, None, None]) & (j < end[b][:, None, None]) & ((a != b)[:, None, None] | (i <= j))
    return i[ok], j[ok]


def link(group: np.ndarray, prints: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Links within groups (numbers in order), as positions of ``prints``.

    The links connect exactly the fingerprints that chains of pairs within ``radius`` connect.
    ``prints`` (unsigned) are sorted by group and Gray rank.
    """
    levels = _levels(group, prints)
    leaf_first, leaf_end = [np.arange(len(prints))], [np.arange(1, len(prints) + 1)]
    for _, _, first, end in levels[1:]:
        leaf_first.append(leaf_first[-1][first])
        leaf_end.append(leaf_end[-1][end - 1])
    out_a, out_b = [], []

    def star(nodes: np.ndarray, hubs: np.ndarray, depth: int) -> None:
        """Link all leaves below ``nodes`` to the leaves ``hubs``."""
        count = leaf_end[depth][nodes] - leaf_first[depth][nodes]
        start = np.repeat(leaf_first[depth][nodes] - np.r_[0, np.cumsum(count)[:-1]], count)
        out_a.append(np.arange(count.sum()) + start)
        out_b.append(np.repeat(hubs, count))

    top = np.arange(len(levels[-1][0]))
    todo = [(len(levels) - 1, top[at : at + PAIRS], top[at : at + PAIRS]) for at in range(0, len(top), PAIRS)]
    while todo:
        depth, a, b = todo.pop()
        same, pattern, first, end = levels[depth]
        both = same[a] & same[b]
        apart = np.bitwise_count((pattern[a] ^ pattern[b]) & both)
        near = apart <= radius
        a, b, both, apart = a[near], b[near], both[near], apart[near]
        close = apart + np.bitwise_count(~both) <= radius
        if close.any():
            star(a[close], leaf_first[depth][b[close]], depth)
            star(b[close], leaf_first[depth][a[close]], depth)
        a, b = a[~close], b[~close]
        if depth and len(a):
            i, j = _child_pairs(a, b, first, end)
            todo += [(depth - 1, i[at : at + PAIRS], j[at : at + PAIRS]) for at in range(0, len(i), PAIRS)]
    if not out_a:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(out_a), np.concatenate(out_b)


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest position connected to each position."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        root = root[root]
        if (root == before).all():
            return root


def _edges(group: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    a, b = link(group, prints)
    apart = a != b
    root = _roots(len(prints), a[apart], b[apart])
    moved = np.flatnonzero(root != np.arange(len(prints)))
    return prints[moved].view(np.int64), prints[root[moved]].view(np.int64)


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges of the groups of one partition, sorted by group; slices end where a group ends."""
    held: list[np.ndarray] = []

    def edges(rows: np.ndarray) -> pa.RecordBatch:
        same = (rows[1:, :2] == rows[:-1, :2]).all(axis=1)
        group = np.r_[0, np.cumsum(~same)]
        prints = np.ascontiguousarray(rows[:, 2]).view(np.uint64)
        order = np.lexsort((gray_rank(prints), group))
        u, v = _edges(group[order], prints[order])
        return pa.record_batch([pa.array(u), pa.array(v)], names=["u", "v"])

    size = 0
    for batch in batches:
        held.append(np.column_stack([batch.column(k).to_numpy() for k in range(3)]))
        size += len(held[-1])
        if size >= SLICE_ROWS:
            rows = np.concatenate(held)
            last = (rows[:, :2] == rows[-1, :2]).all(axis=1)
            cut = int(np.flatnonzero(~last)[-1]) + 1 if not last.all() else 0
            if cut:
                yield edges(rows[:cut])
            held, size = [rows[cut:]], len(rows) - cut
    if size:
        yield edges(np.concatenate(held))


def near_duplicates(documents: DataFrame, group_rows: int = GROUP_ROWS) -> DataFrame:
    """One row per row of ``documents``: ``doc_id, fp`` (long), ``component_id``.

    ``documents`` has ``doc_id`` and ``text``; further columns are not read. Components join rows
    whose fingerprints differ in at most 3 bits, through any number of others; ``component_id`` is
    the smallest ``doc_id`` among them. A null or empty text has fingerprint 0 and is linked like
    any other. Rows with a null id take part; their component's id is null if no other row is in
    it. Repeated rows stay; an empty table gives no rows. A fingerprint that many rows share is
    indexed once.
    """
    marked = settle(fingerprints(documents), "simhash")
    prints = settle(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    dealt = _groups(prints, group_rows)
    edges = (
        dealt.repartition("mask", "value")
        .sortWithinPartitions("mask", "value")
        .select("mask", "value", "fp")
        .mapInArrow(_linked, "u long, v long")
    )
    member = components(edges).withColumnRenamed("node", "fp")
    joined = settle(prints.join(member, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root")), "simhash-roots")
    least = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    named = joined.join(least, "root").select(F.col("fp").alias("__fp"), "component_id")
    return marked.join(named, marked["fp"] == named["__fp"]).select("doc_id", "fp", "component_id")


def representatives(documents: DataFrame, group_rows: int = GROUP_ROWS) -> DataFrame:
    """``documents`` without near-duplicates: of each component the row with the smallest id stays.

    Rows that share that id are one document, of which the smallest row by all columns stays; rows
    with a null id, which nothing can stand for, stay all. All columns are kept.
    """
    found = near_duplicates(documents, group_rows)
    lost = small(found.filter("doc_id <> component_id").select(F.col("doc_id").alias("__lost")).distinct())
    rest = documents.join(lost, documents["doc_id"] == lost["__lost"], "left_anti")
    again = found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1 AND doc_id IS NOT NULL")
    again = settle(again.select(F.col("doc_id").alias("__again")), "simhash-again")
    if again.isEmpty():
        return rest
    again = small(again)
    single = rest.join(again, rest["doc_id"] == again["__again"], "left_anti")
    repeated = rest.join(again, rest["doc_id"] == again["__again"], "left_semi")
    whole = F.struct(*[F.col(f"`{c}`") for c in documents.columns])
    repeated = repeated.groupBy("doc_id").agg(F.min(whole).alias("__row")).select("__row.*")
    return single.unionByName(repeated)
