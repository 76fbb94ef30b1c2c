"""Benchmark decontamination by greedy string tiling.

Tokens are runs of letters and digits in lower case, hashed to 64 bits. A document and a test item
can share a tile of ``tile`` tokens only if they share a token run of that length, so runs are the
seeds. Karp-Rabin hashes of all runs of the items fill a bit array of fixed size, which goes to all
tasks; a document gives on only the stretches of tokens whose runs may occur in an item, which for
most documents are none. Their runs are joined with those of the items; each pair found is tiled:
longest common stretches of unmarked tokens are marked, longest first. The next length is found by
halving: running Karp-Rabin hashes of a length tell whether any stretch of it is common. As tiles may lie in any order, reordered passages count.
The share of an item's tokens that is tiled is its coverage.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanwatch.llm.common import settle, small

TILE = 5
COVERAGE = 0.5
FILTER_BITS = 25
_BASE = np.uint64(0x9E3779B97F4A7C15)
_TOKEN = regex.compile(r"[\p{L}\p{N}\p{M}]+")


def token_hashes(text: str | None, known: dict[str, int]) -> np.ndarray:
    """64-bit hashes of the tokens; ``known`` remembers up to a million words."""
    found = _TOKEN.findall(text.lower()) if text else []
    if len(known) > 1_000_000:
        known.clear()
    out = []
    for token in found:
        value = known.get(token)
        if value is None:
            value = known[token] = xxhash.xxh64_intdigest(token)
        out.append(value)
    return np.array(out, np.uint64)


def run_hashes(tokens: np.ndarray, length: int) -> np.ndarray:
    """Karp-Rabin hashes, modulo 2^64, of all runs of ``length`` tokens, by doubling."""
    n = len(tokens) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    done, block, size, power = 0, tokens, 1, _BASE
    with np.errstate(over="ignore"):
        while True:
            if length & size:
                scale = np.uint64(pow(int(_BASE), size, 1 << 64))
                out = out * scale + block[done : done + n]
                done += size
            if done == length:
                return _mixed(out)
            block = block[: len(block) - size] * power + block[size:]
            power = np.uint64(pow(int(power), 2, 1 << 64))
            size *= 2


def _mixed(h: np.ndarray) -> np.ndarray:
    """Spreads a hash over all bits."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def tiles(item: np.ndarray, stretches: list[np.ndarray], tile: int) -> list[tuple[int, int, int]]:
    """Greedy tiles ``(start in item, start in text, length)``, longest first, at least ``tile`` long.

    The text is the stretches in order; no tile crosses from one to the next. Of tiles of one
    length, those that start first in the item, then in the text, are marked first.
    """
    text = np.concatenate(stretches) if stretches else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(stretches)), [len(s) for s in stretches])
    free_item, free_text = np.ones(len(item), bool), np.ones(len(text), bool)
    out: list[tuple[int, int, int]] = []

    def runs(length: int) -> tuple[np.ndarray, np.ndarray]:
        """Free runs (start, hash) of both sides whose hashes the other side has too."""
        left = _free_runs(run_hashes(item, length), free_item, length)
        right = _free_runs(run_hashes(text, length), free_text, length)
        begin = right[:, 0].astype(np.int64)
        right = right[owner[begin] == owner[begin + length - 1]]
        left = left[np.isin(left[:, 1], right[:, 1])]
        return left, right[np.isin(right[:, 1], left[:, 1])]

    most = min(len(item), max((len(s) for s in stretches), default=0))
    while most >= tile:
        # The greatest length of a common run: each run holds all shorter ones.
        length, found = tile, runs(tile)
        if not len(found[0]):
            break
        while length < most:
            middle = (length + most + 1) // 2
            longer = runs(middle)
            if len(longer[0]):
                length, found = middle, longer
            else:
                most = middle - 1
        left, right = found
        where: dict[int, list[int]] = {}
        for start, h in right.tolist():
            where.setdefault(h, []).append(start)
        for start, h in left.tolist():
            for other in where.get(h, ()):
                if not free_item[start : start + length].all():
                    break
                if free_text[other : other + length].all() and (
                    item[start : start + length] == text[other : other + length]
                ).all():
                    free_item[start : start + length] = False
                    free_text[other : other + length] = False
                    out.append((start, other, length))
                    break
        # The next length worth trying: no longer than what is left on both sides.
        most = min(length - 1, _longest(free_item), _longest(free_text))
    return out


def _longest(free: np.ndarray) -> int:
    edge = np.flatnonzero(np.diff(np.r_[False, free, False]))
    return int((edge[1::2] - edge[::2]).max(initial=0))


def _free_runs(hashes: np.ndarray, free: np.ndarray, length: int) -> np.ndarray:
    """Rows (start, hash) of the runs without a marked token."""
    if not len(hashes):
        return np.zeros((0, 2), np.uint64)
    taken = np.r_[0, np.cumsum(~free)]
    at = np.flatnonzero(taken[length:] == taken[: len(taken) - length])
    return np.column_stack([at.astype(np.uint64), hashes[at]])


def item_runs(benchmark: DataFrame, tile: int = TILE) -> tuple[DataFrame, DataFrame]:
    """Items as ``item_id, tokens`` and their distinct runs as ``run, item_id``.

    Items shorter than ``tile`` have one run, all their tokens; those without tokens none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}
        for batch in batches:
            tokens = [token_hashes(t.as_py(), known) for t in batch.column(1)]
            runs = [np.unique(run_hashes(t, min(tile, len(t)) or 1)) for t in tokens]
            yield pa.record_batch(
                [
                    batch.column(0),
                    pa.array([t.view(np.int64) for t in tokens], pa.list_(pa.int64())),
                    pa.array([r.view(np.int64) for r in runs], pa.list_(pa.int64())),
                ],
                names=["item_id", "tokens", "runs"],
            )

    kind = dict(benchmark.dtypes)["item_id"]
    whole = benchmark.select("item_id", "text").filter("item_id IS NOT NULL").mapInArrow(
        run, f"item_id {kind}, tokens array<long>, runs array<long>"
    )
    whole = settle(whole, "tiling-items")
    return (
        whole.filter("size(tokens) > 0").select("item_id", "tokens"),
        whole.select(F.explode("runs").alias("run"), "item_id").distinct(),
    )


def _filter(runs: DataFrame, bits: int) -> np.ndarray:
    """A bit array of ``2**bits`` with a bit for each run: a fixed size, whatever the items are."""
    word = F.shiftrightunsigned("run", 64 - bits)
    words = runs.groupBy(F.shiftright(word, 6).alias("word")).agg(
        F.expr(f"bit_or(shiftleft(1L, cast(shiftrightunsigned(run, {64 - bits}) & 63 as int)))").alias("bits")
    )
    out = np.zeros(1 << (bits - 6), np.int64)
    for batch in words.toArrow().to_batches():
        out[batch.column(0).to_numpy()] = batch.column(1).to_numpy()
    return out.view(np.uint64)


def stretches_of(documents: DataFrame, runs: DataFrame, short: list[int], tile: int = TILE, bits: int = FILTER_BITS) -> DataFrame:
    """``doc_id, alone, stretches, runs``: only rows with tokens whose runs may occur in an item.

    ``alone`` is a digest of the text where ``doc_id`` is null, so that such rows stay apart. ``short`` lists the lengths below ``tile`` of items that are shorter.
    """
    sent = documents.sparkSession.sparkContext.broadcast(_filter(runs, bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}
        table = sent.value

        def may(h: np.ndarray) -> np.ndarray:
            place = h >> np.uint64(64 - bits)
            return table[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63)) & np.uint64(1) > 0

        for batch in batches:
            rows, found, seeds = [], [], []
            for row, text in enumerate(batch.column(2)):
                tokens = token_hashes(text.as_py(), known)
                own, cut = [], []
                for length in [tile, *short]:
                    h = run_hashes(tokens, length)
                    hit = may(h)
                    if hit.any():
                        own.append(h[hit])
                        cut.append((hit, length))
                if own:
                    inside = np.zeros(len(tokens) + 1, np.int64)
                    for hit, length in cut:
                        at = np.flatnonzero(hit)
                        np.add.at(inside, at, 1)
                        np.add.at(inside, at + length, -1)
                    covered = np.cumsum(inside)[:-1] > 0
                    edge = np.flatnonzero(np.diff(np.r_[False, covered, False]))
                    rows.append(row)
                    found.append([tokens[a:b].view(np.int64) for a, b in zip(edge[::2], edge[1::2], strict=True)])
                    seeds.append(np.unique(np.concatenate(own)).view(np.int64))
            if rows:
                yield pa.record_batch(
                    [
                        batch.column(0).take(pa.array(rows)),
                        batch.column(1).take(pa.array(rows)),
                        pa.array(found, pa.list_(pa.list_(pa.int64()))),
                        pa.array(seeds, pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "alone", "stretches", "runs"],
                )

    kind = dict(documents.dtypes)["doc_id"]
    alone = F.when(F.col("doc_id").isNull(), _digest()).alias("alone")
    return documents.select("doc_id", alone, "text").mapInArrow(
        run, f"doc_id {kind}, alone string, stretches array<array<long>>, runs array<long>"
    )


def _digest() -> Column:
    """What a row without an id is known by: rows with one text have one verdict."""
    return F.sha2(F.col("text"), 256)


def coverages(documents: DataFrame, benchmark: DataFrame, tile: int = TILE) -> DataFrame:
    """``row, doc_id, alone, item_id, covered, n_tokens``: pairs that share a run of ``tile`` tokens.

    ``row`` tells rows of one ``doc_id`` apart, ``alone`` is a digest of the text of a row without one.
    """
    items, runs = item_runs(benchmark, tile)
    lengths = items.select(F.size("tokens").alias("n")).filter(F.col("n") < tile).distinct().collect()
    short = sorted(r["n"] for r in lengths)
    cut = stretches_of(documents, runs, short, tile)
    # The id of a row must not change when a task is repeated: it is written here.
    cut = settle(cut.withColumn("row", F.monotonically_increasing_id()), "tiling-stretches")
    pairs = (
        cut.select("row", F.explode("runs").alias("run")).join(runs, "run").select("row", "item_id").distinct()
    )
    joined = (
        pairs.join(cut.select("row", "doc_id", "alone", "stretches"), "row")
        .join(small(items, 100_000), "item_id")
        .select("row", "doc_id", "alone", "item_id", "tokens", "stretches")
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            covered = [
                sum(t[2] for t in tiles(
                    np.asarray(item, np.int64).view(np.uint64),
                    [np.asarray(s, np.int64).view(np.uint64) for s in text],
                    min(tile, len(item)),
                ))
                for item, text in zip(batch["tokens"], batch["stretches"], strict=True)
            ]
            out = batch[["row", "doc_id", "alone", "item_id"]].copy()
            out["covered"], out["n_tokens"] = covered, batch["tokens"].map(len)
            yield out

    kinds = dict(documents.dtypes), dict(benchmark.dtypes)
    return joined.mapInPandas(
        run,
        f"row long, doc_id {kinds[0]['doc_id']}, alone string, item_id {kinds[1]['item_id']}, "
        "covered long, n_tokens long",
    )


def contamination(
    documents: DataFrame, benchmark: DataFrame, tile: int = TILE, coverage: float = COVERAGE
) -> DataFrame:
    """One row per row of ``documents``: ``doc_id, item_id, coverage, n_items, contaminated``.

    ``item_id`` is the item best covered (ties: the smallest), ``coverage`` its covered share,
    ``n_items`` the number of items covered to at least ``coverage``; null, 0 and 0 without a
    shared run. Contaminated is a document with such an item. Rows of one ``doc_id`` are one document;
    rows with a null ``doc_id`` are judged each by its own text. Null or empty texts and items have no
    tokens and match nothing; items with a null id are left out. Repeated items count once each; repeated rows stay. An empty table gives
    no rows. Further columns are not read.
    """
    share = F.col("covered") / F.col("n_tokens")
    found = (
        settle(coverages(documents, benchmark, tile), "tiling-coverages")
        .withColumn("share", share)
        .groupBy("row", "doc_id", "alone")
        .agg(
            F.min(F.struct(F.negate("share").alias("short"), "item_id")).alias("best"),
            F.countDistinct(F.when(F.col("share") >= coverage, F.col("item_id"))).alias("n_items"),
        )
        .groupBy("doc_id", "alone")
        .agg(F.min("best").alias("best"), F.max("n_items").alias("n_items"))
    )
    found = settle(found, "tiling-found")
    named = found.filter("doc_id IS NOT NULL").select(F.col("doc_id").alias("__doc"), "best", "n_items")
    nameless = found.filter("doc_id IS NULL").select("alone", "best", "n_items")
    known = documents.filter("doc_id IS NOT NULL").select("doc_id")
    unknown = documents.filter("doc_id IS NULL").select("doc_id", _digest().alias("digest"))
    judged = known.join(small(named), F.col("doc_id") == F.col("__doc"), "left").select("doc_id", "best", "n_items")
    rest = unknown.join(small(nameless), F.col("digest") == F.col("alone"), "left").select("doc_id", "best", "n_items")
    return judged.unionByName(rest).select(
        "doc_id",
        F.col("best.item_id").alias("item_id"),
        F.coalesce(-F.col("best.short"), F.lit(0.0)).alias("coverage"),
        F.coalesce("n_items", F.lit(0)).alias("n_items"),
        (F.coalesce("n_items", F.lit(0)) > 0).alias("contaminated"),
    )


def decontaminate(
    documents: DataFrame, benchmark: DataFrame, tile: int = TILE, coverage: float = COVERAGE
) -> DataFrame:
    """``documents`` without the contaminated ones, see ``contamination``; all columns are kept.

    Of the rows with a null ``doc_id`` those go whose own text is contaminated; rows with a null or
    empty text stay, unless another row of their id is contaminated.
    """
    share = F.col("covered") / F.col("n_tokens")
    bad = coverages(documents, benchmark, tile).filter(share >= coverage).select("doc_id", "alone").distinct()
    bad = settle(bad, "tiling-bad")
    named = small(bad.filter("doc_id IS NOT NULL").select(F.col("doc_id").alias("__bad")))
    nameless = small(bad.filter("doc_id IS NULL").select(F.col("alone").alias("__bad")))
    known, unknown = documents.filter("doc_id IS NOT NULL"), documents.filter("doc_id IS NULL")
    kept = known.join(named, known["doc_id"] == named["__bad"], "left_anti")
    return kept.unionByName(unknown.join(nameless, _digest() == nameless["__bad"], "left_anti"))
