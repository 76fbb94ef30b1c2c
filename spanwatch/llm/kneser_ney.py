"""Quality by the perplexity of an interpolated modified Kneser-Ney model of characters.

The model has order five over characters (one symbol for each of the commonest characters of the
trusted texts, one for all others, one for the start of a text). Tasks count the five-grams of
trusted texts per chunk, Spark sums them by key, and lower orders, discounts, context totals and
probabilities are aggregations and joins of count tables, none of which holds a document.

For scoring, the model is split into shards by the two symbols before the predicted one: all orders
that can answer for a position lie in one shard, so a position is looked up in one shard only. A
shard has at most ``shard_rows`` rows, the proven bound under which it is sent to the tasks; there
are as many shards as the model needs, and each gives partial sums per document that are added up.
Inside a task every distinct five-gram of a chunk is looked up once.

Trusted documents are scored by models without their own fold, all others by the whole model. A
document above the ``quantile`` of the trusted documents of its language and length is rejected; what few
documents cannot tell is taken from all languages (``thresholds``).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanwatch.llm.common import settle, small

ORDER = 5
SYMBOL_BITS = 12
OTHER, START = 0, 1
ALPHABET = (1 << SYMBOL_BITS) - 2
CHUNK_CHARS = 400_000
SHARD_ROWS = 1_500_000
QUANTILE = 0.998
FOLDS = 2
NEAR = 20  # documents at which a median of its own counts as much as the one it is shrunk to
CLASSES = 21  # of length, by powers of two; the last is open
STEPS = 1_000  # of log2 perplexity, per bit


def _points(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Chunks of a text column: first row, code points, and lengths of its texts (null: empty).

    A text longer than a chunk is a chunk of its own.
    """
    rows: list[bytes] = []
    size = first = 0
    for at, value in enumerate(column):
        data = (value.as_py() or "").encode("utf-32-le", "replace")
        if rows and size + len(data) > 4 * CHUNK_CHARS:
            yield first, *_joined(rows)
            rows, size, first = [], 0, at
        rows.append(data)
        size += len(data)
    if rows:
        yield first, *_joined(rows)


def _joined(rows: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(rows), np.uint32), np.array([len(r) // 4 for r in rows])


def _grams(points: np.ndarray, lengths: np.ndarray, symbols: np.ndarray) -> np.ndarray:
    """Key of the five-gram that ends at each character; starts of texts are padded."""
    coded = symbols[np.minimum(points, len(symbols) - 1)]
    pad = ORDER - 1
    place = np.arange(len(points)) + pad * np.repeat(np.arange(1, len(lengths) + 1), lengths)
    line = np.full(len(points) + pad * len(lengths), START, np.int64)
    line[place] = coded
    key = line[place - pad]
    for back in range(pad - 1, -1, -1):
        key = key << SYMBOL_BITS | line[place - back]
    return key


def _symbols_of(alphabet: list[int]) -> np.ndarray:
    """Symbol of each code point, the last entry for all points beyond."""
    table = np.full(max(alphabet, default=0) + 2, OTHER, np.int64)
    table[alphabet] = np.arange(START + 1, START + 1 + len(alphabet))
    return table


def alphabet_of(texts: DataFrame, size: int = ALPHABET) -> list[int]:
    """The ``size`` commonest code points of the column ``text``, ties by number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, points, _ in _points(batch.column(0)):
                point, n = np.unique(points, return_counts=True)
                yield pa.record_batch([pa.array(point.astype(np.int64)), pa.array(n)], names=["point", "n"])

    counts = texts.select("text").mapInArrow(run, "point long, n long").groupBy("point").agg(F.sum("n").alias("n"))
    found = counts.orderBy(F.col("n").desc(), "point").limit(size).collect()
    return sorted(r["point"] for r in found)


def count_grams(texts: DataFrame, alphabet: list[int]) -> DataFrame:
    """``key, n``: five-grams of the column ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbols = _symbols_of(alphabet)
        held: dict[str, np.ndarray] = {"key": np.zeros(0, np.int64), "n": np.zeros(0, np.int64)}
        for batch in batches:
            for _, points, lengths in _points(batch.column(0)):
                code, key = pd.factorize(_grams(points, lengths, symbols))
                keys = np.concatenate([held["key"], key])
                n = np.concatenate([held["n"], np.bincount(code, minlength=len(key))])
                code, key = pd.factorize(keys)
                held = {"key": key, "n": np.bincount(code, n, minlength=len(key)).astype(np.int64)}
                if len(key) > 500_000:
                    yield pa.record_batch([pa.array(held["key"]), pa.array(held["n"])], names=["key", "n"])
                    held = {k: v[:0] for k, v in held.items()}
        yield pa.record_batch([pa.array(held["key"]), pa.array(held["n"])], names=["key", "n"])

    counted = texts.select("text").mapInArrow(run, "key long, n long")
    return counted.groupBy("key").agg(F.sum("n").alias("n"))


def _discounts(counts: DataFrame) -> list[float]:
    """Modified Kneser-Ney discounts for counts 1, 2 and 3 or more.

    Where a count of counts is zero the estimate does not exist and 0.5, 1 and 1.5 stand in.
    """
    n1, n2, n3, n4 = counts.agg(*[F.sum((F.col("n") == k).cast("long")) for k in (1, 2, 3, 4)]).first()
    if not (n1 and n2 and n3 and n4):
        return [0.5, 1.0, 1.5]
    y = n1 / (n1 + 2 * n2)
    found = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    return [min(max(d, 0.05), k - 0.05) for d, k in zip(found, (1, 2, 3), strict=True)]


def train(texts: DataFrame, alphabet: list[int]) -> DataFrame:
    """The model of the column ``text``."""
    return model_of(settle(count_grams(texts, alphabet), "kn-counts"))


def model_of(counts: DataFrame) -> DataFrame:
    """The model of the five-grams ``key, n``: ``length, key, p, rest``.

    ``p`` is the interpolated probability of the last symbol of a gram of that length after the
    others; ``rest`` is the mass that a gram, as a context, leaves to the next shorter order (null
    if it never was one). Length 0 is the empty context.
    """
    levels = {ORDER: counts}
    for length in range(ORDER - 1, 0, -1):
        # Distinct symbols to the left, the continuation count.
        mask = (1 << SYMBOL_BITS * length) - 1
        shorter = levels[length + 1].groupBy(F.col("key").bitwiseAND(F.lit(mask)).alias("key"))
        levels[length] = settle(shorter.agg(F.count(F.lit(1)).alias("n")), "kn-counts")
    below: DataFrame | None = None
    parts = []
    for length in range(1, ORDER + 1):
        d1, d2, d3 = _discounts(levels[length])
        n = F.col("n")
        context = F.shiftright("key", SYMBOL_BITS)
        kinds = [F.sum((n == 1).cast("long")), F.sum((n == 2).cast("long")), F.sum((n > 2).cast("long"))]
        totals = levels[length].groupBy(context.alias("context")).agg(
            F.sum("n").alias("total"), *[k.alias(f"k{i}") for i, k in enumerate(kinds)]
        )
        rest = (F.col("k0") * d1 + F.col("k1") * d2 + F.col("k2") * d3) / F.col("total")
        totals = settle(totals.select("context", "total", rest.alias("rest")), "kn-totals")
        left = F.when(n == 1, n - d1).when(n == 2, n - d2).otherwise(n - d3)
        joined = levels[length].withColumn("context", context).join(totals, "context")
        if below is None:
            lower = F.lit(1.0 / (1 << SYMBOL_BITS))
        else:
            mask = (1 << SYMBOL_BITS * (length - 1)) - 1
            joined = joined.withColumn("suffix", F.col("key").bitwiseAND(F.lit(mask))).join(
                below.select(F.col("key").alias("suffix"), F.col("p").alias("lower")), "suffix"
            )
            lower = F.col("lower")
        below = settle(joined.select("key", (left / F.col("total") + F.col("rest") * lower).alias("p")), "kn-level")
        parts.append((length, below, totals))
    whole = parts[0][2].select(F.lit(0).alias("length"), F.lit(0).cast("long").alias("key"), F.lit(None).cast("double").alias("p"), "rest")
    for length, grams, _ in parts:
        grams = grams.select("key", "p")
        if length < ORDER:
            longer = parts[length][2].select(F.col("context").alias("key"), "rest")
            grams = grams.join(longer, "key", "full")
        else:
            grams = grams.withColumn("rest", F.lit(None).cast("double"))
        whole = whole.unionByName(grams.select(F.lit(length).alias("length"), "key", "p", "rest"))
    return settle(whole, "kn-model")


@dataclass
class Shard:
    """One shard of a model, in sorted arrays by length of gram."""

    number: int
    shards: int
    keys: list[np.ndarray]
    p: list[np.ndarray]
    rest: list[np.ndarray]

    def log2(self, grams: np.ndarray) -> np.ndarray:
        """log2 probability of distinct five-grams; 0 for those of other shards."""
        p = np.full(len(grams), 1.0 / (1 << SYMBOL_BITS))
        p *= np.nan_to_num(self._find(self.rest, 0, np.zeros_like(grams)), nan=1.0)
        for length in range(1, ORDER + 1):
            gram = grams & ((1 << SYMBOL_BITS * length) - 1)
            own = self._find(self.p, length, gram)
            if length > 1:
                rest = self._find(self.rest, length - 1, gram >> SYMBOL_BITS)
                p = p * np.where(np.isnan(rest), 1.0, rest)
            p = np.where(np.isnan(own), p, own)
        return np.where(shard_of(grams, self.shards) == self.number, np.log2(p), 0.0)

    def _find(self, values: list[np.ndarray], length: int, keys: np.ndarray) -> np.ndarray:
        known = self.keys[length]
        if not len(known):
            return np.full(len(keys), np.nan)
        at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
        return np.where(known[at] == keys, values[length][at], np.nan)


def shard_of(grams: np.ndarray, shards: int) -> np.ndarray:
    """By the two symbols before the last."""
    return (grams >> SYMBOL_BITS & ((1 << 2 * SYMBOL_BITS) - 1)) * 2_654_435_761 % (1 << 31) % shards


def shards(model: DataFrame, shard_rows: int = SHARD_ROWS) -> Iterator[Shard]:
    """The model in shards of about ``shard_rows`` rows, fetched one at a time."""
    n = -(-model.count() // shard_rows) or 1
    two = F.lit((1 << 2 * SYMBOL_BITS) - 1)
    place = lambda pair: pair.bitwiseAND(two) * 2_654_435_761 % (1 << 31) % n
    gram, context = F.col("key"), F.shiftright("key", SYMBOL_BITS)
    for k in range(n):
        # As a gram it answers for the context before its last symbol, as a context for itself;
        # grams and contexts of up to one symbol answer for many pairs and go to every shard.
        wanted = (
            (F.col("length") < 2)
            | ((F.col("length") == 2) & F.col("p").isNotNull())
            | (F.col("p").isNotNull() & (place(context) == k))
            | (F.col("rest").isNotNull() & (place(gram) == k))
        )
        rows = (model.filter(wanted) if n > 1 else model).toArrow().to_pandas()
        levels = [rows[rows["length"] == length].sort_values("key") for length in range(ORDER + 1)]
        yield Shard(
            k,
            n,
            [x["key"].to_numpy(np.int64) for x in levels],
            [x["p"].to_numpy(np.float64) for x in levels],
            [x["rest"].to_numpy(np.float64) for x in levels],
        )


def score(documents: DataFrame, model: DataFrame, alphabet: list[int], shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``doc_id, lang, n_symbols, bits`` (log2 perplexity; null for an empty text), one row per row."""
    spark = documents.sparkSession
    kinds = dict(documents.dtypes)
    picked = documents.select("doc_id", "lang", "text")
    parts = []
    for shard in shards(model, shard_rows):
        sent = spark.sparkContext.broadcast(shard)
        parts.append(
            picked.mapInArrow(_scorer(sent, alphabet), f"doc_id {kinds['doc_id']}, lang {kinds['lang']}, n long, log2 double, mark long")
        )
    if len(parts) == 1:
        summed = parts[0]
    else:
        # Rows of one id and text are alike; each counts once in every shard.
        summed = parts[0]
        for part in parts[1:]:
            summed = summed.unionByName(part)
        n = len(parts)
        summed = summed.groupBy("doc_id", "lang", "n", "mark").agg(
            F.sum("log2").alias("log2"), F.count(F.lit(1)).alias("rows")
        )
        copies = (F.col("rows") / n).cast("int")
        summed = summed.withColumn("log2", F.col("log2") / copies).withColumn(
            "copy", F.explode(F.sequence(F.lit(1), copies))
        )
    bits = F.when(F.col("n") > 0, -F.col("log2") / F.col("n"))
    return summed.select("doc_id", "lang", F.col("n").alias("n_symbols"), bits.alias("bits"))


def _scorer(sent, alphabet: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        symbols, shard = _symbols_of(alphabet), sent.value
        for batch in batches:
            texts = batch.column(2)
            sizes, sums = [], []
            for _, points, lengths in _points(texts):
                sizes.append(lengths)
                if not len(points):
                    sums.append(np.zeros(len(lengths)))
                    continue
                code, key = pd.factorize(_grams(points, lengths, symbols))
                row = np.repeat(np.arange(len(lengths)), lengths)
                sums.append(np.bincount(row, shard.log2(key)[code], minlength=len(lengths)))
            mark = [xxhash.xxh64_intdigest(t.as_py() or b"") >> 1 for t in pc.cast(texts, pa.binary())]
            yield pa.record_batch(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(np.concatenate(sizes) if sizes else [], pa.int64()),
                    pa.array(np.concatenate(sums) if sums else [], pa.float64()),
                    pa.array(mark, pa.int64()),
                ],
                names=["doc_id", "lang", "n", "log2", "mark"],
            )

    return run


def _fold() -> Column:
    """By text, so that copies of a text are never in the counts it is scored by."""
    return F.pmod(F.xxhash64(F.coalesce("text", F.lit(""))), F.lit(FOLDS)).cast("int")


def score_held_out(
    documents: DataFrame, trusted: DataFrame, texts: DataFrame, alphabet: list[int], shard_rows: int = SHARD_ROWS
) -> DataFrame:
    """As ``score``; trusted documents by the ``texts`` of the other folds, all others by all of them."""
    counts = [settle(count_grams(texts.filter(_fold() == k), alphabet), "kn-counts") for k in range(FOLDS)]

    def model(folds: list[int]) -> DataFrame:
        whole = counts[folds[0]]
        for k in folds[1:]:
            whole = whole.unionByName(counts[k])
        if len(folds) > 1:
            whole = settle(whole.groupBy("key").agg(F.sum("n").alias("n")), "kn-counts")
        return model_of(whole)

    known = small(trusted)
    found = score(documents.join(known, documents["doc_id"] == known["doc_id"], "left_anti"), model([*range(FOLDS)]), alphabet, shard_rows)
    mine = documents.join(known, documents["doc_id"] == known["doc_id"], "left_semi")
    for k in range(FOLDS):
        others = model([j for j in range(FOLDS) if j != k])
        found = found.unionByName(score(mine.filter(_fold() == k), others, alphabet, shard_rows))
    return found


def length_class() -> Column:
    """Class of ``n_symbols``, by powers of two."""
    return F.least(F.floor(F.log2(F.greatest("n_symbols", F.lit(1)))), F.lit(CLASSES - 1)).cast("int")


def _chain(rows: DataFrame, start: float | None = None) -> list[float]:
    """By class the median of ``x``, shrunk to that of the next shorter class; at most ``CLASSES`` rows come here."""
    found = {r["class"]: r for r in rows.groupBy("class").agg(_percentile("x", 0.5), F.sum("n").alias("n")).collect()}
    held, out = found[min(found)]["x"] if start is None else start, []
    for k in range(CLASSES):
        if k in found:
            held = (found[k]["n"] * found[k]["x"] + NEAR * held) / (found[k]["n"] + NEAR)
        out.append(float(held))
    return out


def _percentile(name: str, share: float) -> Column:
    """Of a column with counts ``n``; its state is one entry per value, combined before the shuffle."""
    return F.percentile(name, share, F.col("n")).alias(name)


def _shrunk(own: str, n: str, to: Column, weight: float) -> Column:
    count = F.coalesce(n, F.lit(0))
    return (count * F.coalesce(own, F.lit(0)) + weight * to) / (count + weight)


def thresholds(scores: DataFrame, trusted: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """``lang, class, limit_bits``: per language and class of length, and as null language for all others.

    One rule for every number of trusted documents: the limit is a centre (the class's median, the
    language's distance from it, and that of language and class) and, above it, a number of scatters
    (the class's median distance from the centre). That number is the quantile over all trusted
    documents, to which a language and class's own is shrunk by count, 1 / (1 - quantile) documents
    weighing as much. Medians are shrunk with the weight of ``NEAR`` documents, and so is a
    language's limit to the one of all languages. Scores are counted in steps of 1/1000 bit, so no
    language's scores are sorted or gathered.
    """
    step = F.round(F.col("bits") * STEPS).cast("long")
    mine = scores.filter("bits IS NOT NULL").join(trusted, "doc_id", "left_semi")
    mine = mine.select("lang", length_class().alias("class"), step.alias("step"))
    counts = settle(mine.groupBy("lang", "class", "step").agg(F.count(F.lit(1)).alias("n")), "kn-steps")
    of = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), F.col("class") + 1)
    centre = of(_chain(counts.withColumn("x", F.col("step"))))
    apart = counts.withColumn("apart", F.col("step") - centre)
    langs = apart.filter("lang IS NOT NULL").withColumn("off", F.col("apart")).groupBy("lang")
    langs = F.broadcast(settle(langs.agg(_percentile("off", 0.5), F.sum("n").alias("n_lang")), "kn-langs"))
    cells = apart.join(langs, "lang").withColumn("cell", F.col("apart") - F.col("off")).groupBy("lang", "class")
    cells = cells.agg(_percentile("cell", 0.5), F.sum("n").alias("n_cell"))
    cells = cells.withColumn("cell", _shrunk("cell", "n_cell", F.lit(0), NEAR))
    cells = F.broadcast(settle(cells, "kn-cells"))
    rest = F.col("apart") - F.coalesce("off", F.lit(0)) - F.coalesce("cell", F.lit(0))
    rest = settle(apart.join(langs, "lang", "left").join(cells, ["lang", "class"], "left").withColumn("rest", rest), "kn-rest")
    wide = rest.withColumn("x", F.abs("rest"))
    scatter = of([max(x, 1.0) for x in _chain(wide, wide.agg(_percentile("x", 0.5)).first()["x"])])
    tails = rest.withColumn("tail", F.col("rest") / scatter).withColumn("all", F.col("apart") / scatter)
    tail, every = tails.agg(_percentile("tail", quantile), _percentile("all", quantile)).first()
    own = tails.filter("lang IS NOT NULL").groupBy("lang", "class").agg(_percentile("tail", quantile))
    classes = scores.sparkSession.range(CLASSES).select(F.col("id").cast("int").alias("class"))
    limit_all = centre + scatter * every
    whole = langs.crossJoin(classes).join(cells, ["lang", "class"], "left").join(own, ["lang", "class"], "left")
    tail = _shrunk("tail", "n_cell", F.lit(tail), 1 / (1 - quantile) if quantile < 1 else 1)
    whole = whole.withColumn("limit", centre + F.col("off") + F.coalesce("cell", F.lit(0)) + scatter * tail)
    bits = lambda limit: ((limit + 1) / STEPS).alias("limit_bits")
    return whole.select("lang", "class", bits(_shrunk("limit", "n_lang", limit_all, NEAR))).unionByName(
        classes.select(F.lit(None).cast("string").alias("lang"), "class", bits(limit_all))
    )


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Ids labelled good and never bad or toxic. Null labels count as neither."""
    marks = labels.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.min("quality").alias("quality"), F.max("toxic").alias("toxic")
    )
    return marks.filter("quality = 1 AND coalesce(toxic, 0) = 0").select("doc_id")


def classify(
    documents: DataFrame, labels: DataFrame, quantile: float = QUANTILE, shard_rows: int = SHARD_ROWS
) -> DataFrame:
    """One row per row of ``documents``: ``doc_id, lang, n_symbols, bits, limit_bits, kept``.

    Trusted text are the documents that ``labels`` (doc_id, quality, toxic) call good; without any,
    or without any text, nothing can be judged and all documents are kept. An empty or null text
    has no perplexity and is rejected then too. A null language is judged by the limit of all.
    Repeated rows stay; an empty table gives no rows; further columns are not read.
    """
    trusted = settle(trusted_ids(labels), "kn-trusted")
    texts = documents.select("doc_id", "text").join(small(trusted), "doc_id", "left_semi").filter("text <> ''")
    alphabet = alphabet_of(texts)
    if not alphabet:
        return documents.select(
            "doc_id",
            "lang",
            F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n_symbols"),
            F.lit(None).cast("double").alias("bits"),
            F.lit(None).cast("double").alias("limit_bits"),
            F.coalesce(F.length("text") > 0, F.lit(False)).alias("kept"),
        )
    scores = settle(score_held_out(documents, trusted, texts, alphabet, shard_rows), "kn-scores")
    limits = settle(thresholds(scores, trusted, quantile), "kn-limits")
    every = {r["class"]: r["limit_bits"] for r in limits.filter("lang IS NULL").collect()}
    every = F.element_at(F.array(*[F.lit(every[k]) for k in range(CLASSES)]), length_class() + 1)
    own = limits.filter("lang IS NOT NULL").select(F.col("lang").alias("__lang"), F.col("class").alias("__class"), "limit_bits")
    limit = F.coalesce("limit_bits", every)
    return scores.join(small(own), (F.col("lang") == F.col("__lang")) & (length_class() == F.col("__class")), "left").select(
        "doc_id",
        "lang",
        "n_symbols",
        "bits",
        limit.alias("limit_bits"),
        F.coalesce(F.col("bits") <= limit, F.lit(False)).alias("kept"),
    )


def keep_good(documents: DataFrame, labels: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """``documents`` without those rejected; all columns are kept. Rows with a null id are kept.

    Rows that share an id stay or go together: one accepted row keeps them.
    """
    judged = classify(documents, labels, quantile)
    bad = judged.groupBy("doc_id").agg(F.max("kept").alias("kept")).filter("NOT kept AND doc_id IS NOT NULL")
    bad = small(settle(bad.select(F.col("doc_id").alias("__bad")), "kn-rejected"))
    return documents.join(bad, documents["doc_id"] == bad["__bad"], "left_anti")
