"""Mixing sources to target weights by entropy balancing. DataFrame functions only.

Every document d of source s and length class c gets a rate 0 < r_d < cap. The rates minimise
sum size_d (r_d ln r_d + (cap - r_d) ln(cap - r_d)), the entropy of words taken and left, under
token constraints that overlap: the words of each source are its target, and each length class
keeps the share of the words that it has in the corpus. Sources hold exactly; class shares may miss
at a price (``slack``), as a source that is taken whole can make them impossible.

The dual is concave in one multiplier for each source and each class, and its solution tilts all
documents exponentially: r / (cap - r) = exp(l_s + m_c). Given the class multipliers, a source's own
follows by halving an interval in the row of the source. Newton's steps are for the classes: gradient
and Hessian of what is left, with the sources eliminated, are summed over all sources in one
distributed aggregation for each step; the driver sees 8 + 64 sums and solves the small system. A
step is halved until the dual rises; the rounds end by the gradient. The dual depends on documents
only through the words of each source and class, so these are summed once.

Rates become copies: floor(r), and one more for documents whose priority is below a threshold of
the source. The priority is u / (u + f), u a keyed hash and f the rest of the rate, so documents go
by u / f (sequential Poisson sampling). The threshold is where the sizes summed in that order reach the
rest of the target, found digit by digit with three aggregations over (source, digit): no source is
sorted or gathered, and the words taken miss a target by half a document at most. The hash depends
on seed, doc_id and text, and for rows alike in these on a number among them; reruns agree.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanwatch.llm.common import settle, small, word_count

DIGIT_BITS = 12
DIGITS = 3
HASH_BITS = DIGIT_BITS * DIGITS
# Length classes by powers of four words; the last has all longer texts.
CLASSES = 8
# Price of a class share that is missed; smaller holds the shares tighter.
SLACK = 0.02
# Most sources of a plan that is sent to all executors; a row of it has eight rates.
PLAN_ROWS = 200_000
# Copies of one row that are made in one task.
LOT = 1_000


def _class_of(size: Column) -> Column:
    return sum([(size >= 4**k).cast("int") for k in range(2, CLASSES)], (size >= 4).cast("int"))


def _numbered(sized: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``sized`` with ``nth``, the number of a row among those alike, and ``id0, id1`` of rows that have any.

    Rows alike are numbered within their split, splits follow each other: a row repeated by the million
    is spread over all splits that hold it. Rows without another are not moved again.
    """
    alike = ["id0", "id1"]
    sized = settle(sized.withColumn("split", F.spark_partition_id()), "mix-sizes")
    repeated = settle(
        sized.groupBy(*alike).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(*alike), "mix-repeated"
    )
    single = sized.join(small(repeated), alike, "left_anti").withColumn("nth", F.lit(1).cast("long"))
    within = F.row_number().over(Window.partitionBy(*alike, "split").orderBy("size"))
    many = sized.join(small(repeated), alike, "left_semi").withColumn("within", within)
    counts = many.groupBy(*alike, "split").agg(F.count(F.lit(1)).alias("n"))
    # One row for each split that holds one of the rows alike.
    before = F.sum("n").over(Window.partitionBy(*alike).orderBy("split")) - F.col("n")
    many = many.join(counts.withColumn("before", before), [*alike, "split"])
    many = many.withColumn("nth", F.col("before") + F.col("within"))
    columns = [c for c in sized.columns if c != "split"] + ["nth"]
    return single.select(*columns).unionByName(many.select(*columns)), repeated


def _ranked(sources: DataFrame) -> DataFrame:
    """``sources`` with ``place`` in code-point order, null last: ranges, and how many are before each."""
    order = F.col("source").asc_nulls_last()
    ranged = settle(sources.repartitionByRange(order).withColumn("range", F.spark_partition_id()), "mix-sources")
    # One row for each range.
    before = ranged.groupBy("range").agg(F.count(F.lit(1)).alias("n")).withColumnRenamed("range", "r")
    before = before.withColumn("before", F.sum("n").over(Window.orderBy("r")) - F.col("n"))
    within = F.row_number().over(Window.partitionBy("range").orderBy(order)) - 1
    ranged = ranged.withColumn("within", within)
    return ranged.join(before, F.col("range") == F.col("r")).select(
        *sources.columns, (F.col("before") + F.col("within")).alias("place")
    )


def source_targets(sizes: DataFrame, weights: Sequence[int], budget: float, cap: float) -> DataFrame:
    """One row per source: ``source, source_size, masses, target``.

    ``sizes`` has ``source, size, class``; ``masses`` are the words of each length class. Weights
    repeat over the sources in code-point order, null last. Targets share ``budget`` times all sizes by
    weight; one above ``cap`` times its source's size stops there and the rest is shared again, until
    none is above.
    """
    mass = [F.sum(F.when(F.col("class") == c, F.col("size")).otherwise(0)).cast("double") for c in range(CLASSES)]
    sources = _ranked(
        sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.array(*mass).alias("masses"))
    )
    listed = F.array(*[F.lit(int(w)) for w in weights])
    weight = F.element_at(listed, (F.col("place") % len(weights) + 1).cast("int"))
    sources = settle(sources.withColumn("weight", weight).drop("place"), "mix-sources")
    limit = F.lit(float(cap)) * F.col("source_size")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level, full = 0.0, -1
    while True:
        above = limit <= F.lit(level) * F.col("weight")
        capped, free, n = sources.agg(
            F.coalesce(F.sum(F.when(above, limit)), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0)),
            F.coalesce(F.sum(above.cast("int")), F.lit(0)),
        ).first()
        if n == full or not free:
            break
        full, level = n, (budget * total - capped) / free
    target = F.least(limit, F.lit(level) * F.col("weight"))
    return sources.select("source", "source_size", "masses", target.alias("target"))


def _logistic(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def _source_multiplier(mu: Sequence[float], cap: float, rounds: int = 64) -> Column:
    """The multiplier at which a source's words are its target, given those of the classes.

    The share taken rises with it, and lies between the shares for the least and the largest ``mu``.
    """
    share = F.col("target") / (F.lit(cap) * F.col("source_size"))
    middle = F.log(share / (F.lit(1.0) - share))
    bounds = F.struct((middle - max(mu) - 1e-9).alias("low"), (middle - min(mu) + 1e-9).alias("high"))
    tilts = F.array(*[F.lit(float(m)) for m in mu])

    def taken(l: Column) -> Column:  # noqa: E741
        words = F.zip_with("masses", tilts, lambda m, t: m * F.lit(cap) * _logistic(l + t))
        return F.aggregate(words, F.lit(0.0), lambda a, b: a + b)

    def halve(state: Column, _: Column) -> Column:
        half = (state["low"] + state["high"]) / 2
        less = taken(half) < F.col("target")
        return F.struct(
            F.when(less, half).otherwise(state["low"]).alias("low"),
            F.when(less, state["high"]).otherwise(half).alias("high"),
        )

    steps = F.sequence(F.lit(1), F.lit(rounds))
    return F.aggregate(steps, bounds, halve, lambda s: (s["low"] + s["high"]) / 2)


def _open(cap: float) -> Column:
    """Sources with a choice: something to take, and not all of it."""
    whole = F.lit(cap) * F.col("source_size")
    return (F.col("target") > 0) & (F.col("target") < whole * (1 - 1e-12))


def _dual(targets: DataFrame, mu: np.ndarray, cap: float) -> tuple[float, np.ndarray, np.ndarray]:
    """Of the dual over all open sources: its value, the words taken of each class, and the Hessian's part.

    Each is a sum over sources; ``CLASSES`` + ``CLASSES`` squared + 1 numbers reach the driver.
    """
    rows = targets.filter(_open(cap)).withColumn("l", _source_multiplier(mu.tolist(), cap))
    tilts = [F.col("l") + F.lit(float(m)) for m in mu]
    part = [_logistic(x) for x in tilts]
    # ln(1 + exp(x))
    rise = [F.greatest(x, F.lit(0.0)) + F.log1p(F.exp(-F.abs(x))) for x in tilts]
    mass = [F.get("masses", F.lit(c)) for c in range(CLASSES)]
    rows = rows.select(
        "target",
        "l",
        *[(mass[c] * cap * part[c]).alias(f"t{c}") for c in range(CLASSES)],
        *[(mass[c] * cap * part[c] * (1 - part[c])).alias(f"w{c}") for c in range(CLASSES)],
        sum([mass[c] * cap * rise[c] for c in range(CLASSES)], F.lit(0.0)).alias("f"),
    )
    rows = rows.withColumn("d", F.greatest(F.lit(1e-300), sum([F.col(f"w{c}") for c in range(1, CLASSES)], F.col("w0"))))
    pairs = [(a, b) for a in range(CLASSES) for b in range(a, CLASSES)]
    sums = rows.agg(
        F.sum(F.col("l") * F.col("target") - F.col("f")),
        *[F.sum(f"t{c}") for c in range(CLASSES)],
        *[F.sum(f"w{c}") for c in range(CLASSES)],
        *[F.sum(F.col(f"w{a}") * F.col(f"w{b}") / F.col("d")) for a, b in pairs],
    ).first()
    value, *rest = [s or 0.0 for s in sums]
    taken, own, crossed = rest[:CLASSES], rest[CLASSES : 2 * CLASSES], rest[2 * CLASSES :]
    hessian = np.diag(own).astype(float)
    for (a, b), c in zip(pairs, crossed):
        hessian[a, b] -= c
        if a != b:
            hessian[b, a] -= c
    return value, np.array(taken), hessian


def class_multipliers(targets: DataFrame, cap: float, slack: float = SLACK, rounds: int = 50) -> list[float]:
    """Newton's steps on the dual: the multipliers of the length classes.

    Stops when no class misses its condition by more than 1e-9 of all words, or after ``rounds``.
    """
    sums = targets.agg(
        F.sum("target"),
        F.sum("source_size"),
        *[F.sum(F.get("masses", F.lit(c))) for c in range(CLASSES)],
        *[F.sum(F.when(~_open(cap), F.try_divide(F.get("masses", F.lit(c)) * F.col("target"), F.col("source_size")))) for c in range(CLASSES)],
    ).first()
    wanted, total, *rest = [s or 0.0 for s in sums]
    mu = np.zeros(CLASSES)
    if not total or not wanted:
        return mu.tolist()
    goal = wanted * np.array(rest[:CLASSES]) / total - np.array(rest[CLASSES:])
    price = slack * total

    def at(mu: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        value, taken, hessian = _dual(targets, mu, cap)
        return value + goal @ mu - price / 2 * mu @ mu, goal - taken - price * mu, hessian + price * np.eye(CLASSES)

    value, gradient, hessian = at(mu)
    for _ in range(rounds):
        if np.abs(gradient).max() <= 1e-9 * total:
            break
        step = np.linalg.solve(hessian, gradient)
        for _ in range(30):
            tried = at(mu + step)
            if tried[0] >= value - 1e-12 * abs(value):
                break
            step = step / 2
        mu = mu + step
        value, gradient, hessian = tried
    return mu.tolist()


def tilt(targets: DataFrame, cap: float = 2.0, slack: float = SLACK) -> DataFrame:
    """``targets`` with ``rates``, one for each length class; an empty target has 0, a full one ``cap``."""
    mu = class_multipliers(targets, cap, slack)
    solved = targets.withColumn("l", F.when(_open(cap), _source_multiplier(mu, cap)))
    tilted = F.array(*[F.lit(cap) * _logistic(F.col("l") + F.lit(m)) for m in mu])
    same = F.array_repeat(F.when(F.col("target") > 0, F.lit(float(cap))).otherwise(F.lit(0.0)), CLASSES)
    # Sums over sources may differ in their last bits from run to run; rates do not.
    near = F.transform(tilted, lambda r: F.round(r, 9))
    return solved.withColumn("rates", F.when(_open(cap), near).otherwise(same)).drop("l")


def _thresholds(keyed: DataFrame, rated: DataFrame) -> DataFrame:
    """``source, below``: the priority below which a document of the source has one copy more.

    ``keyed`` has ``source, size, key``.
    """
    whole = F.aggregate(
        F.zip_with("masses", "rates", lambda m, r: m * F.floor(r)), F.lit(0.0), lambda a, b: a + b
    )
    rest = F.col("target") - whole
    state = settle(
        rated.select(
            "source",
            F.when(rest > F.col("target") * 1e-9, rest).otherwise(0.0).alias("need"),
            F.lit(0).cast("long").alias("prefix"),
            F.lit(0).cast("long").alias("last_size"),
        ),
        "mix-state",
    )
    for digit in range(1, DIGITS + 1):
        shift = HASH_BITS - digit * DIGIT_BITS
        current = small(state.select(F.col("source").alias("s"), "prefix", "need").filter("need > 0"))
        sums = (
            keyed.join(
                current,
                F.col("source").eqNullSafe(F.col("s"))
                & (F.shiftright("key", shift + DIGIT_BITS) == F.col("prefix")),
            )
            .groupBy("source", "need", F.shiftright("key", shift).alias("bucket"))
            .agg(F.sum("size").alias("size"))
        )
        # At most 4,096 rows for a source.
        running = Window.partitionBy("source").orderBy("bucket")
        crossed = (
            sums.withColumn("through", F.sum("size").over(running))
            .filter(F.col("through") >= F.col("need") - 1e-6)
            .groupBy("source")
            .agg(F.min_by(F.struct("bucket", "size", "through"), "bucket").alias("at"))
        )
        state = settle(
            state.join(crossed.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")), "left").select(
                "source",
                F.when(F.col("at").isNotNull(), F.col("need") - (F.col("at.through") - F.col("at.size")))
                .otherwise(F.lit(0.0))
                .alias("need"),
                F.coalesce(F.col("at.bucket"), F.shiftleft("prefix", DIGIT_BITS)).alias("prefix"),
                F.coalesce(F.col("at.size"), F.lit(0)).cast("long").alias("last_size"),
            ),
            "mix-state",
        )
    # The bucket that crosses the target is taken if that comes nearer.
    below = F.col("prefix") + F.when(F.col("need") * 2 > F.col("last_size"), 1).otherwise(0)
    return state.select("source", below.alias("below"))


def _identity(columns: Sequence[str], seed: int) -> list[Column]:
    """Two 64-bit hashes of the columns; rows that agree in both are taken for the same."""
    cells = [F.col(f"`{c}`") for c in columns]
    empty = F.concat(*[F.isnull(c).cast("string") for c in cells])
    return [F.xxhash64(F.lit(seed + k), empty, *cells).alias(f"id{k}") for k in (0, 1)]


def _hashes(columns: Sequence[str], seed: int) -> list[Column]:
    """``id0, id1`` of id, source and text, which decide about a row, and ``whole`` of all ``columns``."""
    return [*_identity(["doc_id", "source", "text"], seed), _identity(columns, seed)[0].alias("whole")]


def _copies() -> Column:
    """Copies of a row with ``id0, id1, nth, class`` and its source's ``rates`` and ``below``."""
    return F.floor(_rate()) + (_key() < F.col("below")).cast("long")


def _rate() -> Column:
    return F.get("rates", F.col("class"))


def _key() -> Column:
    u = F.shiftrightunsigned(F.xxhash64("id0", "id1", "nth"), 12).cast("double") / F.lit(float(2**52))
    u = F.greatest(u, F.lit(2.0**-60))
    key = (u / (u + _rate() - F.floor(_rate())) * F.lit(float(2**HASH_BITS))).cast("long")
    return F.least(key, F.lit(2**HASH_BITS - 1))


def _planned(documents: DataFrame, columns: Sequence[str], weights, budget, cap, seed) -> tuple[DataFrame, ...]:
    """Documents (``doc_id, source, size, class, id0, id1, whole, nth``), sources and rows that have others alike.

    Of a source: ``s, source_size, target, rates, below``.
    """
    sized, repeated = _numbered(
        documents.select("doc_id", "source", word_count(F.col("text")).alias("size"), *_hashes(columns, seed))
    )
    sized = settle(sized.withColumn("class", _class_of(F.col("size"))), "mix-numbered")
    rated = settle(tilt(source_targets(sized, weights, budget, float(cap)), float(cap)), "mix-rates")
    plan = rated.select(F.col("source").alias("s"), "source_size", "target", "rates")
    keyed = _with_source(sized, plan).select("source", "size", _key().alias("key"))
    below = _thresholds(settle(keyed, "mix-keyed"), rated)
    plan = plan.join(below, F.col("s").eqNullSafe(F.col("source"))).drop("source")
    return sized, settle(plan, "mix-plan"), repeated


def _with_source(rows: DataFrame, plan: DataFrame) -> DataFrame:
    return rows.join(small(plan, PLAN_ROWS), F.col("source").eqNullSafe(F.col("s")))


def mix_plan(
    documents: DataFrame,
    weights: Sequence[int] = (3, 1, 2),
    budget: float = 1.5,
    cap: float = 2.0,
    seed: int = 20240,
) -> DataFrame:
    """One row per document: ``doc_id, source, size, source_size, target, rate, copies, taken``.

    ``taken`` = ``copies`` times ``size``, the words the mix takes. No document has more than
    ``ceil(cap)`` copies. A null text has size 0; null sources are one source, the last; rows that
    share an id, null ids too, and repeated rows are documents of their own, each with its own fate; an
    empty table gives no rows. Very long texts are of the last length class. Further columns of
    ``documents`` are not read.
    """
    sized, plan, _ = _planned(documents, ["doc_id"], weights, budget, cap, seed)
    taken = (_copies() * F.col("size")).alias("taken")
    return _with_source(sized, plan).select(
        "doc_id", "source", "size", "source_size", "target", _rate().alias("rate"), _copies().alias("copies"), taken
    )


def mix_documents(
    documents: DataFrame,
    weights: Sequence[int] = (3, 1, 2),
    budget: float = 1.5,
    cap: float = 2.0,
    seed: int = 20240,
) -> DataFrame:
    """``documents`` with each row as often as the mix takes it, all columns kept, whatever their names.

    Handles all that ``mix_plan`` does. Texts are not shuffled: the plan has a row for each source. Only
    rows alike in id, source and text are brought together; those alike in all columns are interchangeable
    and come as often as all of them together. Columns must be hashable (no maps).
    """
    columns = documents.columns
    sized, plan, repeated = _planned(documents, columns, weights, budget, cap, seed)
    # The row in one column, so that no name of a user's can clash with the plan's.
    row = F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row")
    rows = documents.select(
        row, "source", _class_of(word_count(F.col("text"))).alias("class"), *_hashes(columns, seed)
    )
    alike = ["id0", "id1"]
    single = rows.withColumn("nth", F.lit(1).cast("long"))
    again = not repeated.isEmpty()
    if again:
        single = single.join(small(repeated), alike, "left_anti")
    taken = _with_source(single, plan).select("row", _copies().alias("copies"))
    if again:
        copies = (
            _with_source(sized.join(small(repeated), alike, "left_semi"), plan)
            .withColumn("copies", _copies())
            .groupBy(*alike, "whole")
            .agg(F.sum("copies").alias("copies"))
        )
        copies = settle(copies, "mix-copies")
        one = rows.join(small(repeated), alike, "left_semi").groupBy(*alike, "whole").agg(F.first("row").alias("row"))
        # A row taken by the million is copied in many tasks.
        lots = F.sequence(F.lit(0).cast("long"), F.col("copies"), F.lit(LOT).cast("long"))
        dealt = one.join(small(copies), [*alike, "whole"]).withColumn("lot", F.explode(lots))
        dealt = dealt.repartition(*alike, "whole", "lot")
        some = F.least(F.lit(LOT), F.col("copies") - F.col("lot"))
        taken = taken.unionByName(dealt.select("row", some.cast("long").alias("copies")))
    taken = taken.filter("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("row.*")
