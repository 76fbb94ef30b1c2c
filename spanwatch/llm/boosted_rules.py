"""Quality rules as gradient-boosted trees over document statistics.

Tasks take the statistics of each whole text once; everything later works on one short row per
document. Trees are grown on a bounded sample of labelled rows (``fit_rows``, those with the
smallest hashes of their ids), second-order logistic boosting over histogram bins. For a feature
with a monotonic constraint a split must keep the order of its two values, and the values below
stay within bounds set by the midpoint. The trees are flattened into node arrays, sent to the tasks
(a few kilobytes, by the parameters), and a batch is scored by walking all rows and trees down one
level at a time.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanwatch.llm.common import settle

FIT_ROWS = 20_000
KEEP_GOOD = 0.998
WINDOW = 5
MIN_WORDS = 10
REPEAT_PERCENT = 20

# Fixed value: blanks between words.
BLANK = "\t\n\v\f\r "
_SYMBOLS = str.maketrans({c: None for c in "#*$%&|<>"})
_UPPER, _LETTERS, _DIGITS = (regex.compile(p) for p in (r"\p{Lu}", r"\p{L}+", r"\p{N}"))
_MARKS = regex.compile(r"[^\p{L}\p{N}\p{M}\s]")

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
EXTRA = ["n_lines", "n_distinct", "n_upper", "n_letters", "n_digits", "n_marks", "longest_run"]

# Features and the sign their effect on quality must have; 0 leaves it free.
FEATURES = [
    ("symbols_per_char", -1),
    ("dup_line_share", -1),
    ("repeat_share", -1),
    ("upper_share", -1),
    ("digit_share", -1),
    ("mark_share", -1),
    ("run_share", -1),
    ("mean_word", 0),
    ("distinct_share", 0),
    ("log_words", 0),
]


_TO_SPACE = str.maketrans({c: " " for c in BLANK})


def statistics(text: str | None) -> list[int]:
    """The values of ``COUNTS`` and ``EXTRA`` of one text."""
    text = text or ""
    # str.split alone would also cut at other Unicode blanks.
    words = [w for w in text.translate(_TO_SPACE).split(" ") if w]
    lines = [line for line in text.split("\n") if line.strip(BLANK)]
    windows = Counter(zip(*(words[k:] for k in range(WINDOW)), strict=False))
    repeated = 0
    if len(windows) < len(words) - WINDOW + 1:
        until = 0
        for at, window in enumerate(zip(*(words[k:] for k in range(WINDOW)), strict=False)):
            if windows[window] > 1:
                repeated += at + WINDOW - max(at, until)
                until = at + WINDOW
    n_upper, n_letters = len(_UPPER.findall(text)), sum(map(len, _LETTERS.findall(text)))
    run = longest = 0
    before = None
    for word in words:
        run = run + 1 if word == before else 1
        before = word
        if run > longest:
            longest = run
    return [
        len(words),
        sum(map(len, words)),
        len(text) - len(text.translate(_SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated,
        len(lines),
        len(set(words)),
        n_upper,
        n_letters,
        len(_DIGITS.findall(text)),
        len(_MARKS.findall(text)),
        longest,
    ]


def document_statistics(documents: DataFrame) -> DataFrame:
    """``doc_id`` and the statistics of each row, in longs."""
    names = COUNTS + EXTRA

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([statistics(t.as_py()) for t in batch.column(1)], np.int64).reshape(-1, len(names))
            yield pa.record_batch(
                [batch.column(0), *[pa.array(found[:, k]) for k in range(len(names))]], names=["doc_id", *names]
            )

    kind = dict(documents.dtypes)["doc_id"]
    columns = ", ".join(f"{n} long" for n in names)
    return documents.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, {columns}")


def features(counts: pd.DataFrame) -> np.ndarray:
    """One row of ``FEATURES`` per row of statistics; shares of nothing are 0."""
    share = lambda a, b: (counts[a] / counts[b].where(counts[b] > 0, 1)).to_numpy(float)
    return np.column_stack(
        [
            share("n_symbols", "word_chars"),
            share("n_dup_lines", "n_lines"),
            share("n_repeat_words", "n_words"),
            share("n_upper", "n_letters"),
            share("n_digits", "word_chars"),
            share("n_marks", "word_chars"),
            share("longest_run", "n_words") * (counts["longest_run"] > 2),
            share("word_chars", "n_words"),
            share("n_distinct", "n_words"),
            np.log1p(counts["n_words"].to_numpy(float)),
        ]
    )


@dataclass
class Trees:
    """All trees in node arrays; a leaf is its own child."""

    roots: np.ndarray
    feature: np.ndarray
    limit: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Log odds of good quality per row."""
        out = np.full(len(x), self.base)
        for at in range(0, len(x), 8_192):
            part = x[at : at + 8_192]
            node = np.repeat(self.roots[None, :], len(part), axis=0)
            rows = np.arange(len(part))[:, None]
            for _ in range(self.depth):
                down = part[rows, self.feature[node]] <= self.limit[node]
                node = np.where(down, self.left[node], self.right[node])
            out[at : at + 8_192] += self.value[node].sum(axis=1)
        return out


def grow(
    x: np.ndarray,
    y: np.ndarray,
    signs: Sequence[int],
    rounds: int = 60,
    depth: int = 3,
    rate: float = 0.2,
    bins: int = 64,
    least: float = 5.0,
    ridge: float = 1.0,
) -> Trees:
    """Boosted trees for 0/1 labels; ``least`` is the smallest hessian of a leaf."""
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    code = np.column_stack([np.searchsorted(c, x[:, f]) for f, c in enumerate(cuts)])
    share = min(max(y.mean(), 1e-3), 1 - 1e-3)
    base = float(np.log(share / (1 - share)))
    margin = np.full(len(y), base)
    nodes: list[list[float]] = []  # feature, limit, left, right, value
    roots = []

    def build(rows: np.ndarray, left: int, low: float, high: float) -> int:
        g, h = grad[rows], hess[rows]
        value = float(np.clip(-g.sum() / (h.sum() + ridge), low, high))
        at = len(nodes)
        nodes.append([0, 0.0, at, at, value * rate])
        best = _best_split(code[rows], g, h, cuts, signs, low, high, least, ridge) if left else None
        if best is None:
            margin[rows] += value * rate
            return at
        f, b, vl, vr = best
        middle = (vl + vr) / 2
        down = code[rows, f] <= b
        bounds = {1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle)), 0: ((low, high),) * 2}
        (l1, h1), (l2, h2) = bounds[signs[f]]
        a = build(rows[down], left - 1, l1, h1)
        c = build(rows[~down], left - 1, l2, h2)
        nodes[at] = [f, cuts[f][b], a, c, 0.0]
        return at

    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = p - y, np.maximum(p * (1 - p), 1e-6)
        roots.append(build(np.arange(len(y)), depth, -np.inf, np.inf))
    array = np.array(nodes)
    whole = lambda k: array[:, k].astype(np.int64)
    return Trees(np.array(roots), whole(0), array[:, 1], whole(2), whole(3), array[:, 4], depth, base)


def _best_split(code, g, h, cuts, signs, low, high, least, ridge):
    """Feature, bin and the two values of the best allowed split, or None."""
    best, found = 1e-6, None
    whole = g.sum() ** 2 / (h.sum() + ridge)
    for f, cut in enumerate(cuts):
        if not len(cut):
            continue
        gl = np.cumsum(np.bincount(code[:, f], g, len(cut) + 1))[:-1]
        hl = np.cumsum(np.bincount(code[:, f], h, len(cut) + 1))[:-1]
        gr, hr = g.sum() - gl, h.sum() - hl
        vl, vr = np.clip(-gl / (hl + ridge), low, high), np.clip(-gr / (hr + ridge), low, high)
        gain = gl**2 / (hl + ridge) + gr**2 / (hr + ridge) - whole
        gain = np.where((hl >= least) & (hr >= least) & (signs[f] * (vr - vl) >= 0), gain, -np.inf)
        b = int(gain.argmax())
        if gain[b] > best:
            best, found = gain[b], (f, b, vl[b], vr[b])
    return found


def fit(statistics: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, keep_good: float = KEEP_GOOD):
    """Trees and the limit below which a document is rejected, or None without both kinds of label.

    At most ``fit_rows`` labelled rows are taken, those with the smallest hashes of their ids. The
    limit lets pass the share ``keep_good`` of the good ones among them, and is 0.5 at most.
    """
    marks = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    picked = marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)
    rows = statistics.join(F.broadcast(picked), "doc_id").orderBy("doc_id", *COUNTS).toArrow().to_pandas()
    y = rows["quality"].to_numpy(float)
    if not len(y) or y.min() == y.max():
        return None
    x = features(rows)
    trees = grow(x, y, [sign for _, sign in FEATURES])
    good = np.sort(trees.score(x[y == 1]))
    return trees, min(float(good[int((1 - keep_good) * len(good))]), 0.0)


def judge(
    documents: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, keep_good: float = KEEP_GOOD
) -> DataFrame:
    """One row per row of ``documents``: ``doc_id``, ``COUNTS``, ``base_failed``, ``score``, ``kept``.

    Base rules: fewer than 10 words, or over 20 of 100 words in repeated five-word windows. Other
    rows are kept if their score (log odds) reaches the limit; if the labels are all of one kind, or
    none, the base rules alone decide. Null and empty texts have no words and fail. Rows with a null
    id are judged like others; repeated rows stay; an empty table gives no rows; further columns are
    not read.
    """
    counts = settle(document_statistics(documents), "quality-statistics")
    model = fit(counts, labels, fit_rows, keep_good)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    if model is None:
        return counts.select(
            "doc_id", *COUNTS, failed.alias("base_failed"), F.lit(0.0).alias("score"), (~failed).alias("kept")
        )
    trees, limit = model
    sent = documents.sparkSession.sparkContext.broadcast(trees)
    names = COUNTS + EXTRA

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            frame = pd.DataFrame({n: batch.column(n).to_numpy() for n in names})
            scores = pa.array(sent.value.score(features(frame)))
            yield pa.record_batch(
                [batch.column("doc_id"), *[batch.column(n) for n in COUNTS], scores], names=["doc_id", *COUNTS, "score"]
            )

    columns = ", ".join(f"{n} long" for n in COUNTS)
    kind = dict(documents.dtypes)["doc_id"]
    scored = counts.mapInArrow(run, f"doc_id {kind}, {columns}, score double")
    return scored.select(
        "doc_id", *COUNTS, failed.alias("base_failed"), "score", (~failed & (F.col("score") >= limit)).alias("kept")
    )
