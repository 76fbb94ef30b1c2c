"""The operators' queries against their SQL or a plain version, on whole tables."""

from __future__ import annotations

import html as entities
import re
from collections import Counter, defaultdict
from pathlib import Path

import pytest
import xxhash

from spanwatch.llm import string_tiling
from spanwatch.llm.oracle import ORACLE
from spanwatch.llm.queries import QUERIES
from tests.compare import difference, tables

SF_DIR = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def con():
    return tables(SF_DIR)


@pytest.fixture(scope="module")
def documents(con):
    return con.execute("SELECT doc_id, text, lang, source FROM documents").fetchall()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql(spark, con, name):
    assert difference(QUERIES[name](spark, SF_DIR), con, ORACLE[name]) is None


def test_every_operator_has_a_query():
    assert {re.match(r"op(\d+)_", n)[1] for n in QUERIES} == {str(k) for k in range(1, 14)}


def _simhash(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORDS.findall(lowered)
    if not words:
        return 0
    runs = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _closure(prints):
    """Smallest id of each component of ids whose prints differ in at most three bits."""
    ids = sorted(prints)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for n, a in enumerate(ids):
        for b in ids[:n]:
            if (prints[a] ^ prints[b]).bit_count() <= 3:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in ids}


def test_op5(spark, documents):
    prints = {d[0]: _simhash(d[1]) for d in documents}
    expected = {(i, f"{prints[i]:016x}", c) for i, c in _closure(prints).items()}
    rows = QUERIES["op5_simhash_gray"](spark, SF_DIR).collect()
    assert {tuple(r) for r in rows} == expected and len(rows) == len(documents)


def test_op6(spark, documents):
    sizes = {d[0]: len(WORDS.findall(d[1] or "")) for d in documents}
    source = {d[0]: d[3] for d in documents}
    mass = Counter()
    for i, n in sizes.items():
        mass[source[i]] += n
    names = sorted(n for n in mass if n is not None) + [n for n in mass if n is None]
    weight = {n: (3, 1, 2)[k % 3] for k, n in enumerate(names)}
    target, free, rest = {}, set(names), 1.5 * sum(mass.values())
    while True:
        level = rest / sum(weight[n] for n in free)
        over = {n for n in free if weight[n] * level > 2 * mass[n]}
        if not over:
            break
        for n in over:
            target[n] = 2.0 * mass[n]
            rest -= target[n]
        free -= over
    target |= {n: weight[n] * level for n in free}
    query = QUERIES["op6_entropy_mix"]
    rows = query(spark, SF_DIR).collect()
    taken, largest = Counter(), Counter()
    for r in rows:
        n = source[r["doc_id"]]
        assert (r["size"], r["source_size"]) == (sizes[r["doc_id"]], mass[n])
        assert r["target"] == pytest.approx(target[n]) and 0 <= r["taken"] <= 2 * r["size"]
        taken[n] += r["taken"]
        largest[n] = max(largest[n], r["size"])
    assert len(rows) == len(documents)
    assert all(abs(taken[n] - target[n]) <= largest[n] / 2 + 1e-6 for n in names)
    assert Counter(map(tuple, rows)) == Counter(map(tuple, query(spark, SF_DIR).collect()))


def _base(text):
    words = WORDS.findall(text or "")
    windows = Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))
    repeated = {j for k in range(len(words) - 4) if windows[tuple(words[k : k + 5])] > 1 for j in range(k, k + 5)}
    lines = [x for x in (text or "").split("\n") if WORDS.search(x)]
    seen, twice = set(), 0
    for line in lines:
        twice += line in seen
        seen.add(line)
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), twice, len(repeated), n < 10 or 100 * len(repeated) > 20 * n)


def test_op7(spark, con, documents):
    rows = {r["doc_id"]: tuple(r) for r in QUERIES["op7_boosted_rules"](spark, SF_DIR).collect()}
    assert {i: r[1:7] for i, r in rows.items()} == {d[0]: _base(d[1]) for d in documents}
    assert not any(r[6] and r[7] for r in rows.values())
    labels = con.execute("SELECT doc_id, quality FROM labels").fetchall()
    good = [rows[i][7] for i, q in labels if q == 1 and not rows[i][6]]
    bad = [rows[i][7] for i, q in labels if q == 0 and not rows[i][6]]
    assert sum(good) >= 0.99 * len(good) and sum(bad) <= 0.1 * len(bad)


def _article(page):
    found = re.search(r"<article>(.*?)</article>", page or "", re.S)
    blocks = re.split(r"</?(?:p|h\d|div|ul|li)\b[^>]*>", found[1]) if found else []
    texts = [" ".join(entities.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in blocks]
    return "\n".join(t for t in texts if t)


def test_op8(spark, con):
    expected = {(i, u, _article(h), len(_article(h))) for i, u, h in con.execute("SELECT page_id, url, html FROM pages").fetchall()}
    assert {tuple(r) for r in QUERIES["op8_html_wrappers"](spark, SF_DIR).collect()} == expected


def test_op1(spark, con, documents):
    rows = {r["doc_id"]: r for r in QUERIES["op1_kneser_ney"](spark, SF_DIR).collect()}
    assert set(rows) == {d[0] for d in documents}
    assert all(rows[d[0]]["n_symbols"] == len(d[1]) for d in documents)
    labels = con.execute("SELECT doc_id, quality FROM labels").fetchall()
    good = [rows[i]["kept"] for i, q in labels if q == 1]
    bad = [rows[i]["kept"] for i, q in labels if q == 0]
    assert sum(good) >= 0.98 * len(good) and sum(bad) <= 0.3 * len(bad)


def test_op1_long_junk(spark, con, documents):
    """Runs of one repeated word have low perplexity for a short text, not for one of their length."""
    rows = {r["doc_id"]: r for r in QUERIES["op1_kneser_ney"](spark, SF_DIR).collect()}
    labels = con.execute("SELECT doc_id, quality FROM labels").fetchall()
    bad = [rows[i]["kept"] for i, q in labels if q == 0]
    assert sum(bad) <= 0.1 * len(bad)


def _tiling(item, text, tile):
    """Greedy tiling by comparing all stretches; returns the number of covered tokens."""
    a, b, total = [True] * len(item), [True] * len(text), 0
    while True:
        best = (tile - 1, 0, 0)
        for i in range(len(item)):
            for j in range(len(text)):
                n = 0
                while i + n < len(item) and j + n < len(text) and a[i + n] and b[j + n] and item[i + n] == text[j + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < tile:
            return total
        for k in range(n):
            a[i + k] = b[j + k] = False
        total += n


def test_op10(spark, con, documents):
    cut = lambda t: re.findall(r"\w+", (t or "").lower().replace("_", " "))
    items = {i: cut(t) for i, t in con.execute("SELECT item_id, text FROM benchmark").fetchall()}
    runs = defaultdict(set)
    for i, item in items.items():
        for k in range(len(item) - string_tiling.TILE + 1):
            runs[tuple(item[k : k + string_tiling.TILE])].add(i)
    expected = {}
    for doc, text, _, _ in documents:
        words = cut(text)
        near = {i for k in range(len(words)) for i in runs.get(tuple(words[k : k + string_tiling.TILE]), ())}
        shares = {}
        for i in near:
            shares[i] = _tiling(items[i], words, string_tiling.TILE) / len(items[i]) if len(words) < 600 else None
        expected[doc] = shares
    for r in QUERIES["op10_string_tiling"](spark, SF_DIR).collect():
        shares = expected[r["doc_id"]]
        if None in shares.values():
            continue
        best = max(shares.values(), default=0)
        assert r["coverage"] == pytest.approx(best)
        assert r["n_items"] == sum(s >= string_tiling.COVERAGE for s in shares.values())
        assert r["contaminated"] == (r["n_items"] > 0)
        assert r["item_id"] == min((i for i, s in shares.items() if s == best), default=None)


def test_op4(spark, documents):
    rows = QUERIES["op4_feistel_shards"](spark, SF_DIR).collect()
    slots = sorted(r["slot"] for r in rows)
    assert slots == list(range(len(rows)))
    assert {d for r in rows for d in r["doc_ids"]} == {d[0] for d in documents if d[1]}
