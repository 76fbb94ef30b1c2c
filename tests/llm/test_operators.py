"""Each operator on small tables: nulls, empty and long texts, ties, repeated rows, hot groups."""

from __future__ import annotations

import json
import math
import random
import time
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from spanwatch.llm import (
    boosted_rules,
    components,
    entropy_mix,
    feistel_shards,
    html_wrappers,
    kneser_ney,
    preference_format,
    simhash_gray,
    string_tiling,
    url_rules,
    warc_revisits,
)
from spanwatch.llm.bpe import Encoder
from spanwatch.llm.queries import VOCABULARY

DOCS = "doc_id long, text string, lang string, source string, n_chars long, component_id long, size long"
TEXT = "the quick brown fox jumps over the lazy dog while the other dogs sleep in the warm sun of the yard "


def docs(spark, rows):
    """Rows of (doc_id, text[, source]) with further columns, two of them named like results."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "a", 1, 7, 7) for r in rows]
    return spark.createDataFrame(full, DOCS).repartition(3)


def rows_of_list(rows):
    return sorted((tuple(r) for r in rows), key=repr)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# --- URL rules


def test_url_rules(spark):
    rules = url_rules.path_rules(
        spark, [("org", "/", "allow"), ("example.org", "/x", "block"), ("example.org", "/x/y", "allow")]
    ).unionByName(url_rules.pattern_rules(spark, [("*[0-9]*", "block"), ("/ads/", "block"), ("|a.b^", "block"), (".exe|", "block")]))
    cases = {
        None: ("", "", None, "allow"),
        "": ("", "", None, "allow"),
        "no scheme": ("", "", None, "allow"),
        "http://EXAMPLE.org": ("example.org", "", None, "allow"),
        "http://sub.Example.org/x?q#f": ("sub.example.org", "/x", "example.org/x", "block"),
        "http://example.org/x/y": ("example.org", "/x/y", "example.org/x/y", "allow"),
        "http://notexample.org/x": ("notexample.org", "/x", "org/", "allow"),
        "http://h.net/ads/1": ("h.net", "/ads/1", "/ads/", "block"),
        "http://h.net/bads/1": ("h.net", "/bads/1", None, "allow"),
        "http://a.b/": ("a.b", "/", "|a.b^", "block"),
        "http://a.bc/": ("a.bc", "/", None, "allow"),
        "http://h.net/run.exe": ("h.net", "/run.exe", ".exe|", "block"),
        "http://h.net/run.exe?x": ("h.net", "/run.exe", None, "allow"),
        "http://h.net/[0-9]": ("h.net", "/[0-9]", "*[0-9]*", "block"),
    }
    pages = spark.createDataFrame([(k, u, "old") for k, u in enumerate([*cases, "http://a.b/"])], "page_id int, url string, rule string")
    found = {(r["page_id"], r["url"]): (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_rules.judge_urls(pages, rules).collect()}
    assert found == {(k, u): cases[u] for k, u in enumerate([*cases, "http://a.b/"])}
    assert url_rules.judge_urls(pages, rules.limit(0)).filter("verdict = 'allow'").count() == len(found)
    assert url_rules.judge_urls(pages.limit(0), rules).count() == 0


# --- revisits


def test_revisits(spark):
    head = {"ETag": '"1"', "Content-Type": "text/html", "Date": "d0"}
    rows = [
        (1, "response", "http://www.h.net:80/a/?utm_source=x&b=1&a=2#f", 100, 200, head),
        (2, "response", "https://h.net/a?a=2&b=1", 200_000, 200, {"Last-Modified": "m", "ETag": None}),
        (3, "response", "http://h.net/a?a=2&b=1", 200_000, 404, head),
        (4, "revisit", "http://h.net/a?a=2&b=1", 100, 304, head),
        (5, "revisit", "http://h.net/a?a=2&b=1", 101, 304, {"etag": 'W/"1"', "DATE": "d1", "Content-Type": "x"}),
        (6, "revisit", "http://h.net/a?a=2&b=1", 150_000, 304, {"etag": '"2"'}),
        (7, "revisit", "http://h.net/a?a=2&b=1", 200_001, 304, {"last-modified": "m", "expires": "e"}),
        (8, "revisit", "http://h.net/a?a=2&b=1", 900_000, 304, None),
        (9, "revisit", None, 900_000, 304, head),
        (10, "revisit", "http://h.net/a", None, 304, head),
        (5, "revisit", "http://h.net/a?a=2&b=1", 101, 304, {"etag": 'W/"1"', "DATE": "d1", "Content-Type": "x"}),
    ]
    schema = "record_id int, warc_type string, uri string, ts long, status int, headers map<string,string>, outcome string"
    records = spark.createDataFrame([(*r, "old") for r in rows], schema)
    found = Counter((r["record_id"], r["response_id"], r["outcome"], tuple(sorted((r["merged"] or {}).items()))) for r in warc_revisits.resolve_revisits(records).collect())
    five = (("content-type", "text/html"), ("date", "d1"), ("etag", 'W/"1"'))
    assert found == Counter(
        {
            (4, None, "missing", ()): 1,
            (5, 1, "resolved", five): 2,
            (6, None, "mismatch", ()): 1,
            (7, 2, "resolved", (("etag", None), ("expires", "e"), ("last-modified", "m"))): 1,
            (8, None, "unchecked", ()): 1,
            (9, None, "missing", ()): 1,
            (10, None, "missing", ()): 1,
        }
    )
    assert warc_revisits.resolve_revisits(records.limit(0)).count() == 0


def test_revisits_of_one_url(spark):
    """A URL with all captures, against a scan."""
    draw = random.Random(3)
    rows = [(k, draw.choice(["response", "revisit"]), "http://h.net/", draw.randrange(900_000), 200, {"ETag": "t"}) for k in range(400)]
    records = spark.createDataFrame(rows, "record_id int, warc_type string, uri string, ts long, status int, headers map<string,string>")
    full = [(r[3], r[0]) for r in rows if r[1] == "response"]
    expected = {r[0]: max((f for f in full if f[0] < r[3]), default=(0, None))[1] for r in rows if r[1] == "revisit"}
    assert {r["record_id"]: r["response_id"] for r in warc_revisits.resolve_revisits(records).collect()} == expected


# --- mixing


def test_mix(spark):
    rows = [(k, "w " * (k % 50), ["b", None, "a", "hot", "hot", "hot"][k % 6]) for k in range(3_000)] + [(None, None, "z"), (5, "x", "hot"), (5, "x", "hot")]
    plan = entropy_mix.mix_plan(docs(spark, rows)).collect()
    assert len(plan) == len(rows)
    sources = {}
    for r in plan:
        assert r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 2
        s = sources.setdefault(r["source"], [r["source_size"], r["target"], 0])
        s[2] += r["taken"]
    assert all(abs(taken - target) <= 25 for _, target, taken in sources.values())
    assert sum(t for _, t, _ in sources.values()) == pytest.approx(1.5 * sum(s for s, _, _ in sources.values()))
    assert sources["z"][:2] == [0, 0.0]
    mixed = entropy_mix.mix_documents(docs(spark, rows))
    assert mixed.columns == docs(spark, rows).columns
    copies = Counter(r["doc_id"] for r in mixed.collect() if r["doc_id"] != 5)
    assert copies == Counter({r["doc_id"]: r["copies"] for r in plan if r["copies"] and r["doc_id"] != 5})
    assert entropy_mix.mix_plan(docs(spark, rows).limit(0)).count() == 0


def tilted_words(targets, mu, cap):
    """Words taken of each class, with every source at its target, by plain bisection."""
    taken = [0.0] * len(mu)
    for _, size, masses, target in targets:
        if not 0 < target < cap * size:
            for c, m in enumerate(masses):
                taken[c] += m * target / size if size else 0.0
            continue
        part = lambda l: [m * cap / (1 + math.exp(-l - t)) for m, t in zip(masses, mu)]  # noqa: E731, B023, E741
        low, high = -60.0, 60.0
        for _ in range(200):
            half = (low + high) / 2
            low, high = (half, high) if sum(part(half)) < target else (low, half)
        for c, words in enumerate(part(low)):
            taken[c] += words
    return taken


def test_tilt(spark):
    k = entropy_mix.CLASSES
    masses = lambda *m: [float(x) for x in m] + [0.0] * (k - len(m))
    rows = [
        ("a", 100, masses(0, 60, 40), 200.0),
        ("b", 9_000, masses(100, 900, 8_000), 6_000.0),
        (None, 5_000, masses(3_000, 1_500, 500), 7_000.0),
        ("d", 5, masses(5), 0.0),
        ("e", 0, masses(), 0.0),
    ]
    targets = spark.createDataFrame(rows, "source string, source_size long, masses array<double>, target double")
    mu = entropy_mix.class_multipliers(targets, 2.0)
    total, wanted = sum(r[1] for r in rows), sum(r[3] for r in rows)
    # The dual's conditions hold, by a plain solution of the sources.
    taken = tilted_words(rows, mu, 2.0)
    corpus = [sum(r[2][c] for r in rows) for c in range(k)]
    for c in range(k):
        assert wanted * corpus[c] / total - taken[c] - entropy_mix.SLACK * total * mu[c] == pytest.approx(0, abs=1e-4)
    # Shares of the classes are nearer to the corpus than without their multipliers.
    miss = lambda words: sum(abs(w / sum(words) - m / total) for w, m in zip(words, corpus))
    assert miss(taken) < 0.7 * miss(tilted_words(rows, [0.0] * k, 2.0))
    rates = {r["source"]: r["rates"] for r in entropy_mix.tilt(targets).collect()}
    assert rates["a"] == [2.0] * k and rates["d"] == rates["e"] == [0.0] * k
    for source, _, m, target in rows[1:3]:
        assert sum(r * x for r, x in zip(rates[source], m)) == pytest.approx(target, rel=1e-8)
        assert len(set(rates[source])) > 2 and all(0 < r < 2 for r in rates[source])
        odds = [math.log(r / (2 - r)) for r in rates[source]]
        assert [o - odds[0] for o in odds] == pytest.approx([t - mu[0] for t in mu], abs=1e-5)


def test_mix_of_equal_rows(spark):
    rows = [(None, "one two three four five", "a")] * 1_000 + [(None, "w " * (1 + k % 9), "b") for k in range(900)] + [(7, "x " * 5, "c")] * 400
    plan = entropy_mix.mix_plan(docs(spark, rows)).collect()
    again = entropy_mix.mix_plan(docs(spark, rows).repartition(5)).collect()
    assert rows_of_list(plan) == rows_of_list(again) and len(plan) == len(rows)
    for source in "abc":
        mine = [r for r in plan if r["source"] == source]
        assert abs(sum(r["taken"] for r in mine) - mine[0]["target"]) <= 5 and max(r["copies"] for r in mine) <= 2


def test_mix_keeps_columns_of_any_name(spark):
    rows = [(k % 40, f"{'w ' * (k % 30)}", "ab"[k % 2], k % 3, k, "r", k % 2) for k in range(300)] + [(1, "same", "a", 1, 1, "r", 1)] * 2_500
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, row int, copies int, s string, id0 int").repartition(3)
    mixed = entropy_mix.mix_documents(df)
    assert mixed.columns == df.columns
    out = Counter(tuple(r) for r in mixed.collect())
    assert set(out) <= set(rows) and all(n <= 2 * rows.count(r) for r, n in out.items())
    targets = {r["source"]: r["target"] for r in entropy_mix.mix_plan(df).collect()}
    for source, target in targets.items():
        assert abs(sum(len(r[1].split()) * n for r, n in out.items() if r[2] == source) - target) <= 15
    assert entropy_mix.mix_documents(df.limit(0)).count() == 0


# --- preferences


def test_preferences(spark):
    t = lambda role, text: {"role": role, "text": text}
    a, b, c = t("user", "q"), t("assistant", "yes"), t("assistant", None)
    pairs = [(1, [a, b], [a, c], "x"), (2, [a, b], [a, b], "x"), (3, None, [a], "x"), (4, [a], [a, b], "x"), (5, [t(None, None)], [t(None, None), a, b], "x"), (5, [b], [c], "x")]
    df = spark.createDataFrame(pairs, "pair int, chosen array<struct<role:string,text:string>>, rejected array<struct<role:string,text:string>>, prompt string")
    found = preference_format.format_pairs(df).collect()
    shape = sorted((r["pair"], r["n_prompt_turns"], r["prompt"], r["chosen"], r["rejected"]) for r in found)
    q, y, n = "<|user|>\nq<|end|>\n", "<|assistant|>\nyes<|end|>\n", "<|assistant|>\n<|end|>\n"
    assert shape == sorted([(1, 1, q, y, n), (2, 2, q + y, "", ""), (3, 0, "", "", q), (4, 1, q, "", y), (5, 1, "<||>\n<|end|>\n", "", q + y), (5, 0, "", y, n)])
    for r in found:
        for side in ("chosen", "rejected"):
            assert [r[side][s["start"] : s["end"]] for s in r[f"{side}_mask"]] == [m for m in (["yes"] if "yes" in r[side] else [""] if "assistant" in r[side] else [])]


def test_pairs_of_conversations(spark):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "a"), (1, 1, "assistant", "a"), (1, 2, "user", "r"), (1, 3, "assistant", "b"), (1, 4, "user", "end"), (2, 0, "user", "alone"), (None, None, None, None)]
    df = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string")
    found = {r["conv_id"]: r for r in preference_format.format_pairs(preference_format.last_answer_pairs(df)).collect()}
    assert (found[1]["n_prompt_turns"], found[1]["chosen"], found[1]["rejected"]) == (3, "<|assistant|>\nb<|end|>\n", "<|assistant|>\na<|end|>\n")
    assert (found[2]["n_prompt_turns"], found[2]["chosen"]) == (1, "") and found[None]["n_prompt_turns"] == 1
    assert preference_format.format_pairs(preference_format.last_answer_pairs(df.limit(0))).count() == 0


# --- components and SimHash


def test_components(spark):
    draw = random.Random(1)
    edges = [(k, k + 1) for k in range(60)] + [(1_000, k) for k in range(1_001, 1_200)] + [(draw.randrange(2_000, 2_400), draw.randrange(2_000, 2_400)) for _ in range(250)] + [(5, 5)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for u, v in edges:
        if u != v:
            a, b = sorted((find(u), find(v)))
            root[b] = a
    df = spark.createDataFrame(edges, "u long, v long")
    assert {r["node"]: r["root"] for r in components.components(df).collect()} == {x: find(x) for x in list(root)}
    assert components.components(df.limit(0)).count() == 0


def _linked(prints, radius):
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= radius:
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return [find(i) for i in range(len(prints))]


def _prints(draw, n, centres, flips):
    out = []
    for _ in range(n):
        x = draw.choice(centres)
        for b in draw.sample(range(64), draw.randrange(flips + 1)):
            x ^= 1 << b
        out.append(x)
    return sorted(set(out))


@pytest.mark.parametrize("seed", range(6))
def test_gray_index(seed):
    draw = random.Random(seed)
    prints = _prints(draw, 250, [draw.getrandbits(64) for _ in range(8)], 6)
    group = np.array([p % (1 + seed % 3) for p in prints])
    array = np.array(prints, np.uint64)
    order = np.lexsort((simhash_gray.gray_rank(array), group))
    group, array = group[order], array[order]
    a, b = simhash_gray.link(group, array)
    root = simhash_gray._roots(len(array), a, b)
    for g in np.unique(group):
        at = np.flatnonzero(group == g)
        mine = _linked([int(x) for x in array[at]], 3)
        assert [int(r) - int(at[0]) for r in root[at]] == mine


def test_gray_rank():
    ranks = np.arange(1 << 10, dtype=np.uint64)
    assert (simhash_gray.gray_rank(ranks ^ (ranks >> np.uint64(1))) == ranks).all()


@pytest.mark.parametrize("group_rows", [40, 1_000])
def test_simhash_groups(spark, group_rows):
    """Every pair within three bits shares a group of bounded size, however dense the data."""
    draw = random.Random(9)
    prints = _prints(draw, 400, [draw.getrandbits(64) for _ in range(3)], 5)
    df = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "fp long")
    groups = {}
    for r in simhash_gray._groups(df, group_rows).collect():
        groups.setdefault((r["mask"], r["value"]), set()).add(r["fp"] % (1 << 64))
    assert max(map(len, groups.values())) <= max(group_rows, 16)
    shared = {frozenset((a, b)) for g in groups.values() for a in g for b in g if a < b}
    near = {frozenset((a, b)) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= 3}
    assert near <= shared


def test_near_duplicates(spark):
    copy = TEXT * 3
    rows = [(k, copy) for k in range(20, 320)] + [(3, copy.upper()), (1, None), (2, ""), (9, " \t\n"), (None, copy), (4, "one"), (6, "one two three"), (4, "one"), (7, "word " * 200_000)]
    found = simhash_gray.near_duplicates(docs(spark, rows)).collect()
    assert len(found) == len(rows)
    by = {r["doc_id"]: r["component_id"] for r in found}
    assert {by[k] for k in range(20, 320)} == {3} and by[None] == 3 and by[3] == 3
    assert by[1] == by[2] == by[9] == 1 and by[4] == 4 and by[7] == 7
    kept = simhash_gray.representatives(docs(spark, rows))
    assert kept.columns == docs(spark, rows).columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter([3, 1, 4, 6, 7, None])
    assert simhash_gray.near_duplicates(docs(spark, rows).limit(0)).count() == 0


# --- Kneser-Ney


def _plain_model(texts, alphabet, order=kneser_ney.ORDER):
    """Counts, discounts and probabilities by definition."""
    code = lambda c: alphabet.index(ord(c)) + 2 if ord(c) in alphabet else 0
    grams = Counter()
    for t in texts:
        line = [1] * (order - 1) + [code(c) for c in t]
        grams.update(tuple(line[k : k + order]) for k in range(len(t)))
    levels = {order: grams}
    for n in range(order - 1, 0, -1):
        levels[n] = Counter(g[1:] for g in levels[n + 1])
    discount = {}
    for n, level in levels.items():
        n1, n2, n3, n4 = (sum(c == k for c in level.values()) for k in (1, 2, 3, 4))
        if n1 and n2 and n3 and n4:
            y = n1 / (n1 + 2 * n2)
            d = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
            discount[n] = [min(max(x, 0.05), k - 0.05) for k, x in enumerate(d, 1)]
        else:
            discount[n] = [0.5, 1.0, 1.5]
    contexts = {n: {} for n in levels}
    for n, level in levels.items():
        for g, c in level.items():
            contexts[n].setdefault(g[:-1], []).append(c)

    def p(gram):
        n = len(gram)
        if not n:
            return 1 / (1 << kneser_ney.SYMBOL_BITS)
        counts = contexts[n].get(gram[:-1])
        if counts is None:
            return p(gram[1:])
        d = discount[n]
        c, total = levels[n].get(gram, 0), sum(counts)
        left = max(c - d[min(c, 3) - 1], 0) if c else 0
        return (left + sum(d[min(x, 3) - 1] for x in counts) * p(gram[1:])) / total

    def bits(t):
        line = [1] * (order - 1) + [code(c) for c in t]
        return -sum(math.log2(p(tuple(line[k : k + order]))) for k in range(len(t))) / len(t)

    return bits


@pytest.mark.parametrize("shard_rows", [1_000_000, 60])
def test_kneser_ney(spark, shard_rows):
    texts = [TEXT, TEXT[10:60] * 2, "zu und der des ein", "été à la mer", "a" * 50]
    rows = [*enumerate([*texts, "unseen WORDS! ❄ 雪", "", None, TEXT]), (8, TEXT), (None, "null id")]
    df = docs(spark, rows)
    trusted = df.filter("doc_id < 5")
    alphabet = kneser_ney.alphabet_of(trusted)
    assert alphabet == sorted({ord(c) for t in texts for c in t})
    found = kneser_ney.score(df, kneser_ney.train(trusted, alphabet), alphabet, shard_rows).collect()
    bits = _plain_model(texts, alphabet)
    assert len(found) == len(rows)
    for r in found:
        text = dict(rows)[r["doc_id"]]
        assert r["n_symbols"] == len(text or "")
        assert r["bits"] == (pytest.approx(bits(text)) if text else None)


def test_classify(spark):
    draw = random.Random(4)
    words = TEXT.split()
    good = [(k, " ".join(draw.choices(words, k=60))) for k in range(120)]
    bad = [(k, "".join(chr(draw.randrange(33, 120)) for _ in range(200))) for k in range(200, 210)]
    df = docs(spark, [*good, *bad, (300, None), (301, ""), (None, TEXT), (1, good[1][1])])
    labels = spark.createDataFrame([(k, 1, 0) for k in range(100)] + [(k, 0, None) for k in range(200, 205)] + [(None, 1, 1)], "doc_id long, quality int, toxic int")
    rows = kneser_ney.classify(df, labels).collect()
    kept = Counter(r["doc_id"] for r in rows if r["kept"])
    assert len(rows) == 134 and not set(range(200, 302)) & set(kept) and kept[1] == 2 and kept[None] == 1
    assert sum(kept[k] > 0 for k in range(120)) >= 117
    kept = kneser_ney.keep_good(df, labels)
    assert kept.columns == df.columns and not kept.filter("doc_id >= 200").count()
    assert kneser_ney.classify(df, labels.limit(0)).filter("kept").count() == 132
    assert kneser_ney.classify(df.limit(0), labels).count() == 0


def _letters(draw, seed):
    """A language of its own: forty invented words."""
    own = random.Random(seed)
    words = ["".join(own.choices("abcdefghijklmnopqrstuvwxyz", k=own.randint(3, 8))) for _ in range(40)]
    return lambda n: " ".join(draw.choices(words, k=n))


def test_few_trusted_documents_do_not_reject_unseen_ones(spark):
    draw = random.Random(6)
    rows = []
    for lang, seed, n in (("xx", 1, 300), ("yy", 2, 160)):
        say = _letters(draw, seed)
        rows += [(len(rows) + k, say(60), lang) for k in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    for few in (20, 60):
        trusted = [*range(200), *range(300, 300 + few)]
        labels = spark.createDataFrame([(k, 1, 0) for k in trusted], "doc_id long, quality int, toxic int")
        found = kneser_ney.classify(df, labels).collect()
        unseen = [r["kept"] for r in found if r["lang"] == "yy" and r["doc_id"] not in trusted]
        assert sum(unseen) >= 0.95 * len(unseen)


def test_short_documents_do_not_set_the_limit_of_long_ones(spark):
    scores = [(k, "en", 400 + k % 90, 2.3 + 0.001 * (k % 100)) for k in range(1_000)]
    scores += [(k, "en", 5, 2.0 + 0.02 * (k % 100)) for k in range(1_000, 1_200)]
    df = spark.createDataFrame(scores, "doc_id long, lang string, n_symbols long, bits double")
    limits = kneser_ney.thresholds(df, df.select("doc_id")).filter("lang = 'en'")
    by = {r["class"]: r["limit_bits"] for r in limits.collect()}
    assert 2.38 <= by[8] <= 2.6 and by[2] >= 3.8


# --- boosted trees


def test_trees_are_monotone_and_learn():
    draw = np.random.default_rng(5)
    x = draw.random((4_000, 3))
    y = (x[:, 0] + 0.5 * np.sin(9 * x[:, 1]) + 0.1 * draw.normal(size=4_000) < 0.6).astype(float)
    trees = boosted_rules.grow(x[:3_000], y[:3_000], [-1, 0, 0])
    assert ((trees.score(x[3_000:]) > 0) == y[3_000:]).mean() > 0.9
    for _ in range(50):
        line = np.repeat(draw.random((1, 3)), 64, axis=0)
        line[:, 0] = np.linspace(0, 1, 64)
        assert (np.diff(trees.score(line)) <= 1e-9).all()


def test_judge(spark):
    rows = [(k, TEXT + f"number {k} and some more words to be different {k * 7}") for k in range(40)] + [(100 + k, TEXT.replace(" ", "# ")) for k in range(40)]
    rows += [(200, None), (201, ""), (202, "a b c\n\nx\nx"), (None, TEXT), (203, "w " * 300_000)]
    labels = spark.createDataFrame([(k, 1, 0) for k in range(30)] + [(100 + k, 0, 0) for k in range(30)], "doc_id long, quality int, toxic int")
    found = {r["doc_id"]: r for r in boosted_rules.judge(docs(spark, rows), labels).collect()}
    assert all(found[k]["kept"] for k in range(40)) and not any(found[100 + k]["kept"] for k in range(40))
    assert tuple(found[202])[1:6] == (4, 6, 0, 1, 0) and found[202]["base_failed"]
    assert found[200]["base_failed"] and found[201]["n_words"] == 0 and found[203]["n_repeat_words"] == 300_000
    alone = boosted_rules.judge(docs(spark, rows), labels.filter("quality = 1"))
    assert alone.filter("kept = base_failed").count() == 0 and alone.count() == len(rows)
    assert boosted_rules.judge(docs(spark, rows).limit(0), labels).count() == 0


# --- wrappers


def test_fold_and_merge():
    page = "<ul><li>a<li>b<li>c</ul><div><h2>x</h2><p>y</p><h2>z</h2><p>w</p></div>"
    wrapper = html_wrappers.as_wrapper(html_wrappers.parse(page))
    ul, div = wrapper.parts
    assert [(p.label, p.repeated) for p in ul.parts] == [("li", True)] and ul.parts[0].parts[0].fixed is None
    assert [(p.label, p.repeated, [q.label for q in p.parts]) for p in div.parts] == [("*", True, ["h2", "p"])]
    other = html_wrappers.as_wrapper(html_wrappers.parse("<ul><li>a</ul><hr><div><p>y</p></div>"))
    both = html_wrappers.merge(wrapper, other)
    assert [(p.label, p.optional) for p in both.parts] == [("ul", False), ("hr", True), ("div", False)]
    assert html_wrappers.dump(html_wrappers.load(html_wrappers.dump(both))) == html_wrappers.dump(both)


def test_main_text(spark):
    nav = '<nav><ul><li><a href="/">Home</a></ul></nav><div class="ad">Buy</div><!-- <p>no</p> -->'
    end = '<section class="comments"><p>First!</p></section></article><footer>&copy; x</footer>'
    page = lambda body: f"<html><head><title>t</title><style>p{{}}</style></head><body>{nav}<article>{body}{end}</body></html>"
    plain = lambda body: f"<html><body><div class='menu'>Home</div><div id=x>{body}</div><div>All rights</div></body></html>"
    rows = [
        (1, "http://a/1", page("<h1>T &amp; U</h1><p>one\n  two<b>three</b><p>four<script>var x='<p>';</script>")),
        (2, "http://a/2", page("<h1>V</h1><p><b>open<br><p>last</p><aside>side</aside><form>f</form>")),
        (3, "http://b/1", plain("<p>first text here</p><p>second text here</p>")),
        (4, "http://b/2", plain("<p>third text here now</p>")),
        (5, "http://b/3", plain("<p>fifth</p><ul><li>x<li>y</ul>")),
        (6, None, None),
        (7, "http://c/", ""),
        (8, "http://a/9", "<p>a &lt; b"),
        (9, "http://a/1", "<article>" + "<p>x y</p>" * 20_000 + "</article>"),
        (1, "http://a/1", page("<p>again</p>")),
    ]
    pages = spark.createDataFrame([(*r, "old") for r in rows], "page_id long, url string, html string, text string")
    found = Counter((r["page_id"], r["text"]) for r in html_wrappers.main_text(pages).collect())
    assert found == Counter(
        [
            (1, "T & U\none twothree\nfour"),
            (2, "V\nopen\nlast"),
            (3, "first text here\nsecond text here"),
            (4, "third text here now"),
            (5, "fifth\nx\ny"),
            (6, ""),
            (7, ""),
            (8, "a < b"),
            (9, "\n".join(["x y"] * 20_000)),
            (1, "again"),
        ]
    )
    assert html_wrappers.main_text(pages.limit(0)).count() == 0


@pytest.mark.parametrize("nest", ["<div>", "<span>", "<blockquote>", "<article>", "<p>", "<ul><li>", "<div class='a'>x<b>"])
def test_deep_markup(nest):
    """A hundred thousand nested elements pass every step that a page and its host's wrapper pass."""
    page = nest * (100_000 // nest.count("<"))
    one = html_wrappers.as_wrapper(html_wrappers.parse(page + "deep words"))
    both = html_wrappers.merge(one, html_wrappers.as_wrapper(html_wrappers.parse(page + "other words")))
    rows = json.loads(json.dumps(html_wrappers.dump(both)))
    assert html_wrappers.dump(html_wrappers.load(rows)) == html_wrappers.dump(both)
    path = html_wrappers.main_path(html_wrappers.load(rows))
    assert html_wrappers.extract(page + "deep words", path).endswith("deep words")


def test_deep_page_beside_others(spark):
    pages = spark.createDataFrame(
        [(1, "http://h.org/1", "<div>" * 3_000 + "deep words"), (2, "http://h.org/2", "<article><p>a plain page</p></article>")],
        "page_id long, url string, html string",
    )
    assert rows_of(html_wrappers.main_text(pages).select("page_id", "text")) == [(1, "deep words"), (2, "a plain page")]


def test_blank_blocks_and_page_headers():
    text = lambda page: html_wrappers.extract(page, None)
    assert text("<article><p>a</p><p>&nbsp;</p><p>b</p></article>") == "a\nb"
    assert text("<body><header>Site name</header><h1>T</h1><p>a</p></body>") == "T\na"
    assert text("<body><article><header><h1>T</h1></header><p>a</p></article></body>") == "T\na"


def test_align_takes_the_shorter_way():
    part = lambda labels: [html_wrappers.Part(x) for x in labels]
    for left, right, both in [("abc", "axbc", "axbc"), ("abc", "cab", "cabc"), ("ab", "cd", "acbd"), ("", "ab", "ab")]:
        assert "".join(p.label for p in html_wrappers.align(part(left), part(right), [])) == both


def test_white_space_between_inline_elements():
    text = lambda page: html_wrappers.extract(page, None)
    assert text("<p><b>a</b> <i>b</i></p>") == "a b"
    assert text("<article>\n<p>\n<a>x</a>\n<a>y</a></p>\n<p>c<b>d</b></p> </article>") == "x y\ncd"


def test_whole_article_of_common_blog_pages():
    text = lambda page: html_wrappers.extract(page, html_wrappers.main_path(html_wrappers.as_wrapper(html_wrappers.parse(page))))
    body = "<p>" + "long text " * 20 + "</p>"
    whole = "T\nlead\n" + ("long text " * 20).strip()
    article = f'<article><h1>T</h1><p>lead</p><div class="entry-content">{body}</div></article>'
    for name in ("has-sidebar", "no-sidebar", "comments-open", "sidebar", "single nav"):
        assert text(f'<html><body class="{name}"><nav>Home</nav>{article}<div class="site-footer">x</div></body></html>') == whole
    assert text(f"<main><p>aside</p>{article}</main>") == whole
    assert text(f'<div class="sidebar"><p>x</p>{article}</div><p>y</p>') == whole
    assert text(f'<form><div class="related">{body}</div></form><p>y</p>') == ("long text " * 20).strip()
    assert text('<article><p>a</p><div class="comment-list">b</div><p>c</p></article>') == "a\nc"


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="<>/abpli \"'=!-&;\n", max_size=80))
def test_any_page(page):
    tree = html_wrappers.parse(page)
    one = html_wrappers.as_wrapper(tree)
    html_wrappers.merge(one, html_wrappers.as_wrapper(html_wrappers.parse(page[::-1])))
    assert isinstance(html_wrappers.extract(page, html_wrappers.main_path(one)), str)


# --- tiling


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=14), st.lists(st.lists(st.integers(0, 4), min_size=1, max_size=12), max_size=3), st.integers(1, 4))
def test_tiles(item, text, tile):
    array = lambda x: np.array(x, np.uint64)
    found = string_tiling.tiles(array(item), [array(s) for s in text], tile)
    joined = [t for s in text for t in s]
    free_a, free_b = [True] * len(item), [True] * len(joined)
    owner = [k for k, s in enumerate(text) for _ in s]
    for a, b, n in found:
        longest = 0
        for i in range(len(item)):
            for j in range(len(joined)):
                k = 0
                while i + k < len(item) and j + k < len(joined) and owner[j + k] == owner[j] and free_a[i + k] and free_b[j + k] and item[i + k] == joined[j + k]:
                    k += 1
                longest = max(longest, k)
        assert n == longest >= tile and item[a : a + n] == joined[b : b + n]
        assert all(free_a[a : a + n]) and all(free_b[b : b + n])
        free_a[a : a + n] = free_b[b : b + n] = [False] * n
    assert sum(n for _, _, n in found) <= len(item)


def test_tiles_of_long_texts():
    """Halving the length, not stepping down: twenty thousand tokens a side with one common tile."""
    item, text = np.arange(20_000, dtype=np.uint64), np.arange(20_000, 40_000, dtype=np.uint64)
    text[7_000:7_900] = item[100:1_000]
    start = time.perf_counter()
    assert string_tiling.tiles(item, [text], 5) == [(100, 7_000, 900)]
    assert time.perf_counter() - start < 5


def test_run_hashes():
    draw = np.random.default_rng(2)
    tokens = draw.integers(0, 3, 300).astype(np.uint64)
    for n in (1, 2, 3, 5, 8, 13, 300, 301):
        h = string_tiling.run_hashes(tokens, n)
        runs = [tuple(tokens[k : k + n]) for k in range(len(tokens) - n + 1)]
        assert len(h) == len(runs) and len(set(h.tolist())) == len(set(runs)) == len(set(zip(h.tolist(), runs, strict=True)))


def test_contamination(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
    words = item.split()
    swapped = " ".join(words[6:] + ["filler"] + words[:6])
    bench = spark.createDataFrame([(1, item), (2, item), (3, None), (4, ""), (None, item), (5, "tiny item"), (1, item)], "item_id long, text string")
    rows = [(1, f"x y {item.upper()}, z"), (2, swapped), (3, " ".join(words[:5]) + " no"), (4, " ".join(words[::-1])), (5, None), (6, ""), (7, "a tiny item here"), (None, item), (8, "word " * 200_000 + item), (9, item), (9, item)]
    rows += [(k, f"{k} {item} {k}") for k in range(100, 400)]
    found = {r["doc_id"]: r for r in string_tiling.contamination(docs(spark, rows), bench).collect()}
    shape = lambda k: (found[k]["item_id"], round(found[k]["coverage"], 3), found[k]["n_items"], found[k]["contaminated"])
    assert shape(1) == shape(2) == shape(None) == shape(8) == shape(9) == (1, 1.0, 2, True)
    assert shape(3) == (1, 0.417, 0, False) and shape(4) == shape(5) == shape(6) == (None, 0.0, 0, False)
    assert shape(7) == (5, 1.0, 1, True) and all(found[k]["contaminated"] for k in range(100, 400))
    assert string_tiling.contamination(docs(spark, rows), bench).count() == len(rows)
    kept = string_tiling.decontaminate(docs(spark, rows), bench)
    assert kept.columns == docs(spark, rows).columns and sorted(r["doc_id"] for r in kept.collect()) == [3, 4, 5, 6]
    assert string_tiling.contamination(docs(spark, rows).limit(0), bench).count() == 0
    assert string_tiling.decontaminate(docs(spark, rows), bench.limit(0)).count() == len(rows)
    # Rows without an id are judged each by its own text, whatever the others are.
    nameless = [(None, "clean words of a quiet garden behind the old house"), (None, None), (None, ""), *[r for r in rows if r[0] is None] * 2]
    clashing = docs(spark, nameless).withColumn("__bad", F.lit("x")).withColumn("alone", F.lit("y")).withColumn("digest", F.lit("z"))
    judged = Counter(tuple(r) for r in string_tiling.contamination(clashing, bench).select("item_id", "contaminated").collect())
    assert judged == {(None, False): 3, (1, True): 2}
    kept = string_tiling.decontaminate(clashing, bench)
    assert kept.columns == clashing.columns and Counter(r["text"] for r in kept.collect()) == Counter(r[1] for r in nameless[:3])


# --- token shards


@pytest.fixture(scope="module")
def encoder():
    return Encoder(Path(VOCABULARY).read_bytes())


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=40))
def test_encoder(encoder, text):
    ids, none = encoder.batch([text, None])
    assert encoder.encoding.decode(np.frombuffer(ids, "<u2").tolist()) == text and none == b""


@pytest.mark.parametrize("count", [1, 2, 3, 4, 5, 17, 64, 1_000, 4_097])
def test_permutation(count):
    slots = feistel_shards.permute(np.arange(count), count)
    assert sorted(slots) == list(range(count))
    assert (feistel_shards.permute(slots, count, back=True) == np.arange(count)).all()
    if count > 100:
        assert (slots != feistel_shards.permute(np.arange(count), count, key=1)).any()


def test_shards(spark, encoder, tmp_path):
    rows = [(k, f"{TEXT}{k}" * (k % 4)) for k in range(60)] + [(70, None), (71, ""), (None, "no id"), (3, "again"), (99, "long " * 30_000)]
    docs(spark, rows).write.parquet(str(tmp_path / "in"))
    source = spark.read.parquet(str(tmp_path / "in"))
    length, per_shard = 64, 10
    written = feistel_shards.write_shards(source, str(tmp_path / "out"), VOCABULARY, length, per_shard).collect()
    end = encoder.size
    count = len(written)
    assert sorted(r["slot"] for r in written) == list(range(count))
    assert all(r["shard"] == r["slot"] // per_shard and len(r["tokens"]) == 2 * length for r in written)
    order = sorted(written, key=lambda r: int(feistel_shards.permute(np.array([r["slot"]]), count, back=True)[0]))
    stream = np.concatenate([np.frombuffer(r["tokens"], "<u2")[: r["n_tokens"]] for r in order])
    assert all(r["n_tokens"] == length for r in order[:-1])
    texts = Counter(encoder.encoding.decode(x.tolist()) for x in np.split(stream, np.flatnonzero(stream == end) + 1)[:-1] for x in [x[:-1]])
    assert texts == Counter(t for _, t in rows if t)
    begun = [(d, s) for r in order for d, s in zip(r["doc_ids"], r["doc_starts"], strict=True)]
    assert {d for d, _ in begun} == {k for k, t in rows if t} and all(s < length for _, s in begun)
    files = list((tmp_path / "out").rglob("*.parquet"))
    assert len(files) == -(-count // per_shard)
    # Splits that no second read would give again.
    shaken = source.withColumn("order", F.rand()).repartition(5, F.rand()).sortWithinPartitions("order")
    again = feistel_shards.write_shards(shaken, str(tmp_path / "again"), VOCABULARY, length, per_shard).collect()
    order = sorted(again, key=lambda r: int(feistel_shards.permute(np.array([r["slot"]]), count, back=True)[0]))
    stream = np.concatenate([np.frombuffer(r["tokens"], "<u2")[: r["n_tokens"]] for r in order])
    parts = np.split(stream, np.flatnonzero(stream == end) + 1)[:-1]
    assert len(again) == count and Counter(encoder.encoding.decode(x[:-1].tolist()) for x in parts) == texts
    for file in files:
        slots = spark.read.parquet(str(file)).select("slot").toPandas()["slot"].tolist()
        assert slots == sorted(slots)
    late = feistel_shards.read_from(spark, str(tmp_path / "out"), 25, per_shard)
    assert sorted(r["slot"] for r in late.select("slot").collect()) == list(range(25, count))
    docs(spark, rows).limit(0).write.parquet(str(tmp_path / "none"))
    assert feistel_shards.write_shards(spark.read.parquet(str(tmp_path / "none")), str(tmp_path / "empty"), VOCABULARY).count() == 0


def test_pipeline(spark):
    """Each stage on its own input against a plain rule; all keep the columns of documents."""
    import corpus_pipeline

    sf_dir = "/root/testdata/sf0.001"
    if not Path(sf_dir).exists():
        pytest.skip("no test tables")
    before = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, frame = before.columns, before
    kept = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        frame = spark.createDataFrame(stage(spark, frame, sf_dir).toPandas(), before.schema)
        assert frame.columns == columns
        kept.append([r["doc_id"] for r in frame.select("doc_id").collect()])
    good, single, clear, mixed = kept
    assert set(clear) <= set(single) <= set(good) and len(set(single)) == len(single)
    assert set(mixed) <= set(clear) and max(Counter(mixed).values()) <= 2
    found = simhash_gray.near_duplicates(before.filter(F.col("doc_id").isin(good)))
    assert set(single) == {r["component_id"] for r in found.collect()}
