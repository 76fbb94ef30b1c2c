"""Piece encoding, token alignment and conversation repair against libraries and plain versions."""

from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from spanwatch.llm import conversation_repair, piece_bpe, token_alignment
from spanwatch.llm.queries import BYTE_LEVEL, PIECES, QUERIES
from tests.compare import tables

SF_DIR = "/root/testdata/sf0.01"
WITH_TABLES = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")
STRANGE = " \n\tabcde.,'();:/*\r▁ 中文字漢́é1234🙂\x00İ²<s></s><0x0A>\xa0​　\x1c<|endoftext|>"


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


@pytest.fixture(scope="module")
def model():
    return piece_bpe.PieceModel(Path(PIECES).read_bytes())


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def strange_texts(n=1_500):
    rng = random.Random(7)
    texts = ["".join(rng.choice(STRANGE) for _ in range(rng.randint(0, 60))) for _ in range(n)]
    texts += ["".join(rng.choice("    \n▁a*=-_") for _ in range(rng.randint(0, 80))) for _ in range(n)]
    texts += ["".join(chr(rng.choice([rng.randint(32, 0xD7FF), rng.randint(0xE000, 0x1FFFF)])) for _ in range(30)) for _ in range(300)]
    return texts


# --- piece encoding


def test_pieces_of_strange_texts(model, library):
    for text in [*strange_texts(), "", " ", "a" * 20_000, "ab" * 5_000, " " * 4_001, "中" * 4_000, "=*" * 3_000 + "-" * 2_000]:
        ids = library.encode(text)
        assert np.frombuffer(model.encode(text), np.int32).tolist() == ids
        assert model.decode(ids) == library.decode(ids)


def test_decoding_of_any_ids(model, library):
    rng = random.Random(3)
    for _ in range(4_000):
        ids = [rng.choice([rng.randint(0, 31_999), rng.randint(0, 258), 28_705, 0, 1]) for _ in range(rng.randint(0, 8))]
        assert model.decode(ids) == library.decode(ids)


def test_walk_is_plain_merging(model):
    rng = random.Random(5)
    words = ["".join(rng.choice("▁aeinrst") for _ in range(rng.randint(1, 14))) for _ in range(2_000)]
    assert all(model.walk(w) == model.merge(w) for w in words)


def test_a_dead_end_is_entered_once():
    # Longest matches fail again and again here; every position is given up at most once.
    own = piece_bpe.PieceModel(Path(PIECES).read_bytes())
    asked = Counter()

    class Asked(dict):
        def get(self, pair):
            asked.update(["n"])
            return None

    own.agree = Asked()
    text = "nationalisationsinternationalen" * 300
    assert own.walk(text) == own.merge(text)
    assert asked["n"] < 16 * len(text) * 2


def test_memory_of_parts_changes_nothing(model, monkeypatch):
    monkeypatch.setattr(piece_bpe, "KEPT", 3)
    monkeypatch.setattr(piece_bpe, "KEPT_PAIRS", 3)
    own = piece_bpe.PieceModel(Path(PIECES).read_bytes())
    for text in strange_texts(100):
        assert own.encode(text) == model.encode(text)
        assert len(own.known) <= 3 and len(own.known.before) <= 3


def test_encode_rows(spark, library):
    rows = [(1, "One text, two words."), (1, "One text, two words."), (None, None), (2, ""), (None, " x"), (3, "y▁z " * 9_000)]
    docs = spark.createDataFrame([(*r, 5, "mine") for r in rows], "doc_id long, text string, ids int, note string")
    found = piece_bpe.encode(docs, PIECES, decoded=True).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in found), key=repr) == sorted(rows, key=repr)
    for row in found:
        ids = library.encode(row["text"] or "")
        assert (row["ids"], row["decoded"], row["note"]) == (ids, library.decode(ids), "mine")
    again = piece_bpe.decode(piece_bpe.encode(docs, PIECES), PIECES).collect()
    assert {r["decoded"] for r in again} == {r["decoded"] for r in found}
    empty = piece_bpe.digests(docs.limit(0), PIECES)
    assert empty.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and empty.count() == 0


def test_other_models_are_refused():
    with pytest.raises(Exception):
        piece_bpe.PieceModel(b"no model")


@WITH_TABLES
def test_piece_query(spark, library):
    texts = dict(tables(SF_DIR).execute("SELECT doc_id, text FROM documents").fetchall())
    found = QUERIES["op11_piece_bpe"](spark, SF_DIR).collect()
    assert len(found) == len(texts)
    for row in found:
        ids = library.encode(texts[row["doc_id"]] or "")
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == sha(",".join(map(str, ids)))
        assert row["decoded_sha256"] == sha(library.decode(ids))


# --- token alignment


class Plain:
    """Alignment by offsets of whole texts, with the libraries' own encoders."""

    def __init__(self, library):
        self.a = Tokenizer.from_file(BYTE_LEVEL)
        self.a.encode_special_tokens = True
        self.b = library
        own = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in own]
        byte_of = {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}
        self.a_bytes = {i: bytes(byte_of.get(c, 0) for c in t) for t, i in self.a.get_vocab().items()}
        names = [library.id_to_piece(i) for i in range(library.get_piece_size())]
        self.b_bytes = [bytes([int(p[1:-1], 16)]) if library.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(names)]

    def groups(self, text):
        if not text:
            return []
        data = (" " + text).encode()
        a = self.a.encode(" " + text, add_special_tokens=False)
        b = self.b.encode(text)
        a_ids = a.ids
        a_bytes, b_bytes = [self.a_bytes[i] for i in a_ids], [self.b_bytes[i] for i in b]
        if b"".join(a_bytes) != data or b"".join(b_bytes) != data:
            return []
        ends_a, ends_b = (np.cumsum([len(t) for t in side]).tolist() for side in (a_bytes, b_bytes))
        at_b = {e: j for j, e in enumerate(ends_b)}
        out, p, q = [], 0, 0
        for i, end in enumerate(ends_a):
            if end in at_b:
                j = at_b[end]
                out.append((a_ids[p : i + 1], b[q : j + 1]))
                p, q = i + 1, j + 1
        return out

    def rows(self, texts):
        """doc_id to the contract's columns."""
        groups = {d: self.groups(t) for d, t in texts}
        counts = Counter((a[-1], b[-1]) for own in groups.values() for a, b in own)
        best = defaultdict(int)
        for (_, b), n in counts.items():
            best[b] = max(best[b], n)
        out = {}
        for doc, own in groups.items():
            links = [(a[-1], b[-1]) for a, b in own]
            told = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in own)
            out[doc] = (
                sum(len(a) for a, _ in own), sum(len(b) for _, b in own), len(own), len(links),
                sum(counts[k] == best[k[1]] for k in links), sum(counts[k] for k in links), told,
            )
        return out


@pytest.fixture(scope="module")
def plain(library):
    return Plain(library)


NUMBERS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]


def test_groups_of_strange_texts(plain):
    pair = token_alignment.Pair(Path(BYTE_LEVEL).read_bytes(), Path(PIECES).read_bytes())
    texts = [None, *strange_texts(), "it's 'tis don't I'll 3rd ...etc (a)b", "a \xa0b   c", "", "x\n\n  y \n z  ", "<|endoftext|> a<|endoftext|>"]
    coded = pair.encode(texts)
    (a, n_a), (b, n_b) = (([len(c) // 2 for c in side], np.frombuffer(b"".join(side), pair.width).astype(np.int64))[::-1] for side in coded)
    n_a, n_b = np.array(n_a), np.array(n_b)
    told = pair.tell(a, b, n_a, n_b, pair.align(a, b, n_a)).to_pylist()
    for text, own in zip(texts, told, strict=True):
        assert own == ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in plain.groups(text)), repr(text)
    assert 100_000 < pair.most_pairs() < 1_000_000
    nothing = np.zeros(0, np.int64)
    assert pair.tell(nothing, nothing, nothing, nothing, pair.align(nothing, nothing, nothing)).to_pylist() == []


def test_most_pairs_counts_suffixes():
    class Two:
        a_bytes, b_bytes = [b"a", b"ba", b"", b"c"], [b"a", b"cba", b"a", b""]

    # a: a, a, cba; ba: a, a, cba; c: nothing.
    assert token_alignment.Pair.most_pairs(Two) == 6


@pytest.mark.parametrize("n", [0, 1, 2, 63, 5_000])
def test_perfect_hash(n):
    keys = np.unique(np.random.default_rng(n).integers(0, 1 << 40, n))
    found = token_alignment.PerfectHash.of(keys)
    index = found.find(keys)
    assert sorted(index.tolist()) == list(range(len(keys)))
    assert (found.keys[index] == keys).all()
    assert (found.find(keys + (1 << 41)) == -1).all()


def test_align_rows(spark, plain, monkeypatch):
    monkeypatch.setattr(token_alignment, "FAN_IN", 2)
    rows = [(1, "One text, two words."), (2, None), (3, ""), (4, "no▁way, two words"), (5, " x"), (6, "Words, two words. " * 3_000), (None, "null id")]
    rows += [(k, t) for k, t in enumerate(strange_texts(100), 100)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n_a int").repartition(7)
    found = token_alignment.alignments(docs, BYTE_LEVEL, PIECES).collect()
    wanted = plain.rows(rows)
    assert {r["doc_id"]: (*(r[c] for c in NUMBERS), r["groups"]) for r in found} == wanted and len(found) == len(rows)
    # Rows that come twice count twice.
    twice = token_alignment.alignments(docs.unionAll(docs), BYTE_LEVEL, PIECES).collect()
    assert len(twice) == 2 * len(rows)
    assert {r["doc_id"]: r["count_sum"] for r in twice} == {d: 2 * w[5] for d, w in wanted.items()}
    empty = token_alignment.alignments(docs.limit(0), BYTE_LEVEL, PIECES)
    assert empty.count() == 0 and set(NUMBERS) < set(empty.columns)


def test_counts_of_other_documents(spark, plain):
    one = spark.createDataFrame([(1, "a word"), (2, "a word and others")], "doc_id int, text string")
    tokens = token_alignment.encoded(one, BYTE_LEVEL, PIECES)
    counts = token_alignment.pair_counts(tokens.where("doc_id = 1"), BYTE_LEVEL, PIECES)
    found = {r["doc_id"]: r["count_sum"] for r in token_alignment.align_documents(tokens, counts, BYTE_LEVEL, PIECES).collect()}
    assert found == {1: 2, 2: 2}
    told = token_alignment.counts_table(spark, counts)
    assert told.agg(F.sum("n")).first()[0] == 2 and told.columns == ["a_id", "b_id", "n"]


@WITH_TABLES
def test_alignment_query(spark, plain):
    texts = tables(SF_DIR).execute("SELECT doc_id, text FROM documents").fetchall()
    wanted = plain.rows(texts)
    found = QUERIES["op12_token_alignment"](spark, SF_DIR).collect()
    assert len(found) == len(texts)
    for row in found:
        *numbers, told = wanted[row["doc_id"]]
        assert [row[c] for c in NUMBERS] == numbers
        assert row["groups_sha256"] == (sha(told) if told else "")


# --- conversation repair

WORD = re.compile(r"[^\x20\x09-\x0D]")


def cheapest(symbols):
    """Least cost and least audit by search over all edits; a symbol is (initial, must go, unfinished)."""
    heap, best = [(0, "", 0, "")], None
    while heap:
        cost, audit, i, roles = heapq.heappop(heap)
        if best and cost > best[0]:
            break
        if i == len(symbols) and re.fullmatch("(s?(ua)+)?", roles):
            best = min(best or (cost, audit), (cost, audit))
        if not re.fullmatch("s?(ua)*u?", roles):
            continue
        more = [(5, "I", i, r) for r in "ua"]
        if i < len(symbols):
            own, must, unfinished = symbols[i]
            more.append((2, "D", i + 1, ""))
            if not must:
                more += [(5 * unfinished, "K", i + 1, own), *((1 + 5 * unfinished, "R", i + 1, r) for r in "ua")]
        for c, e, at, r in more:
            if best is None or cost + c <= best[0]:
                heapq.heappush(heap, (cost + c, audit + e, at, roles + r))
    return best


def plain_repair(rows):
    """Rows (turn, role, text) of one conversation, in order, to the contract's columns."""
    seen, faults = set(), []
    for _, role, text in rows:
        if not WORD.search(text):
            faults.append("blank")
        elif (role, text) in seen:
            faults.append("duplicate")
        elif WORD.findall(text)[-1] not in ".!?":
            faults.append("truncated")
        else:
            faults.append("")
        seen.add((role, text))
    symbols = [(r[1][:1], f in ("blank", "duplicate"), f == "truncated") for r, f in zip(rows, faults)]
    cost, audit = cheapest([(s if s in ("s", "u", "a") else "x", m, t) for s, m, t in symbols])
    out, k, roles = [], 0, ""
    for edit in audit:
        made = "assistant" if roles.endswith("u") else "user"
        if edit == "I":
            out.append((made, ""))
        else:
            _, role, text = rows[k]
            k += 1
            if edit == "D":
                continue
            out.append((made if edit == "R" else role, text))
        roles += out[-1][0][:1]
    turns = {r[0] for r in rows if r[0] is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    count = Counter(faults)
    told = "\n".join(f"{r}:{t}" for r, t in out)
    return gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit, sha(told)


def damaged(rows):
    """Rows (conv_id, turn, role, text) to conversations in order, all original ones included."""
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        conv_rows = out[conv]
        shown = [" " if v is None else str(v) for v in (conv, turn)]
        role, text = " " if role is None else role, " " if text is None else text
        case = zlib.crc32(":".join(shown).encode()) % 20
        if case == 0:
            continue
        text = "" if case == 1 else re.sub("[.!?]", "", text) if case == 2 else text
        conv_rows += [(turn, "user" if case == 4 else role, text)] * (2 if case == 3 else 1)
    order = lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode())
    return {conv: sorted(own, key=order) for conv, own in out.items()}


REPAIRED = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
TURNS = "conv_id long, turn long, role string, text string"


def repaired(df):
    rows = df.collect()
    assert len({r["conv_id"] for r in rows}) == len(rows)
    return {r["conv_id"]: tuple(r[c] for c in REPAIRED) for r in rows}


def conversations(n, seed):
    rng = random.Random(seed)
    rows = []
    for conv in range(n):
        for turn in range(rng.randint(1, 7)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, "", "Üser"])
            text = rng.choice(["Yes.", "No", "", " \t", None, "Why?", "Well...  ", "x" * 50 + "!"])
            rows.append((conv if conv else None, rng.choice([turn, turn, turn, turn + 3, None]), role, text))
    return rows


@pytest.mark.parametrize("block", [1, 2, 3, 4_096])
def test_repair_is_the_cheapest(spark, block):
    rows = conversations(120, block)
    turns = spark.createDataFrame(rows, TURNS).withColumn("cost", F.lit(9)).repartition(5)
    found = conversation_repair.repair(conversation_repair.damage(turns), block)
    assert repaired(conversation_repair.summary(found)) == {c: plain_repair(own) for c, own in damaged(rows).items()}


def test_solution_of_all_short_symbols():
    kinds = {"s": ("s", 0, 0), "u": ("u", 0, 0), "a": ("a", 0, 0), "x": ("x", 0, 0), "U": ("u", 1, 0), "A": ("a", 1, 0), "2": ("u", 0, 1), "3": ("a", 0, 1), "1": ("s", 0, 1), "4": ("x", 0, 1)}
    rng = random.Random(1)
    cases = [""] + list(kinds) + [a + b for a in kinds for b in kinds]
    cases += ["".join(rng.choice(rng.choice(["suax", "uua3", "ua2U", "".join(kinds)])) for _ in range(rng.randint(3, 7))) for _ in range(300)]
    for symbols in cases:
        assert conversation_repair.solved(symbols) == cheapest([kinds[s] for s in symbols]), symbols


def test_powers_are_repeated_steps():
    for own in "suax1234SUAX":
        n, costs = 37, conversation_repair.FINISH
        slow = costs
        for _ in range(n):
            slow = conversation_repair.back(conversation_repair.transition(own), slow)
        for matrix in conversation_repair.powers(own, n):
            costs = conversation_repair.back(matrix, costs)
        assert costs == slow
        times = conversation_repair.times(conversation_repair.product(own * 5), conversation_repair.product(own * 32))
        assert times == conversation_repair.product(own * n)


def test_one_long_conversation(spark):
    # One conversation holds nearly all rows and copies; it is solved in blocks over several tasks.
    rng = random.Random(2)
    rows = [(1, t, rng.choice(["user", "assistant", "user", "system"]), f"{rng.choice('abc')} {t // 2}{rng.choice('..?,')}") for t in range(3_000)]
    rows += [(1, 7, "user", "same.")] * 3_000 + [(2, 0, "user", "Hi."), (2, 1, "assistant", "Yes.")]
    turns = spark.createDataFrame(rows, TURNS).repartition(6)
    blocks = conversation_repair.repair(turns, 64)
    assert blocks.where("conv_id = 1").count() > 20
    found = repaired(conversation_repair.summary(blocks))
    whole = conversation_repair.repair(turns.repartition(1), 100_000)
    assert found == repaired(conversation_repair.summary(whole))
    assert found[2] == (0, 0, 0, 0, 0, 0, "KK", sha("user:Hi.\nassistant:Yes."))
    assert found[1][2] >= 2_999 and len(found[1][6]) - found[1][6].count("I") == 6_000
    kept = conversation_repair.repaired_turns(blocks).where("conv_id = 1").orderBy("part", "block", "place").collect()
    assert re.fullmatch("s?(ua)+", "".join(r["role"][0] for r in kept))
    assert sha("\n".join(f"{r['role']}:{r['text']}" for r in kept)) == found[1][7]


def test_no_row_left(spark):
    turns = spark.createDataFrame([(1, 0, "user", "Hi."), (None, None, None, None)], TURNS).withColumn("copies", F.lit(0))
    nothing = (0, 0, 0, 0, 0, 0, "", sha(""))
    assert repaired(conversation_repair.summary(conversation_repair.repair(turns))) == {1: nothing, None: nothing}
    empty = conversation_repair.summary(conversation_repair.repair(turns.limit(0)))
    assert empty.columns == ["conv_id", *REPAIRED] and empty.count() == 0


@WITH_TABLES
def test_repair_query(spark):
    rows = tables(SF_DIR).execute("SELECT conv_id, turn, role, text FROM conversations").fetchall()
    found = repaired(QUERIES["op13_conversation_repair"](spark, SF_DIR))
    assert found == {c: plain_repair(own) for c, own in damaged(rows).items()}
