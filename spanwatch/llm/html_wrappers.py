"""Main text of web pages by wrappers that are inferred from the pages of a host.

A page's token stream is read into nested elements. A wrapper is a union-free regular expression
over such streams: an element holds a sequence of parts, each of which may be optional or repeated,
and text that is either fixed or a slot. Wrappers grow by alignment: equal parts are merged,
adjacent parts with the same shape (runs of one to ``PERIOD`` parts) become a repeated group, parts
that only one side has become optional, and texts that differ become a slot.

Each task aligns the pages it has into one wrapper per host; these partial wrappers are merged per
(host, salt) and then per host, since a wrapper aligns with a wrapper as a page does. All pages take
part, and a host with a third of all pages reaches one task as a few wrappers only.

In the wrapper, slots show where a host's pages differ. The path to the element that holds their
main text is the host's rule; pages are then cut by that rule, or by their own shape where it does
not fit. Trees are walked with lists of open work, so that elements may be nested to any depth.
"""

from __future__ import annotations

import html as entities
import json
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanwatch.llm.common import settle, small
from spanwatch.llm.url_rules import host_of

PERIOD = 4
SALTS = 16
HELD_HOSTS = 2_000
RULE_ROWS = 200_000

# Fixed values of HTML: elements without content, with raw content, that break a line, that end a
# paragraph when they start, and that an equal or related element ends.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template iframe svg math canvas object textarea title".split())
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol optgroup option p pre section summary "
    "table tbody td tfoot th thead tr ul".split()
)
ENDED_BY = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
    "option": {"option"},
}
# What holds the parts of a page itself; its header is the site's, that of an article the article's.
PAGE = ("", "html", "body")
FENCES = set("article section div main table td th ul ol dl nav header footer aside form body html".split())

# Elements and names in class, id and role that mark what is not main text.
NOT_TEXT = RAW | set("nav footer aside form head button select input label menu dialog".split())
NOT_TEXT_NAMES = set(
    "ad ads advert adverts advertisement banner sidebar menu nav navbar navigation breadcrumb breadcrumbs footer "
    "masthead comment comments disqus respond reply replies notice notices cookie cookies consent alert popup modal "
    "overlay share sharing social related recommended promo promoted sponsor sponsored newsletter subscribe signup "
    "login search pagination pager toolbar widget contentinfo complementary".split()
)
# What may stand beside those in a compound name ("site-footer", "comment-list"); others ("has-sidebar") mark nothing.
BESIDE = set(
    "0 site page main primary secondary left right top bottom inner outer box list area container wrapper wrap block "
    "section slot unit bar links link buttons button icons form posts articles items item header title text body "
    "global mobile desktop fixed sticky post entry google by".split()
)
MAIN_TAGS = ("article", "main")
MAIN_NAMES = set("articlebody main-content post-content entry-content article-body".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>", re.S
)
_MARK = re.compile(r"(?:class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_BLANKS = re.compile(r"[\x20\x09-\x0D]+")
_DIGITS = re.compile(r"\d+")


@dataclass
class Part:
    """An element, a group of parts (label ``*``) or text (label ``#``) of a page or a wrapper."""

    label: str
    parts: list = field(default_factory=list)
    text: str = ""
    fixed: int | None = None  # hash of a text that all pages have; None for a slot
    chars: int = 0  # of slots and fixed texts below, summed over pages
    slot_chars: int = 0
    optional: bool = False
    repeated: bool = False
    page_level: bool = False  # of a page: directly in its body


def parse(page: str | None) -> Part:
    """The page as nested parts; unclosed and stray tags are mended the way browsers mostly do."""
    root = Part("")
    stack, opened = [root], Counter()
    page = page or ""
    at = 0

    def add_text(raw: str) -> None:
        if raw:
            stack[-1].parts.append(Part("#", text=raw))

    while True:
        token = _TOKEN.search(page, at)
        if token is None:
            add_text(page[at:])
            return root
        add_text(page[at : token.start()])
        at = token.end()
        if token[2] is None:
            continue
        tag = token[2].lower()
        if token[1]:
            _close(stack, opened, tag)
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            at = end.end() if end else len(page) if tag in ("script", "style") else at
            continue
        if tag in BLOCK:
            _end_inside(stack, opened, {"p"})
        if tag in ENDED_BY:
            _end_inside(stack, opened, ENDED_BY[tag])
        part = Part(_label(tag, token[3]), page_level=_tag(stack[-1]) in PAGE)
        stack[-1].parts.append(part)
        if tag not in VOID and not token[3].endswith("/"):
            stack.append(part)
            opened[tag] += 1


def _tag(part: Part) -> str:
    return part.label.partition(".")[0]


def _close(stack: list[Part], opened: Counter, tag: str) -> None:
    if not opened[tag]:
        return
    for k in range(len(stack) - 1, 0, -1):
        own = _tag(stack[k])
        if own == tag:
            _end(stack, opened, k)
            return
        if own in FENCES and tag not in BLOCK:
            return


def _end_inside(stack: list[Part], opened: Counter, tags: set[str]) -> None:
    """End the nearest open element of ``tags`` that no fence hides."""
    if not any(opened[t] for t in tags):
        return
    for k in range(len(stack) - 1, 0, -1):
        own = _tag(stack[k])
        if own in tags:
            _end(stack, opened, k)
            return
        if own in FENCES - tags:
            return


def _end(stack: list[Part], opened: Counter, k: int) -> None:
    opened.subtract(map(_tag, stack[k:]))
    del stack[k:]


def _label(tag: str, attributes: str) -> str:
    if "=" not in attributes:
        return tag
    names = " ".join("".join(m) for m in _MARK.findall(attributes)).lower().split()
    return ".".join([tag, *sorted({_DIGITS.sub("0", n.replace(".", "-")) for n in names})])


def _boiler(label: str, marks: bool = True) -> bool:
    """Whether an element is no main text; without ``marks`` by what it is, not by names or as a form."""
    tag, *names = label.split(".")
    if tag in ("html", "body"):
        return False
    if tag in NOT_TEXT and (marks or tag != "form"):
        return True
    return marks and any(_marks_boiler(n) for n in names)


def _marks_boiler(name: str) -> bool:
    if name in NOT_TEXT_NAMES:
        return True
    words = [w for w in re.split(r"[-_]", name) if w]
    return not NOT_TEXT_NAMES.isdisjoint(words) and all(w in NOT_TEXT_NAMES or w in BESIDE for w in words)


def _preorder(part: Part) -> list[Part]:
    """A part and all below it, each before its own parts."""
    out, todo = [], [part]
    while todo:
        out.append(todo.pop())
        todo.extend(reversed(out[-1].parts))
    return out


def as_wrapper(part: Part) -> Part:
    """A page as the wrapper of itself: fixed texts only, repetitions folded, white space left out."""
    done: dict[int, Part] = {}
    for p in reversed(_preorder(part)):
        if p.label == "#":
            done[id(p)] = Part("#", fixed=xxhash.xxh64_intdigest(p.text.strip()), chars=len(p.text))
        else:
            inside = [done.pop(id(q)) for q in p.parts if q.label != "#" or not q.text.isspace()]
            done[id(p)] = _summed(Part(p.label, parts=fold(inside)))
    return done[id(part)]


def _summed(part: Part) -> Part:
    part.chars = sum(p.chars for p in part.parts)
    part.slot_chars = sum(p.slot_chars for p in part.parts)
    return part


def fold(parts: list[Part]) -> list[Part]:
    """Adjacent runs of the same labels as repeated parts or groups, short runs first."""
    for period in range(1, PERIOD + 1):
        out: list[Part] = []
        at = 0
        while at < len(parts):
            run = parts[at : at + period]
            labels = [p.label for p in run]
            end = at + period
            if len(run) == period and labels != ["#"]:
                while [p.label for p in parts[end : end + period]] == labels:
                    run = [merge(a, b) for a, b in zip(run, parts[end : end + period], strict=True)]
                    end += period
            if end == at + period or len(run) < period:
                out.append(parts[at])
                at += 1
            else:
                whole = run[0] if period == 1 else _summed(Part("*", parts=run))
                whole.repeated = True
                out.append(whole)
                at = end
        parts = out
    return parts


def merge(a: Part, b: Part) -> Part:
    """One part that fits what fits ``a`` or ``b``, which have the same label."""
    # Pairs whose parts are not aligned yet, outer before inner: a merged part's label and flags are
    # known at once, and what it is merged from stands before it.
    todo: list[tuple[Part, Part, Part]] = []
    whole = _merged(a, b, todo)
    for out, left, right in todo:  # grows on the way
        out.parts = align(left.parts, right.parts, todo)
    for out, _, _ in reversed(todo):
        _summed(out)
    return whole


def _merged(a: Part, b: Part, todo: list[tuple[Part, Part, Part]]) -> Part:
    optional, repeated = a.optional or b.optional, a.repeated or b.repeated
    if a.label == "#":
        chars = a.chars + b.chars
        same = a.fixed is not None and a.fixed == b.fixed
        return Part("#", fixed=a.fixed if same else None, chars=chars, slot_chars=0 if same else chars, optional=optional)
    out = Part(a.label, optional=optional, repeated=repeated)
    todo.append((out, a, b))
    return out


def align(left: list[Part], right: list[Part], todo: list[tuple[Part, Part, Part]]) -> list[Part]:
    """Both sequences as one; at a mismatch the shorter way to agreement is skipped as optional.

    Parts of merged elements are left to ``todo``.
    """
    out: list[Part] = []
    i = j = 0
    in_left, in_right = _places(left), _places(right)

    def skip(part: Part) -> None:
        part.optional = True
        out.append(part)

    while i < len(left) and j < len(right):
        if left[i].label == right[j].label:
            out.append(_merged(left[i], right[j], todo))
            i, j = i + 1, j + 1
            continue
        ahead, behind = _next(in_right, left[i].label, j), _next(in_left, right[j].label, i)
        if ahead is not None and (behind is None or ahead - j <= behind - i):
            for part in right[j:ahead]:
                skip(part)
            j = ahead
        elif behind is not None:
            for part in left[i:behind]:
                skip(part)
            i = behind
        else:
            skip(left[i])
            skip(right[j])
            i, j = i + 1, j + 1
    for part in left[i:] + right[j:]:
        skip(part)
    # Optional parts of one label side by side are one repeated part.
    return _joined(out, todo)


def _places(parts: list[Part]) -> dict[str, list[int]]:
    out: dict[str, list[int]] = {}
    for at, part in enumerate(parts):
        out.setdefault(part.label, []).append(at)
    return out


def _next(places: dict[str, list[int]], label: str, at: int) -> int | None:
    """The first place of a label after ``at``."""
    found = places.get(label, [])
    k = bisect_right(found, at)
    return found[k] if k < len(found) else None


def _joined(parts: list[Part], todo: list[tuple[Part, Part, Part]]) -> list[Part]:
    out: list[Part] = []
    for part in parts:
        if out and part.label == out[-1].label != "#" and (part.optional or out[-1].optional):
            part = _merged(out.pop(), part, todo)
            part.repeated = True
        out.append(part)
    return out


def dump(part: Part) -> list:
    """One row per part, each before its own parts; the last field counts those."""
    return [
        [p.label, p.optional + 2 * p.repeated, p.fixed, p.chars, p.slot_chars, len(p.parts)] for p in _preorder(part)
    ]


def load(rows: list) -> Part:
    done: list[Part] = []
    for label, flags, fixed, chars, slots, n in reversed(rows):
        inside = [done.pop() for _ in range(n)]
        done.append(Part(label, inside, "", fixed, chars, slots, bool(flags & 1), bool(flags & 2)))
    return done[0]


def _is_main(label: str) -> bool:
    tag, *names = label.split(".")
    return tag in MAIN_TAGS or (not MAIN_NAMES.isdisjoint(names)) or ("main" in names and tag == "div")


def main_path(wrapper: Part) -> list[str]:
    """Labels from the root to the element with the main text.

    That is the outermost main element with the most text, narrowed to an article inside it that
    holds at least half of that, never to a part of an article; main elements inside elements marked
    as boilerplate are looked for if there is no other. Without any, it is the element reached by
    following the child with over 60% of the slot text (of all text, if a host has one page only).
    Parts that cannot be main text are left out, unless a mere name or form holds over 60% of all text.
    """
    # Paths by number: the number of the path above, and the last label.
    above: list[tuple[int, str]] = []
    numbers: dict[tuple[int, str], int] = {}
    # Main elements: characters, path, path of the outermost main element, articles below that.
    found: list[tuple[int, int, int, int]] = []

    def visit(marks: bool) -> None:
        todo = [(p, -1, -1, 0) for p in reversed(wrapper.parts)]
        while todo:
            part, path, outer, articles = todo.pop()
            if part.label != "*":
                if part.label == "#" or _boiler(part.label, marks):
                    continue
                key = path, part.label
                path = numbers.setdefault(key, len(above))
                if path == len(above):
                    above.append(key)
                if outer >= 0:
                    articles += _tag(part) == "article"
                if _is_main(part.label):
                    outer = path if outer < 0 else outer
                    found.append((part.chars, path, outer, articles))
            todo += [(p, path, outer, articles) for p in reversed(part.parts)]

    visit(True)
    if not found:
        visit(False)
    if found:
        best, path = max(((f[0], f[1]) for f in found if f[1] == f[2]), key=lambda x: x[0])
        if above[path][1].partition(".")[0] != "article":
            inside = [
                (chars, own)
                for chars, own, outer, articles in found
                if outer == path and articles == 1 and above[own][1].partition(".")[0] == "article" and 2 * chars >= best
            ]
            path = max(inside, key=lambda x: x[0], default=(best, path))[1]
        labels = []
        while path >= 0:
            path, label = above[path]
            labels.append(label)
        return labels[::-1]
    path: list[str] = []
    here, mass = wrapper, (lambda p: p.slot_chars) if wrapper.slot_chars else (lambda p: p.chars)
    most = 0.6 * mass(wrapper)
    while True:
        inside = [q for p in here.parts for q in (p.parts if p.label == "*" else [p])]
        inside = [p for p in inside if p.label != "#" and not _boiler(p.label, mass(p) <= most)]
        if _tag(here) in PAGE:
            inside = [p for p in inside if _tag(p) != "header"]
        top = max(inside, key=mass, default=None)
        total = sum(mass(p) for p in inside)
        if top is None or top.repeated or not total or mass(top) <= 0.6 * total or _tag(top) == "p":
            return path
        path.append(top.label)
        here = top


def _at(part: Part, path: list[str]) -> list[Part]:
    """The elements a path leads to, all of them where it branches."""
    here = [part]
    for label in path:
        here = [q for p in here for q in p.parts if q.label == label]
    return here


def blocks_of(parts: list[Part]) -> list[str]:
    """Texts of the blocks, blanks folded, references decoded."""
    out: list[str] = []
    held: list[str] = []

    def flush() -> None:
        text = _BLANKS.sub(" ", entities.unescape("".join(held))).strip(" ")
        held.clear()
        if text and not text.isspace():
            out.append(text)

    for part in parts:
        # None ends a block.
        todo: list[Part | None] = [None, *reversed(part.parts)]
        while todo:
            p = todo.pop()
            if p is None:
                flush()
                continue
            if p.label == "#":
                held.append(p.text)
                continue
            tag = _tag(p)
            if _boiler(p.label) or (p.page_level and tag == "header"):
                flush()
            elif tag == "br":
                held.append(" ")
            else:
                if tag in BLOCK:
                    flush()
                    todo.append(None)
                todo.extend(reversed(p.parts))
    return out


def extract(page: str | None, path: list[str] | None) -> str:
    """The main text of a page by a host's rule, or by its own shape where the rule leads nowhere."""
    tree = parse(page)
    found = _at(tree, path) if path else []
    if not found or not (blocks := blocks_of(found)):
        own = main_path(as_wrapper(tree))
        blocks = blocks_of(_at(tree, own) if own else [tree])
    return "\n".join(blocks)


def infer_rules(pages: DataFrame) -> DataFrame:
    """``host, rule``: for each host of ``url, html`` the path to its main text, as JSON."""

    def pages_to_wrappers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Part] = {}

        def rows() -> pa.RecordBatch:
            texts = [json.dumps(dump(w)) for w in held.values()]
            salts = [xxhash.xxh32_intdigest(t) % SALTS for t in texts]
            hosts = list(held)
            held.clear()
            return pa.record_batch(
                [pa.array(hosts, pa.string()), pa.array(salts, pa.int32()), pa.array(texts, pa.string())],
                names=["host", "salt", "wrapper"],
            )

        for batch in batches:
            for host, page in zip(batch.column(0), batch.column(1), strict=True):
                host, one = host.as_py(), as_wrapper(parse(page.as_py()))
                held[host] = merge(held[host], one) if host in held else one
                if len(held) >= HELD_HOSTS:
                    yield rows()
        yield rows()

    def merged(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows are sorted by host; one wrapper is held at a time."""
        host, held = None, None
        for frame in frames:
            out = []
            for name, text in zip(frame["host"], frame["wrapper"], strict=True):
                one = load(json.loads(text))
                if held is not None and name == host:
                    held = merge(held, one)
                else:
                    if held is not None:
                        out.append((host, json.dumps(dump(held))))
                    host, held = name, one
            if out:
                yield _frame(out)
        if held is not None:
            yield _frame([(host, json.dumps(dump(held)))])

    def ruled(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in merged(frames):
            rules = [json.dumps(main_path(load(json.loads(text)))) for text in frame["wrapper"]]
            yield pd.DataFrame({"host": frame["host"], "rule": rules})

    schema = "host string, wrapper string"
    partial = pages.select(host_of(F.col("url")).alias("host"), "html").mapInArrow(
        pages_to_wrappers, "host string, salt int, wrapper string"
    )
    salted = partial.repartition("host", "salt").sortWithinPartitions("host", "salt", "wrapper")
    return (
        salted.mapInPandas(merged, schema)
        .repartition("host")
        .sortWithinPartitions("host", "wrapper")
        .mapInPandas(ruled, "host string, rule string")
    )


def _frame(rows: list[tuple[str, str]]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["host", "wrapper"])


def main_text(pages: DataFrame) -> DataFrame:
    """``pages`` with ``text``, the main text or an empty string, and ``n_chars``, its code points.

    Every row stays, repeated rows too, with all columns but ``html``; columns named like the new
    ones are replaced. A null ``html`` is an empty page. A null URL, or one without ``://``, has the
    empty host, which is a host like others. An empty table gives no rows.
    """
    rules = settle(infer_rules(pages), "wrapper-rules")
    rules = small(rules.withColumnRenamed("host", "__host").withColumnRenamed("rule", "__rule"), RULE_ROWS)
    kept = [c for c in pages.columns if c not in ("html", "text", "n_chars", "__host", "__rule")]
    joined = pages.select(
        *[F.col(f"`{c}`") for c in kept], F.col("html").alias("__html"), host_of(F.col("url")).alias("host__")
    ).join(rules, F.col("host__") == F.col("__host"), "left")
    joined = joined.select(*[F.col(f"`{c}`") for c in kept], "__rule", "__html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        paths: dict[str | None, list[str] | None] = {None: None}
        for batch in batches:
            texts = []
            for rule, page in zip(batch.column("__rule"), batch.column("__html"), strict=True):
                rule = rule.as_py()
                if rule not in paths:
                    paths[rule] = json.loads(rule)
                texts.append(extract(page.as_py(), paths[rule]))
            columns = [*batch.columns[:-2], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.record_batch(columns, names=[*kept, "text", "n_chars"])

    fields = [f for f in joined.schema.fields if f.name in kept]
    schema = T.StructType([*fields, T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    return joined.mapInArrow(run, schema)
