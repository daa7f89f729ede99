"""Main text of pages: host wrappers as union-free regular expressions over tag streams.

A page becomes a stream of structural tags and text slots.  Neighbouring equal blocks of the stream
are folded into a repeated group, so a page is a sequence of items.  Pages of a host are aligned one
after the other with the wrapper so far: equal items match, an item that one side repeats and the
other has once becomes a repeated group, and items that only one side has become optional.  The
result has no alternatives, only slots, optional items and repeated groups, and so can be merged
with another wrapper in the same way; wrappers of partitions merge into one of the host.

Template text is what an item of the wrapper says on nearly all contents of a host, outside of their main
regions; slots that vary are content.  A page is aligned with the wrapper of its host to find its template items.  What
is content is then read from the page with the elements that are never part of an article left out.
"""

from __future__ import annotations

import html as references
import pickle
import re
from collections.abc import Collection, Iterator
from dataclasses import dataclass, field
from difflib import SequenceMatcher
from functools import lru_cache
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railwatch.llm.urls import host_of
from railwatch.sources.staging import ship_package, staged

SHOWN, DOUBTED, NOT_SHOWN = range(3)
LONGEST_GROUP = 12
LABEL = 100  # characters of text for each control that a form may have as labels
REMEMBERED = 1_000  # characters of attributes; longer ones are read each time
PAGES_FOR_TEMPLATE = 4
NEARLY_ALL = 90  # per cent of a host's distinct contents that a template slot is on

# Names of elements and of their roles.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NEVER = frozenset(
    "head script style noscript template nav footer aside button select option textarea iframe object svg canvas "
    "audio video dialog menu map datalist title".split()
)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong "
    "sub sup time tt u var wbr input".split()
)
ENDED_BY = {
    "p": frozenset(
        "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu "
        "nav ol p pre section table ul".split()
    ),
    "li": frozenset({"li"}), "dt": frozenset({"dt", "dd"}), "dd": frozenset({"dt", "dd"}), "tr": frozenset({"tr"}),
    "td": frozenset({"td", "th", "tr"}), "th": frozenset({"td", "th", "tr"}), "option": frozenset({"option"}),
}
KEEPS_OPEN = frozenset("ul ol dl table tbody thead tfoot article section div body html".split())
CONTROLS = frozenset("input select button".split())
NEVER_ROLES = frozenset("navigation banner contentinfo complementary search alert dialog alertdialog menu menubar".split())
NEVER_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adsense adslot adbox sponsor sponsored promo promoted promotion "
    "banner sidebar sidenav menu nav navbar navigation breadcrumb breadcrumbs footer masthead topbar cookie cookies consent gdpr notice "
    "notices notification alert popup modal overlay lightbox newsletter subscribe subscription signup login share sharing sharebar "
    "social related recommended recommendations comment comments commentlist respond replies disqus widget widgets pagination pager "
    "toolbar disclaimer copyright hidden".split()
)
COMMENT_WORDS = frozenset("comment comments commentlist reply replies respond".split())
HEADER_WORDS = frozenset("header pageheader siteheader".split())

# A quote opens a value after "=" only, and the value ends at its closing quote; without one the quote is a stray.
_INSIDE_TAG = r"(?>[^>\"'=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?|[\"'])*+"
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    rf"|<(script|style|textarea|title|xmp|noembed|noframes|iframe)(?=[\s/>]){_INSIDE_TAG}>.*?(?:</\1\s*>|\Z)"
    rf"|<(/?)([a-zA-Z][^\s/>]*)({_INSIDE_TAG})(?:>|\Z)",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z_:][\w:.-]*)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


def _looks(tag: str, attributes: str) -> tuple[int, bool, bool, str]:
    """Whether an element is content by its names (``SHOWN``, ``DOUBTED``, ``NOT_SHOWN``), is a comment, is a main region, and its mark in the stream."""
    return (_looks_held if len(attributes) <= REMEMBERED else _looks_of)(tag, attributes)


def _looks_of(tag: str, attributes: str) -> tuple[int, bool, bool, str]:
    values = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)}
    names = f"{values.get('class', '')} {values.get('id', '')}"
    parts = frozenset(p.lower() for p in _NAME_PART.findall(names)) | frozenset(names.lower().split())
    role = values.get("role", "").lower()
    comment = bool(parts & COMMENT_WORDS)
    hides = "hidden" in values or values.get("aria-hidden") == "true" or bool(
        re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", values.get("style", ""), re.I)
    )
    root = tag in ("html", "body")
    main = tag in ("article", "main") or role in ("main", "article") or values.get("itemprop") == "articleBody"
    never = NOT_SHOWN if tag in NEVER or hides or role in NEVER_ROLES or comment else SHOWN
    if never == SHOWN and (tag == "form" or (not main and parts & NEVER_WORDS)):
        never = DOUBTED
    header = tag == "header" or bool(parts & HEADER_WORDS)
    mark = re.sub(r"\d+", "", values.get("class", "").strip()) or re.sub(r"\d+", "", values.get("id", ""))
    name = f"{tag}.{mark}" if mark else tag
    return (SHOWN if root else never, comment, main and not comment and not root, ("^" if header and not root else "") + name)


_looks_held = lru_cache(4096)(_looks_of)


@dataclass
class Block:
    """A run of text between structural tags."""

    text: str
    never: bool
    header: bool
    region: int  # number of the outermost main region around it, or -1
    linked: int  # characters inside links
    at: int  # position in the tag stream
    doubts: tuple[int, ...] = ()  # numbers of the elements around it whose names alone speak against it


@dataclass
class Page:
    stream: list[str] = field(default_factory=list)
    blocks: list[Block] = field(default_factory=list)
    controls: dict[int, int] = field(default_factory=dict)  # visible controls of each form

    def settle(self) -> None:
        """Decide doubted elements: they are not content, unless they hold most of a page without a main region.

        A form must hold more text than labels of its controls take.
        """
        open_ = [b for b in self.blocks if not b.never]
        sizes: dict[int, int] = {}
        for b in open_:
            for d in b.doubts:
                sizes[d] = sizes.get(d, 0) + len(b.text)
        most = set()
        if not any(b.region >= 0 and not b.doubts for b in open_):
            total = sum(len(b.text) for b in open_)
            most = {d for d, n in sizes.items() if 2 * n > total and n > LABEL * self.controls.get(d, 0)}
        for b in open_:
            b.never = any(d not in most for d in b.doubts)


def read(markup: str) -> Page:
    """Tag stream and text blocks of a page; forgiving of unclosed, misnested and cut-off markup."""
    page = Page()
    open_tags: list[tuple[str, int, bool, bool, int]] = []  # tag, shown or not, header, begins a region, number
    words: list[str] = []
    linked, regions, position, number = 0, 0, 0, 0

    def flush() -> None:
        nonlocal linked
        text = " ".join("".join(words).split())
        words.clear()
        if text:
            region = next((i for i, t in enumerate(open_tags) if t[3]), -1)
            page.blocks.append(Block(
                text, any(t[1] == NOT_SHOWN for t in open_tags), region < 0 and any(t[2] for t in open_tags),
                regions if region >= 0 else -1, linked, len(page.stream), tuple(t[4] for t in open_tags if t[1] == DOUBTED),
            ))
            page.stream.append("#")
        linked = 0

    def say(raw: str) -> None:
        nonlocal linked
        if raw:
            text = references.unescape(raw)
            words.append(text)
            if any(t[0] == "a" for t in open_tags[-4:]):
                linked += len(text)

    for match in _TOKEN.finditer(markup):
        say(markup[position:match.start()])
        position = match.end()
        if match[3] is None:
            if match[0].startswith("<![CDATA["):
                words.append(match[0][9:].removesuffix("]]>"))
            elif match[1] and match[1].lower() not in ("script", "style"):
                flush()
            continue
        tag = match[3].lower()
        if tag in CONTROLS and not match[2] and "hidden" not in match[4].lower():
            for t in open_tags:
                if t[0] == "form":
                    page.controls[t[4]] = page.controls.get(t[4], 0) + 1
        if tag in INLINE:
            if tag == "br":
                words.append(" ")
            elif match[2]:
                for i in range(len(open_tags) - 1, max(-1, len(open_tags) - 6), -1):
                    if open_tags[i][0] == tag:
                        del open_tags[i]
                        break
                    if open_tags[i][0] not in INLINE:
                        break
            elif tag not in VOID and not match[4].endswith("/"):
                never, _, _, _ = _looks(tag, match[4])
                number += 1
                open_tags.append((tag, never, False, False, number))
            continue
        flush()
        if match[2]:
            at = next((i for i in range(len(open_tags) - 1, -1, -1) if open_tags[i][0] == tag), -1)
            if at >= 0:
                del open_tags[at:]
                if tag not in ENDED_BY:
                    page.stream.append("/" + tag)
            continue
        never, comment, main, mark = _looks(tag, match[4])
        if main and not comment and any(t[1] for t in open_tags) and not any(t[3] for t in open_tags):
            # A main region does not lie in a menu or an advert: those were left unclosed.
            while any(t[1] for t in open_tags):
                open_tags.pop()
        # Elements with an optional end are ended by what may not stand in them; so are inline ones.
        for i in range(len(open_tags) - 1, -1, -1):
            if tag in ENDED_BY.get(open_tags[i][0], ()):
                del open_tags[i:]
                break
            if open_tags[i][0] in KEEPS_OPEN:
                break
        inside = any(t[3] for t in open_tags)
        # An article inside an article is a comment on it.
        nested = tag == "article" and any(t[3] and t[0] == "article" for t in open_tags)
        begins = main and not inside
        regions += begins
        header = mark.startswith("^")
        page.stream.append(mark.removeprefix("^"))
        if tag not in VOID and not match[4].endswith("/"):
            number += 1
            open_tags.append((tag, NOT_SHOWN if nested else never, header, begins, number))
    say(markup[position:])
    flush()
    page.settle()
    return page


def fold(stream: list[str]) -> list[tuple[tuple[str, ...], int, int]]:
    """Items ``(block, start, end)`` of a stream; a block that repeats at once is one item.

    A repeated group has the mark ``+`` in front of its block.
    """
    items, i, n = [], 0, len(stream)
    while i < n:
        best = None
        for size in range(1, min(LONGEST_GROUP, (n - i) // 2) + 1):
            if stream[i] == stream[i + size] and stream[i:i + size] == stream[i + size:i + 2 * size]:
                block, end = stream[i:i + size], i + 2 * size
                while stream[end:end + size] == block:
                    end += size
                best = (("+", *block), i, end)
                break
        if best is None:
            best = ((stream[i],), i, i + 1)
        items.append(best)
        i = best[2]
    return items


def _as_groups(keys: list, groups: list) -> list[tuple[int, int, tuple]]:
    """Spans of ``keys`` as items, with single blocks that the other side repeats taken as that group."""
    spans, i = [], 0
    by_first = {}
    for group in sorted(set(groups), key=lambda g: (-len(g), g)):
        by_first.setdefault((group[1],), []).append(group)
    while i < len(keys):
        for group in by_first.get(keys[i], ()):
            size = len(group) - 1
            if all(i + k < len(keys) and keys[i + k] == (group[k + 1],) for k in range(size)):
                spans.append((i, i + size, group))
                i += size
                break
        else:
            spans.append((i, i + 1, keys[i]))
            i += 1
    return spans


def _align(one: list, two: list) -> list[tuple[int, int]]:
    """Longest common subsequence of two key lists, after equal beginnings and ends; between long ones, long common blocks."""
    if one == two:
        return [(i, i) for i in range(len(one))]
    head = 0
    while head < min(len(one), len(two)) and one[head] == two[head]:
        head += 1
    tail = 0
    while tail < min(len(one), len(two)) - head and one[-1 - tail] == two[-1 - tail]:
        tail += 1
    a, b = one[head:len(one) - tail], two[head:len(two) - tail]
    ends = [(k, k) for k in range(head)], [(len(one) - tail + k, len(two) - tail + k) for k in range(tail)]
    if len(a) * len(b) > SEARCHED:
        blocks = SequenceMatcher(None, a, b, autojunk=False).get_matching_blocks()
        return [*ends[0], *((head + m.a + k, head + m.b + k) for m in blocks for k in range(m.size)), *ends[1]]
    lengths = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            lengths[i][j] = lengths[i + 1][j + 1] + 1 if a[i] == b[j] else max(lengths[i + 1][j], lengths[i][j + 1])
    pairs, i, j = ends[0], 0, 0
    while i < len(a) and j < len(b):
        if a[i] == b[j]:
            pairs.append((head + i, head + j))
            i, j = i + 1, j + 1
        elif lengths[i + 1][j] >= lengths[i][j + 1]:
            i += 1
        else:
            j += 1
    return pairs + ends[1]


# An item of a wrapper: [block, contents that have it, its texts by checksum and how many contents say each].
TEXTS = 32  # texts that an item remembers; the count of one said on 90 % is short by a third of a per cent at most


def said_by(page: Page) -> list[tuple[tuple[str, ...], int | None]]:
    """The items of a page: their block, and the checksum of their text where that may be template text.

    Items with text in a main region are content, and items that are never shown need no template.
    """
    blocks = {b.at: b for b in page.blocks}
    out = []
    for block, start, end in fold(page.stream):
        said = [blocks[i] for i in range(start, end) if i in blocks]
        open_ = said and all(b.region < 0 for b in said) and not all(b.never for b in said)
        out.append((block, _digest("\n".join(b.text for b in said)) if open_ else None))
    return out


def wrapper_of(items: list[tuple[tuple[str, ...], int | None]]) -> list[list]:
    return [[list(block), 1, {} if text is None else {text: 1}] for block, text in items]


def _summed(one: dict[int, int], two: dict[int, int]) -> dict[int, int]:
    """Counts added up; beyond ``TEXTS`` every count falls by the next largest (frequent items survive)."""
    out = dict(one)
    for text, n in two.items():
        out[text] = out.get(text, 0) + n
    if len(out) > TEXTS:
        less = sorted(out.values(), reverse=True)[TEXTS]
        out = {t: n - less for t, n in out.items() if n > less}
    return out


def _joined(items: list[list], spans: list[tuple[int, int, tuple]]) -> list[list]:
    """Items with the spans of a group taken together; the texts of several are no text of the group."""
    return [[list(key), max(p[1] for p in items[a:b]), items[a][2] if b - a == 1 else {}] for a, b, key in spans]


def merge(one: list[list], two: list[list]) -> list[list]:
    """The union-free expression of both: matched items add up, the others become optional."""
    keys = [[tuple(i[0]) for i in w] for w in (one, two)]
    if keys[0] != keys[1]:
        groups = [[k for k in ks if k[0] == "+"] for ks in keys]
        one = _joined(one, _as_groups(keys[0], groups[1]))
        two = _joined(two, _as_groups(keys[1], groups[0]))
        keys = [[tuple(i[0]) for i in w] for w in (one, two)]
    out, i, j = [], 0, 0
    for a, b in [*_align(*keys), (len(one), len(two))]:
        out += one[i:a] + two[j:b]
        if a < len(one):
            x, y = one[a], two[b]
            out.append([x[0], x[1] + y[1], _summed(x[2], y[2])])
        i, j = a + 1, b + 1
    return out


def _digest(text: str) -> int:
    return int.from_bytes(blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(), "big", signed=True)


def main_text(page: Page, template: Collection[int]) -> str:
    """The blocks of a page that are content, joined by line breaks; ``template`` are numbers of items."""
    dropped: set[int] = set()
    if template:
        for k, (_, start, end) in enumerate(fold(page.stream)):
            if k in template:
                dropped.update(range(start, end))
    shown = [b for b in page.blocks if not b.never and b.at not in dropped]
    plain = [b for b in shown if b.region >= 0 or not b.header and not (b.linked > 0.8 * len(b.text) and len(b.text) < 200)]
    inside = [b for b in shown if b.region >= 0]
    if 2 * sum(len(b.text) for b in inside) > sum(len(b.text) for b in plain):
        return "\n".join(b.text for b in inside)
    return "\n".join(b.text for b in plain)


def template_items(items: list[tuple[tuple[str, ...], int | None]], wrapper: list[list], constant: list[int | None]) -> list[int]:
    """Numbers of a page's items that match an item of its host's wrapper and say that item's template text."""
    keys, others = [block for block, _ in items], [tuple(w[0]) for w in wrapper]
    groups = [[k for k in ks if k[0] == "+"] for ks in (keys, others)]
    spans = [_as_groups(keys, groups[1]), _as_groups(others, groups[0])]
    out = []
    for a, b in _align(*([s[2] for s in side] for side in spans)):
        (low, high, _), (at, to, _) = spans[0][a], spans[1][b]
        if high - low == 1 and to - at == 1 and items[low][1] is not None and items[low][1] == constant[at]:
            out.append(low)
    return out


PARTS = (1024, 32)  # of a host, merged by themselves before they are merged with each other
SEARCHED = 40_000  # pairs of items up to which the longest common sequence is searched in full


def _merged(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One wrapper for each group of ``keys``, merged one after the other in a stream; no group is held."""
    def fold_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held, n = None, None, 0
        done: list[tuple] = []
        for batch in batches:
            marks = list(zip(*(batch.column(k).to_pylist() for k in range(len(keys))), strict=True))
            for mark, text, contents in zip(marks, batch.column(len(keys)), batch.column(len(keys) + 1).to_pylist(), strict=True):
                own = pickle.loads(text.as_buffer())  # noqa: S301  written by this module
                if mark != current:
                    if held is not None:
                        done.append((*current, pickle.dumps(held), n))
                    current, held, n = mark, own, contents
                else:
                    held, n = merge(held, own), n + contents
            yield out(done)
            done = []
        if held is not None:
            yield out([(*current, pickle.dumps(held), n)])

    def out(done: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*done, strict=True)) or [[]] * (len(keys) + 2)
        kinds = [pa.string(), *[pa.int32()] * (len(keys) - 1), pa.binary(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[*keys, "wrapper", "contents"])

    schema = T.StructType([rows.schema[k] for k in keys] + [T.StructField("wrapper", T.BinaryType()), T.StructField("contents", T.LongType())])
    ordered = rows.select(*keys, "wrapper", "contents").repartition(*keys).sortWithinPartitions(*keys, "wrapper")
    return ordered.mapInArrow(fold_groups, schema)


def wrappers(pages: DataFrame) -> DataFrame:
    """``host, wrapper, contents`` from rows of ``host, html``: the merged wrapper of all distinct contents of each host.

    Pages whose shown text is the same are one content.  Pages of one shape (the same blocks in the same
    order) align without a search: their items are counted by Spark, map side first, by (host, shape, item, text).  The
    shapes of a host are then aligned and merged in a tree: in many parts of the host (``PARTS``), then in few, then all.
    Shapes and counts move, texts and pages do not.
    """
    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            contents, shapes, keys, texts = [], [], [], []
            for markup in batch.column(1):
                page = read(markup.as_py() or "")
                shown = [b.text for b in page.blocks if not b.never]
                items = said_by(page)
                blocks = "\n".join("\t".join(block) for block, _ in items)
                contents.append(_digest("\n".join(shown)) if shown else None)
                shapes.append(_digest(blocks))
                keys.append(blocks)
                texts.append([text for _, text in items])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(contents, pa.int64()), pa.array(shapes, pa.int64()), pa.array(keys, pa.string()), pa.array(texts, pa.list_(pa.int64()))],
                names=["host", "content", "shape", "blocks", "texts"],
            )

    told = staged(pages.mapInArrow(look, "host string, content long, shape long, blocks string, texts array<long>").where("content IS NOT NULL"), "shapes")
    # A content stands for one page, in its smallest shape.
    one = told.groupBy("host", "content").agg(F.min("shape").alias("shape"))
    told_once = told.join(one, ["host", "content", "shape"], "left_semi")
    said = told_once.select("host", "content", "shape", F.posexplode("texts").alias("item", "text")).where("text IS NOT NULL").distinct()
    counts = said.groupBy("host", "shape", "item", "text").agg(F.count(F.lit(1)).alias("n"))
    best = counts.withColumn("k", F.row_number().over(Window.partitionBy("host", "shape", "item").orderBy(F.desc("n"), "text"))).where(F.col("k") <= TEXTS)
    texts = best.groupBy("host", "shape").agg(F.collect_list(F.struct("item", "text", "n")).alias("said"))
    shapes = told.groupBy("host", "shape").agg(F.min("blocks").alias("blocks")).join(
        one.groupBy("host", "shape").agg(F.count(F.lit(1)).alias("contents")), ["host", "shape"]
    ).join(texts, ["host", "shape"], "left")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for blocks, n, said in zip(*(batch.column(k).to_pylist() for k in (2, 3, 4)), strict=True):
                wrapper = [[block.split("\t"), n, {}] for block in blocks.split("\n")]
                for s in said or ():
                    wrapper[s["item"]][2][s["text"]] = s["n"]
                made.append(pickle.dumps(wrapper))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(made, pa.binary()), batch.column(3)], names=["host", "part", "wrapper", "contents"])

    merged = shapes.select("host", F.pmod("shape", F.lit(PARTS[0])).cast("int").alias("part"), "blocks", "contents", "said").mapInArrow(
        build, "host string, part int, wrapper binary, contents long")
    for parts in PARTS:
        merged = _merged(merged.withColumn("part", (F.col("part") % parts).cast("int")), ["host", "part"])
    return _merged(merged, ["host"])


def constant_texts(wrapper: list[list], contents: int) -> list[int | None]:
    """For each item of a wrapper the text that nearly all contents of the host say there, four at least."""
    out = []
    for _, _, texts in wrapper:
        text, n = max(texts.items(), key=lambda x: (x[1], x[0]), default=(None, 0))
        out.append(text if n >= PAGES_FOR_TEMPLATE and 100 * n >= NEARLY_ALL * contents else None)
    return out


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``id, url, text`` for every page.

    Every page is aligned with the wrapper of its host (see :func:`wrappers`) that the wrapper has template text for;
    items that match such an item and say its text go.  A page's text is that of its main regions
    (article, main), in page order, if they hold most of it, else of all its blocks but links and headers;
    menus, footers, asides, notices, adverts, forms, comments and hidden parts are left out.  Forms, and elements that only their class or
    id speaks against, stay where they hold most of a page that has no main region.

    Null and empty markup gives an empty text; a null url has the empty host.  Null ids and repeated
    rows are extracted each (repeats are one content: a host of copies keeps its text).  Other columns are not carried.
    An empty table gives an empty result.
    """
    ship_package(pages.sparkSession)
    data = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    hosted = data.withColumn("host", host_of(F.col("url")))

    def worth(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                any(c is not None for c in constant_texts(pickle.loads(w.as_buffer()), n))  # noqa: S301
                for w, n in zip(batch.column(1), batch.column(2).to_pylist(), strict=True)
            ]
            yield batch.filter(pa.array(rows, pa.bool_()))

    found = wrappers(hosted.select("host", "html"))
    told = staged(found.mapInArrow(worth, found.schema).withColumnRenamed("host", "_host"), "wrappers")
    joined = hosted.join(told, F.col("host") == F.col("_host"), "left").select("id", "url", "html", "wrapper", "contents")
    kind = pages.schema[id_col].dataType

    def text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, known = [], {}
            for markup, wrapper, contents in zip(batch.column(2), batch.column(3), batch.column(4).to_pylist(), strict=True):
                page, template = read(markup.as_py() or ""), []
                if contents is not None:
                    raw = wrapper.as_py()
                    if raw not in known:
                        known.clear()
                        items = pickle.loads(raw)  # noqa: S301
                        known[raw] = items, constant_texts(items, contents)
                    template = template_items(said_by(page), *known[raw])
                out.append(main_text(page, frozenset(template)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.string())], names=["id", "url", "text"])

    schema = T.StructType([T.StructField("id", kind), T.StructField("url", T.StringType()), T.StructField("text", T.StringType())])
    return joined.mapInArrow(text, schema).select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text")
