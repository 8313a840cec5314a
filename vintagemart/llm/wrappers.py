"""Main text of web pages by union-free wrapper inference.

The pages of a host share templates. A wrapper is a regular expression without
unions over the host's block elements: sequences, optional parts, repeated parts and
text slots. It is inferred by aligning pages with it one after another. Sibling
elements of one kind in a row become a repeated part, and so do rows of alternating
kinds; what has no partner in the other sequence becomes optional; texts that differ
leave a slot, and slots keep what they saw (a sample of the distinct page contents,
characters, linked characters and whether the text ever changed). Copies of a page
count as one page.

Wrappers of one host merge like pages do, so tasks infer wrappers of the pages they
read, and these meet by host in rounds of bounded groups: a host with most of the
pages is no larger for any task than one with few. Then each page is aligned with
the wrapper of its host, which says for every text whether its slot is part of the
article. Inside an article, where rows of paragraphs share a slot, it says so by the
texts that repeat over all pages of the host, which are counted by host and text.
"""

from __future__ import annotations

import hashlib
import json
import zlib
from collections import Counter
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vintagemart.llm.markup import Element, Slot, parse
from vintagemart.llm.worker import slices
from vintagemart.sources.scratch import materialize

# Wrappers that one group of a merging round holds per host.
FAN_IN = 64
# Hosts a task keeps open before it hands its wrappers over.
OPEN_HOSTS = 1_000
# Bytes of all wrappers up to which they are broadcast; more are shuffled.
BROADCAST_BYTES = 16 << 20
# Longest row of alternating kinds that is looked for.
WIDEST = 4
# A text that never changed over so many unlike pages is part of the template.
CONSTANT_PAGES = 3
# Lowest hashes of page contents that a slot keeps: up to so many pages are counted
# exactly, which is more than CONSTANT_PAGES asks for.
PAGE_SAMPLE = 16
# Share of the host's unlike pages that have a text of the template.
REPEATED_SHARE = 0.75
# Words from which on a text that isn't a link counts as repeated inside an article:
# short ones are also units, ingredients, answers.
REPEATED_WORDS = 5


class Part:
    """A block, a group of blocks that repeats as a whole (``unit`` names its marks)
    or a text slot of a wrapper."""

    __slots__ = ("mark", "optional", "repeated", "children", "unit", "seen", "source", "pages", "repeating")

    def __init__(self, mark: str, children: list[Part] | None = None, unit: tuple = ()) -> None:
        self.mark, self.unit = mark, unit
        self.optional = self.repeated = False
        self.children: list[Part] = children or []
        # Of a slot: sample of pages, characters, linked characters, lowest and highest text sum.
        self.seen: list | None = None
        self.source: list[Slot] = []
        # Of a root: the texts of unlike pages by their content, and those texts that are
        # known to repeat over the host.
        self.pages: dict[int, list[int]] | None = None
        self.repeating: list[int] = []

    def packed(self) -> list:
        flags = self.optional + 2 * self.repeated
        data = [self.mark, flags, [c.packed() for c in self.children], list(self.unit), self.seen]
        return data if self.pages is None else [*data, list(self.pages.items())]

    @staticmethod
    def unpacked(data: list) -> Part:
        mark, flags, children, unit, seen, *root = data
        part = Part(mark, [Part.unpacked(c) for c in children], tuple(unit))
        part.optional, part.repeated, part.seen = bool(flags & 1), bool(flags & 2), seen
        if root:
            part.pages, part.repeating = dict(root[0]), root[1] if len(root) > 1 else []
        return part


SLOT = "#"


def _text_sum(text: str) -> int:
    return zlib.crc32(text.encode("utf-8", "surrogatepass"))


def _repeatable(slot: Slot) -> int | None:
    """What an article's text is known by on other pages; None if it's too short to say,
    a heading or a table's cell."""
    tag = slot.mark.split(".", 1)[0]
    if tag in ("h1", "h2", "h3", "h4", "h5", "h6", "td", "th", "pre"):
        return None
    if 2 * slot.linked <= len(slot.text) and slot.text.count(" ") < REPEATED_WORDS - 1:
        return None
    return zlib.crc32(slot.mark.encode("utf-8", "surrogatepass"), _text_sum(slot.text))


def _seen(slot: Slot, content: int) -> list:
    total = _text_sum(slot.text)
    return [[content], len(slot.text), slot.linked, total, total]


def _add_seen(one: list, two: list) -> None:
    pages = one[0]
    if two[0] != pages and (len(pages) < PAGE_SAMPLE or two[0][0] < pages[-1]):
        one[0] = sorted({*pages, *two[0]})[:PAGE_SAMPLE]
    one[1] += two[1]
    one[2] += two[2]
    one[3], one[4] = min(one[3], two[3]), max(one[4], two[4])


def _of_page(node: Element | Slot, content: int) -> Part:
    if isinstance(node, Slot):
        part = Part(SLOT)
        part.seen, part.source = _seen(node, content), [node]
        return part
    return Part(node.mark, _folded([_of_page(c, content) for c in node.children]))


def _folded(parts: list[Part]) -> list[Part]:
    """Rows of equal marks, then of equal runs of marks, become repeated parts."""
    for width in range(1, WIDEST + 1):
        if len(parts) < 2 * width:
            break
        out, at = [], 0
        while at < len(parts):
            unit = tuple(p.mark for p in parts[at : at + width])
            end = at + width
            while len(unit) == width and tuple(p.mark for p in parts[end : end + width]) == unit:
                end += width
            if end == at + width or width > 1 and len(set(unit)) == 1:
                out.append(parts[at])
                at += 1
                continue
            first = parts[at] if width == 1 else Part("(" + " ".join(unit) + ")", parts[at : at + width], unit)
            for other in range(at + width, end, width):
                if width == 1:
                    _merge(first, parts[other])
                else:
                    for mine, theirs in zip(first.children, parts[other : other + width]):
                        _merge(mine, theirs)
            first.repeated = True
            out.append(first)
            at = end
        parts = out
    return parts


def _grouped(parts: list[Part], groups: list[Part]) -> list[Part]:
    """Single occurrences of groups that the other sequence repeats."""
    for group in groups:
        width, at = len(group.unit), 0
        out = []
        while at < len(parts):
            if tuple(p.mark for p in parts[at : at + width]) == group.unit:
                out.append(Part(group.mark, parts[at : at + width], group.unit))
                at += width
            else:
                out.append(parts[at])
                at += 1
        parts = out
    return parts


def _pairs(one: list[Part], two: list[Part]) -> list[tuple[int, int]]:
    """Places of a longest common subsequence of marks."""
    head = 0
    while head < min(len(one), len(two)) and one[head].mark == two[head].mark:
        head += 1
    n, m = len(one), len(two)
    while n > head and m > head and one[n - 1].mark == two[m - 1].mark:
        n, m = n - 1, m - 1
    found = [(i, i) for i in range(head)]
    if n > head and m > head:
        best = [[0] * (m - head + 1) for _ in range(n - head + 1)]
        for i in range(n - 1, head - 1, -1):
            row, below = best[i - head], best[i - head + 1]
            for j in range(m - 1, head - 1, -1):
                k = j - head
                row[k] = below[k + 1] + 1 if one[i].mark == two[j].mark else max(below[k], row[k + 1])
        i = j = head
        while i < n and j < m:
            if one[i].mark == two[j].mark:
                found.append((i, j))
                i, j = i + 1, j + 1
            elif best[i - head + 1][j - head] >= best[i - head][j - head + 1]:
                i += 1
            else:
                j += 1
    return found + [(n + i, m + i) for i in range(len(one) - n)]


def _merge(one: Part, two: Part) -> None:
    """Align ``two`` with ``one``, which takes in what it lacks."""
    one.optional |= two.optional
    one.repeated |= two.repeated
    if two.seen is not None:
        _add_seen(one.seen, two.seen)
        one.source += two.source
    if not one.children and not two.children:
        return
    _align(one, two.children)


def _align(one: Part, theirs: list[Part]) -> None:
    mine = one.children
    groups = [p for p in mine if p.unit and not any(p.mark == q.mark for q in theirs)]
    if groups:
        theirs = _grouped(theirs, groups)
    groups = [p for p in theirs if p.unit and not any(p.mark == q.mark for q in mine)]
    if groups:
        mine = _grouped(mine, groups)
    out, i, j = [], 0, 0
    for a, b in [*_pairs(mine, theirs), (len(mine), len(theirs))]:
        for part in (*mine[i:a], *theirs[j:b]):
            part.optional = True
            out.append(part)
        if a < len(mine):
            _merge(mine[a], theirs[b])
            out.append(mine[a])
        i, j = a + 1, b + 1
    one.children = out


def _find(one: Part, two: Part, owner: dict[int, Part]) -> None:
    """The wrapper's slots for the texts of a page's part ``two``, aligned with ``one``
    as ``_merge`` does, while ``one`` stays as it is. Texts without a partner have none."""
    if one.seen is not None:
        for slot in two.source:
            owner[id(slot)] = one
    if not one.children or not two.children:
        return
    mine, theirs = one.children, two.children
    groups = [p for p in mine if p.unit and not any(p.mark == q.mark for q in theirs)]
    if groups:
        theirs = _grouped(theirs, groups)
    groups = [p for p in theirs if p.unit and not any(p.mark == q.mark for q in mine)]
    if groups:
        mine = _grouped(mine, groups)
    for a, b in _pairs(mine, theirs):
        _find(mine[a], theirs[b], owner)


def _slots(node: Element, found: list[Slot], shape: list[str]) -> None:
    for child in node.children:
        if isinstance(child, Slot):
            found.append(child)
            shape.append(SLOT)
        else:
            shape.append(child.mark)
            _slots(child, found, shape)
            shape.append("/")


class Wrapper:
    """The wrapper of one host. Pages of a shape that was met before aren't aligned
    again, only counted."""

    def __init__(self, root: Part | None = None) -> None:
        self.root = root
        self.places: dict[str, list[Part]] = {}
        self.found: dict[str, list[Part | None]] = {}
        # Slots known as template text or as links from the pages that the wrapper came from.
        self.template: set[int] = set()
        self.links: set[int] = set()
        # Texts of articles that repeat over the host.
        self.repeated: set[int] = set()
        if root is not None:
            self._find_template(root)
            pages = root.pages or {}
            counts = Counter(total for totals in pages.values() for total in totals)
            least = max(CONSTANT_PAGES, REPEATED_SHARE * len(pages))
            self.repeated = {total for total, n in counts.items() if n >= least}.union(root.repeating)

    def _find_template(self, part: Part) -> None:
        if part.seen is not None and _is_template(part):
            self.template.add(id(part))
        if part.seen is not None and 2 * part.seen[2] > part.seen[1]:
            self.links.add(id(part))
        for child in part.children:
            self._find_template(child)

    def add(self, page: Element) -> tuple[list[Slot], list[Part]]:
        """Take in a page; its texts in order, and the slots they fell into."""
        slots: list[Slot] = []
        shape: list[str] = []
        _slots(page, slots, shape)
        key = " ".join(shape)
        content = "\n".join([key, *(s.text for s in slots)]).encode("utf-8", "surrogatepass")
        content = int.from_bytes(hashlib.blake2b(content, digest_size=8).digest(), "little", signed=True)
        if self.root is None:
            self.root = Part("")
            self.root.pages = {}
        # Copies of a page differ in their links at most.
        totals = sorted({t for s in slots if (t := _repeatable(s)) is not None})
        self.root.pages[content] = min(totals, self.root.pages.get(content, totals))
        places = self.places.get(key)
        if places is not None:
            for slot, part in zip(slots, places):
                _add_seen(part.seen, _seen(slot, content))
            return slots, places
        part = _of_page(page, content)
        if self.root.children:
            _merge(self.root, part)
        else:
            self.root.children = part.children
        owner: dict[int, Part] = {}
        self._collect(self.root, owner)
        places = [owner[id(slot)] for slot in slots]
        if len(self.places) > 2_000:
            self.places.clear()
        self.places[key] = places
        return slots, places

    def find(self, page: Element) -> tuple[list[Slot], list[Part | None]]:
        """A page's texts in order, and the slots they fall into; the wrapper stays as it
        is, so what is found depends on the page and the wrapper alone."""
        slots: list[Slot] = []
        shape: list[str] = []
        _slots(page, slots, shape)
        if self.root is None:
            return slots, [None] * len(slots)
        # Parts are aligned by marks, so pages of one shape have the same places.
        key = " ".join(shape)
        if key not in self.found:
            owner: dict[int, Part] = {}
            _find(self.root, _of_page(page, 0), owner)
            if len(self.found) > 2_000:
                self.found.clear()
            self.found[key] = [owner.get(id(slot)) for slot in slots]
        return slots, self.found[key]

    def _collect(self, part: Part, owner: dict[int, Part]) -> None:
        for slot in part.source:
            owner[id(slot)] = part
        part.source = []
        for child in part.children:
            self._collect(child, owner)

    def join(self, other: Part) -> None:
        """Take in a wrapper of other pages; known shapes have to be aligned anew."""
        if self.root is None:
            self.root = other
        else:
            _merge(self.root, other)
            self.root.pages.update(other.pages)
        self.places.clear()

    def taken_pages(self) -> dict[int, list[int]]:
        """The texts of the pages met since the last time, which the wrapper forgets."""
        pages, self.root.pages = self.root.pages, {}
        return pages

    def packed(self) -> str:
        return json.dumps(self.root.packed(), separators=(",", ":"))


def _mains(node: Element, level: int, strict: bool, found: list[Element]) -> None:
    """Topmost elements of a level that aren't beside the article."""
    for child in node.children:
        if isinstance(child, Element) and not _out(child, strict):
            if child.level >= level:
                found.append(child)
            else:
                _mains(child, level, strict, found)


def _out(node: Element, strict: bool) -> bool:
    out = node.beside or node.doubtful
    from_name = out and node.tag in ("html", "body", "main", "div", "section")
    if from_name and (not strict or node.tag in ("html", "body", "main")):
        return False
    return out


def _dropped(node: Element, template: set[int]) -> bool:
    """Doubtful elements are dropped if links or template texts are most of them."""
    if not node.doubtful:
        return node.beside
    slots: list[Slot] = []
    _slots(node, slots, [])
    return 2 * sum(len(s.text) if id(s) in template else s.linked for s in slots) > sum(len(s.text) for s in slots)


def _kept(node: Element, keep: set[int], template: set[int]) -> None:
    for child in node.children:
        if isinstance(child, Slot):
            keep.add(id(child))
        elif not _dropped(child, template):
            _kept(child, keep, template)


def _outside(node: Element, keep: set[int], template: set[int]) -> None:
    for child in node.children:
        if isinstance(child, Slot):
            keep.add(id(child))
            continue
        page = child.tag in ("html", "body", "main")
        out = _dropped(child, template) if child.doubtful and not page else _out(child, True)
        if not out and not (child.around and child.tag not in ("html", "body")):
            _outside(child, keep, template)


def _is_template(part: Part) -> bool:
    """The same on every page."""
    pages, _, _, low, high = part.seen
    return len(pages) >= CONSTANT_PAGES and low == high


def main_text(page: Element, wrapper: Wrapper) -> str:
    """The texts of the article's blocks, joined by line ends.

    The article is what the page marks as such, in this order: article elements, the
    main element, elements named after the content. There, texts that repeat over the
    host are left out, unless they are half of the article, as in copies with small
    changes. Elsewhere, slots that the wrapper knows as links or as constant are left out.
    """
    slots, places = wrapper.find(page)
    # Links are template texts where the slot and the text itself are mostly links.
    template = {
        id(s)
        for s, p in zip(slots, places)
        if id(p) in wrapper.template or id(p) in wrapper.links and 2 * s.linked > len(s.text)
    }
    keep: set[int] = set()
    for strict in (True, False):
        for level in (3, 2, 1):
            mains: list[Element] = []
            _mains(page, level, strict, mains)
            for main in mains:
                _kept(main, keep, template)
            if keep:
                kept = [s for s in slots if id(s) in keep]
                own = [s for s in kept if not wrapper.repeated or _repeatable(s) not in wrapper.repeated]
                if 2 * sum(len(s.text) for s in own) > sum(len(s.text) for s in kept):
                    kept = own
                return "\n".join(s.text for s in kept)
    _outside(page, keep, template)
    return "\n".join(s.text for s in slots if id(s) in keep and id(s) not in template)


HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"
WRAPPER = "host string, part long, wrapper string"
# Wrappers, and pages (without one) by their contents.
INFERRED = f"{WRAPPER}, content long, texts array<long>"


def _inferred(wrappers: dict[str, Wrapper], part: int) -> pa.RecordBatch:
    return _with_pages(_rows(wrappers, part), [], [])


def _page_rows(wrappers: dict[str, Wrapper], part: int) -> pa.RecordBatch:
    """The pages met since the last time."""
    found = [(h, c, t) for h, w in wrappers.items() for c, t in w.taken_pages().items()]
    hosts, contents, texts = zip(*found) if found else ((), (), ())
    rows = pa.RecordBatch.from_arrays(
        [pa.array(hosts, pa.string()), pa.array([part] * len(hosts), pa.int64()), pa.nulls(len(hosts), pa.string())],
        names=["host", "part", "wrapper"],
    )
    return _with_pages(rows, contents, texts)


def _with_pages(rows: pa.RecordBatch, contents: Sequence[int], texts: Sequence[list[int]]) -> pa.RecordBatch:
    kind = pa.list_(pa.int64())
    if not contents:
        added = [pa.nulls(len(rows), pa.int64()), pa.nulls(len(rows), kind)]
    else:
        added = [pa.array(contents, pa.int64()), pa.array(texts, kind)]
    return pa.RecordBatch.from_arrays([*rows.columns, *added], names=[*rows.schema.names, "content", "texts"])


def _rows(wrappers: dict[str, Wrapper], part: int) -> pa.RecordBatch:
    hosts = sorted(wrappers)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(hosts, pa.string()),
            pa.array([part] * len(hosts), pa.int64()),
            pa.array([wrappers[h].packed() for h in hosts], pa.string()),
        ],
        names=["host", "part", "wrapper"],
    )


def _infer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    context = TaskContext.get()
    part = context.partitionId() if context else 0
    wrappers: dict[str, Wrapper] = {}
    for batch in slices(batches):
        for host, html in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
            if host not in wrappers and len(wrappers) >= OPEN_HOSTS:
                yield _page_rows(wrappers, part)
                yield _inferred(wrappers, part)
                wrappers = {}
            wrappers.setdefault(host, Wrapper()).add(parse(html))
        yield _page_rows(wrappers, part)
    yield _inferred(wrappers, part)


def _merge_group(group: pa.Table) -> pa.Table:
    wrappers: dict[str, Wrapper] = {}
    part = group.column("part")[0].as_py() // FAN_IN
    # In a fixed order, whatever order the shuffle left, as merging depends on it.
    rows = zip(*(group.column(c).to_pylist() for c in ("host", "part", "wrapper")))
    for host, _, data in sorted(rows):
        wrappers.setdefault(host, Wrapper()).join(Part.unpacked(json.loads(data)))
    return pa.Table.from_batches([_rows(wrappers, part)])


def host_wrappers(pages: DataFrame) -> DataFrame:
    """(host, wrapper) of ``pages`` (host, html)."""
    inferred = materialize(pages.mapInArrow(_infer, INFERRED), "wrappers")
    repeating = _repeating(inferred.where(F.col("wrapper").isNull()))
    found = inferred.where(F.col("wrapper").isNotNull()).select("host", "part", "wrapper")
    while True:
        parts, rows = found.agg(F.max("part"), F.count("*")).first()
        # Hosts of one bucket share a group, which holds a few hundred wrappers.
        bucket = F.pmod(F.xxhash64("host"), F.lit(-(-rows // (8 * FAN_IN)) or 1))
        group = (bucket.alias("bucket"), F.expr(f"part div {FAN_IN}").alias("next"))
        found = materialize(found.groupBy(*group).applyInArrow(_merge_group, WRAPPER), "wrappers")
        if (parts or 0) < FAN_IN:
            # The list becomes the last item of the wrapper's root.
            root = F.expr("left(wrapper, length(wrapper) - 1)")
            listed = F.coalesce(F.to_json("repeating"), F.lit("[]"))
            wrapper = F.concat(root, F.lit(","), listed, F.lit("]")).alias("wrapper")
            return found.join(repeating, "host", "left").select("host", wrapper)


def _repeating(pages: DataFrame) -> DataFrame:
    """(host, repeating): the texts that are on most of the unlike pages of a host, at most
    a few more than a page has."""
    pages = pages.groupBy("host", "content").agg(F.min("texts").alias("texts"))
    sizes = pages.groupBy("host").agg(F.count("*").alias("n_pages"))
    least = F.greatest(F.lit(float(CONSTANT_PAGES)), REPEATED_SHARE * F.col("n_pages"))
    counts = pages.select("host", F.explode("texts").alias("total")).groupBy("host", "total").agg(F.count("*").alias("n"))
    often = counts.where(F.col("n") >= CONSTANT_PAGES).join(sizes, "host").where(F.col("n") >= least)
    return often.groupBy("host").agg(F.sort_array(F.collect_list("total")).alias("repeating"))


def _extract(names: list[str]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wrappers: dict[str, Wrapper] = {}
        for batch in slices(batches):
            texts = []
            columns = (batch.column(c).to_pylist() for c in ("host", "html", "wrapper"))
            for host, html, data in zip(*columns):
                if host not in wrappers:
                    if len(wrappers) >= OPEN_HOSTS:
                        wrappers = {}
                    wrappers[host] = Wrapper(Part.unpacked(json.loads(data)) if data else None)
                texts.append(main_text(parse(html), wrappers[host]))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(texts, pa.string())], names=[*names, "text"]
            )

    return run


def extract_main_text(
    pages: DataFrame, columns: list[str], url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """``columns`` of every row of ``pages`` with ``text``, the main text of the page.

    Character references are decoded, white space inside a block becomes one space,
    blocks are trimmed and joined in page order by one line end; blocks without text
    are left out.

    Each page is read with the finished wrapper of its host, so its text depends on that
    wrapper alone, not on the pages around it.

    Null and empty pages have an empty text. Pages with a null url or one without a
    host share one wrapper. Repeated rows are extracted each; columns may have any
    names but ``text``; an empty table gives an empty one.
    """
    if "text" in columns:
        raise ValueError("there is a column text already")
    names = [f"c{i}" for i in range(len(columns))]
    host = F.lower(F.coalesce(F.regexp_extract(F.col(url_col), HOST, 1), F.lit(""))).alias("host")
    rows = pages.select(
        *[F.col(c).alias(n) for c, n in zip(columns, names)], host, F.col(html_col).alias("html")
    )
    wrappers = materialize(host_wrappers(rows.select("host", "html")), "host-wrappers")
    size = wrappers.agg(F.sum(F.length("wrapper") + F.length("host"))).first()[0] or 0
    rows = rows.join(F.broadcast(wrappers) if size <= BROADCAST_BYTES else wrappers, "host", "left")
    schema = T.StructType([*rows.select(*names).schema.fields, T.StructField("text", T.StringType())])
    done = rows.mapInArrow(_extract(names), schema)
    return done.toDF(*columns, "text")
