"""Wrapper induction: what the pages of a host have in common, and the main text of each.

The trees of the pages of one host are aligned by simple tree matching into a template tree. Siblings
of one sign (tag and class words) in a row are one slot, so lists and paragraphs of any number align. A
slot counts its pages and knows whether its text was the same on all of them: constant slots are
template, varying ones hold content. Slots are then told apart further by what their tags and class
words say (menus, footers, adverts, comments and so on are no content wherever they vary), and the
content is looked for in the article, else in the main element or what is named content, else in the
whole body without blocks that are mostly links. A page of which nothing would be left, as where all pages of a host are
copies, keeps the constant slots of its main region.

Beside the tree, and for all sizes of it, blocks are looked at one by one: a block (no cell of a table)
whose text stands on all pages that have its path of signs is template too, so that a fixed notice after an
article's paragraphs goes although it shares their slot. Where such blocks hold half of a page's text or
more, the pages are near copies of each other: the blocks stay, and so does the title (h1) in the article. These rows (host, path) are summed up by Spark.

Evidence is `LEAST_PAGES` pages with different html; copies of a page count once.

Templates are made in three steps: per task and host, per host and group of tasks, per host. A
host with a third of all pages is folded where its pages are read; only templates move. A template of
more than `MOST_SLOTS` slots loses those that the fewest pages have. A slot that lost some takes in no new
ones, so only slots that were never dropped are judged by the tree. What such a closed slot has no room for is
judged by Spark, where nothing is dropped: all pages of the host are aligned with the finished template, and each
run of siblings without a partner has a place, which is its slot, the partner before it, its sign and its number among those;
what is below goes on from there. (host, place) rows are summed up, and by the rule of slots a place is
template if its own text is the same on all its pages, `LEAST_PAGES` or more, and so is each place below it. A closed slot
of which all such places are constant is judged as if nothing had been dropped. Pages are then joined with the
template of their host, as a skewed join that Spark splits, and each is extracted by itself.

Trees are compared by simple tree matching to four levels below the slots to be aligned; siblings that differ
only deeper are aligned by order alone.

Defined results: a null or empty html has an empty text. Pages without a host, or alone on theirs, are
judged by tags, class words and links only. Repeated pages each give their text. Unclosed, stray
and unknown tags are read as browsers do, more or less. A very long page is parsed in one pass. An empty table
gives an empty one. Other columns are not looked at.
"""

from __future__ import annotations

import html as entities
import json
from collections import Counter
from collections.abc import Collection, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cashline.llm.common import settled
from cashline.llm.dom import BLOCK, RAW, Node, parse

LEAST_PAGES = 3
MOST_SLOTS = 4_000
MOST_HOSTS = 2_000
MOST_PATHS = 200_000

# Elements that are never content, and class words of menus, headers, footers, sidebars,
# notices, adverts, forms and comments.
CHROME = RAW | set(
    """aside audio button canvas datalist dialog footer form head input label link map menu meta nav noscript object
    progress script search select svg template textarea video""".split()
)
CHROME_WORDS = set(
    """ad ads advert advertisement advertising adverts alert alerts announcement author banner banners breadcrumb
    breadcrumbs byline captcha comment commentlist comments consent cookie cookies copyright disclaimer discussion disqus footer
    footnav form gdpr header login masthead menu menubar modal nav navbar navigation newsletter notice notices notification
    notifications overlay pager pagination paywall popup popups promo promoted promotion promotions recommended
    register related replies reply responses search share sharing sidebar sidebars signup skip social sponsor sponsored sponsors
    subscribe subscription tags toc toolbar topbar topnav widget widgets""".split()
)
# The header of an article holds its title.
ARTICLE_CHROME_WORDS = CHROME_WORDS - {"header", "author", "byline"}
MAIN_WORDS = {"content", "article", "post", "entry", "story"}


class Slot:
    """A place of a template: sign, how many pages, hash of its text (0: none, -1: varying), kids, the least
    LEAST_PAGES distinct pages, and whether kids were dropped, so that none that comes later is whole."""

    __slots__ = ("sign", "pages", "text", "kids", "seen", "closed", "constant", "page", "now")

    def __init__(self, sign: str, pages: int = 0, text: int = 0, kids: list[Slot] | None = None):
        self.sign, self.pages, self.text, self.kids = sign, pages, text, kids or []
        self.seen, self.closed = [], False
        self.constant, self.page, self.now = False, -1, None

    def plain(self) -> list:
        return [self.sign, self.pages, self.text, [kid.plain() for kid in self.kids], self.seen, int(self.closed)]

    @classmethod
    def of(cls, plain: list) -> Slot:
        slot = cls(plain[0], plain[1], plain[2], [cls.of(kid) for kid in plain[3]])
        slot.seen, slot.closed = plain[4], bool(plain[5])
        return slot

    def size(self) -> int:
        return 1 + sum(kid.size() for kid in self.kids)

    def lost_some(self) -> bool:
        return self.closed or any(kid.lost_some() for kid in self.kids)


def _groups(nodes: list) -> list[tuple[str, list[Node]]]:
    """Elements of one sign in a row, texts between them left out."""
    out: list[tuple[str, list[Node]]] = []
    for node in nodes:
        if node.__class__ is Node:
            if out and out[-1][0] == node.sign:
                out[-1][1].append(node)
            else:
                out.append((node.sign, [node]))
    return out


def _matching(sign: str, kids: list, other: Slot, depth: int = 0) -> int:
    """Simple tree matching: the most nodes that two trees with equal roots share in order."""
    if sign != other.sign:
        return 0
    if depth > 3 or not kids or not other.kids:
        return 1
    return 1 + _align(kids, other.kids, depth + 1)[-1][-1]


def _kids(item) -> list:
    return item.kids if isinstance(item, Slot) else _groups([k for node in item[1] for k in node.kids])


def _sign(item) -> str:
    return item.sign if isinstance(item, Slot) else item[0]


def _align(left: list, right: list[Slot], depth: int = 0) -> list[list[int]]:
    """The table of the best matching of every two prefixes."""
    best = [[0] * (len(right) + 1) for _ in range(len(left) + 1)]
    for i, a in enumerate(left):
        sign, kids = _sign(a), None
        for j, b in enumerate(right):
            most = best[i][j + 1] if best[i][j + 1] >= best[i + 1][j] else best[i + 1][j]
            if sign == b.sign:
                kids = _kids(a) if kids is None else kids
                most = max(most, best[i][j] + _matching(sign, kids, b, depth))
            best[i + 1][j + 1] = most
    return best


def matched(left: list, right: list[Slot]) -> list[int | None]:
    """For each of `left` the place of its partner in `right`, in order."""
    if len(left) == len(right) and all(_sign(a) == b.sign for a, b in zip(left, right)):
        return list(range(len(left)))
    if not left or not right:
        return [None] * len(left)
    best = _align(left, right)
    out: list[int | None] = [None] * len(left)
    i, j = len(left), len(right)
    while i and j:
        if best[i][j] == best[i - 1][j]:
            i -= 1
        elif best[i][j] == best[i][j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            out[i] = j
    return out


def _least(seen: list[int], more: list[int]) -> list[int]:
    """The least LEAST_PAGES distinct ones of both."""
    return sorted({*seen, *more})[:LEAST_PAGES]


def _added(kids: list[Slot], partners: list[int | None], signs: list[str], closed: bool) -> list[Slot | None]:
    """Partners of all, with new slots put in where there was none: right after that of the one before. None if closed."""
    out, moved, last = [], 0, -1
    for partner, sign in zip(partners, signs, strict=True):
        if partner is None and closed:
            out.append(None)
            continue
        if partner is None:
            last += 1
            kids.insert(last, Slot(sign))
            moved += 1
        else:
            last = partner + moved
        out.append(kids[last])
    return out


def learn(slot: Slot, node: Node, page: int) -> None:
    """Align a page's tree with the template under `slot`, which takes in what it lacks."""
    if slot.page != page:
        slot.page, slot.now = page, xxhash.xxh64()
        slot.pages += 1
        slot.seen = _least(slot.seen, [page])
    for kid in node.kids:
        if kid.__class__ is str:
            slot.now.update(kid.encode("utf-8", "surrogatepass"))
    groups = _groups(node.kids)
    if groups:
        signs = [sign for sign, _ in groups]
        for (_, nodes), kid in zip(groups, _added(slot.kids, matched(groups, slot.kids), signs, slot.closed)):
            for own in nodes if kid else ():
                learn(kid, own, page)


def _turn(slot: Slot, page: int) -> None:
    """End of a page: its text in every slot against that of the pages before."""
    if slot.page == page:
        now = slot.now.intdigest() >> 1 or 1
        slot.text = now if slot.pages == 1 or slot.text == now else -1
        slot.now = None
        for kid in slot.kids:
            _turn(kid, page)


def merge(into: Slot, other: Slot) -> None:
    """Add a template of other pages of the host."""
    if into.pages and other.pages:
        into.text = into.text if into.text == other.text else -1
    elif other.pages:
        into.text = other.text
    into.pages += other.pages
    into.seen = _least(into.seen, other.seen)
    partners = matched(other.kids, into.kids)
    if other.closed:  # what it lacks may have been dropped there
        both = [p for p in partners if p is not None]
        into.kids = [into.kids[p] for p in both]
        places = iter(range(len(both)))
        partners = [None if p is None else next(places) for p in partners]
    for kid, own in zip(other.kids, _added(into.kids, partners, [k.sign for k in other.kids], into.closed)):
        if own:
            merge(own, kid)
    into.closed |= other.closed


def prune(root: Slot) -> None:
    """Drop the slots of the fewest pages until the template has MOST_SLOTS or only common ones."""
    least = 1
    while root.size() > MOST_SLOTS and least < root.pages:
        least *= 2
        _drop(root, min(least, root.pages))


def _drop(slot: Slot, least: int) -> None:
    kept = [kid for kid in slot.kids if kid.pages >= least]
    slot.closed |= len(kept) < len(slot.kids)
    slot.kids = kept
    for kid in slot.kids:
        _drop(kid, least)


def judge(slot: Slot, proven: Collection[int] = (), number: int = 0) -> bool:
    """Marks slots whose whole text is the same on LEAST_PAGES pages or more. True if so.

    A closed slot is whole if `proven` has its place, `number`.
    """
    kids = [judge(kid, proven, _number(number, k) if proven else 0) for k, kid in enumerate(slot.kids)]
    whole = not slot.closed or number in proven
    slot.constant = slot.text != -1 and whole and all(kids) and len(slot.seen) >= LEAST_PAGES
    return slot.constant


def _number(*parts) -> int:
    return xxhash.xxh64_intdigest(repr(parts).encode("utf-8", "surrogatepass")) >> 1


_paths: dict[tuple[int, str], int] = {}


def blocks_by_path(node: Node, path: int = 0, out: dict[int, list[tuple[int, Node]]] | None = None) -> tuple[dict, int]:
    """Per path of signs the blocks with text there, each with a number for path and text; and that of the node's text, or 0.

    Cells of tables are no blocks here: a column of few values would make its cells look like template.
    """
    out = {} if out is None else out
    texts = []
    for kid in node.kids:
        if kid.__class__ is str:
            if text := kid.strip():
                texts.append(text)
            continue
        below = _paths.get((path, kid.sign))
        if below is None:
            below = _number(path, kid.sign)
            if len(_paths) < MOST_PATHS:
                _paths[path, kid.sign] = below
        _, text = blocks_by_path(kid, below, out)
        if text:
            texts.append(text)
            if kid.tag in BLOCK and kid.tag not in ("td", "th"):
                out.setdefault(below, []).append((_number(below, text), kid))
    return out, _number(*texts) if texts else 0


def _host(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


_TEMPLATE = "host string, part long, template string, closed boolean"


def _page(html: str) -> int:
    return xxhash.xxh64_intdigest(html.encode("utf-8", "surrogatepass")) >> 1


def _fold_paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per host and path the least distinct pages and the blocks that stand on all of the pages; maybe more than once."""
    known: dict[tuple[str, int], list] = {}

    def out() -> pa.RecordBatch:
        hosts, paths = [k[0] for k in known], [k[1] for k in known]
        seen, common = [x[0] for x in known.values()], [list(x[1]) for x in known.values()]
        kinds = pa.string(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())
        arrays = [pa.array(x, kind) for x, kind in zip((hosts, paths, seen, common), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, ["host", "path", "seen", "common"])

    for batch in batches:
        for host, html in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
            if host and html:
                page = _page(html)
                for path, blocks in blocks_by_path(parse(html))[0].items():
                    own = {number for number, _ in blocks}
                    state = known.get((host, path))
                    if state is None:
                        known[host, path] = [[page], own]
                    else:
                        state[0] = _least(state[0], [page])
                        state[1] &= own
                if len(known) >= MOST_PATHS:
                    yield out()
                    known.clear()
    yield out()


def shared_blocks(pages: DataFrame) -> DataFrame:
    """host and shared, the numbers of the blocks that stand on all pages with their path, if these are LEAST_PAGES or more."""
    states = pages.select(_host(F.col("url")).alias("host"), "html").mapInArrow(
        _fold_paths, "host string, path long, seen array<long>, common array<long>"
    )
    # Of each task the rows of a path are few, so those of a host come together as paths.
    paths = states.groupBy("host", "path").agg(F.collect_list("seen").alias("seen"), F.collect_list("common").alias("common"))
    both = F.aggregate("common", F.get("common", F.lit(0)), lambda a, b: F.array_intersect(a, b))
    proven = paths.filter(F.size(F.array_distinct(F.flatten("seen"))) >= LEAST_PAGES).select("host", F.explode(both).alias("number"))
    return proven.groupBy("host").agg(F.collect_list("number").alias("shared"))


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    roots: dict[str, Slot] = {}
    copies: set[tuple[str, int]] = set()
    number = 0

    def out() -> pa.RecordBatch:
        for root in roots.values():
            prune(root)
        plain = [json.dumps(root.plain(), separators=(",", ":")) for root in roots.values()]
        return pa.RecordBatch.from_pydict({"host": pa.array(list(roots), pa.string()), "template": pa.array(plain, pa.string())})

    for batch in batches:
        for host, html in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
            if host and html:
                root = roots.get(host)
                if root is None:
                    if len(roots) >= MOST_HOSTS:
                        yield out()
                        roots.clear()
                        copies.clear()
                    root = roots[host] = Slot("")
                page = _page(html)
                if (host, page) in copies:
                    continue
                copies.add((host, page))
                number += 1
                learn(root, parse(html), page)
                _turn(root, page)
                if number % 100 == 0 and root.size() > 2 * MOST_SLOTS:
                    prune(root)
    yield out()


def _merged(rows: pa.Table) -> pa.Table:
    root = Slot("")
    for text in rows.column("template").to_pylist():
        merge(root, Slot.of(json.loads(text)))
    prune(root)
    plain = json.dumps(root.plain(), separators=(",", ":"))
    return pa.table({
        "host": [rows.column("host")[0].as_py()],
        "part": [rows.column("part")[0].as_py()],
        "template": [plain],
        "closed": [root.lost_some()],
    })


def templates(pages: DataFrame) -> DataFrame:
    """host and template of every host of `pages` (url, html), and whether it lost slots."""
    parts = pages.select(_host(F.col("url")).alias("host"), "html").mapInArrow(_fold, "host string, template string")
    parts = parts.withColumn("part", F.spark_partition_id() % 64)
    some = parts.groupBy("host", "part").applyInArrow(_merged, _TEMPLATE)
    return some.groupBy("host").applyInArrow(_merged, _TEMPLATE).select("host", "template", "closed")


def _no_content(node: Node, inside: bool) -> bool:
    if node.tag in CHROME or (node.tag == "header" and not inside):
        return True
    if node.tag in ("html", "body", "main"):
        return False
    return not (ARTICLE_CHROME_WORDS if inside else CHROME_WORDS).isdisjoint(node.marks)


_SHARED, _PROVEN = Slot(""), Slot("")
_SHARED.constant = _PROVEN.constant = True


def _mark(root: Node, shared: set[int]) -> bool:
    """Marks the shared blocks that the tree has not found. True if there are some."""
    found = False
    for blocks in blocks_by_path(root)[0].values():
        for number, node in blocks:
            if number in shared and not (node.slot and node.slot.constant):
                node.slot, found = _SHARED, True
    return found


def _assign(node: Node, slot: Slot | None) -> None:
    """Gives every node its slot of the template, if there is one."""
    node.slot = slot
    groups = _groups(node.kids)
    partners = matched(groups, slot.kids) if slot and groups else [None] * len(groups)
    for (_, nodes), partner in zip(groups, partners):
        for own in nodes:
            _assign(own, None if partner is None else slot.kids[partner])


def _place(node: Node, slot: Slot | None, out: dict[int, tuple], number: int = 0, above: tuple[int, ...] = ()) -> None:
    """Gives every node its slot, as `_assign` does, and collects what closed slots have no room for.

    `out` gets closed slots, and the places in them, each with the places it is part of, its own texts and its nodes.
    """
    node.slot = slot
    groups = _groups(node.kids)
    partners = matched(groups, slot.kids) if slot and groups else [None] * len(groups)
    if slot and slot.closed:
        out.setdefault(number, (above, [], []))
        above = (*above, number)
    last, alike = -1, Counter()
    for (sign, nodes), partner in zip(groups, partners):
        if partner is not None:
            last, alike = partner, Counter()
            for own in nodes:
                _place(own, slot.kids[partner], out, _number(number, partner), above)
        elif slot and not slot.closed:
            for own in nodes:
                _assign(own, None)
        else:
            alike[sign] += 1
            below = _number(number, last, sign, alike[sign])
            _, texts, found = out.setdefault(below, (above, [], []))
            for own in nodes:
                found.append(own)
                texts += [kid for kid in own.kids if kid.__class__ is str]
                _place(own, None, out, below, (*above, below))


def _fold_places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per host and place what it is part of, the least distinct pages, and the least and the greatest hash of its text;
    maybe more than once."""
    known: dict[tuple[str, int], list] = {}
    roots: dict[str, Slot] = {}

    def out() -> pa.RecordBatch:
        columns = [*zip(*((*key, *state) for key, state in known.items()))] or [()] * 6
        kinds = pa.string(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.int64()
        arrays = [pa.array(x, kind) for x, kind in zip(columns, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, ["host", "place", "above", "seen", "least", "greatest"])

    for batch in batches:
        for host, html, template in zip(*(batch.column(c).to_pylist() for c in ("host", "html", "template"))):
            if not html:
                continue
            if host not in roots:
                if len(roots) >= MOST_HOSTS:
                    roots.clear()
                roots[host] = Slot.of(json.loads(template))
            page, places = _page(html), {}
            _place(parse(html), roots[host], places)
            for place, (above, texts, _) in places.items():
                text = xxhash.xxh64_intdigest("".join(texts).encode("utf-8", "surrogatepass")) >> 1
                state = known.get((host, place))
                if state is None:
                    known[host, place] = [above, [page], text, text]
                else:
                    state[1:] = _least(state[1], [page]), min(state[2], text), max(state[3], text)
            if len(known) >= MOST_PATHS:
                yield out()
                known.clear()
    yield out()


def proven_places(pages: DataFrame, known: DataFrame) -> DataFrame:
    """host and proven, the places that are template, of `pages` (host, html) of the hosts in `known` (host, template)."""
    states = pages.select("host", "html").join(known, "host").mapInArrow(
        _fold_places, "host string, place long, above array<long>, seen array<long>, least long, greatest long"
    )
    # Of each task the rows of a place are few, so those of a host come together as places.
    places = states.groupBy("host", "place").agg(
        F.first("above").alias("above"),
        (F.size(F.array_distinct(F.flatten(F.collect_list("seen")))) >= LEAST_PAGES).alias("often"),
        (F.min("least") == F.max("greatest")).alias("same"),
    )
    places = settled(places.select("host", "place", "above", (F.col("often") & F.col("same")).alias("constant")), "places")
    varying = places.filter(~F.col("constant")).select("host", F.explode("above").alias("place")).distinct()
    proven = places.filter("constant").join(varying, ["host", "place"], "left_anti")
    return proven.groupBy("host").agg(F.collect_list("place").alias("proven"))


def _find(node: Node, wanted, out: list[Node]) -> list[Node]:
    for kid in node.kids:
        if kid.__class__ is Node and not _no_content(kid, False):
            if wanted(kid):
                out.append(kid)
            else:
                _find(kid, wanted, out)
    return out


def _links(node: Node, linked: bool = False) -> tuple[int, int]:
    """Characters of links, and of all text."""
    own = of_links = 0
    for kid in node.kids:
        if kid.__class__ is str:
            n = len(kid.strip())
            own, of_links = own + n, of_links + n * linked
        else:
            a, b = _links(kid, linked or kid.tag == "a")
            of_links, own = of_links + a, own + b
    return of_links, own


class _Blocks:
    """Collects text into blocks."""

    def __init__(self, constants: bool, links: bool, shared: bool = True, titles: bool = False):
        self.constants, self.links, self.shared, self.titles = constants, links, shared, titles
        self.done, self.now = [], []

    def template(self, node: Node) -> bool:
        if not self.constants or not node.slot or not node.slot.constant:
            return False
        return self.shared if node.slot is _SHARED else not (self.titles and node.tag == "h1")

    def end(self) -> None:
        if self.now:
            text = "".join(self.now)
            text = " ".join((entities.unescape(text) if "&" in text else text).split())
            if text:
                self.done.append(text)
            self.now = []

    def add(self, node: Node) -> None:
        block = node.tag in BLOCK
        if block:
            self.end()
        for kid in node.kids:
            if kid.__class__ is str:
                self.now.append(kid)
            elif kid.tag in ("br", "wbr"):
                self.now.append(" " if kid.tag == "br" else "")
            elif not _no_content(kid, not self.links) and not self.template(kid):
                if self.links and kid.tag in BLOCK and kid.kids:
                    of_links, own = _links(kid)
                    if 2 * of_links > own:
                        self.end()
                        continue
                self.add(kid)
        if block:
            self.end()


def _text(regions: list[Node], links: bool, shared: bool) -> str:
    def left(*how: bool) -> str:
        blocks = _Blocks(how[0], links, *how[1:])
        for region in regions:
            blocks.add(region)
            blocks.end()
        return "\n".join(blocks.done)

    text = left(True)
    # Blocks on all pages that hold half of the text are no notices: the pages are near copies.
    if shared and 2 * len(text) <= len(left(True, False)):
        text = left(True, False, not links)
    return text or left(False)


def main_text(
    html: str | None, template: Slot | None = None, shared: set[int] | None = None, proven: Collection[int] = ()
) -> str:
    """The main text of a page, one block per line, given its host's template, shared blocks and proven places."""
    if not html:
        return ""
    root = parse(html)
    if template and proven:
        places: dict[int, tuple] = {}
        _place(root, template, places)
        for node in (node for number in places if number in proven for node in places[number][2]):
            node.slot = _PROVEN
    elif template:
        _assign(root, template)
    marked = bool(shared) and _mark(root, shared)
    for wanted in (
        lambda n: n.tag == "article",
        lambda n: n.tag == "main" or "main" in n.marks,
        lambda n: not MAIN_WORDS.isdisjoint(n.marks),
    ):
        regions = _find(root, wanted, [])
        if regions and (text := _text(regions, False, marked)):
            return text
    return _text([root], True, marked)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[str, tuple[Slot | None, set[int], set[int]]] = {}
    for batch in batches:
        texts = []
        shared, proven = batch.column("shared"), batch.column("proven")
        for k, (host, html, template) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("host", "html", "template")))):
            if host not in known:
                if len(known) >= MOST_HOSTS:
                    known.clear()
                places = set(proven[k].as_py() or ())
                known[host] = (Slot.of(json.loads(template)) if template else None, set(shared[k].as_py() or ()), places)
                if template:
                    judge(known[host][0], places)
            texts.append(main_text(html, *known[host]))
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"]
        )


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url and text of `pages` (page_id, url, html)."""
    own = pages.select("page_id", "url", "html", _host(F.col("url")).alias("host"))
    known = settled(templates(pages).join(shared_blocks(pages), "host", "left"), "templates")
    closed = known.filter("closed")
    if closed.isEmpty():
        known = known.withColumn("proven", F.lit(None).cast("array<long>"))
    else:
        known = known.join(proven_places(own, closed.select("host", "template")), "host", "left")
    kind = pages.schema["page_id"].dataType.simpleString()
    return own.join(known, "host", "left").mapInArrow(_extract, f"page_id {kind}, url string, text string")
