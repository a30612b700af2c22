"""A small, forgiving HTML tree for the extraction of text."""

from __future__ import annotations

import re

# Fixed values of HTML: elements without an end, elements whose content is not markup, elements that
# begin a block, and what a start tag closes of the elements open before it.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title iframe noembed noframes xmp".split())
BLOCK = set(
    """address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption
    figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre search section
    summary table tbody td tfoot th thead tr ul""".split()
)
_ENDS_P = BLOCK - set("body html td th tr tbody thead tfoot caption option legend summary".split())
_CELLS = {"td", "th", "table", "template"}
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select", "datalist"}),
}

_ABOUT_OTHERS = {"has", "no", "with", "without"}
DEEPEST = 256

_TAG = re.compile(
    r"""<(?:!--.*?(?:--!?>|\Z)|[!?][^>]*(?:>|\Z)|/?([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+(?:>|\Z)|[^>]*(?:>|\Z)))""",
    re.S,
)
_MARK = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORD = re.compile(r"[a-z]+|[A-Z][a-z]*|[A-Z]+(?![a-z])")


class Node:
    """An element: tag, the words of its class, id and role, and its children, elements or texts."""

    __slots__ = ("tag", "marks", "sign", "kids", "slot")

    def __init__(self, tag: str, marks: tuple[str, ...]):
        self.tag, self.marks, self.kids, self.slot = tag, marks, [], None
        self.sign = f"{tag}.{'.'.join(marks)}" if marks else tag


_marks: dict[str, tuple[str, ...]] = {}


def _read_marks(attributes: str) -> tuple[str, ...]:
    """Words of class, id and role in order, in lower case; digits tell pages apart, not templates."""
    if len(attributes) < 5:
        return ()
    found = _marks.get(attributes)
    if found is None:
        values = " ".join(a or b or c for _, a, b, c in _MARK.findall(attributes))
        words = [w.lower() for w in _WORD.findall(values)]
        # "has-sidebar" says what else there is on the page.
        found = tuple(dict.fromkeys(w for before, w in zip(["", *words], words) if before not in _ABOUT_OTHERS))
        if len(_marks) < 10_000:
            _marks[attributes] = found
    return found


def parse(html: str) -> Node:
    """The tree of a page under a root without a tag. Any text is a page.

    What is nested deeper than DEEPEST elements goes to the element there, as browsers do.
    """
    root = Node("", ())
    opened = [root]
    at, size = 0, len(html)
    while at < size:
        tag = _TAG.search(html, at)
        begin, end = tag.span() if tag else (size, size)
        if begin > at:
            opened[-1].kids.append(html[at:begin])
        at = end
        if not tag or not tag[1]:
            continue
        name = tag[1].lower()
        if html[begin + 1] == "/":
            _close(opened, name, _CELLS if name in BLOCK else BLOCK)
            continue
        if name in _ENDS_P:
            _close(opened, "p", {"article", "section", "div", "td", "th", "li", "table", "button"})
        if name in _ENDS:
            ended, scope = _ENDS[name]
            for place in range(len(opened) - 1, 0, -1):
                if opened[place].tag in scope:
                    break
                if opened[place].tag in ended:
                    del opened[place:]
        node = Node(name, _read_marks(tag[2]))
        opened[-1].kids.append(node)
        if name in RAW:
            close = re.compile(rf"</{re.escape(name)}\b[^>]*(?:>|\Z)", re.I).search(html, at)
            at = close.end() if close else size
        elif name not in VOID and not tag[2].endswith("/>") and len(opened) < DEEPEST:
            opened.append(node)
    return root


def _close(opened: list[Node], name: str, scope: set[str]) -> None:
    """End the innermost element of that name, unless one of `scope` is open inside it."""
    for place in range(len(opened) - 1, 0, -1):
        if opened[place].tag == name:
            del opened[place:]
            return
        if opened[place].tag in scope:
            return
