"""The elements of a page as intervals, from one pass over its tags.

Elements are numbered in the order of their start tags, so those inside an element are the numbers that follow it up to
its last one, and "the first p inside" is a search in a sorted list. Nothing is copied per element.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Callable
from html import unescape

# A tag ends at the first > outside quoted attribute values; where a quote is never closed, at the first >.
TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+|[^>]*+)>""", re.S)
ATTRIBUTE = re.compile(r"""([^\s"'>/=][^\s"'>/=]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")

# Fixed values of HTML: elements without content; elements whose text is no markup; start tags that end an open element,
# and the elements beyond which they do not look.
EMPTY = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title".split())
UNSEEN = frozenset("script style".split())
BLOCKS = """address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4
    h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul""".split()
ENDS_OPEN = dict.fromkeys(BLOCKS, ("p",)) | {
    "li": ("li", "p"), "dt": ("dt", "dd", "p"), "dd": ("dt", "dd", "p"), "option": ("option",), "tr": ("tr",),
    "td": ("td", "th"), "th": ("td", "th"), "tbody": ("thead", "tbody"), "tfoot": ("thead", "tbody"),
}
LIMITS = {
    "li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "option": ("select",), "tr": ("table",), "td": ("table",),
    "th": ("table",), "tbody": ("table",), "thead": ("table",), "tfoot": ("table",),
    "p": ("table", "td", "th", "caption", "button", "object"),
}

Test = Callable[[str, dict[str, str]], bool]


class Elements:
    """The elements of one page: tag names in lower case, parents, last descendants, attributes, texts."""

    def __init__(self, html: str):
        self.tags: list[str] = []
        self.parents: list[int] = []  # -1 for elements that no other holds
        self.lasts: list[int] = []
        self.attributes: list[dict[str, str]] = []
        self.texts: list[str] = []  # trimmed text nodes, empty ones left out
        self.spans: list[tuple[int, int]] = []  # an element's part of texts
        self._read(html)

    def _read(self, html: str) -> None:
        stack: list[int] = []
        open_at: dict[str, list[int]] = {}  # per tag the places in the stack where it is open
        at, close = 0, html.rfind(">") + 1

        def nearest(tag: str) -> int:
            return open_at[tag][-1] if open_at.get(tag) else -1

        def end(place: int) -> None:
            for number in reversed(stack[place:]):
                open_at[self.tags[number]].pop()
                self.lasts[number] = len(self.tags) - 1
                self.spans[number] = (self.spans[number][0], len(self.texts))
            del stack[place:]

        def reachable(tag: str) -> int:
            """Place of the innermost open ``tag`` that no limiting element hides, or -1."""
            place = nearest(tag)
            return -1 if place < max((nearest(limit) for limit in LIMITS.get(tag, ())), default=-1) else place

        while True:
            found = TAG.search(html, at, close) if at < close else None
            text = unescape(html[at:found.start() if found else len(html)]).strip()
            if text:
                self.texts.append(text)
            if found is None:
                break
            at = found.end()
            if found[2] is None:  # a comment or declaration
                continue
            tag = found[2].lower()
            if found[1]:
                place = reachable(tag) if tag == "li" else nearest(tag)
                if place >= 0:
                    end(place)
                continue
            ended = [place for place in map(reachable, ENDS_OPEN.get(tag, ())) if place >= 0]
            if ended:
                end(min(ended))
            number = len(self.tags)
            self.tags.append(tag)
            self.parents.append(stack[-1] if stack else -1)
            self.lasts.append(number)
            self.spans.append((len(self.texts), len(self.texts)))
            values: dict[str, str] = {}
            for name, *quoted in ATTRIBUTE.findall(found[3]):
                values.setdefault(name.lower(), unescape("".join(quoted)))
            self.attributes.append(values)
            if tag in EMPTY or found[3].endswith("/"):
                continue
            if tag in RAW:
                ending = re.compile(rf"</{tag}\s*>", re.I).search(html, at)
                text = html[at:ending.start() if ending else len(html)]
                if tag not in UNSEEN and text.strip():
                    self.texts.append(unescape(text).strip())
                self.spans[number] = (self.spans[number][0], len(self.texts))
                at = ending.end() if ending else len(html)
                continue
            open_at.setdefault(tag, []).append(len(stack))
            stack.append(number)
        end(0)

    def where(self, test: Test) -> list[int]:
        """Numbers, rising, of the elements whose tag and attributes pass."""
        return [i for i, (tag, values) in enumerate(zip(self.tags, self.attributes)) if test(tag, values)]

    def inside(self, number: int, places: list[int]) -> list[int]:
        """Those of the rising ``places`` that lie in the element; -1 is the whole page."""
        if number < 0:
            return places
        return places[bisect_right(places, number):bisect_right(places, self.lasts[number])]

    def first_inside(self, number: int, places: list[int]) -> int | None:
        at = bisect_left(places, number + 1)
        return places[at] if at < len(places) and (number < 0 or places[at] <= self.lasts[number]) else None

    def text(self, number: int | None) -> str | None:
        """Text nodes in the element, joined without a gap; None for no element."""
        if number is None:
            return None
        low, high = self.spans[number]
        return "".join(self.texts[low:high])


def named(tag: str, css_class: str | None = None) -> Test:
    """A test for elements with this tag and, where given, this class among their classes."""
    return lambda t, values: t == tag and (css_class is None or css_class in values.get("class", "").split())
