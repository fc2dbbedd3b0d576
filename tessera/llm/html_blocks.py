"""Blocks of text of an HTML page, each with the place it stands in.

A forgiving tokenizer with a stack of open elements: enough of HTML's rules
(void elements, raw text, paragraphs and list items that end by themselves,
end tags that close what was left open, a head that ends by itself) to know
for every piece of text which elements hold it. Open elements are looked up by
name, so time grows with the length of the page, however deep it nests.
"""

from __future__ import annotations

import html as _html
import re
from collections import defaultdict

# places of a block
OTHER, ARTICLE, MARKED, MAIN = 0, 1, 2, 3

TAG = re.compile(r"""<(?:
    !--.*?(?:-->|\Z)                                    # comment
  | [!?][^>]*(?:>|\Z)                                   # declaration
  | (/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*')*+)(?:>|\Z)
  | (/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)               # unbalanced quotes
)""", re.S | re.X)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea iframe noembed noframes xmp".split())
HEAD = frozenset("html head title meta link base style script noscript template".split())
INLINE = frozenset("""a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s
    samp small span strike strong sub sup time tt u var wbr img""".split())
SELF_CLOSING = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
                "th": {"td", "th"}, "option": {"option"}}
LISTS = frozenset("ul ol dl table tbody thead tfoot select menu".split())
NOT_TEXT = frozenset("""head nav header footer aside form button menu dialog select option noscript object embed svg
    canvas audio video template map""".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar toolbar".split())
NAMES = frozenset("""nav navbar navigation menu sidebar breadcrumb breadcrumbs footer header masthead ad ads advert
    adverts advertisement adsense sponsor sponsored promo banner cookie cookies consent gdpr notice notices popup modal
    newsletter subscribe signup login comment comments respond disqus replies share sharing social related recommended
    widget toolbar skip copyright pagination pager""".split())
WRAPPER = frozenset("content main article post entry body text has with no page wrapper container layout".split())
ATTR = re.compile(r"""\b(class|id|role|itemprop|hidden)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)


def _place(name: str, attrs: str, in_article: bool) -> int:
    """The place that an element opens: ``MARKED``, ``ARTICLE``, ``MAIN``, or ``OTHER`` for none."""
    found = {k.lower(): (v or "").strip("\"'").lower() for k, v in ATTR.findall(attrs)} if attrs else {}
    if name in ("html", "body"):
        return OTHER
    if name in NOT_TEXT and not (name == "header" and in_article):
        return MARKED
    role = found.get("role", "")
    if role in ROLES or "hidden" in found:
        return MARKED
    if name != "main" and (name != "article" or in_article):
        for word in f"{found.get('class', '')} {found.get('id', '')}".split():
            parts = [p for p in re.split(r"[-_]+", word) if p]
            if parts and not WRAPPER.intersection(parts) and (parts[0] in NAMES or parts[-1] in NAMES):
                if not (in_article and "header" in parts):
                    return MARKED
    if name == "article" or role == "article" or found.get("itemprop") == "articlebody":
        return ARTICLE
    return MAIN if name == "main" or role == "main" else OTHER


class _Page:
    def __init__(self):
        self.stack: list[tuple[str, int]] = []
        self.at: defaultdict[str, list[int]] = defaultdict(list)    # places in the stack by name
        self.open = [0, 0, 0, 0]            # open elements by place
        self.blocks: list[tuple[str, int]] = []
        self.buffers: tuple[list[str], list[str]] = ([], [])    # text, marked text

    def place(self) -> int:
        return MARKED if self.open[MARKED] else ARTICLE if self.open[ARTICLE] else MAIN if self.open[MAIN] else OTHER

    def text(self, raw: str) -> None:
        if raw:
            self.buffers[self.open[MARKED] > 0].append(_html.unescape(raw) if "&" in raw else raw)

    def flush(self) -> None:
        for marked, buffer in enumerate(self.buffers):
            if buffer:
                line = " ".join("".join(buffer).split())
                if line:
                    place = ARTICLE if self.open[ARTICLE] else MAIN if self.open[MAIN] else OTHER
                    self.blocks.append((line, MARKED if marked else place))
                buffer.clear()

    def pop_to(self, at: int) -> None:
        while len(self.stack) > at:
            name, place = self.stack.pop()
            self.open[place] -= 1
            self.at[name].pop()

    def innermost(self, names) -> int:
        """Place in the stack of the innermost open element of ``names``, -1 if there is none."""
        return max((places[-1] for n in names if (places := self.at.get(n))), default=-1)

    def find(self, names, stop=()) -> int:
        """``innermost`` of ``names``, -1 if one of ``stop`` stands further in; the depth of the stack does not matter."""
        at = self.innermost(names)
        return at if at >= 0 and at >= self.innermost(stop) else -1

    def start(self, name: str, attrs: str) -> None:
        if self.stack and name not in HEAD and (at := self.find(("head",))) >= 0:
            self.flush()
            self.pop_to(at)
        if name not in INLINE:
            self.flush()
            if (at := self.find(("p",), _SCOPE)) >= 0:
                self.pop_to(at)
            if name in SELF_CLOSING and (at := self.find(SELF_CLOSING[name], LISTS)) >= 0:
                self.pop_to(at)
        if name not in VOID and not attrs.endswith("/"):
            place = _place(name, attrs, self.open[ARTICLE] > 0)
            self.at[name].append(len(self.stack))
            self.stack.append((name, place))
            self.open[place] += 1

    def end(self, name: str) -> None:
        if name not in INLINE:
            self.flush()
        # an inline end tag does not reach past the block it stands in
        at = self.find((name,), _SCOPE if name in INLINE or name == "p" else ())
        if at >= 0:
            self.pop_to(at)


_SCOPE = frozenset("""html body article section main div nav header footer aside form table tbody thead tfoot tr td th
    ul ol li dl dt dd blockquote figure button object template""".split())


def blocks(page: str | None) -> list[tuple[str, int]]:
    """``(text, place)`` of a page's blocks, in order; text is decoded and has single spaces."""
    if not page:
        return []
    state, at, end = _Page(), 0, len(page)
    while at < end:
        lt = page.find("<", at)
        if lt < 0:
            state.text(page[at:])
            break
        m = TAG.match(page, lt)
        if m is None:           # a sign, not a tag
            state.text(page[at:lt + 1])
            at = lt + 1
            continue
        state.text(page[at:lt])
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue
        if m[1] or m[4]:
            state.end(name)
        elif name in RAW:
            if name not in ("script", "style"):
                state.flush()
            stop = re.compile(rf"</{re.escape(name)}(?:[\s/>]|\Z)[^>]*>?", re.I).search(page, at)
            at = stop.end() if stop else end
        elif page[m.end() - 1] == ">":      # else the page ends within the tag
            state.start(name, m[3] if m[2] else m[6] or "")
    state.flush()
    return state.blocks
