"""HTML tokens to one page's preorder node columns: the only per-row Python of the extraction.

It repairs the tree and numbers it.  Everything that scores, chooses or renders is Spark
expressions over the node array (``functions/nodes.py``).
"""

import re
from html import unescape
from itertools import accumulate

# Elements removed with their subtrees, and media elements left out of the text.
BLOCK_KILL = frozenset(
    "script style header footer nav aside noscript iframe svg form template canvas".split()
)
MEDIA = frozenset("img video source svg noscript".split())
# In a body that is no page of its own only code is removed.
CODE_KILL = frozenset("script style template".split())

SPACES = " \n\t\f\r"
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr frame".split()
)
RAW_TEXT = frozenset(["script", "style", "title", "textarea"])
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary "
    "table tbody td tfoot th thead tr ul".split()
)
HEAD_ONLY = frozenset("base head link meta script style title noscript template html body".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
CODE = frozenset("code kbd samp".split())

# A start tag closes an open element of the left set unless one of the right set is in between.
CLOSED_BY = {
    "li": (frozenset(["li"]), frozenset("ul ol menu".split())),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "tr": (frozenset(["tr"]), frozenset(["table"])),
    "tbody": (frozenset("thead tbody tfoot".split()), frozenset(["table"])),
    "thead": (frozenset("thead tbody tfoot".split()), frozenset(["table"])),
    "tfoot": (frozenset("thead tbody tfoot".split()), frozenset(["table"])),
    "option": (frozenset(["option"]), frozenset(["select"])),
}
# How far an end tag looks for its start: a cell's content cannot end what is outside of the cell, parts
# of a table only end inside that table, and other inline ends do not reach out of a block.
TABLE_PARTS = frozenset("caption tbody td tfoot th thead tr".split())
TABLE_SCOPE = frozenset("html table template".split())
SCOPE = TABLE_SCOPE | frozenset("caption object td th".split())
FORMATTING = frozenset("a b big code em font i s small strike strong tt u".split())

TAG_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
ATTRIBUTE = re.compile(
    r"""[\s/]*([^\s/>=][^\s/>=]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]*)))?"""
)
WORD = re.compile(r"\w+")
CONTROL = re.compile(r"[\x00-\x08\x0b\x0e-\x1f]")
RAW_END = {t: re.compile("</" + t + r"(?=[\s/>])", re.I) for t in RAW_TEXT}


class PageNodes:
    """Column lists of one page's nodes, filled by ``feed``."""

    __slots__ = (
        "parent", "end", "tag", "text", "attrs", "killed", "media", "item_no", "indent", "quotes",
        "verbatim", "oneline", "words", "links", "_open", "_count", "_items", "_tail", "_seen", "_kill",
    )

    def __init__(self, page=True):
        """``page=False`` for a body from elsewhere: it has no html, head and body, and only code is removed."""
        for name in self.__slots__[:14]:
            setattr(self, name, [])
        self._open = []      # ids of open elements
        self._count = {}     # open elements by tag
        self._items = {}     # list or table id -> items so far
        self._tail = False   # directly behind a removed element
        self._seen = set() if page else {"html", "head", "body"}   # those met so far
        self._kill = BLOCK_KILL if page else CODE_KILL

    def feed(self, html):
        if CONTROL.search(html):
            html = CONTROL.sub("", html)
        pos, size, run = 0, len(html), []
        while pos < size:
            lt = html.find("<", pos)
            if lt < 0:
                run.append(html[pos:])
                break
            if lt > pos:
                run.append(html[pos:lt])
            mark = html[lt + 1:lt + 2]
            if mark == "!" or mark == "?":
                self._flush(run)
                self._tail = False
                if self._open and (mark == "?" or html.startswith("<!--", lt)):
                    self._add("#comment", None, None)
                if html.startswith("<!--", lt):
                    close = html.find("-->", lt + 4)
                    pos = size if close < 0 else close + 3
                else:
                    close = html.find(">", lt)
                    pos = size if close < 0 else close + 1
                continue
            name = TAG_NAME.match(html, lt + 2 if mark == "/" else lt + 1)
            if name is None:
                if mark == "/":      # "</" without a name is dropped up to ">"
                    close = html.find(">", lt)
                    pos = size if close < 0 else close + 1
                else:
                    run.append("<")
                    pos = lt + 1
                continue
            tag = name.group().lower()
            if mark == "/":
                close = html.find(">", name.end())
                pos = size if close < 0 else close + 1
                if self._closable(tag):
                    self._flush(run)
                    if self._closable(tag):      # the text may have opened the body
                        self._close_tag(tag)
                continue
            self._flush(run)
            attrs, pos, empty = self._attributes(html, name.end())
            node = self._start(tag, attrs, empty)
            if node is not None and tag in RAW_TEXT and not empty:
                close = RAW_END[tag].search(html, pos)
                if close is None and tag in ("title", "textarea"):
                    continue
                body = html[pos:close.start()] if close else html[pos:]
                pos = close.start() if close else size
                if tag in ("title", "textarea"):
                    body = unescape(body) if "&" in body else body
                elif tag == "style" or attrs.get("type") != "application/ld+json":
                    body = ""        # code is never text: not kept
                if body:
                    self._add_text(body)
        self._flush(run)
        while self._open:
            self._pop()
        self._count_words()
        return self

    def _attributes(self, html, pos):
        attrs = {}
        size = len(html)
        while pos < size:
            if html[pos] == ">":
                return attrs, pos + 1, False
            if html.startswith("/>", pos):
                return attrs, pos + 2, True
            m = ATTRIBUTE.match(html, pos)
            if m is None:
                pos += 1
                continue
            key = m.group(1).lower()
            if key not in attrs:
                value = m.group(2) or m.group(3) or m.group(4) or ""
                attrs[key] = unescape(value) if "&" in value else value
            pos = m.end()
        return attrs, size, False

    def _start(self, tag, attrs, empty):
        self._tail = False
        if tag in ("html", "head", "body"):
            if tag in self._seen or (tag == "head" and "body" in self._seen):
                return None
            self._seen.add(tag)
        elif tag not in HEAD_ONLY:
            self._imply_body()
        if tag == "body" and self._count.get("head"):
            self._close_tag("head")
            self._tail = False
        if tag in BLOCK and self._count.get("p"):
            self._close_above(frozenset(["p"]), BLOCK)
        rule = CLOSED_BY.get(tag)
        if rule and any(self._count.get(t) for t in rule[0]):
            self._close_above(*rule)
        if tag == "a" and self._open and self.tag[self._open[-1]] == "a":
            self._pop()
        node = self._add(tag, None, attrs)
        if not (empty or tag in VOID):
            self._open.append(node)
            self._count[tag] = self._count.get(tag, 0) + 1
        else:
            self._after(node)
        return node

    def _imply_body(self):
        """Content right under html or head opens the missing body."""
        if "body" not in self._seen and self._open and self.tag[self._open[-1]] in ("html", "head"):
            self._start("body", {}, False)

    def _add(self, tag, text, attrs):
        node = len(self.tag)
        up = self._open[-1] if self._open else -1
        live = up < 0
        kind = "" if live else self.tag[up]
        self.parent.append(up)
        self.end.append(node)
        self.tag.append(tag)
        self.text.append(text)
        self.attrs.append(attrs)
        self.killed.append((not live and self.killed[up]) or (tag in self._kill and node > 0))
        self.media.append((not live and self.media[up]) or tag in MEDIA)
        number, indent = 0, 0 if live else self.indent[up]
        if kind == "li":
            indent += len(str(self.item_no[up])) + 2 if self.item_no[up] else 2
        if tag == "li" and kind in ("ul", "ol", "menu"):
            number = self._items[up] = self._items.get(up, self._first(up)) + 1
            if kind != "ol":
                number = 0
        elif tag == "tr":
            table = up if kind == "table" or live else self.parent[up]
            number = self._items[table] = self._items.get(table, 0) + 1
        self.item_no.append(number)
        self.indent.append(indent)
        self.quotes.append((0 if live else self.quotes[up]) + (tag == "blockquote"))
        self.verbatim.append(
            2 if tag == "pre" else max(0 if live else self.verbatim[up], 1 if tag in CODE else 0)
        )
        self.oneline.append(
            (not live and self.oneline[up]) or tag in HEADING or tag == "td" or tag == "th"
        )
        return node

    def _first(self, up):
        start = self.attrs[up].get("start", "")
        return int(start) - 1 if start.isascii() and start.isdigit() and len(start) < 9 else 0

    def _add_text(self, text):
        if text.isspace() and (not self._open or self.tag[self._open[-1]] in ("html", "head")):
            return
        if not (self._open and self.tag[self._open[-1]] in RAW_TEXT) and not text.isspace():
            self._imply_body()
        node = self._add("#text", text, None)
        if self._tail:
            self.killed[node] = True
        self._tail = False

    def _flush(self, run):
        if run:
            text = "".join(run)
            run.clear()
            if not text.strip(SPACES) and not (self._open and self.verbatim[self._open[-1]] == 2):
                text = "\n" if "\n" in text else " "      # blank texts shrink to one character
            self._add_text(unescape(text) if "&" in text else text)

    def _closable(self, tag):
        if tag in ("html", "body") or not self._count.get(tag):
            return False
        if tag in TABLE_PARTS:
            scope = TABLE_SCOPE
        elif tag in BLOCK or tag in FORMATTING:
            scope = SCOPE
        else:
            scope = BLOCK | SCOPE
        for node in reversed(self._open):
            if self.tag[node] == tag:
                return True
            if self.tag[node] in scope:
                return False
        return False

    def _close_tag(self, tag):
        while self._pop() != tag:
            pass

    def _close_above(self, targets, stops):
        for depth in range(len(self._open) - 1, -1, -1):
            tag = self.tag[self._open[depth]]
            if tag in targets:
                while len(self._open) > depth:
                    self._pop()
                self._tail = False
                return
            if tag in stops:
                return

    def _pop(self):
        node = self._open.pop()
        tag = self.tag[node]
        self._count[tag] -= 1
        self.end[node] = len(self.tag) - 1
        self._after(node)
        return tag

    def _after(self, node):
        up = self.parent[node]
        self._tail = self.killed[node] and not (up >= 0 and self.killed[up])

    def _count_words(self):
        """Words and links per subtree from running totals, so nesting costs nothing extra.

        A subtree's text joins its live text nodes without a separator, so a word that runs
        through the border of two texts is counted in both and taken off once.
        """
        counts, merges, end_in_word = [], [], False
        parts, links = [0], [0]
        for text, killed, tag in zip(self.text, self.killed, self.tag):
            live = not killed
            if text and live:
                counts.append(len(WORD.findall(text)))
                merges.append(end_in_word and WORD.match(text) is not None)
                end_in_word = text[-1] == "_" or text[-1].isalnum()
            parts.append(len(counts))
            links.append(links[-1] + (live and tag == "a"))
        words = list(accumulate(counts, initial=0))
        merged = list(accumulate(merges, initial=0))     # borders in front of the first k texts
        for i, end in enumerate(self.end):
            lo, hi = parts[i], parts[end + 1]
            joined = merged[hi] - merged[lo + 1] if hi > lo else 0
            self.words.append(words[hi] - words[lo] - joined)
            self.links.append(links[end + 1] - links[i + 1])
