"""The tag-stack parser behind the selector forms of page extraction."""

from __future__ import annotations

import sys
from html.parser import HTMLParser

import pandas as pd
from pyspark import cloudpickle

# Ship the classes themselves, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Elements that never have an end tag.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)


class _Outline(HTMLParser):
    """Keeps the open elements as (tag, classes) and feeds two hooks."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open = []

    def handle_starttag(self, tag, attrs):
        attrs = {k: v or "" for k, v in attrs}
        classes = frozenset(attrs.get("class", "").split())
        self.entered(tag, classes, attrs)
        if tag not in VOID:
            self.open.append((tag, classes))

    def handle_startendtag(self, tag, attrs):
        attrs = {k: v or "" for k, v in attrs}
        self.entered(tag, frozenset(attrs.get("class", "").split()), attrs)

    def handle_endtag(self, tag):
        for depth in range(len(self.open) - 1, -1, -1):
            if self.open[depth][0] == tag:
                del self.open[depth:]
                self.left()
                return

    def entered(self, tag, classes, attrs):
        pass

    def left(self):
        pass


class _Listing(_Outline):
    """Posts: ``div.thing.link`` with the text of its first ``a.title``."""

    def __init__(self):
        super().__init__()
        self.posts, self.around, self.titled = [], [], []
        self.title_depth = None

    def entered(self, tag, classes, attrs):
        if tag == "div" and {"thing", "link"} <= classes:
            post = {
                "title": None, "depth": len(self.open),
                "permalink": attrs.get("data-permalink", ""), "score": attrs.get("data-score", "0"),
            }
            self.posts.append(post)
            self.around.append(post)
        elif tag == "a" and "title" in classes and self.title_depth is None:
            self.titled = [post for post in self.around if post["title"] is None]
            self.title_depth = len(self.open)
            for post in self.titled:
                post["title"] = ""

    def left(self):
        depth = len(self.open)
        self.around = [post for post in self.around if post["depth"] < depth]
        if self.title_depth is not None and depth <= self.title_depth:
            self.title_depth = None

    def handle_data(self, data):
        if self.title_depth is not None:
            for post in self.titled:
                post["title"] += data.strip()


class _Thread(_Outline):
    """Top-level comments: ``div.thing.comment`` right below the site table of
    the comment area, with the text of the first body in each."""

    def __init__(self):
        super().__init__()
        self.comments, self.top, self.body = [], None, None

    def entered(self, tag, classes, attrs):
        stack = self.open
        if tag == "div" and {"thing", "comment"} <= classes and self.top is None and len(stack) >= 2:
            (tag1, area), (tag2, table) = stack[-2:]
            if tag1 == tag2 == "div" and "commentarea" in area and "sitetable" in table:
                self.top = len(stack)
                self.comments.append(None)
        elif "md" in classes and self.top is not None and self.comments[-1] is None:
            if any("usertext-body" in c for _, c in stack[self.top:]):
                self.body = len(stack)
                self.comments[-1] = []

    def left(self):
        if self.body is not None and len(self.open) <= self.body:
            self.body = None
        if self.top is not None and len(self.open) <= self.top:
            self.top = None

    def handle_data(self, data):
        if self.body is not None and data.strip():
            self.comments[-1].append(data.strip())


def _parse(parser, html):
    parser.feed(html or "")
    parser.close()
    return parser


def posts_of(batches):
    for batch in batches:
        rows = [
            (page, pos, post["title"] or "", post["permalink"], post["score"])
            for page, html in zip(batch["page_id"], batch["html"])
            for pos, post in enumerate(_parse(_Listing(), html).posts)
        ]
        yield pd.DataFrame(rows, columns=["page_id", "pos", "title", "permalink", "score"])


def comments_of(batches):
    for batch in batches:
        rows = [
            (page, pos, " ".join(parts))
            for page, html in zip(batch["page_id"], batch["html"])
            for pos, parts in enumerate(_parse(_Thread(), html).comments)
            if parts
        ]
        yield pd.DataFrame(rows, columns=["page_id", "pos", "text"])
