"""Title and tag attributes of a page, from one parse of its HTML.

The parser is the standard library's; it sees each page once and stops as soon as every wanted
field is settled. Nothing native can replace it on broken markup, so it is the one Python step
of feature extraction and receives the HTML column alone, in Arrow batches.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from html import entities, unescape
from html.parser import HTMLParser
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Elements that never have content.
VOID_ELEMENTS = frozenset(
    "area base basefont bgsound br col command embed frame hr image img input isindex keygen "
    "link menuitem meta nextid param source spacer track wbr".split()
)


class AttrRule(NamedTuple):
    """Take ``out_attr`` of the first element whose ``match_attr`` matches ``pattern``."""

    match_attr: str
    pattern: str
    out_attr: str


# The two meta fields, matched on any element and in any case.
META_RULES = {
    "keywords": AttrRule("name", "keywords", "content"),
    "description": AttrRule("name", "description", "content"),
}


class _Settled(Exception):
    """Every wanted field is known."""


class _FieldParser(HTMLParser):
    RCDATA_CONTENT_ELEMENTS = ()  # markup inside a title is markup, on every Python version

    def __init__(self, rules: Mapping[str, tuple], want_title: bool):
        super().__init__(convert_charrefs=False)
        self.found: dict[str, str | None] = {}
        self._open_rules = dict(rules)
        self._title_done = not want_title
        self._open: list[str] = []  # names of open elements, until the title is closed
        self._nodes: list[list] = []  # content of the title and of what is open inside it
        self._text: list[str] = []

    # -- title: text, or the only child's text, else nothing
    def _flush(self) -> None:
        if self._nodes and self._text:
            text = "".join(self._text)
            if not text.strip(" \n\t\f\r"):
                text = "\n" if "\n" in text else " "
            self._nodes[-1].append(text)
        self._text.clear()

    def _close_to(self, depth: int) -> None:
        self._flush()
        base = len(self._open) - len(self._nodes)
        if depth <= base and self._nodes:
            node: list | str | None = self._nodes[0]
            while isinstance(node, list):
                node = node[0] if len(node) == 1 else None
            self.found["title"] = node
            self._title_done = True
            self._nodes.clear()
            self._check()
            return
        del self._nodes[max(depth - base, 0) :]
        del self._open[depth:]

    def _check(self) -> None:
        if self._title_done and not self._open_rules:
            raise _Settled

    def _start(self, tag: str, attrs: list, closed: bool) -> None:
        if self._open_rules:
            values = {name: "" if value is None else value for name, value in attrs}
            for field, (match_attr, pattern, out_attr) in list(self._open_rules.items()):
                value = values.get(match_attr)
                if value is not None and pattern.search(value):
                    self.found[field] = values.get(out_attr)
                    del self._open_rules[field]
            self._check()
        if self._title_done:
            return
        self._flush()
        node: list = []
        if self._nodes:
            self._nodes[-1].append(node)
        self._open.append(tag)
        if self._nodes or tag == "title":
            self._nodes.append(node)
        if closed or tag in VOID_ELEMENTS:
            self._close_to(len(self._open) - 1)

    def handle_starttag(self, tag, attrs):
        self._start(tag, attrs, closed=False)

    def handle_startendtag(self, tag, attrs):
        self._start(tag, attrs, closed=True)

    def handle_endtag(self, tag):
        if self._title_done or tag not in self._open:
            return
        self._close_to(len(self._open) - 1 - self._open[::-1].index(tag))

    def handle_data(self, data):
        if self._nodes:
            self._text.append(data)

    def handle_entityref(self, name):
        self.handle_data(entities.html5.get(f"{name};", f"&{name}"))

    def handle_charref(self, name):
        self.handle_data(unescape(f"&#{name};"))

    def handle_comment(self, data):
        if self._nodes:
            self._flush()
            self._nodes[-1].append(data)

    def finish(self) -> None:
        if not self._title_done:
            self._close_to(0)


def parse_fields(html: str | None, rules: Mapping[str, tuple], want_title: bool) -> dict:
    """Fields of one page; a field the page does not have is missing from the result."""
    if html is None:
        return {}
    parser = _FieldParser(rules, want_title)
    try:
        parser.feed(html)
        parser.close()
        parser.finish()
    except _Settled:
        pass
    except AssertionError:  # markup the parser rejects
        return {}
    return parser.found


def page_fields(
    html: Column, rules: Mapping[str, AttrRule] = META_RULES, title: bool = True
) -> Column:
    """One struct with ``title`` (if asked for) and a field for every rule.

    Filters on other columns pass below the parse, to the scan. One on a field of the struct would
    take a parse of its own below it: store the fields first.
    """
    compiled = {
        field: (rule.match_attr, re.compile(rule.pattern, re.IGNORECASE), rule.out_attr)
        for field, rule in rules.items()
    }
    names = (["title"] if title else []) + list(rules)
    schema = T.StructType([T.StructField(name, T.StringType()) for name in names])

    @F.pandas_udf(schema)
    def fields(pages: pd.Series) -> pd.DataFrame:
        parsed = (parse_fields(page, compiled, title) for page in pages)
        rows = [[found.get(name) for name in names] for found in parsed]
        return pd.DataFrame(rows, columns=names, dtype=object)

    return fields(html)


def page_title(html: Column) -> Column:
    return page_fields(html, rules={})["title"]


def page_attr(html: Column, match_attr: str, pattern: str, out_attr: str) -> Column:
    rule = AttrRule(match_attr, pattern, out_attr)
    return page_fields(html, {"value": rule}, title=False)["value"]
