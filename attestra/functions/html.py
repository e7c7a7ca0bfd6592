"""HTML to text and to simple markdown lines, in Arrow batches over the standard library parser."""

from __future__ import annotations

import re
from html import unescape
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from attestra.functions.columns import as_col


class _Text(HTMLParser):
    """Stripped text pieces outside the dropped tags."""

    def __init__(self, dropped: frozenset[str]):
        super().__init__(convert_charrefs=True)
        self.dropped, self.depth, self.pieces, self.current = dropped, 0, [], ""

    def _flush(self):
        if self.current.strip():
            self.pieces.append(self.current.strip())
        self.current = ""

    def handle_starttag(self, tag, attrs):
        self._flush()
        self.depth += tag in self.dropped

    def handle_endtag(self, tag):
        self._flush()
        if tag in self.dropped and self.depth:
            self.depth -= 1

    def handle_comment(self, data):
        self._flush()

    def handle_data(self, data):
        if not self.depth:
            self.current += data


def _text_of(html: str, dropped: frozenset[str]) -> str:
    parser = _Text(dropped)
    parser.feed(html)
    parser.close()
    parser._flush()
    return re.sub(r"\n{3,}", "\n\n", "\n".join(parser.pieces)).strip()


def html_to_text(html, dropped=("script", "style")) -> Column:
    """Visible text, one line per text node."""
    tags = frozenset(dropped)

    @F.pandas_udf("string")
    def run(values: pd.Series) -> pd.Series:
        return values.map(lambda v: None if v is None else _text_of(v, tags))

    return run(as_col(html))


@F.pandas_udf(StringType())
def _unescape(values: pd.Series) -> pd.Series:
    return values.map(lambda v: v if v is None or "&" not in v else unescape(v))


def strip_tags(html) -> Column:
    """Tags to blanks, entities resolved: the quick form for short snippets."""
    return F.trim(_unescape(F.regexp_replace(F.coalesce(as_col(html), F.lit("")), "<[^>]+>", " ")))
