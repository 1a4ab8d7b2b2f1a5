"""Assembling texts: crops into pages, pages into documents, OCR trees into lines, marked-up pages into plain text."""

from __future__ import annotations

import html
import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions.strings import strip
from .pages import doc_stem

RULE = "=" * 50


def ordered_text(order: Column, text: Column, separator: str) -> Column:
    """Aggregate: the texts joined in the order given, nulls left out.  Bounded by one page's or document's text."""
    pairs = F.array_sort(F.collect_list(F.struct(order.alias("o"), text.alias("t"))))
    return F.array_join(F.transform(pairs, lambda x: x["t"]), separator)


def page_blocks(pages: DataFrame, text: str = "text", lexicographic: bool = False) -> DataFrame:
    """(stem, o, t): each page's part of its document, with what orders the parts."""
    key = F.col("page_key")
    number = F.regexp_extract(key, r"_page_(\d+)$", 1).try_cast("bigint")
    order = F.struct(key) if lexicographic else F.struct(number, key)
    block = F.concat(F.lit("## "), key, F.lit("\n\n"), F.coalesce(F.col(text), F.lit("")), F.lit(f"\n\n{RULE}\n\n"))
    return pages.where(key.isNotNull()).select(doc_stem(key).alias("stem"), order.alias("o"), block.alias("t"))


def merged_documents(pages: DataFrame, text: str = "text", lexicographic: bool = False) -> DataFrame:
    """(stem, n_pages, document): the pages of each document under headings, in page order.

    pages: (page_key, text).  Order is that of the page number, or that of the key's characters if `lexicographic`.
    A null text counts as empty.  A document is one row here; `sinks.files.write_merged` writes documents of any size.
    """
    rows = page_blocks(pages, text, lexicographic)
    whole = rows.groupBy("stem").agg(F.count("*").alias("n_pages"), ordered_text(F.col("o"), F.col("t"), "").alias("body"))
    return whole.select("stem", "n_pages", F.concat(F.lit("# Document: "), "stem", F.lit("\n\n"), "body").alias("document"))


def page_texts(crops: DataFrame, strip_ends: bool = True) -> DataFrame:
    """(page_key, text) from crop results (page_key, crop_idx, text): joined by a blank line in crop order."""
    text = ordered_text(F.col("crop_idx"), F.col("text"), "\n\n")
    return crops.groupBy("page_key").agg((strip(text) if strip_ends else text).alias("text"))


def tree_text(pages: Column) -> Column:
    """The text of an OCR tree: words joined by blanks, lines by line ends, stripped.

    pages: array<struct<blocks:array<struct<lines:array<struct<words:array<struct<value:string>>>>>>>>
    """
    lines = F.flatten(F.transform(pages, lambda p: F.flatten(F.transform(p["blocks"], lambda b: F.transform(b["lines"], lambda line: F.array_join(F.transform(line["words"], lambda w: w["value"]), " "))))))
    return strip(F.array_join(lines, "\n"))


def block_text(blocks: Column) -> Column:
    """The text of content blocks (content, else text): stripped, empty ones dropped, joined by blank lines."""
    texts = F.transform(blocks, lambda b: strip(F.coalesce(b["content"], b["text"], F.lit(""))))
    return F.array_join(F.filter(texts, lambda t: t != ""), "\n\n")


class _Text(HTMLParser):
    """Collects the text nodes of an HTML page, each without white space at its ends."""

    HIDDEN = frozenset(("script", "style"))

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parts: list[str] = []
        self.hidden = 0

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in self.HIDDEN

    def handle_endtag(self, tag):
        self.hidden = max(0, self.hidden - (tag in self.HIDDEN))

    def handle_data(self, data):
        if not self.hidden and data.strip():
            self.parts.append(data.strip())


INLINE = ((re.compile(r"!\[([^\]\n]*)\]\([^)\n]*\)"), ""), (re.compile(r"\[([^\]\n]+)\]\([^)\n]*\)"), r"<a>\1</a>"), (re.compile(r"`([^`\n]+)`"), r"<code>\1</code>"), (re.compile(r"(\*\*|__)(?=\S)(.+?)(?<=\S)\1"), r"<b>\2</b>"), (re.compile(r"(?<![\w*])\*(?=\S)([^*\n]+?)(?<=\S)\*(?![\w*])"), r"<i>\1</i>"))


def to_html(markdown: str) -> str:
    """A page of Markdown (headings, lists, quotes, tables, rules, code, emphasis, links) as HTML; HTML in it stays."""
    out, fenced = [], False
    for line in markdown.split("\n"):
        if re.match(r"\s*(```|~~~)", line):
            fenced = not fenced
            out.append("<pre>" if fenced else "</pre>")
            continue
        if fenced:
            out.append(html.escape(line))
            continue
        if re.fullmatch(r"\s*\|?[\s:|-]*-{3,}[\s:|-]*", line) or re.fullmatch(r"\s*([-*_=])(\s*\1){2,}\s*", line):
            out.append("<hr>")
            continue
        block = None
        if m := re.match(r" {0,3}(#{1,6})\s+(.*?)\s*#*\s*$", line):
            block, line = f"h{len(m[1])}", m[2]
        elif m := re.match(r"\s*(?:[-*+]|\d+[.)])\s+(.*)$", line):
            block, line = "li", m[1]
        elif m := re.match(r"\s*>\s?(.*)$", line):
            block, line = "blockquote", m[1]
        elif line.strip().startswith("|") and line.strip().endswith("|"):
            out.append("<tr>" + "".join(f"<td>{_inline(c)}</td>" for c in line.strip().strip("|").split("|")) + "</tr>")
            continue
        line = _inline(line)
        out.append(f"<{block}>{line}</{block}>" if block else line)
    return "\n".join(out)


def _inline(text: str) -> str:
    for pattern, into in INLINE:
        text = pattern.sub(into, text)
    return text


def plain_text(markdown: str | None) -> str | None:
    """The text nodes of a marked-up page joined by single blanks; line ends become blanks; null stays null."""
    if markdown is None:
        return None
    parser = _Text()
    parser.feed(to_html(markdown))
    parser.close()
    return re.sub(r"\n", " ", " ".join(parser.parts))


@F.pandas_udf(StringType())
def parsed_text(pages: pd.Series) -> pd.Series:
    """`plain_text` for Arrow batches."""
    return pages.map(plain_text)
