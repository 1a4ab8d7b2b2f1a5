"""A data source of PDF pages: partitions are shares of files' pages, and page filters reach it.

The driver lists names and sizes only; pages are counted by the tasks that read the files.  What a page looks like is the
renderer's business: `renderer` names a function `module:function` that takes (file content, page number, scale) and
returns an image struct.  Without one, page numbers and totals are right and the image is null.
"""

from __future__ import annotations

import glob
import importlib
import os
import re
import zlib

from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

#: A file is dealt to one task for each so many bytes of it: page k goes to task k modulo their number.
BYTES_A_TASK = 4 << 20
OBJECT = re.compile(rb"/Type\s*/Page(?![A-Za-z])")
STREAM = re.compile(rb"stream\r?\n(.*?)\r?\nendstream", re.S)


def page_count(content: bytes) -> int:
    """The number of page objects, also of those in compressed object streams."""
    n = len(OBJECT.findall(content))
    if b"/ObjStm" in content:
        for part in STREAM.findall(content):
            try:
                n += len(OBJECT.findall(zlib.decompress(part)))
            except zlib.error:
                continue
    return n


class PageShare(InputPartition):
    def __init__(self, path: str, share: int, shares: int):
        self.path, self.share, self.shares = path, share, shares


class PdfPages(DataSource):
    """Options: path, recursive, dpi, renderer."""

    @classmethod
    def name(cls) -> str:
        return "pdf_pages"

    def schema(self) -> str:
        return "url string, page_num int, total_pages int, image struct<height:int,width:int,n_channels:int,mode:int,data:binary>, error string"

    def reader(self, schema) -> PdfReader:
        return PdfReader(self.options)


class PdfReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options
        self.pages: set[int] | None = None

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            if isinstance(f, EqualTo) and f.attribute == ("page_num",):
                wanted = {f.value}
            elif isinstance(f, In) and f.attribute == ("page_num",):
                wanted = set(f.value)
            else:
                yield f
                continue
            self.pages = wanted if self.pages is None else self.pages & wanted

    def partitions(self) -> list[InputPartition]:
        path = self.options["path"].removeprefix("file://")
        deep = self.options.get("recursive", "true") == "true"
        names = [path] if os.path.isfile(path) else sorted(glob.glob(os.path.join(glob.escape(path), "**" if deep else "", "*"), recursive=deep))
        out: list[InputPartition] = []
        for name in names:
            if name.lower().endswith(".pdf") and os.path.isfile(name) and os.path.basename(name)[0] not in "._":
                shares = 1 + os.path.getsize(name) // BYTES_A_TASK if self.options.get("renderer") else 1
                out += [PageShare(name, k, shares) for k in range(shares)]
        return out or [PageShare("", 0, 1)]

    def read(self, part: PageShare):
        if not part.path:
            return
        content, total, error = b"", 0, None
        try:
            with open(part.path, "rb") as file:
                content = file.read()
            total = page_count(content)
        except OSError as e:
            error = str(e)
        if error or not total:
            if part.share == 0 and (self.pages is None or 1 in self.pages):
                yield (part.path, 1, 0, None, error or "no pages found")
            return
        render = None
        if self.options.get("renderer"):
            module, _, function = self.options["renderer"].partition(":")
            render = getattr(importlib.import_module(module), function)
        for page in range(1 + part.share, total + 1, part.shares):
            if self.pages is not None and page not in self.pages:
                continue
            image, error = None, None
            if render:
                try:
                    found = render(content, page, float(self.options.get("dpi", "200")) / 72.0)
                    image = (found["height"], found["width"], found["n_channels"], found["mode"], found["data"])
                except Exception as e:  # one page's failure must not lose the file's others
                    error = str(e) or type(e).__name__
            yield (part.path, page, total, image, error)
