"""Problem 4: lines printed on many pages of one stem, found and removed.

1. Every task keeps, for each stem, a heavy-hitter summary (Misra and Gries) of the wordings of its lines.  Summaries
   merge in a tree, FAN at a time, and each merge cuts the result back to its capacity, with a known error.
2. Wordings that may reach a quarter of the wanted share are candidates; those of one stem that differ by misread
   characters only are merged.  A stem's last summary is bounded, so this needs no more than one task for each stem.
3. A second pass over the current pages counts, exactly, the pages on which each candidate stands, misread or not.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import dropped, stem_of, written

MIN_PAGES, MIN_SHARE, MIN_WORDS = 6, 0.2, 5
#: A summary keeps at least this many wordings of a stem, or CAPACITY_LINES for each line that an average page has.
CAPACITY, CAPACITY_LINES = 2048, 21
#: Summaries of one stem that are merged at a time.
FAN = 32
#: Candidate wordings are broadcast up to this number (about 100 bytes each); beyond it they reach the pages by a join on the stem.
BROADCAST_CANDIDATES = 200_000


def wording(line: str, least: int = MIN_WORDS) -> str:
    """The words of a line: lower case, without punctuation, digits and spacing; '' of fewer than `least`.  Numbers drop out."""
    words = []
    for token in line.lower().split():
        if token.isalpha():
            words.append(token)
            continue
        kept = "".join(c for c in token if c.isalpha())
        if kept and not (len(kept) < 3 and any(c.isdigit() for c in token)):
            words.append(kept)
    return " ".join(words) if len(words) >= least else ""


class Summary:
    """A Misra-Gries summary: every count is too low by at most `error`, and no wording whose count exceeds the error is missing."""

    def __init__(self, least: int = CAPACITY, per_line: int = CAPACITY_LINES):
        self.counts: dict[str, int] = {}
        self.pages = self.lines = self.error = 0
        self.least, self.per_line = least, per_line

    @property
    def capacity(self) -> int:
        return max(self.least, self.per_line * (1 + self.lines // max(1, self.pages)))

    def add(self, wordings: set[str]) -> None:
        self.pages += 1
        self.lines += len(wordings)
        counts = self.counts
        for w in wordings:
            counts[w] = counts.get(w, 0) + 1
        if len(counts) > 2 * self.capacity:
            self.cut()

    def merge(self, counts: dict[str, int], pages: int, lines: int, error: int) -> None:
        self.pages, self.lines, self.error = self.pages + pages, self.lines + lines, self.error + error
        for w, n in counts.items():
            self.counts[w] = self.counts.get(w, 0) + n
        if len(self.counts) > 2 * self.capacity:
            self.cut()

    def cut(self) -> None:
        """Back to the capacity: the count that comes next is taken off all, and the error grows by it."""
        if len(self.counts) > self.capacity:
            least = sorted(self.counts.values(), reverse=True)[self.capacity]
            self.error += least
            self.counts = {w: n - least for w, n in self.counts.items() if n > least}

    def rows(self, stem: str, part: int) -> list[tuple]:
        """One row for each wording, and one of a null wording that bears pages, lines and error."""
        return [(stem, part, w, n, None, None) for w, n in self.counts.items()] + [(stem, part, None, self.pages, self.lines, self.error)]


SUMMARY = "stem string, part long, wording string, n long, lines long, error long"


def _summary_rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64())
    columns = list(zip(*rows)) or [()] * 6
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["stem", "part", "wording", "n", "lines", "error"])


def summaries(pages: DataFrame, forms: Callable[[str], set[str]], least: int = CAPACITY, per_line: int = CAPACITY_LINES) -> DataFrame:
    """One summary for each stem and task, from (stem, text) rows; `forms` gives the wordings of a text, '' doesn't count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held: dict[str, Summary] = {}
        for batch in batches:
            for stem, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if text and stem is not None:
                    held.setdefault(stem, Summary(least, per_line)).add(forms(text) - {""})
        rows: list[tuple] = []
        for stem, s in held.items():
            rows += s.rows(stem, part)
            if len(rows) > 50_000:
                yield _summary_rows(rows)
                rows = []
        yield _summary_rows(rows)

    return pages.mapInArrow(run, SUMMARY)


def merged_summaries(parts: DataFrame, least: int = CAPACITY, per_line: int = CAPACITY_LINES, fan: int = FAN) -> DataFrame:
    """One summary for each stem: summaries are merged `fan` at a time, as often as it takes."""

    def merge(table: pa.Table) -> pa.Table:
        columns = [table.column(c).to_pylist() for c in ("stem", "part", "wording", "n", "lines", "error")]
        own: dict[int, tuple[dict, list]] = {}
        for _stem, part, w, n, lines, error in zip(*columns):
            counts, head = own.setdefault(part, ({}, []))
            if w is None:
                head += (n, lines, error)
            else:
                counts[w] = n
        whole = Summary(least, per_line)
        for part in sorted(own):
            whole.merge(own[part][0], *own[part][1])
        whole.cut()
        return pa.Table.from_batches([_summary_rows(whole.rows(columns[0][0], columns[1][0] // fan))])

    parts = written(parts, "site-lines")
    most = parts.where("wording is null").agg(F.max("part")).first()[0] or 0
    while True:
        made = parts.withColumn("_node", F.floor(F.col("part") / fan)).groupBy("stem", "_node").applyInArrow(merge, SUMMARY)
        made, before = written(made, "site-lines"), parts
        dropped(before)
        parts, most = made, most // fan
        if not most:
            return parts


def _near(a: str, b: str, most: int) -> bool:
    """Whether two words differ by at most `most` edits, checked between their common start and end."""
    if a == b:
        return True
    if abs(len(a) - len(b)) > most:
        return False
    i, n = 0, min(len(a), len(b))
    while i < n and a[i] == b[i]:
        i += 1
    j = 0
    while j < n - i and a[-1 - j] == b[-1 - j]:
        j += 1
    x, y = a[i : len(a) - j], b[i : len(b) - j]
    if max(len(x), len(y)) <= most:
        return True
    before = list(range(len(y) + 1))
    for p, c in enumerate(x, 1):
        now = [p]
        for q, d in enumerate(y, 1):
            now.append(min(before[q] + 1, now[-1] + 1, before[q - 1] + (c != d)))
        before = now
    return before[-1] <= most


def same_wording(a: list[str], b: list[str]) -> bool:
    """Equal up to single misread characters: the same number of words, most of them equal, the others within two edits.

    In a line of few words an edit takes four letters, or other words would do as well.
    """
    if len(a) != len(b):
        return False
    unlike = [(x, y) for x, y in zip(a, b) if x != y]
    return len(unlike) <= max(1, 2 * len(a) // 5) and all(_near(x, y, 2 if len(a) >= MIN_WORDS else min(2, len(x) // 4)) for x, y in unlike)


class Matcher:
    """Finds which candidate of a stem a line is.  Candidates are indexed by their words, so that a line meets few of them."""

    def __init__(self, candidates: Iterable[str] = ()):
        self.lines: list[list[str]] = []
        self.exact: dict[str, int] = {}
        self.by_word: dict[tuple[int, int, str], list[int]] = {}
        self.lengths: set[int] = set()
        for form in candidates:
            self.add(form)

    def add(self, form: str) -> None:
        k, words = len(self.lines), form.split(" ")
        self.lines.append(words)
        self.exact.setdefault(form, k)
        self.lengths.add(len(words))
        for at, word in enumerate(words):
            self.by_word.setdefault((len(words), at, word), []).append(k)

    def __call__(self, form: str) -> int:
        found = self.exact.get(form)
        if found is not None:
            return found
        words = form.split(" ")
        if len(words) not in self.lengths:
            return -1
        met: dict[int, int] = {}
        for at, word in enumerate(words):
            for k in self.by_word.get((len(words), at, word), ()):
                met[k] = met.get(k, 0) + 1
        for k, n in sorted(met.items(), key=lambda x: (-x[1], x[0])):
            if n * 5 < len(words) * 3 - 5:
                break
            if same_wording(words, self.lines[k]):
                return k
        return -1


def merged(candidates: list[tuple[str, int]]) -> list[str]:
    """The most frequent spelling of each wording; the index of those kept so far grows along."""
    kept = Matcher()
    for form, _ in sorted(candidates, key=lambda x: (-x[1], x[0])):
        if kept(form) < 0:
            kept.add(form)
    return [" ".join(words) for words in kept.lines]


def line_forms(text: str) -> set[str]:
    return {wording(line) for line in text.split("\n")}


def candidates(pages: DataFrame, forms: Callable[[str], set[str]] = line_forms, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """(stem, wordings) that may be printed lines.  pages: (stem, text), any superset of the current pages.

    Half the wanted number and a quarter of the share is enough here, since misread lines and the pages' older texts don't
    count towards the clean wording yet.  A summary's error stays below that, so no wording that reaches it is missing.
    """
    parts = merged_summaries(summaries(pages, forms))
    stems = parts.where("wording is null").select("stem", F.col("n").alias("pages"), F.col("error").alias("missed"))
    likely = parts.where("wording is not null").select("stem", "wording", "n").join(stems, "stem").where(F.col("n") + F.col("missed") >= F.greatest(F.lit(min_pages / 2), F.col("pages") * min_share / 4))

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"stem": [rows.stem.iloc[0]], "wordings": [merged(list(zip(rows.wording, rows.n)))]})

    return likely.select("stem", "wording", "n").groupBy("stem").applyInPandas(merge, "stem string, wordings array<string>")


def line_hits(pages: DataFrame, found: DataFrame) -> DataFrame:
    """(stem, page_key, line_no, candidate) for each line that is a candidate; one row without line_no for each page with text."""
    spark = pages.sparkSession
    size = found.agg(F.sum(F.size("wordings"))).first()[0] or 0
    schema = "stem string, page_key string, line_no long, candidate int"

    def run_with(lookup):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known: dict[str, Matcher | None] = {}
            for batch in batches:
                columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
                out: tuple[list, ...] = ([], [], [], [])
                for row in zip(*columns):
                    key, stem, text = row[:3]
                    if not text or not text.strip() or stem is None:
                        continue
                    for x, v in zip(out, (stem, key, None, None)):
                        x.append(v)
                    if stem not in known:
                        own = lookup(stem, row)
                        known[stem] = Matcher(own) if own else None
                    if (matcher := known[stem]) is None:
                        continue
                    for no, line in enumerate(text.split("\n"), 1):
                        if len(line) > 8 and (form := wording(line)) and (k := matcher(form)) >= 0:
                            for x, v in zip(out, (stem, key, no, k)):
                                x.append(v)
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, (pa.string(), pa.string(), pa.int64(), pa.int32()))], ["stem", "page_key", "line_no", "candidate"])

        return run

    if size <= BROADCAST_CANDIDATES:
        sent = spark.sparkContext.broadcast({r.stem: r.wordings for r in found.collect()})
        return pages.mapInArrow(run_with(lambda stem, row: sent.value.get(stem)), schema)
    return pages.join(found, "stem", "left").select("page_key", "stem", "clean_ocr", "wordings").mapInArrow(run_with(lambda stem, row: row[3]), schema)


def printed_lines(audit_pages: DataFrame, every_row: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """(stem, page_key, line_no, candidate) of all printed lines.

    audit_pages: current (page_key, clean_ocr); every_row: (page_key, clean_ocr) of all rows, read for candidates only.
    Null, empty and blank texts aren't pages with text.  Lines that are equal on one page count as one page.
    """
    stem = stem_of().alias("stem")
    found = written(candidates(every_row.select(stem, "clean_ocr"), line_forms, min_pages, min_share), "site-candidates")
    hits = written(line_hits(audit_pages.select("page_key", stem, "clean_ocr"), found), "site-hits")
    stems = hits.where("line_no is null").groupBy("stem").agg(F.count("*").alias("pages"))
    once = hits.where("line_no is not null").select("stem", "candidate", "page_key").distinct()
    confirmed = once.groupBy("stem", "candidate").agg(F.count("*").alias("on_pages")).join(stems, "stem")
    confirmed = confirmed.where((F.col("on_pages") >= min_pages) & (F.col("on_pages") >= min_share * F.col("pages"))).select("stem", "candidate")
    return hits.where("line_no is not null").join(confirmed, ["stem", "candidate"])


def without_lines(pages: DataFrame, lines: DataFrame) -> DataFrame:
    """(page_key, text): the pages (page_key, clean_ocr) without the given (page_key, line_no); null stays null."""
    gone = lines.groupBy("page_key").agg(F.collect_set("line_no").alias("_gone"))
    kept = F.expr("array_join(transform(filter(transform(split(clean_ocr, '\\n', -1), (x, i) -> struct(i + 1 as no, x as line)), x -> not array_contains(_gone, cast(x.no as bigint))), x -> x.line), '\\n')")
    return pages.join(gone, "page_key", "left").select("page_key", F.when(F.col("_gone").isNull(), F.col("clean_ocr")).otherwise(kept).alias("text"))
