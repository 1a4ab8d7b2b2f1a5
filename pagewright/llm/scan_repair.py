"""Problem 5: repair of text from scanned pages.

Faults are found line by line with corpus statistics: words broken over lines (dehyphenated by what the corpus writes),
misread words (undone towards frequent words), page-number lines (numbers that run along with the pages of a stem),
and running headers and footers (fuzzy repetition of lines at page edges, of any length, counted exactly by page).
`repaired_pages` joins what is left into continuous paragraphs.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import EDGE, Asking, Lexicon, Own, Repairer, broken_words, stem_of, with_own, word_of, written
from .site_lines import Matcher, candidates, wording

#: An offset between printed number and page_key's number counts as a sequence of a stem from this many pages on.
SEQUENCE = 3
#: Wordings of edge lines are broadcast up to this many, else joined by stem.
BROADCAST_EDGES = 200_000
#: Lines with text at the top and at the bottom of a page that may be running headers or footers, and what makes them so:
#: words from which on a rule holds, and pages and share of the pages of the stem on which they must stand there.
EDGE_LINES = 6
HEADERS = ((1, 6, 0.2), (1, 3, 0.5), (5, 3, 0.2))

SIGNS = re.compile(r"[\W_]+")
#: Letters and digits of the longest page-number line.
NUMBER_LETTERS = 24
NUMBER = re.compile(r"^\W*(?:(?:page|pg|pp|p|sheet|folio)\b[.:]?)?\s*[-~–—\[(#]?\s*(\d{1,5})(?:\s*(?:of|/)\s*(\d{1,5}))?\s*[-~–—\])#]?\W*$", re.I)
REPEATED = re.compile(r"(\W)\1+")
PIECES = re.compile(r"[^\W_|$]+(?:['’|$-][^\W_]+)*")
MARKS = str.maketrans({"‐": "-", "‑": "-", "\xad": "-", "¬": "-"})


class Fixer:
    """Right words by the lexicon: repairs misreadings and decides whether a broken word keeps its hyphen."""

    def __init__(self, words: dict[str, int], names: frozenset[str], usual: frozenset[str], repair: Repairer | None = None):
        self.words, self.names, self.usual = words, names, usual
        self.repair = Repairer({w: n for w, n in words.items() if w not in names}) if repair is None else repair

    @classmethod
    def asking(cls, asking: Asking) -> Fixer:
        return cls(asking, frozenset(), asking.usual, asking)

    @classmethod
    def own(cls, entries: list[dict] | None, usual: frozenset[str]) -> Fixer:
        own = Own(entries or (), usual)
        return cls(own.words, frozenset(), own.usual, own.repair)

    def joined(self, left: str, right: str) -> tuple[str, bool]:
        """(right word, was misread as well) of a word whose parts stand on two lines."""
        left, right = left.strip(EDGE).lower().translate(MARKS), right.strip(EDGE).lower().translate(MARKS)
        plain, hyphened = left + right, f"{left}-{right}"
        n_plain, n_hyphened = self.words.get(plain, 0), self.words.get(hyphened, 0)
        fixed, fixed_hyphened = self.repair(plain), self.repair(hyphened)
        if n_hyphened > n_plain and not (fixed and self.words[fixed] > 8 * n_hyphened):
            return hyphened, False
        if fixed:
            return fixed, True
        if n_plain:
            return plain, False
        return (fixed_hyphened, True) if fixed_hyphened else (plain, False)

    def misread(self, surface: str) -> list[str]:
        """Right words of the misread words in one white-space token."""
        word = word_of(surface)
        if right := self.repair(word):
            return [right]
        if word.isalpha():
            return []
        pieces = [p.lower() for p in PIECES.findall(surface)]
        if pieces == [word]:
            return []
        return [right for p in pieces if len(p) > 2 and (right := self.repair(p))]


def line_numbers(text: str) -> list[tuple[int, int, bool]]:
    """(line_no, printed number, at the page's edge) of lines that hold a number and page words only."""
    found = []
    lines = text.split("\n")
    filled = [k for k, line in enumerate(lines) if line.strip()]
    if not filled:
        return found
    for k in filled:
        line = lines[k].strip()
        if line.isalpha() or len(SIGNS.sub("", line)) > NUMBER_LETTERS:
            continue
        line = REPEATED.sub(r"\1", line)
        if (m := NUMBER.match(line)) and not re.search(r"\d[.\])]*[.]\s*$|(?<![\[\d])\d+\]", line):
            found.append((k + 1, int(m[1]), k in (filled[0], filled[-1])))
    return found


def faults(text: str, fixer: Fixer) -> list[tuple[str, int, str]]:
    """(fault, line_no, right word) of broken and misread words, once for each line and word."""
    out: list[tuple[str, int, str]] = []
    seen = set()
    taken: set[tuple[int, str]] = set()
    if "\n" in text:
        at = no = 0
        for start, end, right, stop in broken_words(text):
            no += text.count("\n", at, start)
            at = start
            line = no + 1
            if not text[right].islower():
                continue
            first, second = text[start:end], text[right:stop]
            word, wrong = fixer.joined(first, second)
            if word and ("hyphen", line, word) not in seen:
                seen.add(("hyphen", line, word))
                out.append(("hyphen", line, word))
                if wrong:
                    out.append(("misread", line, word))
                    seen.add(("misread", line, word))
            taken.add((line, text[start:right].split()[0]))
            taken.add((line + text.count("\n", start, stop), second))
    usual = fixer.usual
    for line, content in enumerate(text.split("\n"), 1):
        for surface in content.split():
            if surface in usual or surface.isdigit() or len(surface) < 3:
                continue
            if (line, surface) in taken:
                continue
            for word in fixer.misread(surface):
                if ("misread", line, word) not in seen:
                    seen.add(("misread", line, word))
                    out.append(("misread", line, word))
    return out


def scan_faults(pages: DataFrame, lex: Lexicon) -> DataFrame:
    """(page_key, fault, line_no, word) of the current pages (page_key, clean_ocr).

    Null, empty and blank texts have no faults.  A page-number line counts if its number is the page's, or if it keeps
    one distance to the page's number on at least SEQUENCE pages of the stem (counted by stem and distance).
    """
    return faults_by_text(pages, lex).drop("version")


def _steady(numbers: DataFrame) -> DataFrame:
    """Those page-number lines that bear the page's number or keep one distance to it on SEQUENCE pages of the stem."""
    steady = numbers.where("edge and offset is not null").groupBy("stem", "offset").agg(F.countDistinct("page_key").alias("n")).where(F.col("n") >= SEQUENCE)
    return numbers.join(steady, ["stem", "offset"], "left").where((F.col("offset") == 0) | (F.col("edge") & F.col("n").isNotNull()))


def _numbers(key: str, text: str) -> list[tuple[int, int | None, bool]]:
    """(line_no, distance to the page's number, at the page's edge) of the number lines of a page."""
    own = key.rsplit("_page_", 1)[-1]
    return [(line, int(own) - number if own.isdecimal() else None, edge) for line, number, edge in line_numbers(text)]


def _texts(pages: DataFrame) -> DataFrame:
    return pages.select("page_key", "clean_ocr", F.xxhash64("clean_ocr").alias("version"))


def faults_by_text(pages: DataFrame, lex: Lexicon) -> DataFrame:
    """The same with `version`, which tells the texts of one page_key apart where it has several."""
    sent = pages.sparkSession.sparkContext.broadcast((lex.words, lex.names, lex.usual))
    large = lex.rest is not None
    names = ["page_key", "fault", "line_no", "word", "version", "offset", "edge"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = Fixer(*sent.value)
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [], [], [], [])
            for key, text, version, *own in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns))):
                if not text:
                    continue
                fixer = Fixer.own(own[0], whole.usual) if large else whole
                for fault, line, word in faults(text, fixer):
                    for x, v in zip(out, (key, fault, line, word, version, None, None)):
                        x.append(v)
                for line, offset, edge in _numbers(key, text):
                    for x, v in zip(out, (key, "page_number", line, "", version, offset, edge)):
                        x.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, (pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.bool_()))], names)

    def ask(row: tuple, asking: Asking) -> None:
        if row[1]:
            faults(row[1], Fixer.asking(asking))

    texts = with_own(_texts(pages), lex, ("page_key", "version"), ask)
    rows = written(texts.mapInArrow(run, "page_key string, fault string, line_no long, word string, version long, offset long, edge boolean").withColumn("stem", stem_of()), "scan-faults")
    numbers = _steady(rows.where("fault = 'page_number'"))
    return rows.where("fault != 'page_number'").select(*names[:5]).unionByName(numbers.select(*names[:5]))


def edge_lines(text: str) -> list[tuple[int, str]]:
    """(line_no, wording) of the lines with text at the top and the bottom of a page; numbers and signs alone have no wording."""
    lines = text.split("\n")
    filled = [k for k, line in enumerate(lines) if line.strip()]
    edges = sorted({*filled[:EDGE_LINES], *filled[-EDGE_LINES:]})
    return [(k + 1, form) for k in edges if (form := wording(lines[k], 1))]


def edge_forms(text: str) -> set[str]:
    return {form for _, form in edge_lines(text)}


def page_furniture(pages: DataFrame, every_row: DataFrame) -> DataFrame:
    """(page_key, version, line_no): page-number lines, and running headers and footers, of all pages (page_key, clean_ocr).

    Summaries of edge lines of every row name the candidates; then the pages on which each stands at an edge, misread or
    not, are counted exactly, and HEADERS says how many it takes.
    """
    spark = pages.sparkSession
    found = written(candidates(every_row.select(stem_of().alias("stem"), "clean_ocr"), edge_forms, min(n for _, n, _ in HEADERS), min(share for _, _, share in HEADERS)), "edge-lines")
    small = (found.agg(F.sum(F.size("wordings"))).first()[0] or 0) <= BROADCAST_EDGES
    sent = spark.sparkContext.broadcast({r.stem: r.wordings for r in found.collect()} if small else {})
    texts = _texts(pages).withColumn("stem", stem_of())
    if not small:
        texts = texts.join(found, "stem", "left").select("page_key", "clean_ocr", "version", "stem", "wordings")
    names = ["page_key", "version", "stem", "line_no", "offset", "edge", "candidate", "words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, Matcher] = {}
        for batch in batches:
            rows = []
            for key, text, version, stem, *own in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns))):
                if not text or not text.strip():
                    continue
                rows.append((key, version, stem, None, None, None, None, None))
                rows += [(key, version, stem, *number, None, None) for number in _numbers(key, text)]
                if stem not in known:
                    known[stem] = Matcher((sent.value.get(stem) if small else own[0]) or ())
                rows += [(key, version, stem, line, None, True, k, len(known[stem].lines[k])) for line, form in edge_lines(text) if (k := known[stem](form)) >= 0]
            columns = list(zip(*rows)) or [()] * 8
            kinds = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)

    rows = written(texts.mapInArrow(run, "page_key string, version long, stem string, line_no long, offset long, edge boolean, candidate int, words int"), "page-furniture")
    stems = rows.where("line_no is null").groupBy("stem").agg(F.countDistinct("page_key").alias("pages"))
    heads = rows.where("candidate is not null")
    often = heads.select("stem", "candidate", "words", "page_key").distinct().groupBy("stem", "candidate", "words").agg(F.count("*").alias("n")).join(stems, "stem")
    enough = reduce(Column.__or__, [(F.col("words") >= words) & (F.col("n") >= n) & (F.col("n") >= share * F.col("pages")) for words, n, share in HEADERS])
    heads = heads.join(often.where(enough).select("stem", "candidate"), ["stem", "candidate"], "left_semi")
    numbers = _steady(rows.where("line_no is not null and candidate is null"))
    return heads.select("page_key", "version", "line_no").unionByName(numbers.select("page_key", "version", "line_no"))


def repaired(text: str | None, number_lines: list[int] | None, matcher: Matcher | None, fixer: Fixer) -> str | None:
    """One page as paragraphs: without the given lines and those at its edges that match, words mended, lines joined."""
    if text is None:
        return None
    lines = text.split("\n")
    filled = [k for k, line in enumerate(lines) if line.strip()]
    edges = set(filled[:EDGE_LINES]) | set(filled[-EDGE_LINES:])
    gone = {n - 1 for n in number_lines or ()}
    kept = []
    for k, line in enumerate(lines):
        if k in gone or (matcher is not None and k in edges and (form := wording(line)) and matcher(form) >= 0):
            continue
        kept.append(line.rstrip())

    whole, mended, at = "\n".join(kept), [], 0
    for start, end, right, stop in broken_words(whole):
        if start < at or not whole[right].islower():
            continue
        left, rest = whole[start:end], whole[right:stop]
        word, _ = fixer.joined(left, rest)
        lead, tail = left[: len(left) - len(left.lstrip(EDGE))], rest[len(rest.rstrip(EDGE)) :]
        word = word[:1].upper() + word[1:] if left.strip(EDGE)[:1].isupper() else word
        mended += (whole[at:start], f"{lead}{word}{tail}\n")
        at = stop
    whole = "".join(mended) + whole[at:]
    done = []
    for line in whole.split("\n"):
        tokens = line.split(" ")
        for k, surface in enumerate(tokens):
            if surface and surface not in fixer.usual and (right := fixer.repair(word := word_of(surface))):
                start = surface.lower().find(word)
                right = right.upper() if surface.isupper() and len(word) > 1 else right[0].upper() + right[1:] if surface[start : start + 1].isupper() else right
                tokens[k] = surface[:start] + right + surface[start + len(word) :]
        done.append(" ".join(tokens))
    widest = max((len(x) for x in done), default=0)
    paragraphs: list[str] = []
    for line in done:
        if not line.strip():
            paragraphs.append("")
        elif paragraphs and paragraphs[-1] and (len(paragraphs[-1].rsplit("\n", 1)[-1]) + len(line.split()[0]) >= min(widest, 100) - 1 or not re.search(r"[.!?:|>]$", paragraphs[-1]) and line[0].islower()):
            paragraphs[-1] += " " + line.strip()
        else:
            paragraphs.append(line)
    return re.sub(r"\n{3,}", "\n\n", "\n".join(paragraphs)).strip()


def repaired_pages(pages: DataFrame, every_row: DataFrame, lex: Lexicon) -> DataFrame:
    """(page_key, text) of all pages (page_key, clean_ocr), where a page_key may have several texts; null stays null, blank becomes ''.

    every_row: the same pages or more, read for candidates of headers only.
    """
    gone = page_furniture(pages, every_row).groupBy("page_key", "version").agg(F.collect_set("line_no").alias("gone"))
    full = _texts(pages).join(gone, ["page_key", "version"], "left").select("page_key", "clean_ocr", "version", "gone")
    words = pages.sparkSession.sparkContext.broadcast((lex.words, lex.names, lex.usual))
    large = lex.rest is not None

    def ask(row: tuple, asking: Asking) -> None:
        repaired(row[1], row[3], None, Fixer.asking(asking))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = Fixer(*words.value)
        for batch in batches:
            texts = []
            for _, text, _, gone, *own in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns))):
                texts.append(repaired(text, gone, None, Fixer.own(own[0], whole.usual) if large else whole))
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.string()), pa.array(texts, pa.string())], ["page_key", "text"])

    return with_own(full, lex, ("page_key", "version"), ask).mapInArrow(run, "page_key string, text string")
