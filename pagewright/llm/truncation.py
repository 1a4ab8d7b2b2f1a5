"""Problem 1: pages cut off by a field limit or during transfer.

Three kinds of evidence speak about each page.  The corpus vocabulary, as a trie flattened to a sorted list, tells whether
the last token is an unknown proper prefix of known words; lengths at which pages pile up tell of a field limit; and the
ending itself may be open, or as other pages end (printed lines, closing remarks, finished sentences).  Each votes `cut` or
`whole` or abstains, expectation-maximisation over the vote patterns (27 at most) learns what each vote is worth in this
corpus, and the posterior decides.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator, Mapping
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Asking, Lexicon, Own, Repairer, fragment, in_trie, stem_of, with_own, written
from .repetition import fit_rules, posterior

#: Pages that must end in the same last words for these to count as a usual end, and their least share: three words in
#: the corpus or in the stem, two or six words in the corpus; one word by the share of its occurrences that end a page, which
#: is less for words that the lists hold as parts of names: printed lines end in `Hospital`, and it stands in every letter.
USUAL_END = {"corpus": (12, 0.001), "stem": (3, 0.02), "two": (12, 0.003), "six": (3, 0.0003), "word": (3, 0.1), "name": (3, 0.01)}
#: A length is a limit if this many pages of the stem, or of the corpus, have it, and LIMIT_TIMES as many as its
#: neighbours there have on average.
LIMIT_STEM, LIMIT_CORPUS, LIMIT_TIMES = 3, 8, 4

#: What speaks about a page, and the posterior from which on it is cut.
EVIDENCE = ("trie", "length", "ending")
CUT = 0.5
#: What votes of -1, 0 and 1 are believed worth before the corpus speaks, in whole and in cut pages, and the weight that
#: this keeps: cut pages are few, and without it those that only one kind of evidence tells may pass for odd whole ones.
WHOLE = ((0.9, 0.09, 0.01), (0.98, 0.01, 0.01), (0.85, 0.145, 0.005))
CUT_PAGES = ((0.45, 0.1, 0.45), (0.6, 0.01, 0.39), (0.03, 0.02, 0.95))
BELIEF = 0.5

#: Words before a signature, titles, and forms of a page number.
SIGNED = r"(?:signed|dictated by|dictated|yours sincerely|yours faithfully|kind regards|typed by|seen by)[:,]?"
TITLES = frozenset("mr mrs ms dr prof st pt".split())

SIGNATURE = re.compile(rf"{SIGNED}\s+((?:[\w.'’,-]+\s*){{1,6}}?)(?:,\s*\w+|\n\s*[A-Z]\w+ \w+)?$", re.I)
NAME_LINE = re.compile(r"\n\s*([A-Z][\w.'’-]*(?:,? +[A-Z][\w.'’-]*){1,4})$")
NUMBER_LINE = re.compile(r"(?:^|\n)\W*(?:(?:page|pg|p)\b[.:]?\s*)?\d+\W*(?:(?:of|/)\s*\d+\W*)?$", re.I)
NUMBER_END = re.compile(r"(?:^|[.!?:;|>]\s+|\n\s*)(?:\b(?:page|pg|p\.)\s*\d+(?:\s*(?:of|/)\s*\d+)?|\[\d+\]|[-~–]\s*\d+\s*[-~–])$", re.I)
LIST_ENTRY = re.compile(r"(?:^|\s)(?:\d{1,2}[.)]|[-*•])\s+[^\W\d_]+\s+([^\W\d_]+)$")
RESULT = re.compile(r"(?:^|[\n.;]\s*|/[a-zA-Z]+\s+)[A-Z][a-z]+(?: [a-z]+)? \d+(?:\.\d+)? ([A-Za-zµ%]+(?:/[A-Za-z]+)?)$")
TABLE_ROW = re.compile(r"(?:^|\n)\s*\|.*$")
CLOSERS = re.compile(r"(?:\s*(?:</[a-zA-Z][\w]*>|\\end\{\w+\}|```|~~~|\|\}|\]\]|\}\}|\*\*|__|[\"”’')\]`*]))+$")
BROKEN = re.compile(r"(?:…|\.\.\.|�+|[\[(<{]|&#?\w*|<[a-zA-Z/][^<>]*|\([^()\n]{0,30}|\[[^\[\]\n]{0,30}|[^\W\d_][-‐¬\xad])$")
TOKENS = re.compile(r"[^\W_]+(?:['’/.-][^\W_]+)*")
DECIMAL = re.compile(r"\d\.$")

SCHEMA = "page_key string, n_chars int, n_bytes int, last_token string, ends string, start string, form string, number boolean, prefix boolean, known boolean, inside long, named long"


class Trie:
    """The proper prefixes of the vocabulary, by binary search in its sorted words; words without numbers count once."""

    def __init__(self, words: Iterable[str] | Mapping[str, int]):
        self.sorted = list(words)
        self.before = [0, *accumulate(words.values() if isinstance(words, Mapping) else (1 for _ in self.sorted))]

    def known(self, word: str) -> bool:
        at = bisect_left(self.sorted, word)
        return at < len(self.sorted) and self.sorted[at] == word and in_trie(word)

    def proper_prefix(self, word: str) -> bool:
        """Whether the word begins known ones, beside whose occurrences its own are next to nothing."""
        at = bisect_left(self.sorted, word)
        if not word or at == len(self.sorted) or not self.sorted[at].startswith(word):
            return False
        longer = at + (self.sorted[at] == word)
        end = bisect_left(self.sorted, True, longer, key=lambda w: not w.startswith(word))
        return fragment(word, self.before[longer] - self.before[at], self.before[end] - self.before[longer])


def last_lines(text: str) -> str:
    """The last two lines with text, whole, without the space behind them."""
    s = text.rstrip()
    end = s.rfind("\n")
    return s if end < 0 else s[s.rfind("\n", 0, len(s[:end].rstrip())) + 1 :]


def last_tokens(text: str, n: int) -> list[str]:
    """The last n tokens of a text, looked for from its end."""
    size = 100
    while True:
        found = TOKENS.findall(text[-size:])
        if len(found) > n or size >= len(text):  # the first of a part may be cut
            return found[-n:]
        size *= 4


def tail_features(text: str, trie: Trie, repair, page_number: str) -> tuple:
    """(last token, last three words, the three before them, form of the end, ends in a bare number, last token is an unknown proper prefix).

    form: `broken`, `sentence`, `signature`, `list`, `result`, `table`, `number` or `open`.
    """
    s, flat = text.rstrip(), last_lines(text)
    bare = CLOSERS.sub("", flat) if s[-1] in ">}`|])*_\"'”’" else flat
    six = last_tokens(s, 6)
    words = six[-3:]
    last = words[-1] if words else ""
    word = last.lower()
    ends = []
    for w in words:
        w = w.lower()
        ends.append("0" if w[0].isdigit() else w if trie.known(w) else repair(w) or w)
    start = " ".join("0" if w[0].isdigit() else w.lower() for w in six[:-3])
    closed = bare[-1:] in (".", "!", "?", "。")
    prefix = not last.isdigit() and trie.proper_prefix(word) and not closed
    if NUMBER_LINE.search(flat) and (flat.rstrip().split("\n")[-1].strip(" -~[]().pPageg:of/0123456789") == ""):
        line = s.rsplit("\n", 1)[-1]
        if "\n" in s and (not DECIMAL.search(line)):
            return last, " ".join(ends), start, "number", False, prefix
    if NUMBER_END.search(flat):
        return last, " ".join(ends), start, "number", False, prefix
    if bare[-1:].isdigit() and last == page_number and re.search(r"[.!?\n]\s*\d+$", flat):
        return last, " ".join(ends), start, "number", False, prefix
    if BROKEN.search(bare) and not (flat is not bare and s[-1] in ")]>"):
        return last, " ".join(ends), start, "broken", False, prefix
    signed = SIGNATURE.search(flat)
    if closed:
        if signed and re.search(r"\b[A-Za-z]\.$", bare):
            form = "signature"
        elif word in TITLES or re.search(r"(?:^|[^\d.°]\s)[A-Z]\.$", bare) and not NAME_LINE.search(flat):
            form = "open"
        else:
            form = "sentence"
    elif TABLE_ROW.search(flat) and s[-1] in "|}" or s.endswith("|}"):
        form = "table"
    elif signed or NAME_LINE.search(flat):
        form = "signature"
    elif entry := LIST_ENTRY.search(bare):
        form = "list" if trie.known(entry[1].lower()) or repair(entry[1].lower()) else "open"
    elif (found := RESULT.search(bare)) and trie.known(found[1].lower()):
        form = "result"
    elif flat is not bare and s[-1] in ">}":
        form = "table"
    else:
        form = "open"
    return last, " ".join(ends), start, form, bool(DECIMAL.search(bare)), prefix


def ends_of_pages(pages: DataFrame, lex: Lexicon) -> DataFrame:
    """One small row for each page with text: its lengths and how it ends.  Lengths count whole texts."""
    large = lex.rest is not None
    sent = pages.sparkSession.sparkContext.broadcast((lex.usual,) if large else (lex.prefixes(), lex.repair.words, lex.words))
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    kinds = (pa.string(), pa.int32(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.string(), pa.bool_(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not large:
            prefixes, ordinary, words = sent.value
            trie, repair = Trie(prefixes), Repairer(ordinary)
        for batch in batches:
            out: tuple[list, ...] = tuple([] for _ in kinds)
            for key, text, *own in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns))):
                if not text or not text.strip():
                    continue
                if large:
                    trie = Own(own[0] or (), *sent.value)
                    repair, ordinary, words = trie.repair, trie.ordinary, trie.words
                last, ends, start, form, decimal, prefix = tail_features(text, trie, repair, page_number(key))
                final = last.lower()
                if form == "sentence":
                    ends += "."
                n_bytes = len(text) if text.isascii() else len(text.encode("utf-8", "replace"))
                one = ends.rsplit(" ", 1)[-1].rstrip(".")
                inside = ordinary.get(one, 0)
                named = 0 if inside else words.get(one, 0)
                for x, v in zip(out, (key, len(text), n_bytes, last, ends, start, form, decimal, prefix, last.isdigit() or trie.known(final), inside, named)):
                    x.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, kinds)], names)

    def ask(row: tuple, asking: Asking) -> None:
        if row[1] and row[1].strip():
            last, ends, *_ = tail_features(row[1], asking, asking, page_number(row[0]))
            asking.words |= {last.lower(), *ends.split()}  # also as the last word that is counted, misread or not

    return with_own(pages.select("page_key", "clean_ocr"), lex, ("page_key",), ask).mapInArrow(run, SCHEMA)


def page_number(key: str) -> str:
    return key.rsplit("_page_", 1)[-1].lstrip("0")


def _marked(rows: DataFrame, groups: DataFrame, keys: list[str], name: str) -> DataFrame:
    """The rows with a flag that tells whether their group is one of the few given."""
    return rows.join(groups.select(*keys, F.lit(True).alias(name)), keys, "left").withColumn(name, F.coalesce(name, F.lit(False)))


def truncation(pages: DataFrame, lex: Lexicon) -> DataFrame:
    """(page_key, stem, n_chars, last_token, form, usual_end, at_limit, prefix, p_cut, cut) for each page with text.

    Null, empty and blank texts have no row.  Statistics of ends and lengths run over all pages with partial aggregation,
    and only the groups that pass a threshold, which are few, are joined back, so that no group is gathered in one task.
    """
    rows = written(ends_of_pages(pages, lex).withColumn("stem", stem_of()), "page-ends")
    rows = rows.withColumn("two", F.substring_index("ends", " ", -2)).withColumn("one", F.substring_index("ends", " ", -1))
    whole = rows.groupBy("stem").agg(F.count("*").alias("in_stem"))
    n_pages = whole.agg(F.sum("in_stem")).first()[0] or 0
    by_stem = rows.where("form in ('open', 'sentence')").groupBy("stem", "ends").agg(F.count("*").alias("n"))
    by_all = by_stem.groupBy("ends").agg(F.sum("n").alias("n"))
    by_two = by_all.groupBy(F.substring_index("ends", " ", -2).alias("two")).agg(F.sum("n").alias("n"))
    by_six = rows.groupBy("start", "ends").agg(F.count("*").alias("n"))
    by_one = rows.where("form = 'open'").groupBy("one").agg(F.count("*").alias("n"), F.max("inside").alias("inside"), F.max("named").alias("named"))

    def often(groups: DataFrame, rule: str) -> DataFrame:
        """Groups of the least number and share of all pages; a share bounds how many there are."""
        least, share = USUAL_END[rule]
        return F.broadcast(groups.where(F.col("n") >= max(least, share * n_pages)))

    least, share = USUAL_END["stem"]
    own = by_stem.where(F.col("n") >= least).join(whole, "stem").where(F.col("n") >= share * F.col("in_stem"))
    least, share = USUAL_END["word"]
    single = (F.col("n") >= share * (F.col("n") + F.col("inside"))) & (F.col("n") >= USUAL_END["name"][1] * (F.col("n") + F.col("named")))
    single = by_one.where((F.col("n") >= least) & single & (F.length("one") >= 3))
    full = _marked(rows, often(by_all, "corpus"), ["ends"], "u_corpus")
    full = _marked(full, often(by_two, "two"), ["two"], "u_two")
    full = _marked(full, often(by_six, "six"), ["start", "ends"], "u_six")
    full = _marked(full, own, ["stem", "ends"], "u_stem")
    full = _marked(full, single, ["one"], "u_word")
    usual = F.col("u_corpus") | F.col("u_two") | F.col("u_six") | F.col("u_stem") | (F.col("u_word") & ~F.col("prefix"))

    # a window holds the different lengths of one stem, not its pages
    around = lambda length: F.sum("n").over(Window.partitionBy("stem").orderBy(length).rangeBetween(-8, 8)) / 17
    limits = [rows.groupBy("stem", length).agg(F.count("*").alias("n")).withColumn("around", around(length)) for length in ("n_chars", "n_bytes")]
    per_length = rows.groupBy("n_chars").agg(F.count("*").alias("n"))
    near = per_length.select(F.explode(F.expr("transform(sequence(-8, 8), d -> n_chars + d)")).alias("n_chars"), "n")
    spread = near.groupBy("n_chars").agg((F.sum("n") / 17).alias("around"))
    full = _marked(full, limits[0].where((F.col("n") >= LIMIT_STEM) & (F.col("n") >= LIMIT_TIMES * F.col("around"))), ["stem", "n_chars"], "l_chars")
    full = _marked(full, limits[1].where((F.col("n") >= LIMIT_STEM) & (F.col("n") >= LIMIT_TIMES * F.col("around"))), ["stem", "n_bytes"], "l_bytes")
    full = _marked(full, per_length.where(F.col("n") >= LIMIT_CORPUS).join(spread, "n_chars").where(F.col("n") >= LIMIT_TIMES * F.col("around")), ["n_chars"], "l_all")
    full = full.withColumn("usual_end", usual).withColumn("at_limit", F.col("l_chars") | F.col("l_bytes") | F.col("l_all"))
    return decided(full).select("page_key", "stem", "n_chars", "last_token", "ends", "form", "usual_end", "at_limit", "prefix", "p_cut", (F.col("p_cut") >= CUT).alias("cut"))


def decided(rows: DataFrame) -> DataFrame:
    """The rows with `p_cut`, the posterior of being cut given what trie, length and ending say."""
    may_go_on = (F.col("form") == "sentence") & F.col("number") & F.col("at_limit") & ~F.col("usual_end")  # 3.| of 3.5
    votes = {
        "trie": F.when(F.col("prefix"), 1).when(F.col("known"), -1).otherwise(0),
        "length": F.when(F.col("at_limit"), 1).otherwise(-1),
        "ending": F.when((F.col("form") == "broken") | may_go_on | ((F.col("form") == "open") & ~F.col("usual_end")), 1).when(F.col("form").isin("list", "result", "signature"), 0).otherwise(-1),
    }
    rows = written(rows.withColumns({f"vote_{k}": v for k, v in votes.items()}), "page-evidence")
    names = [f"vote_{k}" for k in EVIDENCE]
    patterns = [(tuple(r[n] for n in names), r["n"]) for r in rows.groupBy(*names).agg(F.count("*").alias("n")).collect()]
    model = fit_rules(patterns, start={"prior": np.array([0.95, 0.05]), "table": np.array([WHOLE, CUT_PAGES])}, belief=BELIEF)
    told = [(*votes, posterior(model, votes)) for votes, _ in patterns]
    known = rows.sparkSession.createDataFrame(told, ", ".join(f"{n} int" for n in names) + ", p_cut double")
    return rows.join(F.broadcast(known), names)


def truncated_share(found: DataFrame) -> DataFrame:
    """(stem, pages, cut_pages, cut_share) for each stem that has a page with text."""
    cut = F.sum(F.col("cut").cast("int")).alias("cut_pages")
    return found.groupBy("stem").agg(F.count("*").alias("pages"), cut).withColumn("cut_share", F.col("cut_pages") / F.col("pages"))
