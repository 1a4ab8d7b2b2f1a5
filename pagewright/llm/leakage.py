"""Problem 9: passages of held-out test items inside training documents.

The normalised n-grams of the test items form a hash set that is broadcast; every window of every document is looked up
in it.  Hits are verified by aligning the item's words with the document's, allowing for changed and misspelt words.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written
from .lookalikes import SKELETON, folded
from .site_lines import _near

#: Words in a window, windows that must be found before a pair is verified, and the share of the item's words that is a leak.
WINDOW, LEAST_HITS, SHARE = 3, 3, 0.5
#: Part of the wanted words that unharmed windows must cover before a pair is aligned.
COVERED = 0.5
#: Part of a passage's words that must be the item's, in order; below it the passage is another text of the same pattern.
DENSITY = 0.8
#: Item windows are broadcast up to this number (about 60 bytes each); beyond it documents and items are joined on window hashes.
BROADCAST_WINDOWS = 500_000
#: Parts to which the documents of one window are dealt in that join.
SALTS = 8

WORDS = re.compile(r"[^\W_]+")


def words_of(text: str | None) -> list[str]:
    """The words in lower case after folding; look-alike letters count as the Latin ones."""
    return WORDS.findall(folded(text).translate(SKELETON).lower()) if text else []


def alike(a: str, b: str) -> bool:
    """Equal, or one edit apart from five letters on, or two from nine letters on."""
    return a == b or (min(len(a), len(b)) >= 5 and _near(a, b, 2 if min(len(a), len(b)) >= 9 else 1))


def _increasing(matches: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest chain of (document place, item place) that rises in both."""
    matches.sort(key=lambda m: (m[0], -m[1]))
    tails: list[int] = []
    last: list[int] = []
    back = [-1] * len(matches)
    for at, (_, p) in enumerate(matches):
        k = bisect_left(tails, p)
        if k == len(tails):
            tails.append(p)
            last.append(at)
        else:
            tails[k], last[k] = p, at
        back[at] = last[k - 1] if k else -1
    chain, at = [], last[-1] if last else -1
    while at >= 0:
        chain.append(matches[at])
        at = back[at]
    return chain[::-1]


def best_passage(item: list[str], words: list[str], windows: list[tuple[int, int]]) -> tuple[int, int, int, int]:
    """(item words in the best passage, of these standing, its first word, its last) along the found windows.

    Windows give sure matches; the longest chain in order is kept, the gaps between are compared word by word, and the
    stretch is kept in which what fits outweighs what doesn't (each word that is changed, missing or added counts 1
    against it).
    """
    chain = _increasing(list({(k + i, p + i) for k, p in windows for i in range(WINDOW)}))
    (k, p), n = chain[0], len(item)
    misses = 0
    while k > 0 and p > 0 and misses < 3:  # backwards from the first match
        k, p = k - 1, p - 1
        if alike(words[k], item[p]):
            chain.insert(0, (k, p))
            misses = 0
        else:
            misses += 1
    full = [chain[0]]
    for k2, p2 in chain[1:]:
        k1, p1 = full[-1]
        dk, dp = k2 - k1 - 1, p2 - p1 - 1
        if 0 < dk == dp:
            full += [(k1 + i, p1 + i) for i in range(1, dk + 1) if alike(words[k1 + i], item[p1 + i])]
        elif 0 < dk <= 8 and 0 < dp <= 8:
            i = j = 0
            while i < dk and j < dp:
                if alike(words[k1 + 1 + i], item[p1 + 1 + j]):
                    full.append((k1 + 1 + i, p1 + 1 + j))
                    i, j = i + 1, j + 1
                elif i + 1 < dk and alike(words[k1 + 2 + i], item[p1 + 1 + j]):
                    i += 1
                elif j + 1 < dp and alike(words[k1 + 1 + i], item[p1 + 2 + j]):
                    j += 1
                else:
                    i, j = i + 1, j + 1
        full.append((k2, p2))
    k, p = full[-1]
    misses = 0
    while k + 1 < len(words) and p + 1 < n and misses < 3:
        k, p = k + 1, p + 1
        if alike(words[k], item[p]):
            full.append((k, p))
            misses = 0
        else:
            misses += 1
    best, score, start = (0, 0, 0), 0, 0  # score, first, last of the chain
    for at, (k, p) in enumerate(full):
        cost = max(k - full[at - 1][0], p - full[at - 1][1]) - 1 if at else 0
        if score - cost <= 0:
            score, start = 1, at
        else:
            score += 1 - cost
        if score > best[0]:
            best = (score, start, at)
    (k1, p1), (k2, p2) = full[best[1]], full[best[2]]
    return p2 - p1 + 1, best[2] - best[1] + 1, k1, k2


def least_hits(n_words: int) -> int:
    """Windows of an item of so many words that must be found before it is aligned with a document."""
    return min(LEAST_HITS, max(1, n_words - WINDOW))


def windows_of(words: list[str], size: int = WINDOW) -> Iterator[tuple[str, ...]]:
    return zip(*(words[i:] for i in range(size)))


class Index:
    """The windows of the items: window -> (item, position).  An item of fewer words than a window is a window itself."""

    def __init__(self, items: list[tuple[int, list[str]]]):
        self.words = dict(items)
        self.at: dict[tuple, list[tuple[int, int]]] = defaultdict(list)
        for item, words in items:
            for k, gram in enumerate(windows_of(words, min(WINDOW, len(words)))):
                self.at[gram].append((item, k))
        self.at = dict(self.at)
        self.sizes = sorted({len(gram) for gram in self.at}) or [WINDOW]

    def leaks(self, words: list[str]) -> list[tuple[int, int, int, int]]:
        """(item, standing words, first, last) of every passage that holds at least half of an item's words."""
        hits: dict[int, list[tuple[int, int]]] = {}
        at = self.at
        for size in self.sizes:
            for k, gram in enumerate(windows_of(words, size)):
                if gram in at:
                    for item, place in at[gram]:
                        hits.setdefault(item, []).append((k, place))
        return [(item, *passage) for item, places in hits.items() for passage in passages(self.words[item], words, places)]


def passages(own: list[str], words: list[str], places: list[tuple[int, int]]) -> Iterator[tuple[int, int, int]]:
    """(standing words, first, last) of the passages of one item along its hits; none of them overlap.

    Items shorter than a window count where all their words stand in a row.
    """
    if len(own) < WINDOW:
        end = 0
        for k, _ in places:
            if k >= end:
                end = k + len(own)
                yield len(own), k, end - 1
        return
    least = least_hits(len(own))
    if len(places) < least:
        return
    # A passage is at most len(own) / DENSITY words long, so it lies whole in one of the windows of three times the item's
    # words that begin an item's length apart; long documents that say the same over and over cost no more for it.
    for group in _groups(places, 2 * len(own)):
        at = [k for k, _ in group]
        start = at[0]
        while (i := bisect_left(at, start)) < len(at):
            start = at[i]
            spans = _in_window(own, words, group[i : bisect_left(at, start + 3 * len(own))], least)
            yield from spans
            start = max(start + len(own), max((last + 1 for _, _, last in spans), default=0))


def _in_window(own: list[str], words: list[str], group: list[tuple[int, int]], least: int) -> list[tuple[int, int, int]]:
    """The best passage of a few hits, and those before it."""
    # Unharmed windows alone must cover a good part of what is asked for, so that items which share phrases with the
    # passage don't all have to be aligned.
    covered = {p + i for _, p in group for i in range(WINDOW)}
    if len(group) < least or len(covered) < COVERED * SHARE * len(own):
        return []
    span, standing, first, last = best_passage(own, words, group)
    if span < SHARE * len(own) or standing < DENSITY * max(span, last - first + 1):
        return []
    return [*_in_window(own, words, [p for p in group if p[0] + WINDOW <= first], least), (standing, first, last)]


def _groups(places: list[tuple[int, int]], gap: int) -> list[list[tuple[int, int]]]:
    groups = [[places[0]]]
    for p in places[1:]:
        if p[0] - groups[-1][-1][0] > gap:
            groups.append([])
        groups[-1].append(p)
    return groups


SCHEMA = "doc_id long, item_id long, standing int, item_words int, first_word int, last_word int"


def leaks(documents: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, standing, item_words, first_word, last_word), one row for each passage of an item in a document.

    documents: (doc_id, text); items: (item_id, item_text).  Null and empty texts leak nothing; items of fewer words
    than a window are looked up whole.  All documents and all windows are scanned.
    """
    spark = documents.sparkSession
    documents, items = documents.select("doc_id", "text"), items.select("item_id", "item_text").where("item_text is not null").distinct()
    size = items.agg(F.sum(F.size(F.split("item_text", r"\s+")))).first()[0] or 0

    def rows(batch_ids, found) -> pa.RecordBatch:
        out: tuple[list, ...] = ([], [], [], [], [], [])
        for doc, own in zip(batch_ids, found):
            for row in own:
                for x, v in zip(out, (doc, *row)):
                    x.append(v)
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32())
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, kinds)], ["doc_id", "item_id", "standing", "item_words", "first_word", "last_word"])

    if size <= BROADCAST_WINDOWS:
        sent = spark.sparkContext.broadcast([(r.item_id, w) for r in items.collect() if (w := words_of(r.item_text))])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = Index(sent.value)
            for batch in batches:
                found = [[(i, s, len(index.words[i]), a, b) for i, s, a, b in index.leaks(words_of(t))] for t in batch.column(1).to_pylist()]
                yield rows(batch.column(0).to_pylist(), found)

        return documents.mapInArrow(run, SCHEMA)
    return _joined(documents, items, rows)


def _joined(documents: DataFrame, items: DataFrame, rows) -> DataFrame:
    """The same for item sets beyond the broadcast bound: candidates by a join on windows, then the same verification.

    A passage's unharmed windows must cover part of the item's words, so a pair shares a window even when windows that
    together cover less are left out.  Those that stand in the most documents are, which keeps common phrases out of the
    join and loses no pair.  Documents of one window are dealt to SALTS parts.
    """

    def item_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = words_of(text)
                counts = Counter(windows_of(words, min(WINDOW, len(words))))
                wanted = COVERED * SHARE * len(words) if len(words) >= WINDOW else 0.0
                found += [(item, " ".join(g), n, wanted) for g, n in counts.items() if g]
            columns = list(zip(*found)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.string(), pa.int32(), pa.float64()))], ["item_id", "gram", "times", "wanted"])

    def document_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(doc, " ".join(g)) for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for w in [words_of(text)] for size in range(1, WINDOW + 1) for g in set(windows_of(w, size))]
            yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.string())], ["doc_id", "gram"])

    grams = written(items.mapInArrow(item_windows, "item_id long, gram string, times int, wanted double"), "item-windows")
    standing = written(documents.mapInArrow(document_windows, "doc_id long, gram string").join(grams.select("gram").distinct(), "gram", "left_semi"), "standing-windows")
    often = standing.groupBy("gram").agg(F.count("*").alias("n"))
    words = F.sum(F.col("times") * WINDOW).over(Window.partitionBy("item_id").orderBy(F.desc("n"), "gram").rowsBetween(Window.unboundedPreceding, 0))
    kept = grams.join(often, "gram").withColumn("words", words).where("words >= wanted")
    kept = kept.select("item_id", "gram", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    met = standing.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")).join(kept, ["gram", "salt"]).select("doc_id", "item_id").distinct()
    pairs = written(met, "leak-candidates").join(documents, "doc_id").join(items, "item_id").select("doc_id", "text", "item_id", "item_text")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(k).to_pylist() for k in range(4)]
            found = []
            for _, text, item, item_text in zip(*columns):
                index = Index([(item, words_of(item_text))])
                found.append([(k, s, len(index.words[k]), a, b) for k, s, a, b in index.leaks(words_of(text))])
            yield rows(columns[0], found)

    return pairs.mapInArrow(verify, SCHEMA)


def without_leaks(documents: DataFrame, found: DataFrame) -> DataFrame:
    """(doc_id, text): all documents, every leaked passage replaced by one space; texts are otherwise as they were (folded where a passage went)."""
    spans = found.groupBy("doc_id").agg(F.collect_set(F.struct("first_word", "last_word")).alias("spans"))
    full = documents.select("doc_id", "text").join(spans, "doc_id", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, own in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                if text and own:
                    text = folded(text)
                    at = [(m.start(), m.end()) for m in WORDS.finditer(text.translate(SKELETON))]
                    kept, upto = [], 0
                    for first, last in _united([(s["first_word"], s["last_word"]) for s in own]):
                        kept.append(text[upto : at[first][0]].rstrip())
                        upto = at[last][1]
                        while upto < len(text) and text[upto] in " .;:,":
                            upto += 1
                    text = " ".join([*kept, text[upto:]])
                texts.append(text)
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(texts, pa.string())], ["doc_id", "text"])

    return full.mapInArrow(run, "doc_id long, text string")


def _united(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The spans in order, those that overlap or touch as one."""
    out: list[tuple[int, int]] = []
    for first, last in sorted(spans):
        if out and first <= out[-1][1] + 1:
            out[-1] = out[-1][0], max(last, out[-1][1])
        else:
            out.append((first, last))
    return out
