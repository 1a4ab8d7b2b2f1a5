"""Problem 3: the share of a page that repeats itself, and a quality estimate from weak supervision.

Rules (labelling functions) look at a page and vote `repetitive`, `fine`, or abstain.  Expectation-maximisation over
the table of vote patterns (at most 3**rules rows, whatever the corpus) estimates how reliable each rule is, and each
page gets the posterior probability of being repetitive.  No rule vetoes or admits alone: the posterior decides which
pages have their share measured exactly, and no rule knows that share.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

RUN = 6
WORDS = re.compile(r"[^\W\d_]+")
RULES = ("grams", "vocabulary", "sentences", "compression", "top_gram", "passage")
#: For each rule the value up to which it votes `fine` and the value from which it votes `repetitive`.
BOUNDS = {"grams": (0.05, 0.12), "vocabulary": (0.28, 0.62), "sentences": (0.1, 0.3), "compression": (0.45, 0.68), "top_gram": (0.03, 0.06), "passage": (0.03, 0.08)}
#: Words in a gram of the rules, fewer than in a run, so that a doubtful page votes too.
GRAM = 4
#: Pages are handed to the exact share check from this posterior on; far below one half, so that a doubtful page is checked.
CANDIDATE = 0.02
SENTENCES = re.compile(r"[.!?\n]+")

FEATURES = "page_key string, version long, n_words int, " + ", ".join(f"vote_{r} int" for r in RULES)


def repeated_words(words: list[str], run: int = RUN) -> tuple[int, int]:
    """(words lying in a run of `run` words that also began earlier, occurrences of the commonest run)."""
    n = len(words)
    if n <= run:
        return 0, min(n, 1)
    seen: dict[tuple, int] = {}
    covered = upto = most = 0
    for at, gram in enumerate(zip(*(words[k:] for k in range(run)))):
        times = seen.get(gram, 0) + 1
        seen[gram] = times
        if times > 1:
            covered += at + run - max(at, upto)
            upto = at + run
            most = max(most, times)
    return covered, max(most, 1)


def _vote(rule: str, value: float) -> int:
    low, high = BOUNDS[rule]
    return 1 if value >= high else -1 if value <= low else 0


def votes_of(text: str | None) -> tuple:
    """(n_words, one vote per rule); of a text without words all rules abstain."""
    words = WORDS.findall((text or "").lower())
    n = len(words)
    if n == 0:
        return 0, *(0 for _ in RULES)
    seen: Counter[tuple] = Counter()
    again = longest = run = 0
    for gram in zip(*(words[k:] for k in range(GRAM))):
        times = seen[gram] = seen[gram] + 1
        run = run + 1 if times > 1 else 0
        again += times > 1
        longest = max(longest, run)
    votes = [_vote("grams", again / n), _vote("vocabulary", 1 - len(set(words)) / n)]
    parts = [p for p in (x.strip() for x in SENTENCES.split(text.lower())) if len(p) > 20]
    votes.append(_vote("sentences", 1 - len(set(parts)) / len(parts)) if len(parts) > 1 else 0)
    if n >= 40:
        raw = text.encode("utf-8", "replace")
        votes.append(_vote("compression", 1 - len(zlib.compress(raw, 1)) / len(raw)))
    else:
        votes.append(0)
    votes.append(_vote("top_gram", (max(seen.values(), default=1) - 1) * GRAM / n))
    votes.append(_vote("passage", (longest + GRAM - 1) / n if longest else 0.0))
    return (n, *votes)


def share_of(text: str | None) -> float:
    """The exact repeated share; 0 of a text without words."""
    words = WORDS.findall((text or "").lower())
    if len(words) - len(set(words)) < RUN:  # fewer repeats than one run has words: no run can occur twice
        return 0.0
    return repeated_words(words)[0] / len(words)


def page_votes(pages: DataFrame) -> DataFrame:
    """One row of counts and votes for each (page_key, text) row; whole texts, in the order they come."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = list(zip(*map(votes_of, batch.column(2).to_pylist()))) or [()] * (1 + len(RULES))
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.string()), batch.column(1), *(pa.array(x, pa.int32()) for x in made)], ["page_key", "version", "n_words", *(f"vote_{r}" for r in RULES)])

    return _with_version(pages).mapInArrow(run, FEATURES)


def _with_version(pages: DataFrame) -> DataFrame:
    key, text = pages.columns[:2]
    return pages.select(key, F.xxhash64(text).alias("version"), text)


def fit_rules(patterns: list[tuple[tuple[int, ...], int]], rounds: int = 100, start: dict | None = None, belief: float = 0.0) -> dict:
    """EM for a two-class model with one accuracy and one abstention rate per rule and class.

    patterns: (votes, number of pages).  Returns the prior and the tables of vote probabilities.  The start says that a
    rule is right four times in five, which also fixes which class is the second.  `start` gives another: a prior, and for each
    class a row of vote probabilities for each rule; its probabilities keep the weight `belief` beside the corpus's.
    """
    if not patterns:
        patterns = [((0,) * (len(RULES) if start is None else start["table"].shape[1]), 1)]
    votes = np.array([p for p, _ in patterns]) + 1
    weight = np.array([n for _, n in patterns], float)
    rules = votes.shape[1]
    right = np.array([[0.6, 0.25, 0.15], [0.15, 0.25, 0.6]])  # class x vote
    table, prior = np.repeat(right[:, None, :], rules, axis=1), np.array([0.9, 0.1])
    if start is not None:
        table, prior = start["table"].copy(), start["prior"]
    before = table.copy()
    smooth = 0.5
    for _ in range(rounds):
        log = np.log(prior) + sum(np.log(table[:, r, votes[:, r]]).T for r in range(rules))
        post = np.exp(log - log.max(1, keepdims=True))
        post /= post.sum(1, keepdims=True)
        mass = post * weight[:, None]
        prior = (mass.sum(0) + 1) / (weight.sum() + 2)
        for r in range(rules):
            for v in range(3):
                table[:, r, v] = mass[votes[:, r] == v].sum(0) + smooth
            table[:, r] /= table[:, r].sum(1, keepdims=True)
            table[:, r] = (table[:, r] + belief * before[:, r]) / (1 + belief)
    return {"prior": prior, "table": table}


def posterior(model: dict, votes: tuple[int, ...]) -> float:
    log = np.log(model["prior"]) + sum(np.log(model["table"][:, r, v + 1]) for r, v in enumerate(votes))
    odds = np.exp(log - log.max())
    return float(odds[1] / odds.sum())


def judged(pages: DataFrame) -> DataFrame:
    """(page_key, version, n_words, votes, p_repetitive) for each (page_key, text) row; version is the text's hash.

    Only the vote patterns and their numbers go to the driver: at most 3**6 rows.
    """
    names = [f"vote_{r}" for r in RULES]
    votes = written(page_votes(pages), "page-votes")  # read twice: for the patterns and for the result
    spark = pages.sparkSession
    found = [(tuple(row[n] for n in names), row["pages"]) for row in votes.where("n_words > 0").groupBy(*names).agg(F.count("*").alias("pages")).collect()]
    model = fit_rules(found)
    known = spark.createDataFrame([(*p, posterior(model, p)) for p, _ in found], ", ".join(f"{n} int" for n in names) + ", p_repetitive double")
    rated = votes.join(F.broadcast(known), names, "left")
    return rated.select("page_key", "version", "n_words", *names, F.when(F.col("n_words") > 0, F.coalesce("p_repetitive", F.lit(0.0))).otherwise(0.0).alias("p_repetitive"))


def measured(pages: DataFrame) -> DataFrame:
    """(page_key, version, repeated_share) of (page_key, version, text) rows, exactly."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.string()), batch.column(1), pa.array(list(map(share_of, batch.column(2).to_pylist())), pa.float64())], ["page_key", "version", "repeated_share"])

    return pages.mapInArrow(run, "page_key string, version long, repeated_share double")


def repetition(pages: DataFrame) -> DataFrame:
    """(page_key, n_words, repeated_share, votes, p_repetitive) for each (page_key, text) row.

    Null, empty and wordless texts get share 0.  The share is that of every page, also of those that no rule suspects.
    """
    shares = measured(_with_version(pages))
    rated = judged(pages)
    whole = rated.join(shares.distinct(), ["page_key", "version"])
    return whole.select("page_key", "n_words", "repeated_share", *[f"vote_{r}" for r in RULES], "p_repetitive")


def repetitive_pages(pages: DataFrame, share: float = 0.3) -> DataFrame:
    """Pages that the posterior hands on (from CANDIDATE) and whose exact share, measured for these only, is at least `share`."""
    likely = written(judged(pages).where(F.col("p_repetitive") >= CANDIDATE).select("page_key", "version"), "likely-pages")
    # by key first: that reaches the scan, so that only the texts of likely pages are shuffled again
    again = pages.join(likely.select("page_key").distinct(), "page_key", "left_semi")
    again = _with_version(again).join(likely, ["page_key", "version"], "left_semi")
    return measured(again).where(F.col("repeated_share") >= share).select("page_key")
