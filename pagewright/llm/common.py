"""Shared building blocks: current rows, corpus counts, and what the corpus knows about words, at any size."""

from __future__ import annotations

import atexit
import functools
import re
import shutil
import tempfile
import uuid
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Distinct tokens a counting task holds before it hands its counts on; bounds the task's memory, drops nothing.
FLUSH_TOKENS = 400_000
#: A vocabulary of up to so many surfaces is broadcast whole.  Beyond that only usual surfaces with at least 1/MAX_FREQUENT
#: of all occurrences are (never more than MAX_FREQUENT, whatever the corpus), and the words that a page asks for beyond
#: them are joined to it, so every word counts at any size.
MAX_FREQUENT = 200_000
#: Listed name words are collected up to this many, else only those are looked up that a vocabulary or a page needs.
BROADCAST_NAMES = 200_000
#: Words that occur less often than this are never taken for known, however small the corpus.
MIN_COUNT = 5

#: A listed word of which less than this share is written small is a name.
NAME_LOWER = 0.05
#: A word is misread only if the right one is so many times as frequent.
RATIO = 8
#: A word that occurs less than so often for each occurrence of the longer words that it begins is their fragment, no word:
#: fragments in pages that break off grow with the corpus and pass any fixed number.
FRAGMENT = 0.01

EDGE = " \t\r\n.,;:!?()[]{}<>\"'`*_~|=#/\\-…‐¬\xad"
CURRENT = "written_at"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stem_of(key: str = "page_key"):
    """The part of a page key before its last `_page_`; a key without one is its own stem."""
    stem = F.regexp_extract(key, r"(?s)^(.*)_page_", 1)
    return F.when(F.col(key).contains("_page_"), stem).otherwise(F.col(key))


def current_rows(audit: DataFrame, *fields: str) -> DataFrame:
    """(page_key, *fields) of the row with the greatest written_at of each page_key.

    Rows without a page_key are dropped, repeated rows count once, and of different rows with the same greatest
    written_at the one whose fields sort last is taken.  Only the named fields are read and shuffled.
    """
    newest = F.max(F.struct(CURRENT, *fields)).alias("_newest")
    kept = audit.where(F.col("page_key").isNotNull()).groupBy("page_key").agg(newest)
    return kept.select("page_key", *[F.col(f"_newest.{f}").alias(f) for f in fields])


def column_lists(batch: pa.RecordBatch) -> list[list]:
    return [batch.column(i).to_pylist() for i in range(batch.num_columns)]


def counted(texts: DataFrame, tokens: Callable[[str], Iterable[str]], normal: Callable[[str], str] | None = None) -> DataFrame:
    """(token, n) over every text of the one-column frame; counts are combined in each task before the shuffle.

    Null texts count nothing.  `normal` runs on distinct tokens only and may return '' to drop one.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            if normal is None:
                done = held
            else:
                done = Counter()
                for token, n in held.items():
                    if word := normal(token):
                        done[word] += n
            made = pa.RecordBatch.from_arrays([pa.array(list(done), pa.string()), pa.array(list(done.values()), pa.int64())], ["token", "n"])
            held.clear()
            return made

        for batch in batches:
            for text in batch.column(0).to_pylist():
                if text:
                    held.update(tokens(text))
            if len(held) > FLUSH_TOKENS:
                yield out()
        yield out()

    return texts.mapInArrow(count, "token string, n long").groupBy("token").agg(F.sum("n").alias("n"))


def word_of(surface: str) -> str:
    """A white-space token in lower case without the punctuation around it."""
    return surface.strip(EDGE).lower()


def frequent(counts: DataFrame, most: int = MAX_FREQUENT, least: int = MIN_COUNT) -> dict[str, int]:
    """The tokens with at least 1/most of all occurrences (so never more than `most` of them) and `least` of them."""
    counts = counts.persist()
    try:
        whole = counts.agg(F.sum("n")).first()[0] or 0
        floor = max(least, -(-whole // most))
        return {r.token: r.n for r in counts.where(F.col("n") >= floor).collect()}
    finally:
        counts.unpersist()


def looked_up(counts: DataFrame, tokens: Iterable[str]) -> dict[str, int]:
    """The numbers of the given tokens in the (token, n) table, which may be of any size."""
    asked = counts.sparkSession.createDataFrame(pa.table({"token": pa.array(sorted(set(tokens)), pa.string())}))
    return {r.token: r.n for r in counts.join(asked, "token").collect()}


_FOLDERS: set[str] = set()


def written(df: DataFrame, what: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder of the cluster, so that they are made once and survive executors.

    The folder is spark.checkpoint.dir.  Only where that is unset (tests, a local session) is a temporary one made.  The
    tables lie in a folder of the application, which is deleted when the driver's Python ends; `dropped` deletes one at once.
    """
    spark = df.sparkSession
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = _local_folder()
    own = f"{folder.rstrip('/')}/pagewright/{spark.sparkContext.applicationId}"
    if own not in _FOLDERS:
        _FOLDERS.add(own)
        atexit.register(_deleted, own)
    path = f"{own}/{what}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@functools.cache
def _local_folder() -> str:
    folder = tempfile.mkdtemp(prefix="pagewright-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def _deleted(path: str) -> None:
    """Deletes a folder through Hadoop's file systems; does nothing where the JVM is gone."""
    try:
        jvm = SparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(jvm.org.apache.hadoop.conf.Configuration()).delete(at, True)
    except Exception:  # the driver is ending; what is left then lies in a folder that bears the application's id
        pass


def dropped(df: DataFrame) -> None:
    """Deletes a table that `written` made, once nothing reads it any more."""
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if any(path.startswith(own) or own in path for own in _FOLDERS):
            _deleted(path)


def bounded_sample(rows: DataFrame, most: int, key: str = "page_key") -> DataFrame:
    """At most `most` different rows, those whose key's hash comes first; the same on every run.

    A hash threshold that leaves about twice as many rows is applied where the rows are read, so that the sort sees a
    bounded number of rows, whatever the table's size.
    """
    n = rows.count()
    first = F.xxhash64(key)
    if n > 2 * most:
        rows = rows.where(F.pmod(first, F.lit(1 << 30)) < int((1 << 30) * 2 * most / n))
    return rows.distinct().orderBy(F.pmod(first, F.lit(1 << 30)), *rows.columns).limit(most)


class Rest(NamedTuple):
    """A vocabulary too large to broadcast, as tables."""

    usual: DataFrame  # (token): surfaces to which nothing needs to be done
    words: DataFrame  # (word, n, ordinary, right): numbers, numbers as no name, the right word of a misread one or ''
    longest: int  # letters of the longest ordinary word


class Lexicon:
    """What the corpus says about words: surfaces (white-space tokens), words, and how misread words were printed.

    `names` are words that the entity lists know.  With `rest` it holds usual surfaces only, see `with_own`.
    """

    def __init__(self, surfaces: dict[str, int], names: frozenset[str] = frozenset(), rest: Rest | None = None):
        self.rest = rest
        self.words: dict[str, int] = {}
        if rest is not None:
            self.names, self.repair, self.usual = frozenset(), Repairer({}), frozenset(surfaces)
            return
        lower: dict[str, int] = {}
        for surface, n in surfaces.items():
            if word := word_of(surface):
                self.words[word] = self.words.get(word, 0) + n
                if surface.strip(EDGE)[:1].islower():
                    lower[word] = lower.get(word, 0) + n
        self.names = frozenset(w for w in names if lower.get(w, 0) < NAME_LOWER * self.words.get(w, 0) or w not in self.words)
        ordinary = {w: n for w, n in self.words.items() if w not in self.names}
        self.repair = Repairer(ordinary)
        self.usual = frozenset(s for s in surfaces if not self.repair(word_of(s)))

    def prefixes(self) -> dict[str, int]:
        """The trie of the words with their numbers, flattened: a word's extensions follow it in this sorted dict."""
        return {w: self.words[w] for w in sorted(self.words) if not self.repair(w)}


def fragment(word: str, own: int, longer: int) -> bool:
    """Whether a word of so many occurrences is a fragment of longer ones of so many; a letter that occurs is an initial."""
    return longer > 0 and own < (FRAGMENT * longer if len(word) > 1 else 1)


def in_trie(word: str) -> bool:
    return "'" not in word and "’" not in word


def entity_counts(spark: SparkSession, folder: str) -> DataFrame:
    """(token, n): words listed three times in the elements of redaction and extraction that hold no digit or @."""
    lists = table(spark, folder, "audit_trail").select(F.explode("redacted_entities").alias("e"))
    lists = lists.unionByName(table(spark, folder, "patient_data_extractor").select(F.explode("extracted_identifiers").alias("e")))
    plain = lists.where(~F.col("e").rlike(r"[0-9@]|\bat\b"))
    return written(counted(plain, str.split, word_of).where("n >= 3"), "entity-words")


def entity_words(spark: SparkSession, folder: str, among: Iterable[str] = ()) -> frozenset[str]:
    """The words of `entity_counts`; beyond BROADCAST_NAMES of them, those that are `among` the given words."""
    counts = entity_counts(spark, folder)
    if counts.count() <= BROADCAST_NAMES:
        return frozenset(r.token for r in counts.collect())
    return frozenset(looked_up(counts, among))


BREAK = re.compile(r"[-‐‑¬\xad][ \t]*\n")
SPACE = re.compile(r"\s")


def broken_words(text: str) -> list[tuple[int, int, int, int]]:
    """(start, end of the first part, start of the second part, end) of the words broken over two lines.

    The first part ends with a letter before a hyphen at a line's end, the second begins with a letter.  Breaks are
    looked for first, so long tokens cost nothing.
    """
    found = []
    for m in BREAK.finditer(text):
        end = m.start()
        if not end or not text[end - 1].isalpha():
            continue
        start = 1 + max(text.rfind(c, 0, end) for c in " \n\t\r\xa0")
        right = m.end()
        while right < len(text) and text[right] in " \t":
            right += 1
        if right < len(text) and text[right].isalpha():
            stop = SPACE.search(text, right)
            found.append((start, end, right, stop.start() if stop else len(text)))
    return found


def inner_tokens(text: str) -> list[str]:
    """The white-space tokens but the last, which may be cut off, and but the parts of words broken over lines."""
    if BREAK.search(text):
        kept, at = [], 0
        for start, _, _, end in broken_words(text):
            kept.append(text[at : max(at, start)])
            at = max(at, end)
        text = " ".join([*kept, text[at:]])
    return text.split()[:-1]


def surface_counts(spark: SparkSession, folder: str) -> DataFrame:
    """(token, n) of the surfaces that occur MIN_COUNT times in all rows of audit_trail.clean_ocr."""
    texts = table(spark, folder, "audit_trail").select("clean_ocr")
    return written(counted(texts, inner_tokens).where(F.col("n") >= MIN_COUNT), "surfaces")


def lexicon(spark: SparkSession, folder: str) -> Lexicon:
    """The lexicon of all rows of audit_trail.clean_ocr; runs no shuffle but that of the counts."""
    counts = surface_counts(spark, folder)
    if counts.count() <= MAX_FREQUENT:
        surfaces = {r.token: r.n for r in counts.collect()}
        return Lexicon(surfaces, entity_words(spark, folder, map(word_of, surfaces)))
    rest = rest_of(counts, entity_counts(spark, folder).select(F.col("token").alias("word")))
    return Lexicon(frequent(counts.join(rest.usual, "token", "left_semi")), rest=rest)


def word_counts(counts: DataFrame) -> DataFrame:
    """(word, n, lower) from surfaces (token, n): numbers of the words, and of their surfaces in lower case."""

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bare = [t.strip(EDGE) for t in batch.column(0).to_pylist()]
            n = batch.column(1).to_pylist()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x.lower() for x in bare], pa.string()), pa.array(n, pa.int64()), pa.array([k if x[:1].islower() else 0 for x, k in zip(bare, n)], pa.int64())], ["token", "word", "n", "lower"])

    return counts.select("token", "n").mapInArrow(words, "token string, word string, n long, lower long")


def rest_of(counts: DataFrame, names: DataFrame, always: bool = False) -> Rest:
    """The tables of a vocabulary (token, n).

    names: (word), distinct, none of them an ordinary word; unless `always`, only those that the corpus doesn't write small.
    """
    surfaces = written(word_counts(counts), "surface-words")
    words = surfaces.where("word != ''").groupBy("word").agg(F.sum("n").alias("n"), F.sum("lower").alias("lower"))
    named = names.withColumn("listed", F.lit(True))
    ordinary = F.when(F.col("listed").isNotNull() & (F.lit(always) | (F.col("lower") < NAME_LOWER * F.col("n"))), F.lit(0)).otherwise(F.col("n"))
    words = written(words.join(named, "word", "left").select("word", "n", ordinary.cast("long").alias("ordinary")), "word-counts")
    longest = words.where("ordinary > 0").agg(F.max(F.length("word"))).first()[0] or 0
    known = written(words.join(right_words(words.select("word", "ordinary"), words, longest), "word", "left").select(*words.columns, F.coalesce("right", F.lit("")).alias("right")), "known-words")
    usual = surfaces.join(known.where("right != ''").select("word"), "word", "left_anti").select("token")
    return Rest(written(usual, "usual-surfaces"), known, longest)


def right_words(asked: DataFrame, words: DataFrame, longest: int) -> DataFrame:
    """(word, right) of those words (word, ordinary) that are misread ones, by the rule of Repairer, as a join."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repairer = Repairer({})
        repairer.longest = longest
        for batch in batches:
            rows = []
            for word, own in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows += [(word, own, x, step) for step, near in enumerate(repairer.steps(word)) for x in near]
                if len(rows) > 50_000:
                    yield out(rows)
                    rows = []
            yield out(rows)

    def out(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [()] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.string(), pa.int32()))], ["word", "own", "near", "step"])

    met = asked.select("word", "ordinary").mapInArrow(spread, "word string, own long, near string, step int")
    met = met.join(words.where("ordinary > 0").select(F.col("word").alias("near"), F.col("ordinary").alias("n")), "near").where(F.col("n") >= RATIO * F.greatest(F.lit(1), "own"))
    return met.groupBy("word").agg(F.max(F.struct(-F.col("step"), "n", "near")).alias("best")).select("word", F.col("best.near").alias("right"))


class Asking:
    """Stands in for a lexicon where none is at hand: says no to everything and remembers what was asked."""

    def __init__(self, usual: frozenset[str]):
        self.frequent = usual
        self.clear()

    def clear(self) -> None:
        self.surfaces, self.words, self.begun = set(), set(), set()

    def __contains__(self, word: str) -> bool:
        self.words.add(word)
        return False

    def get(self, word: str, default: int = 0) -> int:
        self.words.add(word)
        return default

    def __call__(self, word: str) -> str:
        self.words.add(word)
        return ""

    known = __contains__

    def proper_prefix(self, word: str) -> bool:
        self.begun.add(word)
        self.words.add(word)
        return False

    @property
    def usual(self) -> _Asked:
        return _Asked(self)

    def rows(self, *keys) -> list[tuple]:
        """(*keys, kind, token) of what was asked since the last time."""
        asked = [(*keys, kind, x) for kind, found in (("s", self.surfaces), ("w", self.words), ("p", self.begun)) for x in found if x]
        self.clear()
        return asked


class _Asked:
    def __init__(self, asking: Asking):
        self.asking = asking

    def __contains__(self, surface: str) -> bool:
        if surface in self.asking.frequent:
            return True
        self.asking.surfaces.add(surface)
        return False


class Own:
    """The part of a large vocabulary that some pages asked for, with the frequent surfaces."""

    def __init__(self, entries: Iterable[dict], usual: frozenset[str]):
        self.words: dict[str, int] = {}
        self.ordinary: dict[str, int] = {}
        self.rights: dict[str, str] = {}
        self.begun: dict[str, int] = {}
        own = set()
        for e in entries:
            if e["kind"] == "s":
                own.add(e["token"])
            elif e["kind"] == "p":
                self.begun[e["token"]] = e["n"]
            else:
                self.words[e["token"]] = e["n"]
                self.ordinary[e["token"]] = e["ordinary"]
                self.rights[e["token"]] = e["right"]
                if e["right"]:
                    self.words[e["right"]] = self.ordinary[e["right"]] = e["right_n"]
        self.words = {w: n for w, n in self.words.items() if n}
        self.usual = usual | own if own else usual
        self.repair = Repairer({}, known=self.rights)

    def known(self, word: str) -> bool:
        return word in self.words and in_trie(word) and not self.repair(word)

    def proper_prefix(self, word: str) -> bool:
        own = 0 if self.repair(word) else self.words.get(word, 0)
        return fragment(word, own, self.begun.get(word, 0))


OWN = "array<struct<kind:string,token:string,n:long,ordinary:long,right:string,right_n:long>>"


def with_own(pages: DataFrame, lex: Lexicon, keys: tuple[str, ...], ask: Callable[[tuple, Asking], None]) -> DataFrame:
    """The rows with a column `own`: the entries of the large vocabulary that each asks for; without `rest` as they are.

    `ask` does with a row (the columns' values) and an Asking what the operator will do with the row and the vocabulary.
    Distinct asked words are answered once for the whole table; what a row asks for is as small as its text.  `keys` tell
    the rows apart.
    """
    if lex.rest is None:
        return pages
    sent = pages.sparkSession.sparkContext.broadcast(lex.usual)

    def asks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asking = Asking(sent.value)
        places = None
        for batch in batches:
            places = places or [batch.schema.names.index(k) for k in keys]
            rows: list[tuple] = []
            for row in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns))):
                ask(row, asking)
                rows += asking.rows(*(row[i] for i in places))
            columns = list(zip(*rows)) or [()] * (len(keys) + 2)
            types = [batch.column(i).type for i in places] + [pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], [*keys, "kind", "token"])

    kinds = dict(pages.dtypes)
    asked = written(pages.mapInArrow(asks, ", ".join(f"{k} {kinds[k]}" for k in keys) + ", kind string, token string"), "asked")
    distinct = asked.select("kind", "token").distinct()
    words = distinct.where("kind = 'w'").select(F.col("token").alias("word"))
    known = lex.rest.words
    new = words.join(known, "word", "left_anti").withColumn("ordinary", F.lit(0).cast("long"))
    new = new.join(right_words(new, known, lex.rest.longest), "word").select("word", F.lit(0).cast("long").alias("n"), "ordinary", "right")
    answers = words.join(known, "word").unionByName(new)
    rights = known.select(F.col("word").alias("right"), F.col("ordinary").alias("right_n"))
    answers = answers.join(rights, "right", "left").select(F.lit("w").alias("kind"), F.col("word").alias("token"), "n", "ordinary", "right", F.coalesce("right_n", F.lit(0)).cast("long").alias("right_n"))
    nothing = [F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("ordinary"), F.lit("").alias("right"), F.lit(0).cast("long").alias("right_n")]
    usual = distinct.where("kind = 's'").join(lex.rest.usual, "token", "left_semi").select("kind", "token", *nothing)
    # the numbers of the longer words that an asked one begins; words are counted before they meet it
    trie = known.where("right = '' and length(word) > 1").select(F.explode(F.expr("transform(sequence(1, length(word) - 1), n -> substring(word, 1, n))")).alias("token"), "n")
    trie = trie.groupBy("token").agg(F.sum("n").alias("n"))
    begun = distinct.where("kind = 'p'").join(trie, "token").select("kind", "token", "n", *nothing[1:])
    answers = answers.unionByName(usual).unionByName(begun)
    own = asked.join(answers, ["kind", "token"]).groupBy(*keys).agg(F.collect_list(F.struct("kind", "token", "n", "ordinary", "right", "right_n")).alias("own"))
    return pages.join(own, list(keys), "left").select(*pages.columns, "own")


LETTERS = re.compile(r"[^\W\d_]+")

#: What optical character recognition commonly reads (left) for what was printed (right).
MISREADINGS = (
    ("0", "o"), ("1", "l"), ("1", "i"), ("5", "s"), ("6", "b"), ("8", "b"), ("9", "g"), ("c", "e"), ("l", "i"), ("f", "t"),
    ("rn", "m"), ("ri", "n"), ("cl", "d"), ("ii", "u"), ("li", "h"), ("vv", "w"), ("|", "l"), ("$", "s"),
)


class Repairer:
    """Finds the frequent word that a misread word was, undoing one or two misreadings; remembers what it found."""

    def __init__(self, words: dict[str, int], ratio: int = RATIO, most_edits: int = 2, known: dict[str, str] | None = None):
        self.words, self.ratio, self.most_edits, self.known = words, ratio, most_edits, {} if known is None else known
        self.longest = max(map(len, words), default=0)

    def undone(self, word: str) -> set[str]:
        out = set()
        for wrong, right in MISREADINGS:
            at = word.find(wrong)
            while at >= 0:
                out.add(word[:at] + right + word[at + len(wrong) :])
                at = word.find(wrong, at + 1)
        return out

    def steps(self, word: str) -> Iterator[Iterable[str]]:
        """What may have been printed, after undoing one misreading and after two.

        Undoing takes at most one letter away, so a word that is longer than any known one by more than the edits has
        nothing to be looked for; shorter ones have a bounded number of places.
        """
        near = {word}
        for left in reversed(range(self.most_edits if len(word) > 3 else 1)):
            near = {x for x in set().union(*map(self.undone, near)) if len(x) <= self.longest + left} - {word}
            yield [x for x in near if len(x) > 2 and len(x) <= self.longest and x.replace("-", "").isalpha()]

    def __call__(self, word: str) -> str:
        """The right word, or '' where none is found or the word is itself well known.  Ties go to the more frequent word."""
        if (found := self.known.get(word)) is not None:
            return found
        found, own = "", self.words.get(word, 0)
        if len(word) <= self.longest + self.most_edits:
            for near in self.steps(word):
                right = [x for x in near if self.words.get(x, 0) >= self.ratio * max(1, own)]
                if right:
                    found = max(right, key=lambda x: (self.words[x], x))
                    break
        if len(self.known) < 200_000:
            self.known[word] = found
        return found
