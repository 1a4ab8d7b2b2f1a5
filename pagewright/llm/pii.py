"""Problem 2: personal identifiers in pages and lists, found and replaced by typed placeholders.

Recognisers propose e-mail addresses, phone and identity numbers and street addresses; words that the corpus doesn't
use as ordinary words propose names.  A skip-chain conditional random field decides about all of them, in pages and in
listed elements alike: neighbouring tokens are linked in a chain, equal or similar tokens anywhere in the text by skip
edges, and loopy message passing makes their labels agree.  Its unary, chain and skip weights are trained together, by the
same message passing, on a bounded sample of pages whose identifiers redaction and extraction listed.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .common import EDGE, Asking, Lexicon, Own, Repairer, bounded_sample, counted, current_rows, frequent, looked_up, table, with_own, word_of, written
from .name_variants import FORMAL, MOST_LETTERS, deletes, near, parse

#: Labelled pages and listed elements that the weights are fitted on, at most; passes over them; rounds of message passing.
FIT_PAGES, FIT_ELEMENTS, EPOCHS, ROUNDS = 3_000, 3_000, 20, 4
#: Passes in which all weights are trained together; how far an edge's weight may go.
JOINT, MOST = 10, 3.0
#: The lists miss identifiers: an unlisted token that the fitted weights give a label with this probability gets it, and
#: the weights are fitted again, RELABELLED times.
MISSED, RELABELLED = 0.25, 2
#: Tokens of the sample that must bear a feature for it to get a weight.
LEAST_SEEN = 4
LABELS = ("other", "name", "organisation", "identifier")

#: Titles before names; words that stand before codes; street types; house names.
TITLES = frozenset("mr mrs ms miss mx dr prof professor sister nurse rev sir dame lady lord master".split())
NOT_INITIALS = frozenset("PT DR MR MS".split())
NOT_TRAILING = frozenset("GP NI OT ID NO AM PM IV BP HR RE NHS".split())
AFTER_NAMES = frozenset("the was is has had at in on to for last this since within after before over during by and with yesterday overnight telephoned rang called".split())
STREET = "Street|St|Road|Rd|Avenue|Ave|Lane|Ln|Close|Cl|Crescent|Cres|Terrace|Terr|Gardens|Gdns|Drive|Dr|Way|Place|Pl|Court|Ct|Square|Sq|Row|Hill|Grove|Mews|Walk|Park|Green|Parade|Quay"
HOUSE = "House|Cottage|Lodge|View|Dairy|Farm|Barn|Villa|Hall|Manor|Mill|Grange|Rectory|Vicarage|Bungalow|Gate"

POSTCODE = r"[A-Z]{1,2}\d{1,2}[A-Z]?\s?\d[A-Z]{2}"
_REST = rf"(?:[A-Za-z]+\s+){{1,2}}?(?i:{STREET})\b(?P<comma>\.?,?)\s+(?P<town>[A-Za-z]+(?:-[A-Za-z]+)*)(?:[,.]?\s+(?P<post>(?i:{POSTCODE}))\b)?"
#: Addresses that begin with a number, and those that begin with a house's name; a flat may stand before the number.
NUMBERED = re.compile(rf"(?<![\w/.-])\d{{1,4}}[A-Za-z]?,?\s+{_REST}")
NAMED = re.compile(rf"(?<![\w/.-])(?:(?i:The)\s+)?[A-Za-z]+\s+(?i:{HOUSE}),\s+{_REST}")
HOUSES = tuple(HOUSE.lower().split("|"))
FLAT = re.compile(r"(?i:\bFlat)\s+\d+[A-Za-z]?,?\s+$")
EMAIL = re.compile(r"(?<![\w.+'-])[\w.+'-]{0,64}\w\s?(?:@|\(at\)|\[at\])\s?[\w-]+(?:(?:\.|\s?\[dot\]\s?|\s?\(dot\)\s?)[\w-]+)+", re.I)
NUMBER = re.compile(
    r"(?<![\w/.+-])(?:(?P<phone>(?:(?:\+|00)44[\s.-]?(?:\(0\)[\s.-]?)?\d{2,5}|\(0\d{2,4}\)|0\d{2,4})(?:[\s.-]?\d{3,6}){1,3}|\+\d{1,3}[\s.-]?\d{2,4}(?:[\s.-]?\d{3,4}){2,3})"
    r"|(?P<nhs>\d{3}[\s.-]?\d{3}[\s.-]?\d{4})|(?P<ni>[A-Z]{2}[\s-]?\d{2}[\s-]?\d{2}[\s-]?\d{2}[\s-]?[A-D])|(?P<unit>[A-Z]{1,2}[\s-]?\d{6,7}(?:/[A-Z])?))(?![\w/-]|\.\d)"
)
BLANK_LINE = re.compile(r"\n\s*\n")
LAST_GROUP = re.compile(r"[\s.-]+\d+$")
TOKEN = re.compile(r"\S+")
INITIALS = re.compile(r"[A-Z]\.?|[A-Z]{2}\.?|(?:[A-Z]\.){2,3}")
NOT_ALNUM = re.compile(r"[\W_]+")
#: Means of the prior of the weight that a feature has for a label; what the lists never tell stays at it.
PRIOR = {"kind phone": (3, 3.0), "kind ni": (3, 3.0), "kind email": (3, 3.0), "kind address": (3, 3.0), "title True": (1, 4.0)}
KIND = {"phone": "phone", "nhs": "id_number", "ni": "id_number", "unit": "id_number", "email": "email", "address": "address"}


def plain(text: str) -> str:
    """Lower case, letters and digits only."""
    return NOT_ALNUM.sub("", text).lower()


def valid_nhs(digits: str) -> bool:
    """The modulo-11 check digit of ten digits."""
    check = 11 - sum((10 - k) * int(c) for k, c in enumerate(digits[:9])) % 11
    return len(digits) == 10 and check != 10 and check % 11 == int(digits[9])


class Node:
    __slots__ = ("start", "end", "kind", "word", "features", "chained", "at", "run")

    def __init__(self, start: int, end: int, kind: str, word: str, features: list[str], chained: bool, at: int = -1, run: int = -1):
        self.start, self.end, self.kind, self.word, self.features, self.chained, self.at, self.run = start, end, kind, word, features, chained, at, run


class Vocabulary:
    """Ordinary words and surfaces, and words of names of persons and organisations with their numbers; all bounded.

    Listed words beyond the bound stay in the table `rest` (token, n), and `beside` takes in those that a text needs.  So do
    ordinary words, in the tables of `lex`.
    """

    def __init__(self, usual: frozenset[str], words: dict[str, int], persons: dict[str, int], places: dict[str, int], rest: DataFrame | None = None, lex: Lexicon | None = None):
        self.usual, self.words, self.persons, self.places, self.rest, self.lex = usual, words, persons, places, rest, lex
        self.repair = Repairer(words) if isinstance(words, dict) else words

    def beside(self, own: dict[str, int]) -> Vocabulary:
        """The same with further listed words, given as `p word` or `o word`."""
        persons, places = ({k[2:]: n for k, n in own.items() if k[0] == kind} for kind in "po")
        more = Vocabulary(self.usual, self.words, self.persons | persons, self.places | places)
        more.repair = self.repair
        return more

    def parts(self) -> tuple:
        return self.usual, self.words, self.persons, self.places


def vocabulary(spark: SparkSession, folder: str) -> Vocabulary:
    """Surfaces and words of all clean_ocr rows, and words of all listed names."""
    audit = table(spark, folder, "audit_trail")
    lists = audit.select(F.explode("redacted_entities").alias("e")).unionByName(table(spark, folder, "patient_data_extractor").select(F.explode("extracted_identifiers").alias("e")))

    def tagged(element: str) -> list[str]:
        found = parse(element)
        if not found or found[0] == "a":
            return []
        return [f"{found[0][0]} {w}" for w in (found[1] + " " + found[2]).split() if len(w) > 2]

    listed = written(counted(lists, tagged).where("n >= 2"), "listed-words")
    surfaces = common.surface_counts(spark, folder)
    if surfaces.count() > common.MAX_FREQUENT:
        return _large(surfaces, listed)
    lex = Lexicon({r.token: r.n for r in surfaces.collect()})
    if listed.count() <= common.BROADCAST_NAMES:
        both, rest = {r.token: r.n for r in listed.collect()}, None
    else:
        # what the words of the corpus decide is decided here; other listed words are names whatever the corpus says
        asked = {x for w in lex.words for x in (w, re.sub(r"['’]s$", "", w), w.replace("'", ""))} | FORMAL.keys()
        tokens = [f"{kind} {w}" for w in asked for kind in "po"]
        both = looked_up(listed, tokens)
        rest = listed.join(spark.createDataFrame(pa.table({"token": pa.array(tokens, pa.string())})), "token", "left_anti")
    lower: dict[str, int] = {}
    for surface in lex.usual:
        if surface.strip(EDGE)[:1].islower():
            lower[word_of(surface)] = 1
    persons = {k[2:]: n for k, n in both.items() if k[0] == "p" and (k[2:] not in lower or n > 0.5 * lex.words.get(k[2:], 1))}
    places = {k[2:]: n for k, n in both.items() if k[0] == "o" and k[2:] not in lower}
    names = persons.keys() | places.keys()
    for nickname in FORMAL:
        if nickname not in lex.words:
            persons.setdefault(nickname, 2)
    words = {w: n for w, n in lex.words.items() if w not in names and re.sub(r"['’]s$", "", w) not in names and w.replace("'", "") not in names}
    usual = frozenset(s for s in lex.usual if word_of(s) in words)
    return Vocabulary(usual, words, persons, places, rest)


def _large(surfaces: DataFrame, listed: DataFrame) -> Vocabulary:
    """The same by joins, for a corpus with more surfaces than can be broadcast: words stay in tables, see `with_words`."""
    spark = surfaces.sparkSession
    counts = common.word_counts(surfaces)
    small = counts.join(common.rest_of(surfaces, surfaces.select(F.col("token").alias("word")).limit(0)).usual, "token", "left_semi").where("lower > 0").select("word").distinct().withColumn("small", F.lit(True))
    totals = counts.groupBy("word").agg(F.sum("n").alias("total"))
    names = listed.withColumn("word", F.substring_index("token", " ", -1)).join(totals, "word", "left").join(small, "word", "left")
    person = F.col("token").startswith("p ") & (F.col("small").isNull() | (F.col("n") > 0.5 * F.coalesce("total", F.lit(1))))
    place = F.col("token").startswith("o ") & F.col("small").isNull()
    names = written(names.where(person | place).select("token", "n", "word"), "name-words")
    # a word is no ordinary one if it is a name, without its possessive or its apostrophes
    forms = totals.select("word", F.explode(F.array("word", F.regexp_replace("word", "['’]s$", ""), F.replace("word", F.lit("'"), F.lit("")))).alias("form"))
    none = forms.join(names.select(F.col("word").alias("form")).distinct(), "form", "left_semi").select("word").distinct()
    rest = common.rest_of(surfaces, none, always=True)
    nicknames = spark.createDataFrame([(w,) for w in FORMAL], "word string").join(totals, "word", "left_anti")
    extra = nicknames.select(F.concat(F.lit("p "), "word").alias("token")).join(names, "token", "left_anti").select("token", F.lit(2).cast("long").alias("n"))
    usual = rest.usual.join(none.join(counts, "word").select("token"), "token", "left_anti")
    rest = rest._replace(usual=written(usual, "usual-surfaces"))
    lex = Lexicon(frequent(surfaces.join(rest.usual, "token", "left_semi"), common.MAX_FREQUENT), rest=rest)
    return Vocabulary(lex.usual, {}, {}, {}, names.select("token", "n").unionByName(extra), lex)


def name_form(surface: str) -> str | None:
    """The form in which a token is looked up among listed words; None of what can't be a name's word."""
    bare = surface.strip(EDGE)
    if not 3 <= len(bare) <= MOST_LETTERS or not bare.replace("'", "").replace("’", "").replace(".", "").isalpha():
        return None
    return re.sub(r"['’]s$", "", bare.lower()).replace("'", "").replace("’", "")


def needed(text: str, usual: frozenset[str]) -> set[str]:
    """The words that nodes_of looks up among listed words."""
    forms = {form for surface in set(TOKEN.findall(text)) - usual if (form := name_form(surface))}
    return forms | {form[:-1] for form in forms if form[-1] == "s"}


def with_listed(pages: DataFrame, v: Vocabulary, *fields: str, key: str = "page_key") -> DataFrame:
    """(key, *fields), and where the vocabulary was left in tables `listed` and `own`: what the row needs of listed and of other words."""
    pages = pages.select(key, *fields)
    if v.rest is None:
        return pages
    sent = pages.sparkSession.sparkContext.broadcast(v.usual)

    def needs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns)))
            pairs = [(k, w) for k, *texts in rows for w in set().union(*(needed(t, sent.value) for t in texts if t))]
            yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.string()), pa.array([p[1] for p in pairs], pa.string())], [key, "word"])

    rest = v.rest.select(F.substring_index("token", " ", -1).alias("word"), F.struct("token", "n").alias("entry"))
    own = pages.mapInArrow(needs, f"{key} string, word string").join(rest, "word").groupBy(key).agg(F.collect_set("entry").alias("listed"))
    pages = pages.join(own, key, "left").select(key, *fields, "listed")
    if v.lex is None:
        return pages

    def ask(row: tuple, asking: Asking) -> None:
        for text in row[1 : 1 + len(fields)]:
            if text:
                nodes_of(text, Vocabulary(asking.usual, asking, {}, {}))
                element_words(text, asking, asking.usual)

    return with_own(pages, v.lex, (key,), ask)


def _beside(v: Vocabulary, batch: pa.RecordBatch) -> Vocabulary:
    """The vocabulary with the words that the rows of a batch of `with_listed` brought along."""
    names = batch.schema.names
    if "listed" in names:
        v = v.beside({x["token"]: x["n"] for row in batch.column(names.index("listed")).to_pylist() for x in row or ()})
    if "own" in names:
        own = Own([x for row in batch.column(names.index("own")).to_pylist() for x in row or ()], v.usual)
        v = Vocabulary(own.usual, {w: n for w, n in own.ordinary.items() if n}, v.persons, v.places)
        v.repair = own.repair
    return v


def recognised(text: str, usual) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """(spans of e-mail addresses and street addresses, number spans by shape) as (start, end, kind).

    What stands for the town where no postcode follows must not be a word that the corpus usually writes small (`usual`).
    """
    sure: list[tuple[int, int, str]] = []
    if "@" in text or "at)" in text or "at]" in text:
        sure += [(m.start(), m.end(), "email") for m in EMAIL.finditer(text)]
    for m in (*NUMBERED.finditer(text), *(NAMED.finditer(text) if any(part[-12:].lower().endswith(HOUSES) for part in text.split(",")) else ())):
        start, town = m.start(), m["town"].lower()
        if flat := FLAT.search(text, max(0, start - 24), start):
            start = flat.start()
        if m["post"] is None and (not m["comma"] or town in usual) or BLANK_LINE.search(text[start : m.end()]):
            continue
        sure.append((start, m.end() if m["post"] else m.end("town"), "address"))
    numbers = []
    for m in NUMBER.finditer(text):
        kind, digits, end = m.lastgroup, re.sub(r"\D", "", m[0]), m.end()
        if kind == "phone":
            own = digits.removeprefix("00").removeprefix("44") if m[0][0] == "+" or digits.startswith("0044") else digits
            own = own.lstrip("0")
            while len(own) > 10 and (cut := LAST_GROUP.search(text, m.start(), end)):  # digits of what follows
                end = cut.start()
                own = own[: len(own) - len(re.sub(r"\D", "", cut[0]))]
            if not 9 <= len(own) <= 10:
                if len(digits) != 10 or digits[0] == "0" and not valid_nhs(digits):
                    continue
                kind = "nhs"
        if any(a < end and m.start() < b for a, b, _ in sure):
            continue
        numbers.append((m.start(), end, kind))
    return sure, numbers


def nodes_of(text: str, v: Vocabulary, where: str = "") -> tuple[list[Node], list[tuple[int, int, str]], list[tuple[int, int]]]:
    """(nodes, spans of e-mail and street addresses, spans of all tokens) of a text.

    `where` is set for listed elements, which have no context: their nodes bear the feature instead.
    """
    sure, numbers = recognised(text, v.usual)
    taken = sorted([(a, b) for a, b, _ in sure] + [(a, b) for a, b, _ in numbers])
    spans = list(map(re.Match.span, TOKEN.finditer(text)))
    nodes: list[Node] = []

    def cue(at: int) -> str:
        """The word of a token, without a tag before it."""
        return word_of(text[spans[at][0] : spans[at][1]].rstrip(EDGE).rsplit(">", 1)[-1]) if 0 <= at < len(spans) else "^"

    def context(at: int) -> str:
        """The word before a name; what ends another sentence says nothing about it."""
        word = cue(at)
        return "." if word not in TITLES and 0 <= at < len(spans) and text[spans[at][1] - 1] in ".!?" else word

    if taken:
        starts = {a: k for k, (a, _) in enumerate(spans)}
        for a, b, kind in (*sure, *numbers):
            k = starts.get(a)
            if k is None:
                k = next((i for i, (x, y) in enumerate(spans) if x <= a < y), 0)
            digits = re.sub(r"\D", "", text[a:b])
            features = [f"kind {kind}", f"kind {kind} {where}"]
            if not where:
                features += [f"before {cue(k - 1)}", f"before2 {cue(k - 2)} {cue(k - 1)}", f"{kind} before {cue(k - 1)}"]
            if kind == "address":
                features.append(f"post {text[b - 1].isalpha() and text[b - 3].isdigit()} {where}")
            if kind == "nhs":
                features.append(f"check {valid_nhs(digits)} {where}")
            nodes.append(Node(a, b, kind, plain(text[a:b]) if kind in ("email", "address") else digits, features, False))
    core: dict[int, tuple[str, str]] = {}
    usual, t = v.usual, 0
    for k, (a, b) in enumerate(spans):
        surface = text[a:b]
        if surface in usual:
            continue
        while t < len(taken) and taken[t][1] <= a:
            t += 1
        if t < len(taken) and taken[t][0] < b:
            continue
        stem = name_form(surface)
        if stem is None:
            continue
        word = word_of(surface)
        person, place = v.persons.get(stem, 0), v.places.get(stem, 0)
        if not place and stem.endswith("s"):
            place = v.places.get(stem[:-1], 0)
        if person or place:
            source = "both" if person and place and 0.1 < person / place < 10 else "person" if person >= place else "place"
        elif word in v.words or word in TITLES or v.repair(word) or surface[-1] in "-‐¬\xad" or (k and text[spans[k - 1][1] - 1] in "-‐¬\xad"):
            continue
        else:
            source = "new"
        core[k] = (stem, source)
    run = -1
    before = -9
    for k in sorted(core):
        stem, source = core[k]
        a, b = spans[k]
        bare = text[a:b].strip(EDGE)
        shape = "upper" if bare.isupper() else "title" if bare[0].isupper() else "lower"
        linked = k - before == 1 or (k - before == 2 and _is_initials(text[spans[k - 1][0] : spans[k - 1][1]]) or k - before == 2 and cue(k - 1) in TITLES)
        linked = linked and "\n\n" not in text[spans[before][1] if before >= 0 else 0 : a]
        if not linked:
            run += 1
        p = k - 1
        title = initial = False
        while p >= 0 and (p in core or cue(p) in TITLES or _is_initials(text[spans[p][0] : spans[p][1]])):
            title |= cue(p) in TITLES
            initial |= p not in core
            p -= 1
        q = k + 1
        while q in core or (q < len(spans) and _is_initials(text[spans[q][0] : spans[q][1]])):
            q += 1
        left = context(p) if p >= 0 and "\n" not in text[spans[p][1] : spans[p + 1][0]] else "^ " + context(p)
        features = [
            f"source {source}", f"shape {shape}", f"source {source} {shape}", f"end {stem[-4:]}", f"start {stem[:4]}", f"left {left}", f"right {cue(q)}", f"title {title}", f"initial {initial}",
            f"length {min(q - p - 1, 4)} {source}", f"near {context(k - 1) if k - 1 not in core else '*'} {cue(k + 1) if k + 1 not in core else '*'}", f"next {cue(k + 1) if k + 1 not in core else '*'}",
        ]
        if where:
            features = [f"source {source} {where}", f"source {source} {shape} {where}", f"source {source}", f"end {stem[-4:]}", f"start {stem[:4]}", f"title {title}", f"length {min(q - p - 1, 4)} {source} {where}"]
        nodes.append(Node(a, b, "word", stem, features, linked, k, run))
        before = k
    return nodes, sure, spans


def _is_initials(surface: str) -> bool:
    bare = surface.strip(",;()")
    return 0 < len(bare) <= 6 and INITIALS.fullmatch(bare) is not None and bare.replace(".", "") not in NOT_INITIALS


class Field:
    """The skip-chain CRF: unary weights by feature, a chain and a skip potential by pair of labels."""

    def __init__(self, index: dict[str, int], weights: np.ndarray, chain: np.ndarray, skip: np.ndarray):
        self.index, self.weights, self.chain, self.skip = index, weights, chain, skip

    def decode(self, documents: list[list[Node]]) -> list[np.ndarray]:
        """Marginals (nodes x labels) of each document, all documents in one array computation."""
        graph = Graph(documents)
        if not graph.size:
            return [np.zeros((0, len(LABELS)))] * len(documents)
        rows, columns = graph.features(self.index)
        belief = self._propagate(graph.unary(self.weights, rows, columns), [(graph.chain, self.chain), (graph.skip, self.skip)])
        return [belief[a:b] for a, b in zip(graph.offsets, graph.offsets[1:])]

    def _propagate(self, unary: np.ndarray, edges: list) -> np.ndarray:
        """Loopy sum-product with all messages sent at once, ROUNDS times; logarithms throughout."""
        return _normal(_passed(unary, edges)[0])


class Graph:
    """The nodes of documents one after another, with chain and skip edges; the same for training and for decoding."""

    def __init__(self, documents: list[list[Node]]):
        self.nodes = [node for nodes in documents for node in nodes]
        self.size = len(self.nodes)
        self.offsets = list(accumulate(map(len, documents), initial=0))
        self.chain: list[tuple[int, int]] = []
        self.skip: list[tuple[int, int]] = []
        for nodes, at in zip(documents, self.offsets):
            seen: dict[str, int] = {}
            similar: dict[str, list[str]] = {}  # keys of the delete index -> words, in the order they come
            for k, node in enumerate(nodes):
                if node.chained and k:
                    self.chain.append((at + k - 1, at + k))
                if node.word in seen:
                    self.skip.append((at + seen[node.word], at + k))
                elif node.kind == "word" and len(node.word) > 5:
                    keys = deletes(node.word)
                    met = {w for key in keys for w in similar.get(key, ()) if near(w, node.word)}
                    if met:
                        self.skip.append((at + seen[min(met, key=seen.__getitem__)], at + k))
                    for key in keys:
                        similar.setdefault(key, []).append(node.word)
                seen[node.word] = k
        self.word = np.array([node.kind == "word" for node in self.nodes], bool)

    def features(self, index: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
        """(node, feature) numbers of the known features."""
        pairs = [(k, i) for k, node in enumerate(self.nodes) for f in node.features if (i := index.get(f)) is not None]
        flat = np.array(pairs, int).reshape(-1, 2)
        return flat[:, 0], flat[:, 1]

    def unary(self, weights: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
        """Scores of the labels; words are no identifiers by themselves and numbers and addresses no names."""
        score = _summed(rows, weights[columns], self.size)
        score[self.word, 3] = score[~self.word, 1] = score[~self.word, 2] = -30
        return score


def _summed(groups: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """The sums of the rows of `values` of each group."""
    return np.stack([np.bincount(groups, column, size) for column in values.T], 1)


def _normal(log: np.ndarray) -> np.ndarray:
    belief = np.exp(log - log.max(1, keepdims=True))
    return belief / belief.sum(1, keepdims=True)


def _passed(unary: np.ndarray, edges: list) -> tuple[np.ndarray, np.ndarray | None]:
    """(logarithms of the beliefs, those of the edges' joint beliefs) after ROUNDS rounds of messages."""
    pairs = np.array([e for own, _ in edges for e in own], int).reshape(-1, 2)
    if not len(pairs):
        return unary, None
    potential = np.concatenate([np.repeat(p[None], len(own), 0) for own, p in edges if len(own)])
    source = np.concatenate([pairs[:, 0], pairs[:, 1]])
    target = np.concatenate([pairs[:, 1], pairs[:, 0]])
    both = np.concatenate([potential, potential.transpose(0, 2, 1)])
    back = np.concatenate([np.arange(len(pairs)) + len(pairs), np.arange(len(pairs))])
    message, belief = np.zeros((len(source), unary.shape[1])), unary
    for _ in range(ROUNDS):
        without = belief[source] - message[back]
        new = without[:, :, None] + both
        top = new.max(1)
        new = top + np.log(np.exp(new - top[:, None, :]).sum(1))
        message = 0.5 * message + 0.5 * (new - new.max(1, keepdims=True))
        belief = unary + _summed(target, message, len(unary))
    n = len(pairs)
    joint = (belief[pairs[:, 0]] - message[n:])[:, :, None] + potential + (belief[pairs[:, 1]] - message[:n])[:, None, :]
    return belief, joint


def labels_of(nodes: list[Node], spans: list[tuple[int, int, int]]) -> list[int]:
    """The label of each node: that of the first (start, end, label) it stands in; addresses may stick out."""
    out = []
    for node in nodes:
        inside = ((a <= node.start and node.end - 2 <= b) or node.kind == "address" and min(b, node.end) - max(a, node.start) > 8 for a, b, _ in spans)
        out.append(next((label for (_, _, label), fits in zip(spans, inside) if fits and (label == 3) == (node.kind != "word")), 0))
    return out


def label_of(element: str) -> int:
    """What a listed element says about the tokens it names."""
    if re.search(r"[\d@]|[(\[]at[)\]]", element):
        return 3
    found = parse(element)
    return 0 if not found else 1 if found[0] == "p" else 2


def fit(documents: list[tuple[str, list[str]]], v: Vocabulary) -> Field:
    """Weights from (text, listed identifiers) pairs: a token within a listed name, place or number bears its label.

    Listed elements are documents as well (the first FIT_ELEMENTS of them).  Unary weights are fitted first, with missed labels restored, then all weights
    together: the gradient is what message passing believes less what the labels say, for nodes, chain and skip edges.
    """
    prepared, y = [], []
    elements: dict[str, int] = {}
    for text, listed in documents:
        spans = []
        for element in dict.fromkeys(listed):
            if not element or len(element) < 4:
                continue
            label, k = elements.setdefault(element, label_of(element) if element not in elements else 0), text.find(element)
            while label and k >= 0:
                spans.append((k, k + len(element), label))
                k = text.find(element, k + 1)
        prepared.append(nodes_of(text, v)[0])
        y += labels_of(prepared[-1], spans)
    for element, label in islice(elements.items(), FIT_ELEMENTS):
        nodes = nodes_of(element, v, "listed")[0]
        prepared.append(nodes)
        # numbers count as they would by themselves: the check digit tells, since lists hold other things too
        y += [(3 if n.kind != "nhs" or valid_nhs(n.word) else 0) if n.kind != "word" else label % 3 for n in nodes]
    counts = Counter(f for nodes in prepared for node in nodes for f in node.features)
    index = {f: k for k, f in enumerate(f for f, n in counts.items() if n >= LEAST_SEEN or f in PRIOR)}
    graph, n, y = Graph(prepared), len(LABELS), np.array(y, int)
    r, c = graph.features(index)
    mean = np.zeros((max(1, len(index)), n))
    for f, (label, w) in PRIOR.items():
        if f in index:
            mean[index[f], label] = w
    weights = mean.copy()
    if not graph.size:
        return Field(index, weights, np.zeros((n, n)), np.zeros((n, n)))
    for again in range(RELABELLED + 1):
        truth = np.eye(n)[y]
        weights = mean.copy()
        squares = np.full_like(weights, 1e-6)
        for _ in range(EPOCHS):
            p = _normal(graph.unary(weights, r, c))
            weights -= _step(weights - mean, _gathered(p - truth, r, c, len(weights)), squares)
        if again < RELABELLED:
            likely = 1 + p[:, 1:].argmax(1)
            y = np.where((y == 0) & (p[np.arange(graph.size), likely] >= MISSED), likely, y)
    ties = [np.zeros((n, n)), np.zeros((n, n))]
    edges = [np.array(own, int).reshape(-1, 2) for own in (graph.chain, graph.skip)]
    told = [np.zeros((n, n)) for _ in edges]
    for count, own in zip(told, edges):
        np.add.at(count, (y[own[:, 0]], y[own[:, 1]]), 1)
    tie_squares = [np.full((n, n), 1e-6) for _ in edges]
    for _ in range(JOINT):
        belief, joint = _passed(graph.unary(weights, r, c), list(zip(edges, ties)))
        weights -= _step(weights - mean, _gathered(_normal(belief) - truth, r, c, len(weights)), squares)
        if joint is None:
            continue
        joint = _normal(joint.reshape(len(joint), -1)).reshape(-1, n, n)
        for k, part in enumerate(np.split(joint, [len(edges[0])])):
            gradient = part.sum(0) - told[k]
            if k:  # a skip edge has no direction
                gradient = (gradient + gradient.T) / 2
            ties[k] = np.clip(ties[k] - _step(ties[k], gradient, tie_squares[k]), -MOST, MOST)
    return Field(index, weights, *ties)


def _gathered(difference: np.ndarray, rows: np.ndarray, columns: np.ndarray, size: int) -> np.ndarray:
    return _summed(columns, difference[rows], size)


def _step(away: np.ndarray, gradient: np.ndarray, squares: np.ndarray) -> np.ndarray:
    """A step of AdaGrad with a penalty on what is away from the prior's mean; `squares` grow along."""
    gradient = gradient + 0.3 * away
    squares += gradient**2
    return 0.5 * gradient / np.sqrt(squares)


def names_in(text: str, nodes: list[Node], labels: np.ndarray, spans: list[tuple[int, int]]) -> list[tuple[int, int, list[tuple[int, int]]]]:
    """(start, end, parts) of the persons' names; parts are the spans without titles.

    A name is a surname after given names or initials, a surname followed by a comma and given names, a surname
    followed by initials, or a surname alone after a title.
    """

    def surface(k: int) -> str:
        return text[spans[k][0] : spans[k][1]] if 0 <= k < len(spans) else ""

    def title(k: int) -> bool:
        return word_of(surface(k)) in TITLES

    def ends(k: int) -> bool:
        s = surface(k).rstrip("\"')]")
        if title(k):
            return False
        return s[-1:] in ";:!?)" or (s.endswith(".") and len(s.strip(EDGE)) > 2) or text[spans[k][1] : spans[k + 1][0] if k + 1 < len(spans) else None].count("\n") > 1

    def trailing(j: int) -> bool:
        """Whether initials may follow the surname here: on its line, not an article, not the label of a number."""
        s = surface(j)
        if "\n" in text[spans[j - 1][1] : spans[j][0]] and "." not in s or _digits_follow(text, spans, j):
            return False
        if s == "A" and surface(j + 1)[:1].islower():  # an article, unless what follows can't stand after one
            return surface(j + 1) in AFTER_NAMES
        return s.strip(",.").replace(".", "") not in NOT_TRAILING

    person = {node.at for node, label in zip(nodes, labels) if node.kind == "word" and label == 1}
    taken = [(node.start, node.end) for node in nodes if node.kind != "word"]
    out, done = [], -1
    for k in sorted(person):
        if k <= done:
            continue
        parts, last, comma = [k], k, surface(k).endswith(",")
        titled = title(k - 1) and not ends(k - 1) or (title(k - 1) and surface(k - 1).endswith("."))
        j = k + 1
        fronted = k - 1 > done and _is_initials(surface(k - 1)) and not ends(k - 1)
        if comma:  # surname first
            while j < len(spans) and title(j):
                j += 1
            first = j
            while j < len(spans) and not ends(j - 1) and (j in person or _is_initials(surface(j))) and len(parts) < 4:
                if j not in person and not trailing(j):
                    break
                parts.append(j)
                last = j
                j += 1
                if surface(last).endswith(","):
                    break
            if last == k or first == j:
                parts, last = [k], k
        elif not ends(k):
            while j < len(spans) and len(parts) < 4 and not ((len(parts) > 1 or fronted) and parts[-1] in person and ("\n" in text[spans[j - 1][1] : spans[j][0]] or j not in person and sum(x in person for x in parts) > 1)) and (j in person or (_is_initials(surface(j)) and (j + 1 in person or len(parts) == 1 and not fronted and trailing(j)))):
                parts.append(j)
                last = j
                j += 1
                if surface(last).endswith(",") or ends(last):
                    break
        p = k - 1
        front = []
        if not comma or last == k:
            while p >= 0 and len(front) < 3 and _is_initials(surface(p)) and not surface(p).endswith((",", ";", ":")) and p > done and not any(a < spans[p][1] and spans[p][0] < b for a, b in taken):
                front.insert(0, p)
                p -= 1
            if p >= 0 and title(p):
                titled = True
        parts = front + parts
        done = last
        if len(parts) < 2 and not titled:
            continue
        spans_of = []
        for x in parts:
            a, b = spans[x]
            s = text[a:b]
            lead = len(s) - len(s.lstrip(EDGE))
            bare = s.strip(EDGE)
            bare = re.sub(r"['’]s$", "", bare)
            spans_of.append((a + lead, a + lead + len(bare)))
        out.append((spans_of[0][0], spans_of[-1][1], spans_of))
    return out


def _digits_follow(text: str, spans: list[tuple[int, int]], k: int) -> bool:
    """Whether a phone number follows on the line, so that a letter is its label."""
    return k + 1 < len(spans) and "\n" not in text[spans[k][1] : spans[k + 1][0]] and bool(re.match(r"[+(]?0|\+\d", text[spans[k + 1][0] : spans[k + 1][1]]))


def identifiers(texts: list[str], v: Vocabulary, field: Field) -> list[list[tuple[int, int, str, str]]]:
    """(start, end, kind, val) of the identifiers of each text, in order."""
    prepared = [nodes_of(t, v) for t in texts]
    marginals = field.decode([p[0] for p in prepared])
    found = []
    for text, (nodes, _, spans), belief in zip(texts, prepared, marginals):
        labels = belief.argmax(1) if len(belief) else np.zeros(0, int)
        own = [(n.start, n.end, KIND[n.kind], plain(text[n.start : n.end])) for n, label in zip(nodes, labels) if n.kind != "word" and label == 3]
        own += [(a, b, "name", "".join(plain(text[x:y]) for x, y in parts)) for a, b, parts in names_in(text, nodes, labels, spans)]
        found.append(sorted(own))
    return found


def _halves(element: str, taken: list[tuple[int, int]]) -> list[str]:
    """The parts of an element that may each be one name: without the given spans and what leads to them."""
    rest, at = [], 0
    for a, b in sorted(taken):
        rest.append(element[at:a])
        at = max(at, b)
    rest.append(element[at:])
    return [half for piece in rest for half in re.split(r"\s*[;/|&]\s*|\s+and\s+", LEADS.sub("", piece))]


def element_words(element: str, words, usual) -> bool:
    """Whether a part of an element would be a name but for words that the corpus uses as ordinary ones."""
    sure, numbers = recognised(element, usual)
    for half in _halves(element, [(a, b) for a, b, _ in (*sure, *numbers)]):
        if (found := parse(half)) and any(len(w) > 2 and w in words for w in (found[1] + " " + found[2]).split()):
            return True
    return False


def elements_identifiers(elements: list[str], v: Vocabulary, field: Field) -> list[list[tuple[str, str]]]:
    """(kind, val) of the identifiers in each listed element, by the field's labels.

    A name takes a title or two words by the grammar of names, and the field must take each of its words for a name's,
    but for those that are no node: initials and words of two letters.
    """
    prepared = [nodes_of(e, v, "listed") for e in elements]
    out = []
    for element, (nodes, _, _), belief in zip(elements, prepared, field.decode([p[0] for p in prepared])):
        labels = belief.argmax(1) if len(belief) else ()
        own = [(KIND[n.kind], plain(element[n.start : n.end])) for n, label in zip(nodes, labels) if n.kind != "word" and label == 3]
        names = {n.word for n, label in zip(nodes, labels) if n.kind == "word" and label == 1}
        for half in _halves(element, [(n.start, n.end) for n in nodes if n.kind != "word"]):
            found = parse(half)
            if found and found[0] == "p":
                words = (found[1] + " " + found[2]).split()
                titled = any(word_of(w) in TITLES for w in half.split())
                if (len(words) > 1 or titled) and all(w in names for w in words if len(w) > 2):
                    own.append(("name", plain("".join(w for w in half.split() if word_of(w) not in TITLES))))
        out.append(own)
    return out


LEADS = re.compile(r"(?i)[\s,;]*\b(?:tel|phone|mob|mobile|email|e-mail|ph|nhs(?: no| number)?|dob|born)\b[.:#]?\s*$")


def element_identifiers(element: str, v: Vocabulary, field: Field | None = None) -> list[tuple[str, str]]:
    """The same of one element; without a field, the one that nothing but the words' sources has taught."""
    return elements_identifiers([element], v, field or UNTAUGHT)[0]


def _untaught() -> Field:
    """What the vocabulary says by itself: words of persons and new ones are names, sound numbers are identifiers."""
    weights = {"source person": 1, "source new": 1, "source both": 1, "source place": 2, "kind phone": 3, "kind ni": 3, "kind unit": 3, "kind email": 3, "kind address": 3, "check True listed": 3}
    table = np.zeros((len(weights), len(LABELS)))
    table[range(len(weights)), list(weights.values())] = 3.0
    return Field({f: k for k, f in enumerate(weights)}, table, np.zeros((4, 4)), np.zeros((4, 4)))


UNTAUGHT = _untaught()


def fitted(spark: SparkSession, folder: str, v: Vocabulary, most: int = FIT_PAGES) -> Field:
    """The field, from at most `most` pages with a redacted identifier (those whose key's hash comes first)."""
    audit = table(spark, folder, "audit_trail").where("clean_ocr is not null and size(redacted_entities) > 0 and page_key is not null")
    sample = bounded_sample(audit.select("page_key", "clean_ocr", "redacted_entities"), most)
    lists = table(spark, folder, "patient_data_extractor").where("extracted_identifiers is not null").select("page_key", "extracted_identifiers")
    listed = sample.select("page_key").distinct().join(lists, "page_key").groupBy("page_key").agg(F.flatten(F.collect_set("extracted_identifiers")).alias("listed"))
    rows = sample.join(listed, "page_key", "left").select("page_key", "clean_ocr", F.concat("redacted_entities", F.coalesce("listed", F.array())).alias("listed")).toArrow().to_pylist()
    rows.sort(key=lambda r: (r["page_key"], r["clean_ocr"]))
    if v.rest is not None:
        texts = spark.createDataFrame(pa.table({"k": pa.array([str(i) for i in range(len(rows))], pa.string()), "text": pa.array([r["clean_ocr"] for r in rows], pa.string()), "elements": pa.array(["\n\n".join(x for x in r["listed"] if x) for r in rows], pa.string())}))
        batches = with_listed(texts, v, "text", "elements", key="k").toArrow().combine_chunks().to_batches()
        v = _beside(v, batches[0]) if batches else v
    return fit([(r["clean_ocr"], [x for x in r["listed"] if x]) for r in rows], v)


ROWS = "page_key string, field string, kind string, val string"


def found_in_pages(pages: DataFrame, v: Vocabulary, field: Field, fields: tuple[str, ...] = ("clean_ocr", "final_llm_scrubbed")) -> DataFrame:
    """(page_key, field, kind, val), one row for each different identifier; null and empty texts have none."""
    sent = pages.sparkSession.sparkContext.broadcast((v.parts(), (field.index, field.weights, field.chain, field.skip)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, model = sent.value
        own, crf = Vocabulary(*parts), Field(*model)
        for batch in batches:
            for start in range(0, batch.num_rows, 2000):
                part = batch.slice(start, 2000)
                keys = part.column(0).to_pylist()
                out: tuple[list, ...] = ([], [], [], [])
                words = _beside(own, part)
                for c, name in enumerate(fields, 1):
                    here = [(k, t) for k, t in zip(keys, part.column(c).to_pylist()) if t]
                    for (key, _), found in zip(here, identifiers([t for _, t in here], words, crf)):
                        for kind, val in dict.fromkeys((kind, val) for _, _, kind, val in found if val):
                            for x, value in zip(out, (key, name, kind, val)):
                                x.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in out], ["page_key", "field", "kind", "val"])

    return with_listed(pages, v, *fields).mapInArrow(run, ROWS)


def found_in_lists(extractor: DataFrame, v: Vocabulary, field: Field) -> DataFrame:
    """The same of all rows of extracted_identifiers; null lists and elements have none.  Each different element is labelled once."""
    sent = extractor.sparkSession.sparkContext.broadcast((v.parts(), (field.index, field.weights, field.chain, field.skip)))
    pairs = extractor.where("page_key is not null").select("page_key", F.explode("extracted_identifiers").alias("element")).where("element is not null").distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, model = sent.value
        own, crf = Vocabulary(*parts), Field(*model)
        known: dict[str, list[tuple[str, str]]] = {}
        for batch in batches:
            keys, elements = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            new = list(dict.fromkeys(e for e in elements if e not in known))
            found = dict(zip(new, elements_identifiers(new, _beside(own, batch), crf)))
            out = [(key, "extracted_identifiers", *x) for key, e in zip(keys, elements) for x in (known.get(e) or found.get(e) or ()) if x[1]]
            if len(known) < 200_000:
                known |= found
            columns = list(zip(*out)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in columns], ["page_key", "field", "kind", "val"])

    if v.rest is None:
        return pairs.mapInArrow(run, ROWS).distinct()
    # a large vocabulary is asked about different elements, which then meet their pages
    alone = with_listed(pairs.select("element").distinct().select("element", F.col("element").alias("text")), v, "text", key="element")
    alone = alone.select(F.col("element").alias("page_key"), *alone.columns[1:])
    found = alone.mapInArrow(run, ROWS).select(F.col("page_key").alias("element"), "field", "kind", "val")
    return pairs.join(found, "element").select("page_key", "field", "kind", "val").distinct()


def scrubbed(pages: DataFrame, v: Vocabulary, field: Field, column: str = "clean_ocr") -> DataFrame:
    """(page_key, text): every identifier replaced by its kind in square brackets, the rest as it was; null stays null."""
    sent = pages.sparkSession.sparkContext.broadcast((v.parts(), (field.index, field.weights, field.chain, field.skip)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, model = sent.value
        own, crf = Vocabulary(*parts), Field(*model)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            made = []
            for text, found in zip(texts, identifiers([t or "" for t in texts], _beside(own, batch), crf)):
                if text is not None:
                    for a, b, kind, _ in reversed(found):
                        text = f"{text[:a]}[{kind.upper()}]{text[b:]}"
                made.append(text)
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.string()), pa.array(made, pa.string())], ["page_key", "text"])

    return with_listed(pages, v, column).mapInArrow(run, "page_key string, text string")


def all_identifiers(spark: SparkSession, folder: str) -> DataFrame:
    """(page_key, field, kind, val) of current clean_ocr and final_llm_scrubbed and of all extracted_identifiers."""
    v = vocabulary(spark, folder)
    field = fitted(spark, folder, v)
    pages = current_rows(table(spark, folder, "audit_trail"), "clean_ocr", "final_llm_scrubbed")
    return found_in_pages(pages, v, field).unionByName(found_in_lists(table(spark, folder, "patient_data_extractor"), v, field))
