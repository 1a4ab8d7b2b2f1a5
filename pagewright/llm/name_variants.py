"""Problem 6: spellings of one person's or organisation's name, linked within a stem.

Elements are parsed into tokens.  A symmetric-delete index (all strings made by deleting up to two letters; pieces of very
long names) finds surnames and proper names a small edit distance apart without comparing all of them.  Within such a
neighbourhood the given names are aligned by the best assignment, which permits initials, nicknames and misspellings.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import dropped, stem_of, written

#: Letters that may be deleted on either side; a name of fewer than LONG letters gets one less.
DELETES, LONG = 2, 5
#: A phrase that stands in more stems than this share of all (and than COMMON_STEMS) is a stock phrase, no name, unless its
#: last word, or a spelling linked to it, stands anywhere with a title, an initial or in inverted order, as only names do.
COMMON_SHARE, COMMON_STEMS = 0.2, 12
#: A name of more letters, which would have thousands of keys in the delete index, is found by its pieces; drops nothing.
MOST_LETTERS = 64
#: Pieces of a long name: an edit changes two of them at most, when it swaps letters across a border, so one stays whole.
PIECES = 2 * DELETES + 1
#: Letters of index rows that a task holds before it hands them on; bounds its memory, drops nothing.
FLUSH_LETTERS = 1 << 24
#: Names that share a key of the delete index are joined in parts of about this size, so that no task holds a hot key.
KEY_PART = 500
#: Names whose edges a task contracts at a time; bounds its memory, drops nothing.
CHUNK_NAMES = 200_000

#: Titles, words of organisations with their abbreviations, words left out of organisations, nicknames.
TITLES = frozenset("mr mrs ms miss mx dr prof professor sister nurse rev sir dame lady lord pt master".split())
ORGANISATION = {
    "hospital": "hospital", "hosp": "hospital", "centre": "centre", "center": "centre", "ctr": "centre", "infirmary": "infirmary", "infy": "infirmary",
    "surgery": "surgery", "surg": "surgery", "unit": "unit", "clinic": "clinic", "medical": "medical", "med": "medical", "general": "general",
    "gen": "general", "community": "community", "comm": "community", "health": "health", "hlth": "health", "rehabilitation": "rehabilitation",
    "rehab": "rehabilitation", "eye": "eye", "royal": "royal", "old": "old", "north": "north", "south": "south", "east": "east", "west": "west",
    "new": "new", "st": "st", "saint": "st", "practice": "practice", "university": "university", "univ": "university", "children": "children",
}
KINDS = frozenset("hospital centre infirmary surgery unit clinic practice".split())
LEFT_OUT = frozenset("the nhs trust foundation of and".split())
NICKNAMES = (
    "alexander sandy alex al lex", "anthony tony", "catherine kate cathy katie kath cath", "charles charlie chas", "christopher chris kit", "deborah debs deb debbie",
    "dorothy dot dottie dolly", "edward ted ed eddie ned", "elizabeth liz beth lizzie betty eliza libby", "francisca fran franny cisca", "frederick fred freddie", "george georgie",
    "gwendolyn gwen wendy", "henry harry hank", "hubert bert hugh", "ibrahim ibra ibby ibro", "james jim jimmy jamie", "john jack johnny", "josephine josie jo", "kenneth ken kenny",
    "lawrence larry laurie", "margaret peggy maggie meg marge", "mary polly molly", "michael mick mike mickey", "nathaniel nate nat nathan", "nicholas nick", "oluwaseun seun olu",
    "patricia trish pat patty tricia", "peter pete", "priyanka priya", "richard dick rick rich", "robert bob rob bobby bert", "rosalind ros roz rosie", "samuel sam", "stephen steve",
    "susan sue susie", "theodora thea dora theo", "thomas tom tommy", "valentina val tina", "victoria vicky vic tori", "william bill will billy liam", "yusuf yus joe", "zbigniew zbig zbyszek",
)
FORMAL: dict[str, frozenset[str]] = {}
for _line in NICKNAMES:
    for _n in _line.split():
        FORMAL[_n] = FORMAL.get(_n, frozenset()) | {_line.split()[0]}

EDGES = " \t\r\n.,;:!?()[]\"'`-"
WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*\.?")
SEVERAL = re.compile(r"[\d@;|/&+*]|\b(?:and|tel)\b|[\[(]at[\])]")


def _letters(word: str) -> str:
    word = word.lower().rstrip(".")
    return re.sub(r"['’]s$", "", word).replace("'", "").replace("’", "")


def parse(element: str | None) -> tuple[str, str, str, str] | None:
    """(block, name, given, acronym) of an element that holds one name; None of anything else.

    Persons have block `p`, name = surname, given = given names and initials in order, joined by blanks.  Organisations
    have the kind and the qualifying words as block and the proper name as name.  An acronym has block `a`.
    """
    if not element:
        return None
    text = element.strip(EDGES)
    if not text or SEVERAL.search(text):
        return None
    if re.fullmatch(r"[A-Z]{3,6}", text):
        return "a", text.lower(), "", text.lower()
    parts = [p for p in text.split(",") if p.strip()]
    if len(parts) > 2:
        return None
    words = [[w for w in WORD.findall(p)] for p in parts]
    flat = [w for p in words for w in p]
    if sum(map(len, flat)) + 2 * len(flat) + 4 < len(text):
        return None
    upper = text.isupper()
    known = [ORGANISATION.get(_letters(w)) for w in flat]
    if any(k in KINDS for k in known if k):
        order = (words[1] + words[0]) if len(words) == 2 else words[0]
        out = [(_letters(w), ORGANISATION.get(_letters(w))) for w in order if _letters(w) not in LEFT_OUT]
        saint, bare = any(k == "st" for _, k in out), possessives(order)
        proper = [w[:-1] if saint and w.endswith("s") and len(w) > 3 and w in bare else w for w, k in out if not k]
        if not proper:
            return None
        kinds = " ".join(sorted({k for _, k in out if k}))
        return f"o {kinds}", " ".join(proper), "", "".join((k or w)[0] for w, k in out)
    if len(parts) == 2:
        before, after = ([w for w in p if _letters(w) not in TITLES] for p in words)
        if len(before) != 1 or not after or len(_letters(before[0])) < 3:
            return None
        surname, given = _letters(before[0]), after
    else:
        if any(_letters(w) in LEFT_OUT for w in flat):
            return None
        rest = [w for w in flat if _letters(w) not in TITLES]
        long = [w for w in rest if not _initials(w, upper)]
        if not long:
            return None
        surname = _letters(long[-1])
        given = list(rest)
        given.remove(long[-1])
        if len(surname) < 3:
            return None
    names: list[str] = []
    for w in given:
        names.extend(_letters(w) if _initials(w, upper) else [_letters(w)])
    return "p", surname, " ".join(n for n in names if n), ""


def possessives(order: list[str]) -> set[str]:
    """The words as they stand in the element: of `Xs`, those without the apostrophe."""
    return {w.lower().rstrip(".") for w in order}


def _initials(word: str, upper: bool) -> bool:
    """Whether the word of an element, which may be all in upper case, is initials."""
    bare = word.rstrip(".")
    return len(bare) == 1 or (len(bare) <= 2 and bare.isupper() and not upper) or (len(bare) == 2 and not re.search("[aeiouyAEIOUY]", bare))


def deletes(name: str) -> set[str]:
    """The name and all strings made from it by deleting up to DELETES letters, each with the first letter kept apart."""
    out, last = {name}, {name}
    for _ in range(DELETES if len(name) >= LONG else DELETES - 1):
        last = {x[:i] + x[i + 1 :] for x in last for i in range(1, len(x))}
        out |= last
    return out


def keys_of(name: str) -> set[str]:
    """Strings of which any two names that are `near` share one: deletes, or marked pieces of long names.

    A piece is marked with the length and place that it has in a name of up to DELETES letters more or fewer, and stands up
    to as many letters away from there.
    """
    n = len(name)
    out = deletes(name) if n <= MOST_LETTERS else set()
    for m in range(n - DELETES, n + DELETES + 1) if n > MOST_LETTERS - DELETES else ():
        for i in range(PIECES):
            start, stop = m * i // PIECES, m * (i + 1) // PIECES
            out |= {f"{m} {i} {name[start + d : stop + d]}" for d in range(-DELETES, DELETES + 1) if start + d >= 0 and stop + d <= n}
    return out


def distance(a: str, b: str, most: int) -> int:
    """Edits with transpositions (optimal string alignment), or most + 1; looks only at places up to `most` apart."""
    far, width = most + 1, 2 * most + 1
    if abs(len(a) - len(b)) > most:
        return far
    two, one = None, [k - most if k >= most else far for k in range(width)]  # place k of row i is letter i + k - most of b
    for i, c in enumerate(a, 1):
        now, v = [far] * width, far
        for k in range(max(0, most - i), min(width, len(b) - i + most + 1)):
            j = i + k - most
            v = min(v + 1, one[k + 1] + 1 if k + 1 < width else far)
            if j:
                v = min(v, one[k] + (c != b[j - 1]))
                if i > 1 and j > 1 and c == b[j - 2] and a[i - 2] == b[j - 1]:
                    v = min(v, two[k] + 1)
            now[k] = v
        two, one = one, now
        if min(min(one), min(two)) > most:
            return far
    return min(one[len(b) - len(a) + most], far)


def near(a: str, b: str) -> bool:
    most = DELETES if min(len(a), len(b)) >= LONG else DELETES - 1
    return a == b or (a[:1] == b[:1] and distance(a, b, most) <= most)


def given_cost(a: str, b: str) -> float:
    """0 for equal given names, little for nicknames and misspellings, 1 for an initial, infinite if they can't be one."""
    if a == b:
        return 0
    if len(a) == 1 or len(b) == 1:
        firsts = {a[0], *(f[0] for f in FORMAL.get(a, ()))} & {b[0], *(f[0] for f in FORMAL.get(b, ()))}
        return 1 if firsts else float("inf")
    fa, fb = FORMAL.get(a, frozenset([a])) | {a}, FORMAL.get(b, frozenset([b])) | {b}
    if fa & fb:
        return 0.2
    if any(near(x, y) for x in fa for y in fb):
        return 0.5
    return float("inf")


def assigned(costs: list[list[int]]) -> int:
    """Least sum of costs of a column of its own for each row, by shortest augmenting paths; no more rows than columns."""
    n, m = len(costs), len(costs[0]) if costs else 0
    above, left, row_of = [0] * (n + 1), [0] * (m + 1), [0] * (m + 1)
    for i in range(1, n + 1):
        row_of[0], at = i, 0
        least, came, used = [None] * (m + 1), [0] * (m + 1), [False] * (m + 1)
        while row_of[at]:
            used[at], row, step, to = True, row_of[at], None, 0
            for j in range(1, m + 1):
                if not used[j]:
                    v = costs[row - 1][j - 1] - above[row] - left[j]
                    if least[j] is None or v < least[j]:
                        least[j], came[j] = v, at
                    if step is None or least[j] < step:
                        step, to = least[j], j
            if step:
                for j in range(m + 1):
                    if used[j]:
                        above[row_of[j]] += step
                        left[j] -= step
                    elif j:
                        least[j] -= step
            at = to
        while at:
            row_of[at], at = row_of[came[at]], came[at]
    return sum(costs[row - 1][j - 1] for j, row in enumerate(row_of) if j and row)


def align(a: list[str], b: list[str]) -> float:
    """Cost of the best assignment of the shorter list's given names to the longer's; names left over must be initials.

    A leftover full name is allowed as well if the first names fit (a second given name).
    """
    if len(a) > len(b):
        a, b = b, a
    if not a:
        return 2.0 if not b else 3.0
    never = 100 * (len(b) + 1)  # more than any names that fit cost together, in tenths
    costs = [[never if (c := given_cost(x, y)) == float("inf") else round(10 * c) + (i != k) for k, y in enumerate(b)] for i, x in enumerate(a)]
    if any(len(x) > 1 for x in a):
        best = assigned(costs)
    else:  # the first names fit each other, or no full name is left over
        straight = costs[0][0] + assigned([row[1:] for row in costs[1:]])
        full = [never * (len(y) > 1) for y in b]
        best = min(straight, assigned([[c - f for c, f in zip(row, full)] for row in costs]) + sum(full))
    return best / 10 if best < never else float("inf")


def one_person(a: list[str], b: list[str]) -> bool:
    """Whether two lists of full given names can be one person's; each name that isn't met at its own place costs a tenth."""
    return sum(x != y for x, y in zip(a, b)) < 10 and align(a, b) < 1


def _keys(given: list[str]) -> set[str]:
    """Keys that two lists of given names share if any of their full names can be one name."""
    return {d for n in given if len(n) > 1 for form in (n, *FORMAL.get(n, ())) for d in keys_of(form)}


def cluster(rows: list[tuple[str, int]]) -> list[int]:
    """Entity numbers of (given names, count) rows that share a surname.

    Rows with a full given name are linked first; only those are compared that share a key of the delete index.  A row
    of initials joins the one entity that it fits; where it fits several, the one that has all its initials, else it
    stays by itself.
    """
    given = [g.split() for g, _ in rows]
    label = list(range(len(rows)))

    def root(k: int) -> int:
        while label[k] != k:
            label[k] = label[label[k]]
            k = label[k]
        return k

    full = [k for k, g in enumerate(given) if any(len(x) > 1 for x in g)]
    long = {k: [x for x in given[k] if len(x) > 1] for k in full}
    middle = {k: {x for x in given[k] if len(x) == 1} for k in full}
    by_key: dict[str, list[int]] = {}
    for k in full:
        for x in _keys(given[k]):
            by_key.setdefault(x, []).append(k)
    compared: set[tuple[int, int]] = set()
    for members in by_key.values():
        for i, j in combinations(members, 2):
            if (i, j) in compared:
                continue
            compared.add((i, j))
            if root(i) != root(j):
                if middle[i] and middle[j] and not middle[i] & middle[j]:
                    continue
                if one_person(long[i], long[j]):
                    label[max(root(i), root(j))] = min(root(i), root(j))
    entities: dict[int, list[int]] = {}
    firsts: dict[str, set[int]] = {}  # letters that an entity's first given name may begin with
    for k in full:
        entities.setdefault(root(k), []).append(k)
        for form in (long[k][0], *FORMAL.get(long[k][0], ())):
            firsts.setdefault(form[0], set()).add(root(k))
    bare: dict[str, list[int]] = {}
    for k, g in enumerate(given):
        if k in long:
            continue
        fits = sorted(firsts.get(g[0], ())) if g else []
        if len(fits) > 1 and len(g) > 1:
            sure = [e for e in fits if any(set(g[1:]) <= {x[0] for x in given[m][1:]} for m in entities[e])]
            fits = sure if len(sure) == 1 else fits
        if len(fits) == 1:
            label[k] = root(fits[0])
        elif g:
            bare.setdefault(g[0], []).append(k)
    for members in bare.values():
        for k in members[1:]:
            label[k] = members[0]
    return [root(k) for k in range(len(rows))]


def _tasks(rows: DataFrame) -> int:
    return int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def elements(extractor: DataFrame, audit: DataFrame) -> DataFrame:
    """Distinct (stem, name): all elements of both lists, in any rows, with a stem."""
    a = extractor.select(F.coalesce("stem", stem_of()).alias("stem"), F.explode("extracted_identifiers").alias("name"))
    b = audit.select(stem_of().alias("stem"), F.explode("redacted_entities").alias("name"))
    return a.unionByName(b).where("stem is not null and name is not null").distinct()


def marked(element: str) -> bool:
    """Whether an element bears a title, an initial or inverted order, as only persons' names do."""
    text = element.strip(EDGES)
    words = WORD.findall(text)
    return "," in text or any(_letters(w) in TITLES or len(w.rstrip(".")) == 1 for w in words)


def parsed(names: DataFrame) -> DataFrame:
    """(stem, name, block, proper, given, acronym, marked) of the elements that hold one name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [], [], [], [])
            for stem, name in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if found := parse(name):
                    for x, v in zip(out, (stem, name, *found, marked(name))):
                        x.append(v)
            yield pa.RecordBatch.from_arrays([*(pa.array(x, pa.string()) for x in out[:6]), pa.array(out[6], pa.bool_())], ["stem", "name", "block", "proper", "given", "acronym", "marked"])

    return names.mapInArrow(run, "stem string, name string, block string, proper string, given string, acronym string, marked boolean")


def neighbours(tokens: DataFrame) -> DataFrame:
    """(stem, block, a, b), a < b: proper names of one stem and block within the edit distance, by the delete index.

    Keys of a single name are dropped before the join.  The names of a key are dealt to parts of about KEY_PART names and
    a name meets each part in a row of its own, so that a hot key's work spreads over tasks.
    """

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: tuple[list[str], ...] = ([], [], [], [])

        def rows() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in out], ["stem", "block", "key", "token"])
            for x in out:
                x.clear()
            return made

        for batch in batches:
            held = 0
            for stem, block, token in zip(*(batch.column(i).to_pylist() for i in range(3))):
                keys = keys_of(token)
                for x, v in zip(out, ([stem] * len(keys), [block] * len(keys), keys, [token] * len(keys))):
                    x.extend(v)
                held += 2 * len(token) * len(keys)
                if held > FLUSH_LETTERS:
                    yield rows()
                    held = 0
            yield rows()

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [near(a, b) for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield batch.filter(pa.array(kept, pa.bool_()))

    spread = tokens.select("stem", "block", "proper").repartition(_tasks(tokens), "stem", "proper")  # each row becomes up to a hundred
    keys = spread.mapInArrow(index, "stem string, block string, key string, token string")
    # one 64-bit key in place of three texts; keys that collide only bring names together that `verify` parts again
    keys = written(keys.select(F.xxhash64("stem", "block", "key").alias("key"), "stem", "block", "token"), "delete-index")
    several = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    met = keys.join(several, "key").withColumn("parts", F.ceil(F.col("n") / KEY_PART).cast("int"))
    a = met.select("key", F.pmod(F.xxhash64("token"), F.col("parts")).cast("int").alias("part"), "stem", "block", F.col("token").alias("a"))
    b = met.select("key", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "stem", "block", F.col("token").alias("b"))
    pairs = a.join(b, ["key", "part", "stem", "block"]).where("a < b").select("stem", "block", "a", "b").distinct()
    return pairs.mapInArrow(verify, "stem string, block string, a string, b string")


def contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges (stem, block, a, b) of the same components, each from a name to the least that a chunk of edges links it to."""
    above: dict[tuple, tuple] = {}

    def root(x: tuple) -> tuple:
        while (up := above.setdefault(x, x)) != x:
            above[x] = above[up]
            x = above[x]
        return x

    def out() -> pa.RecordBatch:
        stars = [(*x, root(x)[2]) for x in list(above)]
        above.clear()
        columns = list(zip(*(r for r in stars if r[2] != r[3]))) or [()] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], ["stem", "block", "a", "b"])

    for batch in batches:
        for stem, block, a, b in zip(*(batch.column(i).to_pylist() for i in range(4))):
            x, y = root((stem, block, a)), root((stem, block, b))
            if x != y:
                above[max(x, y)] = min(x, y)
        if len(above) > CHUNK_NAMES:
            yield out()
    yield out()


def components(tokens: DataFrame, edges: DataFrame) -> DataFrame:
    """(stem, block, proper, least): each proper name with the least of its component.

    Tasks contract their edges first.  Then labels fall until none changes, however many rounds that takes: a name and its
    label take the least of its neighbours' labels' labels, and every name jumps to its label's label, so a chain of n
    names needs about log n rounds.
    """
    node = ["stem", "block", "proper"]
    edges = edges.repartition(_tasks(edges), "stem", "block").mapInArrow(contracted, "stem string, block string, a string, b string")
    both = edges.unionByName(edges.select("stem", "block", F.col("b").alias("a"), F.col("a").alias("b")))
    both = written(both.select("stem", "block", F.col("a").alias("proper"), "b"), "name-edges")
    labels = written(both.groupBy(*node).agg(F.min("b").alias("b")).select(*node, F.least("proper", "b").alias("least")), "name-labels")
    while True:
        jumped = labels.join(labels.select("stem", "block", F.col("proper").alias("least"), F.col("least").alias("top")), ["stem", "block", "least"])
        around = both.join(jumped.select("stem", "block", F.col("proper").alias("b"), "top"), ["stem", "block", "b"]).groupBy(*node).agg(F.min("top").alias("near"))
        told = jumped.join(around, node).select(*node, "least", F.least("top", "near").alias("new"))
        # each name hears the news for itself, and its label hears it from all names that bear it
        news = told.select(*node, "new").unionByName(told.select("stem", "block", F.col("least").alias("proper"), "new"))
        news = news.groupBy(*node).agg(F.min("new").alias("new"))
        now = labels.join(news, node).select(*node, F.least("least", "new").alias("least"), (F.col("new") < F.col("least")).alias("changed"))
        now, before = written(now, "name-labels"), labels
        labels = now.drop("changed")
        done = now.where("changed").isEmpty()
        dropped(before)
        if done:
            break
    dropped(both)
    return tokens.select(*node).join(labels, node, "left").withColumn("least", F.coalesce("least", "proper"))


def variants(extractor: DataFrame, audit: DataFrame) -> DataFrame:
    """(stem, name, entity): every element that holds one name, with its entity; entity is unique within the stem.

    Null lists and elements are skipped.  Stock phrases that stand in many stems aren't names (see COMMON_SHARE).
    """
    rows = written(parsed(elements(extractor, audit)), "name-elements")
    full = rows.where("block != 'a'")
    tokens = full.select("stem", "block", "proper").distinct()
    labels = components(tokens, neighbours(tokens))
    full = full.join(labels, ["stem", "block", "proper"]).withColumn("phrase", F.when(F.col("block") == "p", F.concat_ws(" ", "given", "proper")))
    stems = rows.select("stem").distinct().count()
    common = full.where("block = 'p'").groupBy("phrase").agg(F.countDistinct("stem").alias("n")).where(F.col("n") > max(COMMON_STEMS, COMMON_SHARE * stems))
    # surnames that stand with a mark somewhere, and those linked to one in some stem
    surnames = full.where("block = 'p' and marked").select("proper").distinct()
    linked = full.where("block = 'p'").select("stem", "least", "proper").distinct()
    sure = linked.join(surnames, "proper", "left_semi").select("stem", "least").distinct()
    known = linked.join(sure, ["stem", "least"], "left_semi").select("proper").distinct()
    common = common.select("phrase", F.substring_index("phrase", " ", -1).alias("proper")).join(known, "proper", "left_anti")
    full = written(full.join(common.select("phrase"), "phrase", "left_anti"), "names")
    people = full.where("block = 'p'").groupBy("stem", "least", "given").agg(F.count("*").alias("n"))

    @F.pandas_udf("array<int>")
    def split(groups: pd.Series) -> pd.Series:
        return groups.map(lambda rows: cluster([(r["given"], r["n"]) for r in rows]))

    # a group holds the different given names that stand with one surname of one stem
    groups = people.groupBy("stem", "least").agg(F.array_sort(F.collect_list(F.struct("given", "n"))).alias("rows"))
    groups = groups.repartition(_tasks(groups), "stem", "least").withColumn("labels", split("rows"))
    persons = groups.select("stem", "least", F.explode(F.arrays_zip("rows", "labels")).alias("x")).select("stem", "least", "x.rows.given", F.col("x.labels").alias("person"))
    named = full.where("block = 'p'").join(persons, ["stem", "least", "given"]).select("stem", "name", F.concat_ws("|", F.lit("p"), "least", "person").alias("entity"))
    places = full.where("block != 'p'").select("stem", "name", F.concat_ws("|", "block", "least").alias("entity"), "acronym")
    short = rows.where("block = 'a'").select("stem", "name", "acronym")
    meant = places.select("stem", "acronym", "entity").distinct().groupBy("stem", "acronym").agg(F.min("entity").alias("entity"), F.max("entity").alias("other"))
    # an acronym of two different places means neither for sure
    short = short.join(meant.where("entity = other"), ["stem", "acronym"]).select("stem", "name", "entity")
    return named.unionByName(places.select("stem", "name", "entity")).unionByName(short)


def variant_pairs(found: DataFrame) -> DataFrame:
    """(stem, name_a, name_b), name_a < name_b, of (stem, name, entity) rows: the different strings of one entity."""
    found = written(found, "name-variants")
    a = found.select("stem", "entity", F.col("name").alias("name_a"))
    b = found.select("stem", "entity", F.col("name").alias("name_b"))
    return a.join(b, ["stem", "entity"]).where("name_a < name_b").select("stem", "name_a", "name_b").distinct()
