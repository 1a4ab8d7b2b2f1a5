"""Problem 10: one form for texts that look the same.

Compatibility forms, invisible characters and spaces of other widths are brought to the usual ones.  Then each token
gets its dominant script; look-alike letters of other scripts are substituted where the token mixes scripts (or is
foreign to its text and made of look-alikes only), and only if the result is a word of the corpus.
"""

from __future__ import annotations

import functools
import re
import unicodedata
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

#: Letters of the Latin, Cyrillic and Greek scripts that look alike, in this order.
LOOKALIKES = (
    ("a", "а", "α"), ("c", "с", ""), ("d", "ԁ", ""), ("e", "е", ""), ("h", "һ", ""), ("i", "і", "ι"), ("j", "ј", ""), ("k", "к", "κ"),
    ("l", "ӏ", ""), ("n", "", "η"), ("o", "о", "ο"), ("p", "р", "ρ"), ("q", "ԛ", ""), ("s", "ѕ", ""), ("u", "", "υ"), ("v", "ѵ", "ν"),
    ("w", "ԝ", "ω"), ("x", "х", "χ"), ("y", "у", "γ"), ("A", "А", "Α"), ("B", "В", "Β"), ("C", "С", ""), ("E", "Е", "Ε"), ("G", "Ԍ", ""),
    ("H", "Н", "Η"), ("I", "І", "Ι"), ("J", "Ј", ""), ("K", "К", "Κ"), ("M", "М", "Μ"), ("N", "", "Ν"), ("O", "О", "Ο"), ("P", "Р", "Ρ"),
    ("S", "Ѕ", ""), ("T", "Т", "Τ"), ("W", "Ԝ", ""), ("X", "Х", "Χ"), ("Y", "Ү", "Υ"), ("Z", "", "Ζ"), ("ï", "ї", ""), ("ë", "ё", ""),
)
SCRIPTS = ("latin", "cyrillic", "greek")
#: Confirmed results are broadcast up to this number (of about 60 bytes each); beyond it they are joined to the documents.
BROADCAST_WORDS = 300_000
#: Different words a task holds before it hands them on; bounds its memory, drops nothing.
HELD_WORDS = 400_000

TO: dict[str, dict[str, str]] = {s: {} for s in SCRIPTS}
for _row in LOOKALIKES:
    for _k, _script in enumerate(SCRIPTS):
        for _other in range(3):
            if _other != _k and _row[_k] and _row[_other]:
                TO[_script][_row[_other]] = _row[_k]
AMBIGUOUS = frozenset(c for _row in LOOKALIKES for c in _row)
SKELETON = str.maketrans({c: _row[0] for _row in LOOKALIKES for c in _row[1:] if c})

#: Letters with the accents that stand on them, and the same for texts without accents of their own.
MARK = re.compile("[\u0300-\u036f]")
PLAIN = re.compile(r"[^\W\d_]+")
TOKEN = re.compile("(?:[^\\W\\d_][\u0300-\u036f]*)+")
INVISIBLE = re.compile("[­͏؜ᅟᅠ឴឵᠋-᠎​-‏‪-‮⁠-⁤⁪-⁯︀-️﻿]")
SPACES = re.compile("[   -   　]")
SAME = str.maketrans({"‐": "-", "‑": "-", "ʼ": "'", "’": "'", "‘": "'", "\x0b": "\n", "\x0c": "\n", " ": "\n", " ": "\n", "\x85": "\n"})


#: Code points of the scripts; accents belong to all of them.
RANGES = {"latin": "\u0041-\u005a\u0061-\u007a\u00aa-\u024f\u1e00-\u1eff", "cyrillic": "\u0400-\u052f", "greek": "\u0370-\u03ff\u1f00-\u1fff"}
ONLY = {s: re.compile(f"[{r}\u0300-\u036f]+") for s, r in RANGES.items()}
NOT_LATIN = re.compile(f"[{RANGES['cyrillic']}{RANGES['greek']}]")
#: Letters that no letter of another script resembles.
SURE = {s: re.compile(f"(?![{''.join(sorted(AMBIGUOUS - {''}))}])[{r}]") for s, r in RANGES.items()}
#: Signs whose compatibility form looks different: raised, lowered and encircled ones and fractions; from Unicode's own table.
RAISED = re.compile("[" + "".join(chr(o) for o in range(0xA0, 0x1F300) if unicodedata.decomposition(chr(o)).startswith(("<super>", "<sub>", "<circle>", "<square>", "<fraction>")) and not 0x3300 <= o < 0x3400) + "]")


@functools.cache
def script_of(c: str) -> str:
    return next((s for s in SCRIPTS if ONLY[s].match(c)), "other")


def folded(text: str) -> str:
    """Compatibility composition, without invisible characters, with plain spaces, line ends and hyphens.

    Raised, lowered and encircled signs and fractions stay, since their compatibility forms look different.
    """
    if text.isascii():
        return text.replace("\r\n", "\n").replace("\r", "\n") if "\r" in text else text
    odd, normal = ODD.search(text), unicodedata.is_normalized("NFKC", text)
    if not odd and normal:
        return text
    if odd:
        text = INVISIBLE.sub("", text)
    if not normal:
        kept = RAISED.search(text)
        text = "".join(x if k % 2 else unicodedata.normalize("NFKC", x) for k, x in enumerate(RAISED_SPLIT.split(text))) if kept else unicodedata.normalize("NFKC", text)
        text = INVISIBLE.sub("", text)
    text = SPACES.sub(" ", text)
    if UNUSUAL.search(text):
        text = text.translate(SAME)
    return text.replace("\r\n", "\n").replace("\r", "\n")


RAISED_SPLIT = re.compile(f"({RAISED.pattern})")
UNUSUAL = re.compile("[" + "".join(map(chr, SAME)) + "]")
ODD = re.compile(f"{INVISIBLE.pattern}|{SPACES.pattern}|{UNUSUAL.pattern}|\r")


def _dominant(counts: dict[str, int]) -> str:
    return max(SCRIPTS, key=lambda s: (counts.get(s, 0), -SCRIPTS.index(s)))


def _scripts(letters: str) -> dict[str, int]:
    counts: dict[str, int] = {}
    for c in letters:
        if not unicodedata.combining(c):
            s = script_of(c)
            counts[s] = counts.get(s, 0) + 1
    return counts


def text_script(text: str) -> str:
    """The script of most of those letters of a folded text that no other script resembles."""
    if not NOT_LATIN.search(text):
        return "latin"
    return _dominant({s: len(text) - len(SURE[s].sub("", text)) for s in SCRIPTS})


def tokens_of(text: str) -> re.Pattern:
    return TOKEN if MARK.search(text) else PLAIN


def suggestions(text: str) -> Iterator[tuple[int, int, list[str]]]:
    """(start, end, results in order) of the tokens of a folded text that may hold look-alikes of another script.

    A mixed token is brought to its dominant script, on a tie or failing that to the text's; a token of one script
    that is foreign to the text is brought to the text's script if all its letters have a look-alike there.  Accents
    stay on their letters.
    """
    if not NOT_LATIN.search(text):  # the letters are Latin, or of scripts that nothing here resembles
        return
    whole = text_script(text)
    native = ONLY[whole].fullmatch
    for m in tokens_of(text).finditer(text):
        token = m[0]
        if token.isascii() and whole == "latin" or native(token):
            continue
        letters = unicodedata.normalize("NFD", token)
        s = _scripts(letters)
        if "other" in s:
            continue
        out = []
        for script in dict.fromkeys((_dominant(s), whole) if len(s) > 1 else (whole,)):
            to = TO[script]
            result = "".join(c if unicodedata.combining(c) or script_of(c) == script else to.get(c, "") or "\0" for c in letters)
            if "\0" not in result and result != letters:
                out.append(unicodedata.normalize("NFC", result))
        if out:
            yield m.start(), m.end(), out


def repaired(text: str, is_word: Callable[[str], bool]) -> str:
    """The folded text with look-alikes substituted where the result is a word of the corpus."""
    out, at = [], 0
    for start, end, results in suggestions(text):
        for result in results:
            if is_word(result.lower()):
                out += (text[at:start], result)
                at = end
                break
    return "".join(out) + text[at:] if out else text


#: Bytes of ASCII texts: letters in lower case, all others as blanks.
LETTERS = bytes(ord(chr(o).lower()) if chr(o).isascii() and chr(o).isalpha() else 32 for o in range(256))


def native_words(text: str) -> set[str]:
    """The words of a folded text, in lower case, that are of its own script; disguised ones would vouch for each other."""
    if text.isascii():
        return set(text.encode().translate(LETTERS).decode().split())
    words = set(tokens_of(text).findall(text.lower()))
    if not NOT_LATIN.search(text):
        return words
    native = ONLY[text_script(text)].fullmatch
    return {w for w in words if native(w)}


def beyond_ascii():
    """Texts that need folding or may hold look-alikes; all others are their own form but for line ends.  Null counts as ASCII."""
    return F.coalesce(F.octet_length("text") > F.length("text"), F.lit(False))


def bounded_words(words: DataFrame) -> frozenset[str] | None:
    """The words, or None where there are more than BROADCAST_WORDS."""
    found = words.limit(max(0, BROADCAST_WORDS) + 1).toArrow().column(0).to_pylist()
    return frozenset(found) if len(found) <= BROADCAST_WORDS else None


def canonical(documents: DataFrame) -> DataFrame:
    """(doc_id, n_chars, text, form) of all (doc_id, text) rows: length and hash of the text, and its form; null stays null.

    An empty text has an empty form.  Texts of ASCII alone get their form in the JVM.  The others are folded once, into a
    table; most have their form then.  Those with tokens that may hold look-alikes ask for words, every text is looked
    through for words that somebody asks for and that are of its own script, and then they are repaired.
    """
    spark = documents.sparkSession
    rows = documents.select("doc_id", F.length("text").alias("n_chars"), F.sha2("text", 256).alias("hash"), "text")
    names = ["doc_id", "n_chars", "text", "form", "wanted"]

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            forms = [folded(t) for t in batch.column(3).to_pylist()]
            wanted = [sorted({r.lower() for _, _, results in suggestions(t) for r in results}) for t in forms]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), batch.column(1), batch.column(2).cast(pa.string()), pa.array(forms, pa.string()), pa.array([w or None for w in wanted], pa.list_(pa.string()))], names)

    other = written(rows.where(beyond_ascii()).mapInArrow(fold, "doc_id long, n_chars int, text string, form string, wanted array<string>"), "folded-texts")
    plain = rows.where(~beyond_ascii()).select("doc_id", "n_chars", F.col("hash").alias("text"), F.regexp_replace("text", r"\r\n?", "\n").alias("form"))
    asking = other.where("wanted is not null")
    words = corpus_words(plain.select("form").unionByName(other.select("form")), asking.select(F.explode("wanted").alias("word")).distinct())
    known = spark.sparkContext.broadcast(bounded_words(words))
    small = known.value is not None

    def repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(3).to_pylist()
            own = [known.value] * len(texts) if small else [frozenset(x or ()) for x in batch.column(4).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array([repaired(t, w.__contains__) for t, w in zip(texts, own)], pa.string())], names[:4])

    if not small:
        each = asking.select("doc_id", "text", F.explode("wanted").alias("word")).distinct().join(words, "word")
        asking = asking.drop("wanted").join(each.groupBy("doc_id", "text").agg(F.collect_set("word").alias("own")), ["doc_id", "text"], "left").select(*names[:4], "own")
    done = asking.mapInArrow(repair, "doc_id long, n_chars int, text string, form string")
    return plain.unionByName(other.where("wanted is null").drop("wanted")).unionByName(done)


def corpus_words(forms: DataFrame, wanted: DataFrame) -> DataFrame:
    """(word): those of the wanted words, in lower case, that stand somewhere in a text (form) of their own script."""
    spark = forms.sparkSession
    asked = spark.sparkContext.broadcast(bounded_words(wanted))

    def stands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: set[str] = set()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if text:
                    found = native_words(text)
                    words |= found if asked.value is None else asked.value & found
            if len(words) > HELD_WORDS:
                yield pa.RecordBatch.from_arrays([pa.array(list(words), pa.string())], ["word"])
                words.clear()
        yield pa.RecordBatch.from_arrays([pa.array(list(words), pa.string())], ["word"])

    standing = forms.mapInArrow(stands, "word string").distinct()
    return standing if asked.value is not None else standing.join(wanted, "word", "left_semi")


def look_alike_pairs(documents: DataFrame, least: int = 100) -> DataFrame:
    """(doc_id_a, doc_id_b), a < b: documents of at least `least` characters with one form but different texts.

    Classes are formed over different texts first, so that copies of one text meet only the copies of another.
    """
    rows = canonical(documents).where(F.col("n_chars") >= least)  # shorter texts vouch for words as well
    form = F.sha2(F.regexp_replace("form", r"[ \t]+(?=\n|$)", ""), 256).alias("form")
    rows = written(rows.select("doc_id", form, "text"), "lookalike-forms")
    several = rows.groupBy("form").agg(F.min("text").alias("a"), F.max("text").alias("b")).where("a != b").select("form")
    rows = written(rows.join(several, "form", "left_semi"), "lookalike-classes")
    texts = rows.select("form", "text").distinct()
    a, b = texts.select("form", F.col("text").alias("text_a")), texts.select("form", F.col("text").alias("text_b"))
    pairs = a.join(b, "form").where("text_a < text_b")
    left = rows.select("form", F.col("text").alias("text_a"), F.col("doc_id").alias("x"))
    right = rows.select("form", F.col("text").alias("text_b"), F.col("doc_id").alias("y"))
    met = pairs.join(left, ["form", "text_a"]).join(right, ["form", "text_b"])
    return met.select(F.least("x", "y").alias("doc_id_a"), F.greatest("x", "y").alias("doc_id_b"))
