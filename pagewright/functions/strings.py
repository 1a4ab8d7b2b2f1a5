"""Text functions.  `W` spells the word class out, since Java's \\w knows ASCII only."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

W = r"[\p{L}\p{N}_]"
#: A word boundary that treats letters of all scripts alike.
BOUNDARY = rf"(?:(?<={W})(?!{W})|(?<!{W})(?={W}))"


def strip(c: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def split_words(c: Column) -> Column:
    """White-space separated words; none of them empty."""
    return F.filter(F.split(c, r"\s+"), lambda w: w != "")


def word_tokens(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(rf"({W}+)"), 1)


def is_digits(c: Column) -> Column:
    return c.rlike(r"^\p{Nd}+$")


def is_identifier_word(c: Column, safe: tuple[str, ...]) -> Column:
    """Whether a harvested word may be removed: longer than two, not only digits, no mask, not a safe word."""
    return ~is_digits(c) & (F.length(c) > 2) & (c != "***") & ~F.lower(c).isin(*safe)


def control_to_space(c: Column) -> Column:
    return F.regexp_replace(c, r"[\x00-\x1F\x7F]", " ")


#: Signs that a label loses; what an orientation reading says.
FORBIDDEN = r'[\\/*?:"<>|\n\t]'
ANGLE, CONFIDENCE = r"Rotate: (\d+)", r"Orientation confidence: (\d+(?:\.\d+)?)"


def sanitised_label(c: Column) -> Column:
    """A label fit for a file name: forbidden signs out, blanks as `_`, at most 40 characters, never empty."""
    kept = strip(F.replace(F.regexp_replace(c, FORBIDDEN, ""), F.lit(" "), F.lit("_")))
    return F.substring(F.coalesce(F.nullif(kept, F.lit("")), F.lit("unnamed_text")), 1, 40)


def int_list(c: Column) -> Column:
    """Integers of a comma-separated list; null where one is malformed."""
    parts = F.transform(F.split(c, ","), lambda x: F.trim(x).try_cast("int"))
    return F.when(F.exists(parts, lambda x: x.isNull()), None).otherwise(parts)


def list_cell(c: Column) -> Column:
    """A list as one cell of a report; `None` for an empty or missing one."""
    return F.when(F.size(c) > 0, F.array_join(c, ", ")).otherwise("None")


def context(text: Column, term: Column, around: int = 35) -> Column:
    """The first occurrence of a term with what stands around it, on one line, between dots."""
    at = F.call_function("locate", term, text)
    start = F.greatest(at - around, F.lit(1))
    end = F.least(at + F.length(term) + around, F.length(text) + 1)
    piece = F.substring(text, start, end - start)
    return F.concat(F.lit("..."), F.replace(piece, F.lit("\n"), F.lit(" ")), F.lit("..."))


def orientation_angle(c: Column) -> Column:
    """Degrees of an orientation reading such as `Rotate: 90`; null if there is none."""
    found = F.regexp_extract(c, ANGLE, 1)
    return F.when(found != "", found.cast("int"))


def orientation_confidence(c: Column) -> Column:
    found = F.regexp_extract(c, CONFIDENCE, 1)
    return F.when(found != "", found.cast("double"))


def reading_of(text: str) -> tuple[int | None, float | None]:
    """(angle, confidence) of an orientation reading, as `orientation_angle` and `orientation_confidence` tell them."""
    angle, confidence = re.search(ANGLE, text or ""), re.search(CONFIDENCE, text or "")
    return int(angle[1]) if angle else None, float(confidence[1]) if confidence else None


#: Tokens that models put around what they say.
SPECIAL = r"<\|[^|<>]*\|>|</?s>|<(?:pad|unk|bos|eos)>"


def without_special_tokens(c: Column, prompt: Column | None = None) -> Column:
    """What a model said: without the prompt that it repeats first, without special tokens, stripped."""
    said = c if prompt is None else F.when(F.startswith(c, prompt), F.substring(c, F.length(prompt) + 1, F.length(c))).otherwise(c)
    return strip(F.regexp_replace(said, SPECIAL, ""))


def strip_markup(c: Column) -> Column:
    """Text of marked-up pages by a chain of expressions: comments, scripts, tags, entities, then blanks.

    The structural parser in `operators.documents` is exact; this one stays inside code generation.
    """
    c = F.regexp_replace(c, r"(?s)<!--.*?-->", " ")
    c = F.regexp_replace(c, r"(?is)<(script|style)[^>]*>.*?</(script|style)>", " ")
    c = F.regexp_replace(c, r"(?s)</?[A-Za-z][^<>]*>", " ")
    c = F.regexp_replace(c, r"(?m)^ {0,3}#{1,6} +", "")
    c = F.regexp_replace(c, r"(?m)^\|?[ :|-]*-{3}[ :|-]*$", " ")
    c = F.regexp_replace(c, r"\*\*|__|~~|`+", "")
    for name, sign in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")):
        c = F.replace(c, F.lit(name), F.lit(sign))
    return strip(F.regexp_replace(c, r"\s+", " "))


def ngrams(words: Column, size: int) -> Column:
    """All runs of `size` words, joined by blanks; none if there are fewer words."""
    def of(w: Column) -> Column:
        last = F.size(w) - size
        return F.when(last < 0, F.array().cast("array<string>")).otherwise(F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.array_join(F.slice(w, i + 1, size), " ")))

    return F.element_at(F.transform(F.array(words), of), 1)  # binds the words once, instead of once for each run
