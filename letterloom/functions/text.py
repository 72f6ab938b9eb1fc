"""Body clean-up and tokenization as column expressions."""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Sequence
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Default stop words, the common English function words.
# Every tokenizer takes its own list as a parameter.
STOP_WORDS: tuple[str, ...] = tuple(
    """
    a about above after again against all also am an and any are as at be because
    been before being below between both but by can could did do does doing down
    during each few for from further had has have having he her here hers herself
    him himself his how i if in into is it its itself just me more most my myself
    no nor not now of off on once only or other our ours ourselves out over own
    same she should so some such than that the their theirs them themselves then
    there these they this those through to too under until up very was we were
    what when where which while who whom why will with would you your yours
    yourself yourselves
    """.split()
)

# Number words that count as numbers, next to digit forms.
NUMBER_WORDS: tuple[str, ...] = tuple(
    """
    zero one two three four five six seven eight nine ten eleven twelve thirteen
    fourteen fifteen sixteen seventeen eighteen nineteen twenty thirty forty fifty
    sixty seventy eighty ninety hundred thousand million billion trillion
    """.split()
)

# Patterns that define the results.  Each starts with a cheap test of
# one character, so that most positions of a text fail at once.
FORWARD_HEADER = r"----[- \t\n\r\f\x0B]*(Original|Forwarded)[^\n]*Subject:"
ORIGINAL_MESSAGE = "-----Original Message-----"
BOUNDARY = r"(?=[A-Z])(?<=[a-z])|(?<=[0-9])(?=[a-zA-Z])"
SENTENCE_END = r"(?<=[.!?])[ \t\r\n\f]+"
BLANKS = r"[ \t\r\n\f]+"
INFIX = "(?=[-.?!,])(?:" + "|".join(
    (
        r"\.\.\.",
        r"(?<=[a-z0-9])\.(?=[a-zA-Z0-9\[\]_\-*])",
        r"(?<=[a-zA-Z0-9])--(?=[a-zA-Z0-9\[\\\]^_`])",
        r"(?<=[a-zA-Z0-9])[-?!](?=[a-zA-Z0-9])",
        r"(?<=[A-Za-z0-9]),(?=[A-Za-z\[])",
    )
) + ")"
_EDGE = r"[.,;:!?\"'()\[\]{}<>]"
EDGES = rf"(?={_EDGE})(?:(?<![^ ]){_EDGE}+|{_EDGE}+(?![^ ]))"
PLAIN_WORD = "^[a-z]{2,}$"
REJECTED = "|".join(
    (
        r"_|--|[*/:=(\])#|@+]",  # structure characters
        r"^\p{Punct}+$",
        r"^[0-9]+([.,/][0-9]+)*$",  # numbers
        r"^(https?:|www\.)|\.(com|org|net|edu|gov)(/|$)",
    )
)


@lru_cache(maxsize=1)
def accent_table() -> tuple[str, str]:
    """(matching, replacement) for ``translate``: every BMP letter that NFD takes
    apart maps to its base letter; combining marks come last and are deleted."""
    kept, bases, marks = [], [], []
    for cp in range(0x80, min(sys.maxunicode, 0xFFFF) + 1):
        ch = chr(cp)
        if 0xD800 <= cp <= 0xDFFF:
            continue
        if unicodedata.category(ch) == "Mn":
            marks.append(ch)
            continue
        parts = unicodedata.normalize("NFD", ch)
        base = unicodedata.normalize("NFC", "".join(c for c in parts if unicodedata.category(c) != "Mn"))
        if base != ch and len(base) == 1:
            kept.append(ch)
            bases.append(base)
    return "".join(kept + marks), "".join(bases)


def deaccent(c: Column) -> Column:
    """Drop accents; texts without any non-ASCII character are passed through."""
    matching, replacement = accent_table()
    return F.when(c.rlike(r"[^\x00-\x7F]"), F.translate(c, matching, replacement)).otherwise(c)


def strip_forward(c: Column) -> Column:
    """Remove forward headers; the word Original or Forwarded stays on its own line."""
    return F.regexp_replace(c, FORWARD_HEADER, "\n$1\n")


def is_forward(c: Column) -> Column:
    return F.contains(c, F.lit(ORIGINAL_MESSAGE))


def drop_quote_marks(c: Column) -> Column:
    return F.replace(c, F.lit(">"), F.lit(" "))


def split_boundaries(c: Column) -> Column:
    """Put a space into ``lowerUpper`` and ``4letters``."""
    return F.regexp_replace(c, BOUNDARY, " ")


def clean_body(c: Column) -> Column:
    return drop_quote_marks(strip_forward(deaccent(c)))


def normalize_text(c: Column) -> Column:
    return split_boundaries(clean_body(c))


def sentences(c: Column) -> Column:
    """Non-blank sentences: break after ``. ! ?`` followed by white space."""
    return F.filter(F.split(c, SENTENCE_END, -1), lambda s: s.rlike(r"[^ \t\r\n\f]"))


def infix_split(c: Column) -> Column:
    """Set infix punctuation between letters or digits off by spaces."""
    return F.regexp_replace(c, f"({INFIX})", " $1 ")


def strip_punct(c: Column) -> Column:
    return F.regexp_replace(c, r"\p{Punct}", "")


def strip_digits(c: Column) -> Column:
    return F.regexp_replace(c, "[0-9]", "")


def _spaced(c: Column) -> Column:
    """Text whose tokens stand between single spaces, without edge punctuation.

    Works on the text as a whole: one pass per rule instead of one per token.
    """
    spaced = F.regexp_replace(infix_split(split_boundaries(c)), BLANKS, " ")
    return F.regexp_replace(spaced, EDGES, "")


def pieces(c: Column) -> Column:
    """Raw tokens in text order, before any filter."""
    return F.filter(F.split(_spaced(c), " ", -1), lambda w: w != "")


def _kept_words(
    spaced: Column,
    stop_words: Sequence[str] = STOP_WORDS,
    extended: bool = True,
    extra_stop_words: Sequence[str] = (),
    excluded: Column | None = None,
) -> Column:
    """Words of a spaced text that pass the bag filter, in their stored form.

    Both forms drop stop words, numbers, URLs, punctuation, one-letter words and
    tokens with structure characters.  ``extended`` also strips punctuation and
    digits from the word and tests it against ``extra_stop_words``.
    ``excluded`` is an array of lower-case words to leave out, such as names.
    """
    skipped = (*stop_words, *NUMBER_WORDS)

    def one(low: Column) -> Column:
        if extended:
            bare = F.regexp_replace(low, r"[\p{Punct}0-9]", "")
            stored = F.when(F.length(bare) > 1, bare)
        else:
            bare = F.when(low.rlike("^-|-$"), F.replace(low, F.lit("-"), F.lit(""))).otherwise(low)
            stored = F.when(F.length(low) > 1, bare)
        # plain words, by far the most, need no further look
        word = F.when(low.isin(*skipped), F.lit(None)).when(low.rlike(PLAIN_WORD), low)
        if excluded is not None:
            word = F.when(F.array_contains(excluded, low), F.lit(None)).when(low.isin(*skipped), F.lit(None)).when(
                low.rlike(PLAIN_WORD), low
            )
        return word.when(low.rlike(REJECTED), F.lit(None)).otherwise(stored)

    words = F.filter(F.transform(F.split(F.lower(spaced), " ", -1), one), lambda w: w.isNotNull())
    if extended and extra_stop_words:
        words = F.filter(words, lambda w: ~w.isin(*extra_stop_words))
    return words


def bag_of_words(body: Column, **options) -> Column:
    """Body to one token array, in text order.

    Sentences end at white space, as tokens do, so they need not be told apart.
    """
    return _kept_words(_spaced(clean_body(body)), **options)


def sentence_tokens(body: Column, first: int = -1, **options) -> Column:
    """Body to one token array per sentence; sentences may end up empty.

    ``first`` keeps only that many leading sentences; negative keeps all.
    """
    sents = sentences(clean_body(body))
    if first >= 0:
        sents = F.slice(sents, 1, first) if first else F.array().cast("array<string>")
    return F.transform(sents, lambda s: _kept_words(_spaced(s), **options))


def distinct_tokens(tokens: Column) -> Column:
    return F.sort_array(F.array_distinct(tokens))
