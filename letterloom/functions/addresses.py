"""Recipient strings, addresses and greeting tokens as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from letterloom.functions.text import STOP_WORDS

# Words that are no first or last names although addresses hold them.
# The company's own name is added from the domain by ``name_stop_words``.
NOT_NAMES: tuple[str, ...] = (
    "2000", "product", "call", "guy", "businesses", "date", "stock", "chance", "day",
    "information", "weeks", "forward", "track", "book", "little", "com", "experience", "quick",
)

GREETING_WINDOW = 100  # characters of the body that may hold the greeting, by default
GREETING_BREAK = r"[\p{Punct} ]|(?<=\p{Ll})(?=\p{Lu}[\s\S])"


def name_stop_words(domain: str, extra: Sequence[str] = ()) -> tuple[str, ...]:
    """General stop words, words of addresses that are no names, and the company's own name."""
    return (*STOP_WORDS, *NOT_NAMES, domain.split(".")[0], *extra)


def split_ids(c: Column) -> Column:
    """Ids of a string; white space at its ends gives no id, and an empty string none at all."""
    return F.transform(F.filter(F.split(c, r"\s+"), lambda x: x != ""), lambda x: x.cast("bigint"))


def glue_recipients(c: Column) -> Column:
    """Addresses from a raw string; pieces without ``@`` are glued to the next one."""
    pieces = F.filter(F.split(c, r"\s+"), lambda x: x != "")
    ends = F.filter(F.transform(pieces, lambda x, i: F.when(F.contains(x, F.lit("@")), i)), lambda i: i.isNotNull())

    def run(end: Column, k: Column) -> Column:
        start = F.coalesce(F.get(ends, k - 1) + 1, F.lit(0))
        return F.array_join(F.slice(pieces, start + 1, end - start + 1), "")

    return F.transform(ends, run)


def filter_recipients(c: Column) -> Column:
    """Space-separated pieces that contain ``@``."""
    return F.filter(F.split(c, " "), lambda x: F.contains(x, F.lit("@")))


def repair_date(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("0001"), F.lit("2001")), F.lit("0002"), F.lit("2002"))


def _local(address: Column) -> Column:
    return F.substring_index(address, "@", 1)


def _domain(address: Column) -> Column:
    return F.get(F.split(address, "@"), F.lit(1))


def first_name(address: Column, domain: str) -> Column:
    """Text before the first dot, when that dot stands before the ``@``; else null."""
    dot, at = F.instr(address, "."), F.instr(address, "@")
    ok = (dot > 0) & (dot < at) & (_domain(address) == domain)
    return F.when(ok, F.substring_index(address, ".", 1))


def last_name(address: Column, domain: str) -> Column:
    """Second dot part of the local part; its dot must not touch the ``@``; else null."""
    dot, at = F.instr(address, "."), F.instr(address, "@")
    ok = (dot > 0) & (dot < at - 1) & (_domain(address) == domain)
    return F.when(ok, F.get(F.split(_local(address), r"\."), F.lit(1)))


def name_parts(address: Column) -> Column:
    """Dot parts of the local part, as compared with greeting words."""
    return F.split(_local(address), r"\.")


def greeting_tokens(body: Column, window: int = GREETING_WINDOW) -> Column:
    """Words of the first characters of a body; a word still open there is dropped."""
    words = F.split(F.substring(body, 1, window), GREETING_BREAK, -1)
    closed = F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0)))
    return F.filter(closed, lambda w: F.length(w) > 1)


def clean_name(name: Column) -> Column:
    """Tagged person name: part before ``/`` without digits."""
    return F.regexp_replace(F.substring_index(name, "/", 1), "[0-9]", "")
