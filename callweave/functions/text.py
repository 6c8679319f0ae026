"""Scalar text functions as Spark columns; Python's notion of whitespace and digits."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: What Python counts as whitespace.
SPACE = r"[\s\x1c-\x1f\x85\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
#: The tags that stand for masked values, by type.
TAGS = {"name": "[이름]", "birthdate": "[생년월일]", "phone": "[전화번호]"}
TAG_PATTERN = r"\[이름\]|\[생년월일\]|\[전화번호\]"
#: The shapes of phone numbers and birth dates, and the marks that no name holds.
PHONE_SHAPE = r"\+?[0-9][0-9 \t().-]*[0-9]"
BIRTH_SHAPE = r"[0-9][0-9년월일생 \t./-]*[0-9일생]"
NAME_MARKS = r"[,.:;!?/()\[\]{}]"
#: Where Python splits lines.
LINE_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"


def rstrip(c: Column) -> Column:
    return F.regexp_replace(c, rf"{SPACE}+$(?![\s\S])", "")


def lstrip(c: Column) -> Column:
    return F.regexp_replace(c, rf"^{SPACE}+", "")


def strip(c: Column) -> Column:
    return lstrip(rstrip(c))


def chunk_text(c: Column) -> Column:
    """The text of a chunk: null as empty, without whitespace at its end; at its front it stays."""
    return rstrip(F.coalesce(c, F.lit("")))


def is_blank(c: Column) -> Column:
    return ~c.rlike(SPACE.replace("[", "[^", 1))


def phone_digits(c: Column) -> Column:
    """The decimal digits of all scripts."""
    return F.regexp_replace(c, r"[^\p{Nd}]", "")


def phone_pattern(digits: str) -> str:
    """Matches a number with any separators between its digits, not within a longer run of digits."""
    return r"(?<!\p{Nd})" + r"[ \t().-]*".join(digits) + r"(?!\p{Nd})"


def canonical(c: Column) -> Column:
    """Letters and digits, case folded; see `canonical_exact` for the few letters whose folding isn't lower case."""
    return F.lower(F.regexp_replace(c, r"[^\p{L}\p{N}]", ""))


@F.pandas_udf(StringType())
def canonical_exact(s: pd.Series) -> pd.Series:
    return s.map(lambda t: None if t is None else "".join(ch for ch in t if ch.isalnum()).casefold())


def joined(before: Column, text: Column) -> Column:
    """The two texts, with one space between unless the second begins with whitespace."""
    return F.when(text.rlike(rf"^{SPACE}"), F.concat(before, text)).otherwise(F.concat(before, F.lit(" "), text))


def lines(c: Column) -> Column:
    """The lines of a text without their ends; an end of line at the end of the text opens no further line."""
    parts = F.split(c, LINE_BREAK, -1)
    return F.when(c == "", F.array().cast("array<string>")).when(F.element_at(parts, -1) == "", F.slice(parts, F.lit(1), F.size(parts) - 1)).otherwise(parts)


def tokens(c: Column) -> Column:
    """Tags as they are, everything else character by character."""
    return F.regexp_extract_all(c, F.lit(rf"(?s)({TAG_PATTERN}|.)"), F.lit(1))


def after_last_return(c: Column) -> Column:
    """What a progress line shows in the end."""
    return F.substring_index(c, "\r", -1)


def looks_like(tag: Column, value: Column) -> Column:
    """Whether a value has the shape of the tag's kind; used where adjacent tags are told apart."""
    digits = F.length(phone_digits(value))
    phone = digits.between(7, 15) & value.rlike(rf"^{PHONE_SHAPE}\z")
    birth = (F.length(value) <= 40) & (digits >= 4) & value.rlike(rf"^{BIRTH_SHAPE}\z")
    name = (F.length(value) <= 20) & ~value.rlike(r"\p{Nd}") & ~value.rlike(NAME_MARKS)
    return F.coalesce((value != "") & F.when(tag == TAGS["phone"], phone).when(tag == TAGS["birthdate"], birth).when(tag == TAGS["name"], name), F.lit(False))


def plausible(tag: Column, value: Column) -> Column:
    """The stricter check of a value that was found by comparing texts: stripped, and names in short pieces."""
    pieces = F.split(strip(value), rf"{SPACE}+")
    short = (F.size(pieces) == 1) | F.forall(pieces, lambda p: F.length(p) <= 2)
    stripped = value == strip(value)
    return F.coalesce(looks_like(tag, value) & stripped & F.when(tag == TAGS["name"], short).otherwise(F.lit(True)), F.lit(False))
