"""Masking of names and phone numbers that are known beforehand.

The registry is one document. Up to CHAIN_ENTRIES entries become a chain of literal replacements in one projection: no
join, no Python. A longer registry is applied in the same order by a function on Arrow batches, which skips what a text
doesn't hold; either way gives the same texts.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions.text import PHONE_SHAPE, TAGS, phone_pattern

CHAIN_ENTRIES = 500
#: Stand for the tags while names are replaced, and for themselves if a text holds them.
_MARKS = {tag: chr(0xE000 + i) for i, tag in enumerate(TAGS.values())}
_ESCAPE = chr(0xE003)


class RegistryError(ValueError):
    """A registry that can't be used; the run must not begin."""


@dataclass(frozen=True)
class Registry:
    """Names in order without repeats, and phone numbers by their digits in the writing given first."""

    names: tuple[str, ...] = ()
    phones: tuple[tuple[str, str], ...] = ()

    @classmethod
    def of(cls, document: dict) -> Registry:
        """Checks a document {schema_version: 1, names: [...], phone_numbers: [...]}."""
        if not isinstance(document, dict) or document.get("schema_version") != 1:
            raise RegistryError("schema_version must be 1")
        entries = {}
        for field in ("names", "phone_numbers"):
            values = document.get(field)
            if not isinstance(values, list):
                raise RegistryError(f"{field} must be a list")
            if not all(isinstance(v, str) and v.strip() for v in values):
                raise RegistryError(f"{field} must hold texts that aren't blank")
            entries[field] = [v.strip() for v in values]
        names = tuple(dict.fromkeys(entries["names"]))
        if any(tag in name for name in names for tag in TAGS.values()):
            raise RegistryError("a name can't hold a tag")
        phones: dict[str, str] = {}
        for number in entries["phone_numbers"]:
            digits = "".join(c for c in number if c.isdecimal())
            if not (7 <= len(digits) <= 15 and re.fullmatch(PHONE_SHAPE, number)):
                raise RegistryError("a phone number must have 7 to 15 digits and separators only")
            phones.setdefault(digits, number)
        return cls(names, tuple(phones.items()))

    @classmethod
    def read(cls, df: DataFrame) -> Registry:
        """From a table of one row (schema_version, names, phone_numbers)."""
        rows = df.select("schema_version", "names", "phone_numbers").limit(2).collect()
        if len(rows) != 1:
            raise RegistryError("the registry must have one row")
        return cls.of(rows[0].asDict())


def mask_known(text: Column, registry: Registry) -> Column:
    """The text with known phone numbers, then known names replaced by their tags, each longest first.

    Replacements follow one another, so a shorter name may match what a longer one left. Names aren't replaced
    inside tags. A `+` before a number stays. Null stays null.
    """
    if len(registry.names) + len(registry.phones) > CHAIN_ENTRIES:
        return _masked_in_batches(registry)(text)
    out = text
    for digits, _ in sorted(registry.phones, key=lambda p: -len(p[0])):
        out = F.regexp_replace(out, phone_pattern(digits), TAGS["phone"])
    if not registry.names:
        return out
    for i, mark in enumerate((_ESCAPE, *_MARKS.values())):
        out = F.replace(out, F.lit(mark), F.lit(f"{_ESCAPE}{i}"))
    for tag, mark in _MARKS.items():
        out = F.replace(out, F.lit(tag), F.lit(mark))
    for name in sorted(registry.names, key=lambda n: -len(n)):
        out = F.replace(out, F.lit(name), F.lit(_MARKS[TAGS["name"]]))
    for tag, mark in _MARKS.items():
        out = F.replace(out, F.lit(mark), F.lit(tag))
    for i, mark in reversed(list(enumerate((_ESCAPE, *_MARKS.values())))):
        out = F.replace(out, F.lit(f"{_ESCAPE}{i}"), F.lit(mark))
    return out


def _masked_in_batches(registry: Registry) -> Callable[[Column], Column]:
    numbers = [(digits, re.compile(r"(?<!\d)" + r"[ \t().-]*".join(digits) + r"(?!\d)")) for digits, _ in sorted(registry.phones, key=lambda p: -len(p[0]))]
    names = sorted(registry.names, key=lambda n: -len(n))
    tags = re.compile("(" + "|".join(map(re.escape, TAGS.values())) + ")")
    name_tag = TAGS["name"]

    def masked(text: str | None) -> str | None:
        if text is None:
            return None
        digits = "".join(str(int(c)) if c.isdecimal() else c for c in text if c not in " \t().-")
        for number, pattern in numbers:
            if number in digits:
                text = pattern.sub(TAGS["phone"], text)
        # tags stand apart, so that no name is found inside or across one
        parts = tags.split(text)
        for name in names:
            if any(name in part for part in parts[::2]):
                parts = [q for i, part in enumerate(parts) for q in ([part] if i % 2 else re.split("(" + re.escape(name_tag) + ")", part.replace(name, name_tag)))]
        return "".join(parts)

    @F.pandas_udf(StringType())
    def in_batches(texts: pd.Series) -> pd.Series:
        return texts.map(masked)

    return in_batches


def tag_counts(text: Column) -> dict[str, Column]:
    """How often each tag stands in a text."""
    return {kind: F.regexp_count(text, F.lit(re.escape(tag))) for kind, tag in TAGS.items()}
