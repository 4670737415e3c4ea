"""Names, codes and labels."""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Mapping
from functools import lru_cache

from pyspark.sql import Column, functions as F

# What Python's str.strip and re's \s treat as blank, as a Java character class body.
_BLANK = r"\s\x1c-\x1f\x85\p{Z}"
_FOOTNOTE = r"\[[^\]]*\]"
_SIGNIFICANT = frozenset("abcdefghijklmnopqrstuvwxyz0123456789[]")


def strip(value: Column) -> Column:
    """Trim every Unicode blank from both ends (``trim`` only trims spaces)."""
    return F.regexp_replace(value, f"^[{_BLANK}]+|[{_BLANK}]+$", "")


def is_blank(value: Column) -> Column:
    """True for null and for text of blanks only."""
    return F.coalesce(strip(value) == "", F.lit(True))


def drop_footnotes(value: Column) -> Column:
    return strip(F.regexp_replace(value, _FOOTNOTE, ""))


def _fold(text: str) -> str:
    decomposed = unicodedata.normalize("NFKD", text)
    return "".join(c for c in decomposed if not unicodedata.combining(c)).casefold()


# Stands for a character that folds to several; a private-use character no text should hold.
_RARE = "\uf8ff"


@lru_cache(maxsize=1)
def _fold_table() -> tuple[str, str]:
    """Arguments of ``translate`` for the first two planes, derived from Unicode itself.

    Characters that fold to one letter, digit or bracket are mapped to it,
    those that fold to several to the ``_RARE`` marker. The combining marks
    come last and have no counterpart, so they vanish. Every other character
    folds to a separator and needs no entry; the planes above hold only those.
    """
    source, target, marks = [], [], []
    for point in (*range(0x80, 0xD800), *range(0xE000, 0x20000)):
        char = chr(point)
        folded = _fold(char)
        if not folded:
            marks.append(char)
        elif folded in _SIGNIFICANT:
            source.append(char)
            target.append(folded)
        elif char == _RARE or (len(folded) > 1 and _SIGNIFICANT.intersection(folded)):
            source.append(char)
            target.append(_RARE)
    return "".join(source + marks), "".join(target)


@lru_cache(maxsize=1)
def _spelled_table() -> str:
    """The characters that ``_RARE`` stands for and what they fold to, as JSON, derived from Unicode itself."""
    points = (chr(p) for p in (*range(0x80, 0xD800), *range(0xE000, 0x20000)))
    folded = {c: _fold(c) for c in points}
    return json.dumps({c: f for c, f in folded.items() if len(f) > 1 and _SIGNIFICANT.intersection(f)})


def fold_accents(value: Column) -> Column:
    """Accent- and case-fold (compatibility decomposition, marks dropped).

    ASCII text (as many bytes as characters) is only lower-cased. One
    ``translate`` settles all other texts but those that hold a character with a
    multi-character folding (ligatures, Roman numerals); these are spelled out
    first, character by character, from a literal map. No accented Latin-1
    letter but ß is of that kind, so common texts skip the search.
    """
    text = F.replace(value, F.lit("ß"), F.lit("ss"))
    ascii_only = F.octet_length(text) == F.length(text)
    folded = F.translate(text, *_fold_table())
    unusual = text.rlike(r"[^\x00-\x7F\u00C0-\u00FF]")
    table = F.from_json(F.lit(_spelled_table()), "map<string,string>")
    spelled = F.array_join(F.transform(F.split(text, ""), lambda c: F.coalesce(F.try_element_at(table, c), c)), "")
    rare = unusual & F.contains(folded, F.lit(_RARE))
    return F.lower(F.when(ascii_only, text).when(rare, F.translate(spelled, *_fold_table())).otherwise(folded))


def normalize_name(value: Column) -> Column:
    """Matching key of a name: folded, footnotes dropped, words joined by one space."""
    folded = F.regexp_replace(fold_accents(value), _FOOTNOTE, "")
    return F.nullif(F.trim(F.regexp_replace(folded, "[^a-z0-9]+", " ")), F.lit(""))


def python_normalize(value: str | None) -> str | None:
    """``normalize_name`` for one driver-side string (alias tables, search keys)."""
    import re

    if value is None:
        return None
    words = re.findall("[a-z0-9]+", re.sub(r"\[[^]]*\]", "", _fold(value)))
    return " ".join(words) or None


def apply_aliases(key: Column, aliases: Mapping[str, str]) -> Column:
    """Canonical key for a normalised key; one pass, identity where unlisted.

    The alias list is configuration, so it is a literal in the plan and needs
    no join. A list kept as a table is joined: see ``operators.joins.lookup``.
    """
    pairs = {python_normalize(k): python_normalize(v) for k, v in aliases.items()}
    pairs = {k: v for k, v in pairs.items() if k and v}
    if not pairs:
        return key
    table = F.create_map(*[F.lit(item) for pair in pairs.items() for item in pair])
    return F.coalesce(F.try_element_at(table, key), key)


def clean_code(value: Column, length: int) -> Column:
    """ASCII letters upper-cased; null unless exactly ``length`` remain."""
    letters = F.upper(F.regexp_replace(value.cast("string"), "[^A-Za-z]", ""))
    return F.when(F.length(letters) == length, letters)


def is_code(value: Column, length: int) -> Column:
    """True where the value is exactly ``length`` capital ASCII letters."""
    return F.coalesce(value.rlike(f"^[A-Z]{{{length}}}\\z"), F.lit(False))


def upper_letters(value: Column) -> Column:
    """Upper-cased code for written rows; null where it has a non-letter."""
    return F.when(value.rlike(r"^\p{L}+\z"), F.upper(value))


def escape_like(term: str) -> str:
    return term.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")


def contains_ignoring_case(value: Column, term: str) -> Column:
    """Case-insensitive substring test; ``%`` and ``_`` in the term are literal."""
    return value.ilike(f"%{escape_like(term)}%")


def truncate(value: Column, length: int = 4000) -> Column:
    return F.left(value, F.lit(length))
