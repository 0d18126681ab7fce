"""Text expressions: key normalisation, symbol replacement, tokenising."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._col import as_col


def last_n(c, n: int = 7) -> Column:
    """Last ``n`` characters; shorter strings pass whole, null stays null."""
    return F.right(as_col(c), F.lit(int(n)))


def strip_char(c, ch: str = "-") -> Column:
    """Remove every occurrence of a literal character (plates ``AB-12-CD``)."""
    return F.replace(as_col(c), F.lit(ch), F.lit(""))


def remove_suffix_text(c, text: str) -> Column:
    """Remove a literal substring wherever it occurs (``' - não utilizar'``)."""
    return F.replace(as_col(c), F.lit(text), F.lit(""))


# The ordered symbol replacements applied to the interior text
# and the colour text. ``regex`` marks the one step that the pandas of the
# original era applied as a regular expression ("ind." with a wildcard dot).
INTERIOR_REPLACEMENTS = [
    ("|", "/", False),
    ("ind.", "", True),
    ("]", "/", False),
    (".", " ", False),
    ("'merino'", "merino", False),
    ("' merino'", "merino", False),
    ("'vernasca'", "vernasca", False),
]
COLOUR_REPLACEMENTS = [("|", "", False)]


def replace_chain(c, steps) -> Column:
    """Apply ``(find, replace, is_regex)`` steps in order."""
    out = as_col(c)
    for find, repl, is_regex in steps:
        if is_regex:
            out = F.regexp_replace(out, F.lit(find), F.lit(repl))
        else:
            out = F.replace(out, F.lit(find), F.lit(repl))
    return out


# Punctuation that the word tokeniser splits off as separate tokens; '/' and
# '-' stay inside tokens because the colour vocabularies contain them.
_PUNCT = r'([,;:()\[\]"!?])'


def tokenize(c) -> Column:
    """Word tokens of a string: punctuation split off, whitespace separated,
    empty tokens removed. Null in → null out."""
    spaced = F.regexp_replace(as_col(c), _PUNCT, " $1 ")
    # array_remove is a built-in (code-generated), unlike a filter lambda
    return F.array_remove(F.split(F.trim(spaced), r"\s+"), "")


def shorten_model(tokens, lead: str = "Série") -> Column:
    """First token ``lead`` → first two tokens; otherwise drop the last three
    tokens (three or fewer tokens → empty string; no token → empty string)."""
    tok = as_col(tokens)
    keep = F.when(F.try_element_at(tok, F.lit(1)) == F.lit(lead), F.lit(2)).otherwise(
        F.greatest(F.size(tok) - 3, F.lit(0)))
    return F.array_join(F.slice(tok, F.lit(1), keep), " ")
