"""Text cleaning shared by the maintenance operators."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from fleetpulse.constants import NULL_TOKENS

# every character that counts as whitespace, not just the space that trim() removes
_WHITESPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(_WHITESPACE))


def null_token_normalize(text: Column) -> Column:
    """NULL where the cleaned text is one of the words that stand for a missing value."""
    return F.when(~text.isin(NULL_TOKENS), text)
