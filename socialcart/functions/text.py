"""Text tokens as column expressions (JVM-side, no Python UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Token rule of the keyword extraction and search.
WORD_SPLIT = "[^a-z0-9]+"   # lower-cased text split on runs of non-alphanumerics
DOT_SPLIT = "[.]"           # graph script variant: split on '.' only
MIN_TOKEN_LEN = 3           # keep tokens longer than 2 characters
TOKEN_RE = "[a-z0-9]+"      # a token of lower-cased text (the complement of WORD_SPLIT)


def tokens(text: Column, splitter: str = WORD_SPLIT) -> Column:
    """Array of tokens of ``lower(coalesce(text, ''))`` (empty edge tokens
    included; filter them with :func:`keep_token`)."""
    return F.split(F.lower(F.coalesce(text, F.lit(""))), splitter)


def keep_token(tok: Column, min_len: int = MIN_TOKEN_LEN) -> Column:
    return (tok != "") & (F.length(tok) >= min_len)
