"""Column -> Column tokenizing rules (regex tokenizer + stop words).

Equivalent to a default ``RegexTokenizer`` (lowercase, split on gaps,
minimum token length 1) followed by a default ``StopWordsRemover``, but
written as higher-order column functions so no ML stage, no UDF and no
extra pass is needed.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from triplex.constants import ENGLISH_STOP_WORDS, MIN_LEN_STOP_WORDS, TOKEN_SPLIT_REGEX
from triplex.functions.clean import ColumnOrName, _c


def tokenize(c: ColumnOrName) -> Column:
    """Lowercase and split on runs of non-letters; empty tokens dropped.

    ``array_remove`` is a native (code-generated) array function, cheaper
    than a lambda filter per token.
    """
    return F.array_remove(F.split(F.lower(_c(c)), TOKEN_SPLIT_REGEX), "")


def remove_stop_words(tokens: ColumnOrName, stop_words=ENGLISH_STOP_WORDS) -> Column:
    """Drop every token in ``stop_words`` and keep repeats of the others.

    Tokens are lower case already; ``array_except`` is not used because it
    would also collapse repeated tokens.
    """
    words = list(stop_words)
    return F.filter(_c(tokens), lambda t: ~t.isin(words))


def long_only_stop_words(
    tokens: ColumnOrName, text: ColumnOrName, min_len: int = MIN_LEN_STOP_WORDS
) -> Column:
    """Remove stop words only when the source text has ``min_len`` characters or more."""
    tokens = _c(tokens)
    return F.when(F.length(_c(text)) >= min_len, remove_stop_words(tokens)).otherwise(tokens)


def tokens_text(tokens: ColumnOrName) -> Column:
    """A token array as one space-joined string (for export and hashing)."""
    return F.array_join(_c(tokens), " ")


def token_count(tokens: ColumnOrName) -> Column:
    return F.size(_c(tokens)).cast("long")
