"""Column -> Column cleaning rules for subjects, predicates and objects.

All rules are native Catalyst expressions, so they stay inside whole-stage
codegen.  NULL passes through every rule.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from triplex.constants import (
    OBJECT_UNQUOTE_REGEX,
    PREDICATE_MAPPING,
    PREDICATE_TAIL_REGEX,
    SUBJECT_PREFIX,
)

ColumnOrName = Column | str
# What ends a line of an object.
LINE_ENDS = ("\n", "\r", "\u0085", "\u2028", "\u2029")


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _drop_suffix(c: Column, suffix: str) -> Column:
    """Drop one trailing ``suffix`` if present."""
    return F.when(c.endswith(suffix), c.substr(F.lit(1), F.length(c) - len(suffix))).otherwise(c)


def clean_subject(c: ColumnOrName) -> Column:
    """Strip the namespace prefix if present, then, independently, one trailing ``>``.

    ``<ns/m.1>`` -> ``m.1``; ``<http://x.org/q>`` -> ``<http://x.org/q``;
    the bare prefix gives ``''``.
    """
    c = _c(c)
    stripped = F.when(
        c.startswith(SUBJECT_PREFIX), c.substr(F.lit(len(SUBJECT_PREFIX) + 1), F.length(c))
    ).otherwise(c)
    return _drop_suffix(stripped, ">")


def predicate_tail(c: ColumnOrName) -> Column:
    """Text after the last ``/`` of a ``<...>`` value; other values unchanged.

    The pattern decides where a line ends; values of one line need none.
    """
    c = _c(c)
    tail = F.substring_index(c, "/", -1)
    return (
        F.when(c.contains("\n"), F.regexp_replace(c, PREDICATE_TAIL_REGEX, "$1"))
        .when(c.startswith("<") & c.endswith(">") & c.contains("/"), tail.substr(F.lit(1), F.length(tail) - 1))
        .otherwise(c)
    )


def map_predicate(c: ColumnOrName) -> Column:
    """Apply the fixed vocabulary mapping to an already stripped predicate."""
    c = _c(c)
    out = None
    for old, new in PREDICATE_MAPPING:
        out = (F.when if out is None else out.when)(c == old, F.lit(new))
    return out.otherwise(c)


def clean_predicate(c: ColumnOrName) -> Column:
    return map_predicate(predicate_tail(c))


def unquote_object(c: ColumnOrName) -> Column:
    """Remove a literal backslash-quote pair around the value.

    The anchored pattern can only match a value that starts with ``\\"``,
    so the regex is skipped for every other row.
    """
    c = _c(c)
    return F.when(c.startswith('\\"'), F.regexp_replace(c, OBJECT_UNQUOTE_REGEX, "$1")).otherwise(c)


def object_text(c: ColumnOrName) -> Column:
    """Everything before the first ``@`` of the first line, ``''`` if none."""
    c = _c(c)
    text = F.substring_index(c, "@", 1)
    found = c.contains("@")
    for end in LINE_ENDS:
        found = found & ~text.contains(end)
    return F.when(found, text).when(c.isNotNull(), F.lit(""))


def clean_object(c: ColumnOrName) -> Column:
    return object_text(unquote_object(c))


# --- parts of an object kept beside the blanked text -----------------------


def object_id(c: ColumnOrName) -> Column:
    """For a ``<...>`` URI object, the id under the subject rule; else NULL."""
    c = _c(c)
    return F.when(c.startswith("<") & c.endswith(">"), clean_subject(c))


def _nonempty(c: Column) -> Column:
    return F.when(c != "", c)


LANG_REGEX = r'(?s)^".*"@([A-Za-z][A-Za-z0-9-]*)\z'
DATATYPE_REGEX = r'(?s)^".*"\^\^<([^<>]*)>\z'


def object_lang(c: ColumnOrName) -> Column:
    """Language tag of a ``"text"@tag`` literal, else NULL."""
    c = _c(c)
    return F.when(c.startswith('"') & c.contains('"@'), _nonempty(F.regexp_extract(c, LANG_REGEX, 1)))


def object_datatype(c: ColumnOrName) -> Column:
    """Datatype URI of a ``"v"^^<type>`` literal, else NULL."""
    c = _c(c)
    return F.when(c.startswith('"') & c.endswith(">"), _nonempty(F.regexp_extract(c, DATATYPE_REGEX, 1)))


# --- dotted predicate paths -------------------------------------------------


def domain_of(c: ColumnOrName) -> Column:
    """Text before the first ``.``; the whole value if there is none."""
    return F.substring_index(_c(c), ".", 1)


def path_parts(c: ColumnOrName) -> Column:
    """Split a dotted path on every ``.``; empty parts are kept."""
    return F.split(_c(c), r"\.")


def path_prefix(parts: Column, n: Column | int) -> Column:
    """The first ``n`` parts joined back with ``.``."""
    n = F.lit(n) if isinstance(n, int) else n
    return F.array_join(F.slice(parts, F.lit(1), n), ".")
