"""DuckDB SQL for the same rules, used as the correctness oracle.

These strings restate each rule in plain SQL over the driver's tables
(``RAW_TRIPLES_SQL`` is the adapter).  They are independent of the Spark
code paths: no shared expression builder, only shared fixed values.
"""

from __future__ import annotations

from triplex.constants import ENGLISH_STOP_WORDS, SUBJECT_PREFIX
from triplex.sources.tables import RAW_TRIPLES_SQL


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def clean_subject_sql(x: str) -> str:
    s1 = f"(CASE WHEN starts_with({x}, {q(SUBJECT_PREFIX)}) THEN substr({x}, {len(SUBJECT_PREFIX) + 1}) ELSE {x} END)"
    return f"(CASE WHEN ends_with({s1}, '>') THEN substr({s1}, 1, length({s1}) - 1) ELSE {s1} END)"


def clean_predicate_sql(x: str) -> str:
    t = f"regexp_replace({x}, '^<.*/(.*?)>$', '\\1')"
    return (
        f"(CASE {t} WHEN 'rdf-schema#label' THEN 'type.object.name' "
        f"WHEN 'rdf-syntax-ns#type' THEN 'type.object.type' ELSE {t} END)"
    )


def clean_object_sql(x: str) -> str:
    return f"regexp_extract(regexp_replace({x}, '^\\\\\"(.*)\\\\\"$', '\\1'), '^(.*?)@', 1)"


def object_id_sql(x: str) -> str:
    return f"(CASE WHEN starts_with({x}, '<') AND ends_with({x}, '>') THEN {clean_subject_sql(x)} END)"


def object_lang_sql(x: str) -> str:
    return f"NULLIF(regexp_extract({x}, '(?s)^\".*\"@([A-Za-z][A-Za-z0-9-]*)\\z', 1), '')"


def object_datatype_sql(x: str) -> str:
    return f"NULLIF(regexp_extract({x}, '(?s)^\".*\"\\^\\^<([^<>]*)>\\z', 1), '')"


def sample_unit_sql() -> str:
    return "CAST(('0x' || substr(md5(concat_ws(chr(9), Subject, Predicate, Object)), 1, 8)) AS BIGINT)"


def tokens_sql(x: str) -> str:
    return f"list_filter(string_split_regex(lower({x}), '[^\\p{{L}}]+'), lambda t: t <> '')"


STOP_LIST_SQL = "[" + ", ".join(q(w) for w in ENGLISH_STOP_WORDS) + "]"


def nostop_sql(tokens: str) -> str:
    return f"list_filter({tokens}, lambda t: NOT list_contains({STOP_LIST_SQL}, t))"


def long_only_sql(tokens: str, text: str) -> str:
    return f"(CASE WHEN length({text}) >= 50 THEN {nostop_sql(tokens)} ELSE {tokens} END)"


# --- shared CTEs ---------------------------------------------------------------

TR = f"tr AS ({RAW_TRIPLES_SQL})"
DD = "dd AS (SELECT DISTINCT Subject, Predicate, Object FROM tr)"
CL = (
    f"cl AS (SELECT {clean_subject_sql('Subject')} AS Subject, {clean_predicate_sql('Predicate')} AS Predicate, "
    f"{clean_object_sql('Object')} AS Object FROM dd)"
)
PARTS = (
    f"parts AS (SELECT {clean_subject_sql('Subject')} AS Subject, {clean_predicate_sql('Predicate')} AS Predicate, "
    f"{clean_object_sql('Object')} AS Object, Object AS object_raw, {object_id_sql('Object')} AS object_id, "
    f"{object_lang_sql('Object')} AS object_lang, {object_datatype_sql('Object')} AS object_datatype FROM dd)"
)
PREDS = "preds AS (SELECT DISTINCT Predicate FROM cl WHERE Predicate IS NOT NULL)"
LEAVES = (
    "leaves AS (SELECT p.Predicate FROM preds p WHERE NOT EXISTS "
    "(SELECT 1 FROM preds c WHERE starts_with(c.Predicate, p.Predicate || '.')))"
)


def domain_leaves_cte(domain: str) -> str:
    return (
        "dleaves AS (SELECT Predicate FROM leaves WHERE split_part(Predicate, '.', 1) = "
        f"{q(domain)} AND contains(Predicate, '.'))"
    )


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


CL_BASE = with_(TR, DD, CL)
PARTS_BASE = with_(TR, DD, PARTS)
NODES = (
    "nodes AS (SELECT DISTINCT array_to_string(list_slice(parts, 1, i), '.') AS path, "
    "CASE WHEN i > 1 THEN array_to_string(list_slice(parts, 1, i - 1), '.') END AS parent, "
    "parts[i] AS part, CAST(i AS BIGINT) AS depth "
    "FROM (SELECT parts, unnest(generate_series(1, len(parts))) AS i "
    "FROM (SELECT string_split(Predicate, '.') AS parts FROM preds)))"
)
