"""DuckDB SQL of the operators that SQL can express, from their definitions alone."""

from __future__ import annotations

CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Bytewise CRC-32: its table of 256 remainders, as a list.
CRC_TABLE = """crc_table AS MATERIALIZED (SELECT list(v ORDER BY i) AS crc_of FROM (
    SELECT i, list_reduce(list_concat([i], range(8)), lambda c, k: xor(c >> 1, (c & 1) * 3988292384)) AS v
    FROM range(256) r(i)))"""


def crc32(byte_list: str) -> str:
    """CRC-32 of a list of byte values; ``crc_of`` must be in reach."""
    step = "lambda c, b: xor(c >> 8, crc_of[(xor(c, b) & 255) + 1])"
    return f"xor(list_reduce(list_concat([4294967295], {byte_list}), {step}), 4294967295)"


def ascii_bytes(text: str) -> str:
    return f"list_transform(string_split({text}, ''), lambda c: CAST(ascii(c) AS BIGINT))"


def _field(value: str) -> str:
    return f"coalesce(octet_length(encode({value})) || ':' || {value}, '-')"


def _leaf(text: str) -> str:
    columns = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text]
    return "sha256(" + " || ".join(_field(c) for c in columns) + ")"


def _levels(name: str, levels: int) -> list[str]:
    """``name0`` (tree, p, h) goes up: ``nameK``, and ``nameK_step`` with each node's left and right siblings."""
    out = []
    for k in range(levels):
        run = "PARTITION BY tree, p // 8 ORDER BY p ROWS BETWEEN"
        out.append(f"""{name}{k}_step AS MATERIALIZED (SELECT tree, p, h, count(*) OVER (PARTITION BY tree) AS n,
            coalesce(string_agg(h, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
            coalesce(string_agg(h, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {name}{k})""")
        out.append(f"""{name}{k + 1} AS MATERIALIZED (SELECT tree, p // 8 AS p,
            CASE WHEN min(n) = 1 THEN min(h) ELSE sha256(string_agg(h, '' ORDER BY p)) END AS h
            FROM {name}{k}_step GROUP BY tree, p // 8)""")
    return out


def _climb(name: str, source: str, tree: str, place: str, levels: int) -> list[str]:
    """Fold ``f`` and gather siblings ``s`` of the rows of ``source`` along the levels of ``name``."""
    out = []
    for k in range(levels):
        out.append(f"""{source}_{name}{k} AS MATERIALIZED (SELECT a.* EXCLUDE (f, s), a.s || t.l || t.r AS s,
            CASE WHEN t.n = 1 THEN a.f ELSE sha256(t.l || a.f || t.r) END AS f
            FROM {source if k == 0 else f'{source}_{name}{k - 1}'} a
            JOIN {name}{k}_step t ON t.tree = a.{tree} AND t.p = a.{place} // {8 ** k})""")
    return out


def merkle(levels: int = 7, top_levels: int = 3) -> str:
    """Trees of up to ``8 ** levels`` leaves, ``8 ** top_levels`` trees."""
    ctes = [
        CRC_TABLE,
        f"""leaves AS MATERIALIZED (SELECT doc_id, coalesce('=' || lang, '') AS tree, {_leaf('text')} AS leaf,
            CASE WHEN {crc32(ascii_bytes('CAST(doc_id AS VARCHAR)'))} % 3 = 0
                 THEN {_leaf(f"translate(text, '{CAPITALS}', '{SMALL}')")} ELSE {_leaf('text')} END AS f, '' AS s
            FROM documents, crc_table)""",
        """placed AS MATERIALIZED (SELECT *, row_number() OVER (
            PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p FROM leaves)""",
        "t0 AS (SELECT tree, p, leaf AS h FROM placed)",
        *_levels("t", levels),
        f"""subroots AS MATERIALIZED (SELECT tree AS name, h AS subroot, 0 AS whole,
            row_number() OVER (ORDER BY tree) - 1 AS q FROM t{levels})""",
        "u0 AS (SELECT whole AS tree, q AS p, subroot AS h FROM subroots)",
        *_levels("u", top_levels),
        *_climb("t", "placed", "tree", "p", levels),
        f"""below AS MATERIALIZED (SELECT * FROM placed_t{levels - 1} a JOIN subroots r ON r.name = a.tree)""",
        *_climb("u", "below", "whole", "q", top_levels),
    ]
    last = f"below_u{top_levels - 1}"
    return "WITH " + ",\n".join(ctes) + f"""
        SELECT b.doc_id, b.leaf, b.subroot, r.h AS root, sha256(b.s) AS proof_sha256, b.f AS folded_root,
               b.f = r.h AS verified FROM {last} b, u{top_levels} r"""


def spelling() -> str:
    """Near words by equal strings after one deletion; forms followed by recursion."""
    # U+00C0 to U+00FF have two bytes, the first one always 195.
    run_bytes = """list_concat(ascii_part, flatten(list_transform(string_split(run, ''), lambda c:
        CASE WHEN unicode(c) < 128 THEN [CAST(unicode(c) AS BIGINT)]
             ELSE [CAST(195 AS BIGINT), CAST((unicode(c) & 63) | 128 AS BIGINT)] END)))"""
    ctes = [
        CRC_TABLE,
        f"""runs AS MATERIALIZED (SELECT {ascii_bytes("coalesce(CAST(doc_id AS VARCHAR), '') || ':'")} AS ascii_part,
            translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]{{7,}}')), '{CAPITALS}', '{SMALL}') AS run
            FROM documents)""",
        f"hashed AS MATERIALIZED (SELECT run, {crc32(run_bytes)} AS h FROM runs, crc_table)",
        """words AS MATERIALIZED (SELECT word, count(*) AS n FROM (SELECT CASE WHEN h % 31 = 0
            THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed)
            WHERE length(word) >= 7 GROUP BY word HAVING count(*) >= 2)""",
        """cut AS MATERIALIZED (SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
            FROM (SELECT word, unnest(generate_series(1, length(word))) AS i FROM words))""",
        """near AS MATERIALIZED (SELECT a.word AS u, b.word AS v FROM cut a JOIN cut b
                ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
            UNION SELECT w.word, c.word FROM words w JOIN cut c ON w.word = c.rest
            UNION SELECT c.word, w.word FROM words w JOIN cut c ON w.word = c.rest)""",
        """best AS MATERIALIZED (SELECT u, count(*) AS n_near,
            arg_min(v, {'less': -w.n, 'word': v}) AS v, max(w.n) AS n FROM near JOIN words w ON w.word = v GROUP BY u)""",
        """formed AS MATERIALIZED (SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near,
            CASE WHEN b.n >= 10 * w.n THEN b.v END AS form, CASE WHEN b.n >= 10 * w.n THEN b.n END AS form_n
            FROM words w LEFT JOIN best b ON b.u = w.word)""",
        """chain AS (SELECT word, word AS root, form AS next FROM formed
            UNION ALL SELECT c.word, f.word, f.form FROM chain c JOIN formed f ON f.word = c.next)""",
    ]
    return "WITH RECURSIVE " + ",\n".join(ctes) + """
        SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n
        FROM formed f JOIN chain c ON c.word = f.word AND c.next IS NULL"""
