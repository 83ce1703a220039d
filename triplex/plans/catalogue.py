"""Registered queries: one Spark plan per operator and its DuckDB oracle.

Every query reads the driver's tables (through the triple adapter or
directly) and runs over the whole tables; parameters (domain, fraction,
keywords, k) are fixed below and used identically on both sides.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from triplex.functions.clean import clean_object, clean_predicate, clean_subject
from triplex.functions.text import tokens_text
from triplex.operators import domains, graph, hierarchy, matching, tokens, triples, vocabulary
from triplex.plans import ledger
from triplex.plans import oracle as O
from triplex.plans.batch import ExportConfig, run_batch, run_counters
from triplex.schema import OBJECT, PREDICATE, SUBJECT, TRIPLE_COLUMNS, TRIPLE_SCHEMA
from triplex.session import scratch_path
from triplex.sinks.delimited import merge_parts, read_hierarchy, write_delimited, write_hierarchy, write_triples
from triplex.sinks.template import read_template, write_template
from triplex.sources.tables import load_table, raw_triples
from triplex.sources.triples import (
    escape_field,
    read_named_csv,
    read_parts,
    read_predicate_list,
    read_triples,
    read_triples_checked,
)

# --- FIXED VALUES: query parameters ----------------------------------------------
LEAF_DOMAIN = "people"      # has a non-leaf predicate (people.person)
SAMPLE_DOMAIN = "common"    # the default export domain
MATCH_DOMAIN = "event"      # objects mention their subject
SAMPLE_FRACTION = 0.5
SAMPLE_SEED = 7
KEYWORDS = ("person", "topic", "type", "order")
TOP_K = 3
DAMAGED_EVERY = 11          # of the lengths of a triple: five kinds of damaged lines, six of good ones
PREDICATE_PAIRS = (         # a vocabulary mapping given as a relation
    ("rdf-schema#label", "type.object.name"),
    ("rdf-syntax-ns#type", "type.object.type"),
    ("people.person.name", "person.full_name"),
    ("common.topic.alias", "topic.alias"),
)
PREVIEW_ROWS = 25

Query = Callable[[SparkSession, str], DataFrame]


def _dedup(spark, d):
    return triples.drop_duplicate_triples(raw_triples(spark, d))


def _cl(spark, d):
    return triples.clean_triples(_dedup(spark, d))


def _parts(spark, d):
    return triples.object_parts(_dedup(spark, d))


# --- sources / sinks round trips ---------------------------------------------------


def q_triples_scan_tsv(spark, d):
    path = scratch_path(spark, "tsv")
    write_triples(raw_triples(spark, d), path)
    return read_triples(spark, path, mode="ntriples", escaped=True)


def q_triples_scan_tsv_compat(spark, d):
    path = scratch_path(spark, "tsv-compat")
    write_triples(raw_triples(spark, d), path)
    return read_triples(spark, path, mode="compat", escaped=True)


def _damaged_lines(spark, d):
    """The dump's lines; some, by the length of their triple, lack fields, have one too many or no end mark."""
    tr = raw_triples(spark, d)
    s, p, o = (F.coalesce(escape_field(c), F.lit("")) for c in TRIPLE_COLUMNS)
    tab, end = F.lit("\t"), F.lit(".")
    kind = (F.length(F.concat_ws("", *TRIPLE_COLUMNS)) % DAMAGED_EVERY)
    line = (
        F.when(kind == 0, F.concat_ws("\t", s, p, o))
        .when(kind == 1, s)
        .when(kind == 2, F.concat_ws("\t", s, p, o, end, end))
        .when(kind == 3, F.concat(s, tab, tab, o, tab, end))
        .when(kind == 4, F.concat_ws("\t", s, p, o, F.lit(";")))
        .otherwise(F.concat_ws("\t", s, p, o, end))
    )
    path = scratch_path(spark, "damaged-tsv")
    tr.select(line.alias("value")).write.text(path)
    return read_triples_checked(spark, path, mode="ntriples", escaped=True)


def q_triples_accepted(spark, d):
    return _damaged_lines(spark, d).triples


def q_triples_rejects(spark, d):
    return _damaged_lines(spark, d).rejects


def q_triples_line_counts(spark, d):
    return _damaged_lines(spark, d).counts()


def _run(spark, d, **options):
    cfg = ExportConfig(domain=SAMPLE_DOMAIN, fraction=SAMPLE_FRACTION, **options)
    return run_batch(spark, raw_triples(spark, d), cfg)


def q_batch_run_sample(spark, d):
    result = run_batch(
        spark, raw_triples(spark, d), ExportConfig(domain=SAMPLE_DOMAIN, fraction=SAMPLE_FRACTION), perform_counts=False
    )
    return read_parts(spark, result.paths["sample"], TRIPLE_SCHEMA)


def q_batch_run_matching(spark, d):
    cfg = ExportConfig(export_sample=False, export_matching=True, domain=MATCH_DOMAIN)
    result = run_batch(spark, raw_triples(spark, d), cfg, perform_counts=False)
    schema = StructType([TRIPLE_SCHEMA[c] for c in (SUBJECT, OBJECT, PREDICATE)])
    return read_parts(spark, result.paths["matching"], schema)


def q_batch_run_full(spark, d):
    cfg = ExportConfig(export_sample=False, export_full=True)
    result = run_batch(spark, raw_triples(spark, d), cfg, perform_counts=False)
    return read_parts(spark, result.paths["full"], TRIPLE_SCHEMA)


def q_batch_run_predicates(spark, d):
    cfg = ExportConfig(export_sample=False, export_unique_predicates=True)
    result = run_batch(spark, raw_triples(spark, d), cfg, perform_counts=False)
    return read_predicate_list(spark, result.paths["unique_predicates"])


def q_batch_run_counters(spark, d):
    found = _run(spark, d).metrics(spark)
    return found.where("stage = 'counters'").select("metric", F.col("value").cast("long").alias("value"))


def q_run_ledger(spark, d):
    """Totals of a ledger that holds a run, its retry and a second run over the same input."""
    path = scratch_path(spark, "ledger")
    result = _run(spark, d, ledger_path=path, run_id="first", input_name="tables")
    for run_id in ("first", "second"):
        ledger.record(spark, path, run_id, {"tables": result.counters})
    return ledger.totals(ledger.read(spark, path))


def q_domain_triples_given(spark, d):
    """Domain triples under a vocabulary that was written, read again and given to the filter."""
    path = scratch_path(spark, "vocabulary")
    write_hierarchy(hierarchy.predicate_hierarchy(_cl(spark, d)), path)
    return domains.domain_triples_from_raw(raw_triples(spark, d), LEAF_DOMAIN, read_hierarchy(spark, path))


def q_domain_sample_check(spark, d):
    """What holds for any random sample: rows outside the domain, rows too many of a kind, size within six deviations."""
    domain = domains.domain_triples(_cl(spark, d), SAMPLE_DOMAIN)
    sample = domains.domain_sample_random(_cl(spark, d), SAMPLE_DOMAIN, SAMPLE_FRACTION, SAMPLE_SEED)
    both = domain.withColumn("s", F.lit(0)).unionByName(sample.withColumn("s", F.lit(1)))
    per = both.groupBy(*TRIPLE_COLUMNS).agg(F.sum(1 - F.col("s")).alias("n"), F.sum("s").alias("m"))
    off = F.abs(F.sum("m") - SAMPLE_FRACTION * F.sum("n"))
    return per.agg(
        F.sum("n").alias("n_domain"),
        F.count(F.when((F.col("n") == 0) & (F.col("m") > 0), 1)).alias("n_outside"),
        F.count(F.when(F.col("m") > F.col("n"), 1)).alias("n_repeated"),
        (off <= 6 * F.sqrt(SAMPLE_FRACTION * (1 - SAMPLE_FRACTION) * F.sum("n"))).alias("size_in_bound"),
    )


def _by_subject(spark, d):
    return graph.write_by_subject(_parts(spark, d), f"triplex_{uuid.uuid4().hex}", scratch_path(spark, "by-subject"))


def q_template_roundtrip(spark, d):
    path = scratch_path(spark, "template")
    write_template(hierarchy.predicate_hierarchy(_cl(spark, d)), path)
    return read_template(spark, path)


def q_predicates_mapped(spark, d):
    mapping = spark.createDataFrame(PREDICATE_PAIRS, "old string, new string")
    return triples.clean_triples_mapped(_dedup(spark, d), mapping)


def q_graph_from_csv(spark, d):
    path = scratch_path(spark, "named-csv")
    columns = {SUBJECT: "from", PREDICATE: "link", OBJECT: "to"}
    out = raw_triples(spark, d).select(
        F.col(OBJECT).alias("to"), F.lit("x,\n\"y\"").alias("note"), F.col(SUBJECT).alias("from"), F.col(PREDICATE).alias("link")
    )
    write_delimited(out, path, sep=",", header=True, lossless=True)
    raw = triples.drop_duplicate_triples(read_named_csv(spark, path, columns))
    return graph.graph_nodes(triples.object_parts(raw))


def q_export_roundtrip(spark, d):
    path = scratch_path(spark, "export-lossless")
    write_delimited(_cl(spark, d), path, lossless=True)
    return read_parts(spark, path, TRIPLE_SCHEMA, lossless=True)


def q_export_roundtrip_default(spark, d):
    path = scratch_path(spark, "export-default")
    write_delimited(_cl(spark, d), path)
    return read_parts(spark, path, TRIPLE_SCHEMA)


def q_unique_predicates_export(spark, d):
    path = scratch_path(spark, "predicates")
    write_delimited(vocabulary.unique_predicates(_cl(spark, d)), path)
    return read_predicate_list(spark, path)


def q_merge_parts(spark, d):
    parts_dir = scratch_path(spark, "predicate-parts")
    write_delimited(vocabulary.unique_predicates(_cl(spark, d)).repartition(4), parts_dir)
    from triplex.schema import PREDICATE_LIST_SCHEMA

    return merge_parts(spark, parts_dir, scratch_path(spark, "merged"), PREDICATE_LIST_SCHEMA, header=True, sort=True)


def q_hierarchy_roundtrip(spark, d):
    path = scratch_path(spark, "hierarchy")
    write_hierarchy(hierarchy.predicate_hierarchy(_cl(spark, d)), path)
    return read_hierarchy(spark, path)


# --- the query table -----------------------------------------------------------------

QUERIES: dict[str, Query] = {
    "triples_scan_tsv": q_triples_scan_tsv,
    "triples_scan_tsv_compat": q_triples_scan_tsv_compat,
    "triples_dedup": lambda s, d: _dedup(s, d),
    "triples_dup_counts": lambda s, d: triples.duplicate_counts(raw_triples(s, d)),
    "triple_multiplicity": lambda s, d: triples.triple_multiplicity(raw_triples(s, d)),
    "clean_subjects": lambda s, d: _dedup(s, d).select(
        F.col(SUBJECT).alias("subject_raw"), clean_subject(SUBJECT).alias(SUBJECT)).distinct(),
    "clean_predicates": lambda s, d: _dedup(s, d).select(
        F.col(PREDICATE).alias("predicate_raw"), clean_predicate(PREDICATE).alias(PREDICATE)).distinct(),
    "clean_objects": lambda s, d: _dedup(s, d).select(
        F.col(OBJECT).alias("object_raw"), clean_object(OBJECT).alias(OBJECT)).distinct(),
    "clean_triples": _cl,
    "clean_counts": lambda s, d: _cl(s, d).groupBy(*TRIPLE_COLUMNS).agg(F.count(F.lit(1)).alias("n")).agg(
        F.sum("n").cast("long").alias("n_rows"),
        F.sum(F.when(F.col(OBJECT) == "", F.col("n")).otherwise(0)).cast("long").alias("n_blank_objects"),
        F.count(F.lit(1)).alias("n_distinct"),
        (F.sum("n") - F.count(F.lit(1))).cast("long").alias("n_recreated_duplicates"),
    ),
    "object_parts": _parts,
    "unique_predicates": lambda s, d: vocabulary.unique_predicates(_cl(s, d)),
    "unique_predicates_export": q_unique_predicates_export,
    "predicate_positions": lambda s, d: vocabulary.predicate_positions(_cl(s, d)),
    "domain_counts": lambda s, d: vocabulary.domain_counts(_cl(s, d)),
    "top_domains": lambda s, d: vocabulary.top_domains(_cl(s, d), TOP_K),
    "keyword_predicates": lambda s, d: vocabulary.keyword_predicates(
        vocabulary.unique_predicates(_cl(s, d)), KEYWORDS),
    "predicate_hierarchy": lambda s, d: hierarchy.predicate_hierarchy(_cl(s, d)),
    "hierarchy_roundtrip": q_hierarchy_roundtrip,
    "hierarchy_sizes": lambda s, d: hierarchy.hierarchy_sizes(_cl(s, d)),
    "leaf_predicates": lambda s, d: hierarchy.leaf_predicates(_cl(s, d)),
    "domain_leaves": lambda s, d: hierarchy.domain_leaves(_cl(s, d), LEAF_DOMAIN),
    "domain_triples": lambda s, d: domains.domain_triples_from_raw(raw_triples(s, d), LEAF_DOMAIN),
    "domain_triples_cleaned": lambda s, d: domains.domain_triples(_cl(s, d), LEAF_DOMAIN),
    "domain_sample_hash": lambda s, d: domains.domain_sample_hash(_dedup(s, d), SAMPLE_DOMAIN, SAMPLE_FRACTION),
    "domain_sample_random": lambda s, d: domains.domain_sample_random(
        _cl(s, d), SAMPLE_DOMAIN, SAMPLE_FRACTION, SAMPLE_SEED),
    "doc_tokens": lambda s, d: tokens.with_tokens(load_table(s, d, "documents"), "text", "none", "_t").select(
        "doc_id", tokens_text("_t").alias("tokens"), tokens.token_count("_t").alias("n_tokens")),
    "conversation_tokens": lambda s, d: tokens.with_tokens(
        load_table(s, d, "conversations"), "text", "none", "_t").select(
        "conv_id", "turn", tokens_text("_t").alias("tokens"), tokens.token_count("_t").alias("n_tokens")),
    "doc_tokens_nostop": lambda s, d: tokens.with_tokens(load_table(s, d, "documents"), "text", "all", "_t").select(
        "doc_id", tokens_text("_t").alias("tokens"), tokens.token_count("_t").alias("n_tokens")),
    "doc_tokens_long_only": lambda s, d: tokens.with_tokens(
        load_table(s, d, "documents").select(F.lit("doc").alias("source"), F.col("doc_id").alias("id"), "text")
        .unionByName(load_table(s, d, "part").select(
            F.lit("part").alias("source"), F.col("p_partkey").alias("id"), F.col("p_name").alias("text"))),
        "text", "long_only", "_t").select(
        "source", "id", tokens_text("_t").alias("tokens"), tokens.token_count("_t").alias("n_tokens")),
    "token_frequency": lambda s, d: tokens.token_frequency(load_table(s, d, "documents"), "text", "doc_id"),
    "triple_tokens": lambda s, d: tokens.triple_tokens(_cl(s, d)).select(
        *TRIPLE_COLUMNS, tokens_text("tokenizedObj").alias("tokenized"),
        tokens_text("filtered_tokens").alias("filtered")),
    "matching_triples": lambda s, d: matching.matching_rows(
        domains.domain_triples_from_raw(raw_triples(s, d), MATCH_DOMAIN)),
    "matching_triples_cleaned": lambda s, d: matching.matching_triples(_cl(s, d), MATCH_DOMAIN),
    "subject_as_object": lambda s, d: matching.subject_as_object_from_raw(raw_triples(s, d)),
    "subject_as_object_parts": lambda s, d: matching.subject_as_object(_parts(s, d)),
    "substring_pairs": lambda s, d: matching.substring_pairs(_cl(s, d)),
    "id_mentions": lambda s, d: matching.id_mentions(_cl(s, d)),
    "graph_nodes": lambda s, d: graph.graph_nodes(_parts(s, d)),
    "graph_node_types": lambda s, d: graph.graph_node_types(_parts(s, d)),
    "graph_edges": lambda s, d: graph.graph_edges_from_raw(raw_triples(s, d)),
    "graph_edges_parts": lambda s, d: graph.graph_edges(_parts(s, d)),
    "graph_model": lambda s, d: graph.graph_model(_parts(s, d)),
    "export_roundtrip": q_export_roundtrip,
    "export_roundtrip_default": q_export_roundtrip_default,
    "merge_parts": q_merge_parts,
    "preview_rows": lambda s, d: _cl(s, d).orderBy(
        *[F.col(c).asc_nulls_first() for c in TRIPLE_COLUMNS]).limit(PREVIEW_ROWS),
    "run_metrics": lambda s, d: run_counters(raw_triples(s, d), SAMPLE_DOMAIN, SAMPLE_FRACTION),
    "batch_run_sample": q_batch_run_sample,
    "triples_accepted": q_triples_accepted,
    "triples_rejects": q_triples_rejects,
    "triples_line_counts": q_triples_line_counts,
    "batch_run_matching": q_batch_run_matching,
    "batch_run_full": q_batch_run_full,
    "batch_run_predicates": q_batch_run_predicates,
    "batch_run_counters": q_batch_run_counters,
    "run_ledger": q_run_ledger,
    "domain_triples_given": q_domain_triples_given,
    "domain_sample_check": q_domain_sample_check,
    "graph_nodes_by_subject": lambda s, d: graph.graph_nodes_by_subject(*_by_subject(s, d)),
    "subject_as_object_by_subject": lambda s, d: graph.subject_as_object_by_subject(*_by_subject(s, d)),
    "template_roundtrip": q_template_roundtrip,
    "predicates_mapped": q_predicates_mapped,
    "graph_from_csv": q_graph_from_csv,
}

# --- oracle SQL ------------------------------------------------------------------------

_HIER = O.with_(O.TR, O.DD, O.CL, O.PREDS, O.NODES) + (
    "SELECT n.path, n.parent, n.part, n.depth, "
    "NOT EXISTS (SELECT 1 FROM nodes c WHERE c.parent = n.path) AS is_leaf FROM nodes n"
)


def _tok_select(tok_expr_fn, table, cols):
    return (
        f"SELECT {cols}, array_to_string(tk, ' ') AS tokens, CAST(len(tk) AS BIGINT) AS n_tokens "
        f"FROM (SELECT *, {tok_expr_fn('text')} AS tk FROM {table})"
    )


# Characters that end an id in a text.
_SEP = r""" \t\n\r\f"'()\[\]{}<>,;!?"""
# Characters of a bare id, beside the dot.
_BARE = "0-9A-Za-z_"

_SAMPLE_THRESHOLD = f"{SAMPLE_FRACTION} * 4294967296"

ORACLE: dict[str, str] = {
    "triples_scan_tsv": O.with_(O.TR) + "SELECT Subject, Predicate, Object FROM tr",
    "triples_scan_tsv_compat": O.with_(O.TR) + (
        "SELECT Subject, Predicate, CASE WHEN Object = '\"\"' THEN NULL "
        "WHEN regexp_matches(Object, '^\"[^\"]*\"$') THEN substr(Object, 2, length(Object) - 2) "
        "ELSE Object END AS Object FROM tr"
    ),
    "triples_dedup": O.with_(O.TR, O.DD) + "SELECT * FROM dd",
    "triples_dup_counts": O.with_(O.TR) + (
        "SELECT CAST(count(*) AS BIGINT) AS raw_count, "
        "(SELECT count(*) FROM (SELECT DISTINCT * FROM tr)) AS dedup_count, "
        "count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM tr)) AS duplicate_count FROM tr"
    ),
    "triple_multiplicity": O.with_(O.TR) + (
        "SELECT Subject, Predicate, Object, count(*) AS n FROM tr GROUP BY Subject, Predicate, Object "
        "HAVING count(*) >= 2"
    ),
    "clean_subjects": O.with_(O.TR, O.DD) + (
        f"SELECT DISTINCT Subject AS subject_raw, {O.clean_subject_sql('Subject')} AS Subject FROM dd"
    ),
    "clean_predicates": O.with_(O.TR, O.DD) + (
        f"SELECT DISTINCT Predicate AS predicate_raw, {O.clean_predicate_sql('Predicate')} AS Predicate FROM dd"
    ),
    "clean_objects": O.with_(O.TR, O.DD) + (
        f"SELECT DISTINCT Object AS object_raw, {O.clean_object_sql('Object')} AS Object FROM dd"
    ),
    "clean_triples": O.CL_BASE + "SELECT * FROM cl",
    "clean_counts": O.CL_BASE + (
        "SELECT CAST(count(*) AS BIGINT) AS n_rows, "
        "CAST(count(*) FILTER (WHERE Object = '') AS BIGINT) AS n_blank_objects, "
        "(SELECT count(*) FROM (SELECT DISTINCT * FROM cl)) AS n_distinct, "
        "count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM cl)) AS n_recreated_duplicates FROM cl"
    ),
    "object_parts": O.PARTS_BASE + "SELECT * FROM parts",
    "unique_predicates": O.CL_BASE + "SELECT DISTINCT Predicate FROM cl",
    "unique_predicates_export": O.CL_BASE + "SELECT DISTINCT Predicate FROM cl",
    "predicate_positions": O.with_(O.TR, O.DD, O.CL, O.PREDS) + (
        "SELECT Predicate, row_number() OVER (ORDER BY Predicate) - 1 AS position FROM preds"
    ),
    "domain_counts": O.CL_BASE + (
        "SELECT split_part(Predicate, '.', 1) AS domain, count(DISTINCT Predicate) AS n_predicates, "
        "count(*) AS n_triples FROM cl GROUP BY 1"
    ),
    "top_domains": O.CL_BASE + (
        "SELECT split_part(Predicate, '.', 1) AS domain, count(DISTINCT Predicate) AS n_predicates, "
        f"count(*) AS n_triples FROM cl GROUP BY 1 ORDER BY n_predicates DESC, domain LIMIT {TOP_K}"
    ),
    "keyword_predicates": O.with_(O.TR, O.DD, O.CL, O.PREDS) + (
        "SELECT p.Predicate, k.keyword FROM preds p JOIN (SELECT unnest(["
        + ", ".join(O.q(k) for k in KEYWORDS)
        + "]) AS keyword) k ON contains(p.Predicate, k.keyword) ORDER BY 1, 2"
    ),
    "predicate_hierarchy": _HIER,
    "hierarchy_roundtrip": _HIER,
    "hierarchy_sizes": O.with_(
        O.TR, O.DD, O.CL,
        "pc AS (SELECT Predicate, count(*) AS n FROM cl WHERE Predicate IS NOT NULL GROUP BY Predicate)",
        "ex AS (SELECT n, parts, unnest(generate_series(1, len(parts))) AS i "
        "FROM (SELECT n, string_split(Predicate, '.') AS parts FROM pc))",
    ) + (
        "SELECT array_to_string(list_slice(parts, 1, i), '.') AS path, CAST(i AS BIGINT) AS depth, "
        "count(*) AS n_predicates, CAST(sum(n) AS BIGINT) AS n_triples FROM ex GROUP BY 1, 2"
    ),
    "leaf_predicates": O.with_(O.TR, O.DD, O.CL, O.PREDS, O.LEAVES) + "SELECT Predicate FROM leaves",
    "domain_leaves": O.with_(O.TR, O.DD, O.CL, O.PREDS, O.LEAVES, O.domain_leaves_cte(LEAF_DOMAIN))
    + "SELECT Predicate FROM dleaves",
    "domain_triples": O.with_(O.TR, O.DD, O.CL, O.PREDS, O.LEAVES, O.domain_leaves_cte(LEAF_DOMAIN))
    + "SELECT * FROM cl WHERE Predicate IN (SELECT Predicate FROM dleaves)",
    "domain_triples_cleaned": O.with_(O.TR, O.DD, O.CL, O.PREDS, O.LEAVES, O.domain_leaves_cte(LEAF_DOMAIN))
    + "SELECT * FROM cl WHERE Predicate IN (SELECT Predicate FROM dleaves)",
    "domain_sample_hash": O.with_(
        O.TR, O.DD,
        f"clu AS (SELECT {O.clean_subject_sql('Subject')} AS Subject, {O.clean_predicate_sql('Predicate')} "
        f"AS Predicate, {O.clean_object_sql('Object')} AS Object, {O.sample_unit_sql()} AS u FROM dd)",
        "cl AS (SELECT Subject, Predicate, Object FROM clu)",
        O.PREDS, O.LEAVES, O.domain_leaves_cte(SAMPLE_DOMAIN),
    ) + (
        "SELECT Subject, Predicate, Object FROM clu WHERE Predicate IN (SELECT Predicate FROM dleaves) "
        f"AND u < {_SAMPLE_THRESHOLD}"
    ),
    "batch_run_sample": O.with_(
        O.TR, O.DD,
        f"clu AS (SELECT {O.clean_subject_sql('Subject')} AS Subject, {O.clean_predicate_sql('Predicate')} "
        f"AS Predicate, {O.clean_object_sql('Object')} AS Object, {O.sample_unit_sql()} AS u FROM dd)",
        "cl AS (SELECT Subject, Predicate, Object FROM clu)",
        O.PREDS, O.LEAVES, O.domain_leaves_cte(SAMPLE_DOMAIN),
    ) + (
        "SELECT NULLIF(trim(Subject), '') AS Subject, NULLIF(trim(Predicate), '') AS Predicate, "
        "NULLIF(trim(Object), '') AS Object FROM clu WHERE Predicate IN (SELECT Predicate FROM dleaves) "
        f"AND u < {_SAMPLE_THRESHOLD}"
    ),
    "doc_tokens": _tok_select(O.tokens_sql, "documents", "doc_id"),
    "conversation_tokens": _tok_select(O.tokens_sql, "conversations", "conv_id, turn"),
    "doc_tokens_nostop": _tok_select(lambda t: O.nostop_sql(O.tokens_sql(t)), "documents", "doc_id"),
    "doc_tokens_long_only": _tok_select(
        lambda t: O.long_only_sql(O.tokens_sql(t), t),
        "(SELECT 'doc' AS source, doc_id AS id, text FROM documents UNION ALL "
        "SELECT 'part' AS source, p_partkey AS id, p_name AS text FROM part)",
        "source, id",
    ),
    "token_frequency": (
        f"SELECT token, CAST(count(*) AS BIGINT) AS n, count(DISTINCT doc_id) AS n_rows FROM "
        f"(SELECT doc_id, unnest({O.tokens_sql('text')}) AS token FROM documents) GROUP BY token"
    ),
    "triple_tokens": O.CL_BASE + (
        "SELECT Subject, Predicate, Object, array_to_string(tk, ' ') AS tokenized, "
        f"array_to_string({O.long_only_sql('tk', 'Object')}, ' ') AS filtered "
        f"FROM (SELECT *, {O.tokens_sql('Object')} AS tk FROM cl)"
    ),
    "matching_triples": O.with_(O.TR, O.DD, O.CL, O.PREDS, O.LEAVES, O.domain_leaves_cte(MATCH_DOMAIN)) + (
        "SELECT Subject, Object, Predicate FROM cl WHERE Predicate IN (SELECT Predicate FROM dleaves) "
        "AND contains(Object, Subject)"
    ),
    "matching_triples_cleaned": O.with_(O.TR, O.DD, O.CL, O.PREDS, O.LEAVES, O.domain_leaves_cte(MATCH_DOMAIN)) + (
        "SELECT Subject, Object, Predicate FROM cl WHERE Predicate IN (SELECT Predicate FROM dleaves) "
        "AND contains(Object, Subject)"
    ),
    "subject_as_object": O.PARTS_BASE + (
        "SELECT Subject, Predicate, Object FROM parts WHERE Subject IN "
        "(SELECT object_id FROM parts WHERE object_id IS NOT NULL)"
    ),
    "subject_as_object_parts": O.PARTS_BASE + (
        "SELECT Subject, Predicate, Object FROM parts WHERE Subject IN "
        "(SELECT object_id FROM parts WHERE object_id IS NOT NULL)"
    ),
    "substring_pairs": O.CL_BASE + (
        "SELECT s.Subject, o.Object FROM (SELECT DISTINCT Subject FROM cl WHERE Subject IS NOT NULL) s "
        "JOIN (SELECT DISTINCT Object FROM cl WHERE Object IS NOT NULL) o ON contains(o.Object, s.Subject)"
    ),
    # From the definition: the subject stands between boundaries of the text, separators for an id of any shape,
    # any other character for one of letters, digits, _ and dots.
    "id_mentions": O.with_(
        O.TR, O.DD, O.CL,
        "sp AS MATERIALIZED (SELECT s.Subject, o.Object FROM (SELECT DISTINCT Subject FROM cl "
        f"WHERE regexp_full_match(Subject, {O.q('<?[^' + _SEP + ']*[^' + _SEP + '.:]')}) "
        f"OR regexp_full_match(Subject, {O.q('[' + _BARE + '.]*[' + _BARE + ']')})) s "
        "JOIN (SELECT DISTINCT Object FROM cl WHERE Object IS NOT NULL) o ON contains(o.Object, s.Subject))",
    ) + (
        f"SELECT * FROM sp WHERE regexp_matches(Object, CASE WHEN Subject LIKE '<%' THEN '' "
        f"ELSE {O.q('(^|[' + _SEP + '])')} END || regexp_escape(Subject) || {O.q('[.:]*($|[' + _SEP + '])')}) "
        f"OR (regexp_full_match(Subject, {O.q('[' + _BARE + '.]*[' + _BARE + ']')}) AND regexp_matches(Object, "
        f"{O.q('(^|[^' + _BARE + '.])')} || regexp_escape(Subject) || {O.q('[.]*($|[^' + _BARE + '.])')}))"
    ),
    "graph_nodes": O.PARTS_BASE + (
        "SELECT Subject AS node_id, min(CASE WHEN Predicate = 'type.object.name' THEN Object END) AS name, "
        "count(DISTINCT CASE WHEN Predicate = 'type.object.type' THEN object_id END) AS n_types, "
        "count(*) AS n_triples FROM parts WHERE Subject IS NOT NULL GROUP BY Subject"
    ),
    "graph_node_types": O.PARTS_BASE + (
        "SELECT DISTINCT Subject AS node_id, object_id AS type_id FROM parts "
        "WHERE Predicate = 'type.object.type' AND object_id IS NOT NULL"
    ),
    "graph_edges": O.PARTS_BASE + (
        "SELECT DISTINCT Subject AS src, Predicate AS predicate, object_id AS dst FROM parts "
        "WHERE object_id IN (SELECT Subject FROM parts WHERE Subject IS NOT NULL)"
    ),
    "graph_edges_parts": O.PARTS_BASE + (
        "SELECT DISTINCT Subject AS src, Predicate AS predicate, object_id AS dst FROM parts "
        "WHERE object_id IN (SELECT Subject FROM parts WHERE Subject IS NOT NULL)"
    ),
    "graph_model": O.PARTS_BASE + (
        "SELECT Predicate, count(*) AS n_triples, count(DISTINCT Subject) AS n_subjects, "
        "count(object_id) AS n_links, count(*) - count(object_id) AS n_literals FROM parts GROUP BY Predicate"
    ),
    "export_roundtrip": O.CL_BASE + "SELECT * FROM cl",
    "export_roundtrip_default": O.CL_BASE + (
        "SELECT NULLIF(trim(Subject), '') AS Subject, NULLIF(trim(Predicate), '') AS Predicate, "
        "NULLIF(trim(Object), '') AS Object FROM cl"
    ),
    "merge_parts": O.CL_BASE + "SELECT DISTINCT Predicate FROM cl",
    "preview_rows": O.CL_BASE + (
        "SELECT * FROM cl ORDER BY Subject NULLS FIRST, Predicate NULLS FIRST, Object NULLS FIRST "
        f"LIMIT {PREVIEW_ROWS}"
    ),
    "run_metrics": O.with_(
        O.TR,
        "per AS (SELECT Subject, Predicate, Object, count(*) AS m FROM tr GROUP BY Subject, Predicate, Object)",
        f"clu AS (SELECT {O.clean_subject_sql('Subject')} AS Subject, {O.clean_predicate_sql('Predicate')} "
        f"AS Predicate, {O.clean_object_sql('Object')} AS Object, m, {O.sample_unit_sql()} AS u FROM per)",
        "cl AS (SELECT Subject, Predicate, Object FROM clu)",
        O.PREDS, O.LEAVES, O.domain_leaves_cte(SAMPLE_DOMAIN),
        "fl AS (SELECT m, u, coalesce(Predicate IN (SELECT Predicate FROM dleaves), false) AS d FROM clu)",
    ) + (
        "SELECT 'initCount' AS metric, CAST(sum(m) AS BIGINT) AS value FROM fl "
        "UNION ALL SELECT 'finalCount', count(*) FROM fl "
        "UNION ALL SELECT 'domainCount', count(*) FILTER (WHERE d) FROM fl "
        f"UNION ALL SELECT 'sample', count(*) FILTER (WHERE d AND u < {_SAMPLE_THRESHOLD}) FROM fl"
    ),
}


def _esc(c: str) -> str:
    """A field of a dump line."""
    out = f"replace(coalesce({c}, ''), '\\', '\\\\')"
    for code, letter in ((9, "t"), (10, "n"), (13, "r")):
        out = f"replace({out}, chr({code}), '\\{letter}')"
    return out


# Lines of the damaged dump and why they are no triple, from the definition of the damage.
_LINES = O.with_(
    O.TR,
    f"f AS (SELECT *, {_esc('Subject')} AS s, {_esc('Predicate')} AS p, {_esc('Object')} AS o, "
    f"length(coalesce(Subject, '') || coalesce(Predicate, '') || coalesce(Object, '')) % {DAMAGED_EVERY} AS k FROM tr)",
    "lines AS (SELECT Subject, Predicate, Object, CASE k WHEN 0 THEN concat_ws(chr(9), s, p, o) WHEN 1 THEN s "
    "WHEN 2 THEN concat_ws(chr(9), s, p, o, '.', '.') WHEN 3 THEN concat_ws(chr(9), s, '', o, '.') "
    "WHEN 4 THEN concat_ws(chr(9), s, p, o, ';') ELSE concat_ws(chr(9), s, p, o, '.') END AS line, "
    "CASE WHEN k = 1 AND trim(s) = '' THEN 'blank line' WHEN k < 3 THEN 'field count' "
    "WHEN k = 3 OR s = '' OR p = '' OR o = '' THEN 'missing value' WHEN k = 4 THEN 'no end mark' END AS reason FROM f)",
)
_MAPPED = (
    "CASE regexp_replace(Predicate, '^<.*/(.*?)>$', '\\1') "
    + " ".join(f"WHEN {O.q(old)} THEN {O.q(new)}" for old, new in PREDICATE_PAIRS)
    + " ELSE regexp_replace(Predicate, '^<.*/(.*?)>$', '\\1') END"
)

ORACLE |= {
    "triples_accepted": _LINES + "SELECT Subject, Predicate, Object FROM lines WHERE reason IS NULL",
    "triples_rejects": _LINES + "SELECT line, reason FROM lines WHERE reason IS NOT NULL",
    "triples_line_counts": _LINES + (
        "SELECT coalesce(reason, 'accepted') AS metric, count(*) AS value FROM lines GROUP BY 1 "
        "UNION ALL SELECT 'lines', count(*) FROM lines"
    ),
    "batch_run_matching": O.with_(O.TR, O.DD, O.CL, O.PREDS, O.LEAVES, O.domain_leaves_cte(MATCH_DOMAIN)) + (
        "SELECT NULLIF(trim(Subject), '') AS Subject, NULLIF(trim(Object), '') AS Object, "
        "NULLIF(trim(Predicate), '') AS Predicate FROM cl WHERE Predicate IN (SELECT Predicate FROM dleaves) "
        "AND contains(Object, Subject)"
    ),
    "batch_run_full": ORACLE["export_roundtrip_default"],
    "batch_run_predicates": O.CL_BASE + "SELECT DISTINCT NULLIF(trim(Predicate), '') AS Predicate FROM cl",
    "batch_run_counters": ORACLE["run_metrics"],
    "run_ledger": ORACLE["run_metrics"],
    "domain_triples_given": ORACLE["domain_triples"],
    "domain_sample_check": O.with_(O.TR, O.DD, O.CL, O.PREDS, O.LEAVES, O.domain_leaves_cte(SAMPLE_DOMAIN)) + (
        "SELECT count(*) AS n_domain, CAST(0 AS BIGINT) AS n_outside, CAST(0 AS BIGINT) AS n_repeated, "
        "true AS size_in_bound FROM cl WHERE Predicate IN (SELECT Predicate FROM dleaves)"
    ),
    "graph_nodes_by_subject": ORACLE["graph_nodes"],
    "subject_as_object_by_subject": ORACLE["subject_as_object"],
    "template_roundtrip": _HIER,
    "predicates_mapped": O.with_(O.TR, O.DD) + (
        f"SELECT {O.clean_subject_sql('Subject')} AS Subject, {_MAPPED} AS Predicate, "
        f"{O.clean_object_sql('Object')} AS Object FROM dd"
    ),
    "graph_from_csv": ORACLE["graph_nodes"],
}

# Not SQL-expressible (a random draw): rows-only check, plus a subset test.
NO_ORACLE = ("domain_sample_random",)
