"""Spark-native cleaning and exploration of subject-predicate-object triples.

Every operator takes and returns DataFrames (or Columns) and is built from
native Spark SQL expressions, joins and aggregates; there is no Python UDF
on any hot path.  The most used entry points are importable from here.
"""

__version__ = "0.1.0"

from triplex.operators.domains import domain_sample_hash, domain_triples, domain_triples_from_raw  # noqa: E402
from triplex.operators.hierarchy import domain_leaves, leaf_predicates, predicate_hierarchy  # noqa: E402
from triplex.operators.matching import matching_triples, subject_as_object_from_raw, substring_pairs  # noqa: E402
from triplex.operators.triples import clean_triples, drop_duplicate_triples, object_parts  # noqa: E402
from triplex.operators.vocabulary import domain_counts, unique_predicates  # noqa: E402
from triplex.plans.batch import ExportConfig, run_batch  # noqa: E402
from triplex.sinks.delimited import merge_parts, write_delimited  # noqa: E402
from triplex.sources.triples import read_triples  # noqa: E402

__all__ = [
    "ExportConfig", "clean_triples", "domain_counts", "domain_leaves", "domain_sample_hash",
    "domain_triples", "domain_triples_from_raw", "drop_duplicate_triples", "leaf_predicates",
    "matching_triples", "merge_parts", "object_parts", "predicate_hierarchy", "read_triples",
    "run_batch", "subject_as_object_from_raw", "substring_pairs", "unique_predicates", "write_delimited",
]
