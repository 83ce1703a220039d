"""The batch run: ingest -> dedup -> clean -> exports, with run metrics.

Compared with a chain of independent actions over an uncached plan, the
run reads and dedups the input **once**: the cleaned triples are written
to a Parquet table (sorted by predicate inside each file, so a domain
filter skips row groups), and every export reads that table.  Counters come
from that table as it was committed (narrow columns only) and are recorded in
a ledger (``triplex.plans.ledger``).  Elapsed seconds are measured around
actions (not around lazy plan building).
"""

from __future__ import annotations

import hashlib
import time
import uuid
from contextlib import contextmanager
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from triplex.constants import DEFAULT_DOMAIN, DEFAULT_SAMPLE_FRACTION, EXPORT_DELIMITER
from triplex.operators.domains import (
    SAMPLE_UNIT,
    _TWO_32,
    domain_triples,
    raw_predicates_of_domain,
    sample_unit,
)
from triplex.operators.matching import matching_triples
from triplex.operators.tokens import triple_tokens
from triplex.operators.triples import bounded_key, clean_triples
from triplex.operators.vocabulary import unique_predicates
from triplex.plans import ledger
from triplex.schema import METRICS_SCHEMA, OBJECT, PREDICATE, SUBJECT, TRIPLE_COLUMNS
from triplex.session import scratch_path
from triplex.sinks.delimited import write_delimited
from triplex.sources.triples import CheckedTriples

#: Raw copies of a triple, kept beside the cleaned columns.
COPIES = "_copies"


@dataclass
class ExportConfig:
    """Switches and parameters of one run (all exports are independent)."""

    export_sample: bool = True
    export_matching: bool = False
    export_full: bool = False
    export_unique_predicates: bool = False
    domain: str = DEFAULT_DOMAIN
    fraction: float = DEFAULT_SAMPLE_FRACTION
    sample_mode: str = "hash"  # "hash" (repeatable) or "random" (Spark sample)
    seed: int | None = None
    sample_folder: str | None = None
    matching_path: str | None = None
    full_path: str | None = None
    predicates_path: str | None = None
    work_dir: str | None = None
    hierarchy: DataFrame | None = None  # a maintained vocabulary; else the data's own
    delimiter: str = EXPORT_DELIMITER
    ledger_path: str | None = None  # of all runs; else one beside the run's data
    run_id: str | None = None  # a retry under the same id replaces the run's counters
    input_name: str | None = None  # what the run read; a later run over it replaces its counters


@dataclass
class RunResult:
    cleaned: DataFrame
    tokens: DataFrame
    counters: dict[str, int] = field(default_factory=dict)
    seconds: dict[str, float] = field(default_factory=dict)
    paths: dict[str, str] = field(default_factory=dict)

    def metrics(self, spark: SparkSession) -> DataFrame:
        """``stage, metric, value`` rows (a handful, built on the driver)."""
        rows = [("counters", k, float(v)) for k, v in self.counters.items()]
        rows += [(k, "seconds", float(v)) for k, v in self.seconds.items()]
        return spark.createDataFrame(rows, METRICS_SCHEMA)


class _Clock:
    """Elapsed seconds per named stage, measured around actions."""

    def __init__(self):
        self.seconds: dict[str, float] = {}

    @contextmanager
    def __call__(self, name: str):
        t0 = time.perf_counter()
        try:
            yield
        finally:
            self.seconds[name] = self.seconds.get(name, 0.0) + time.perf_counter() - t0


def materialise_cleaned(raw: DataFrame, path: str, counters: dict[str, int] | None = None) -> DataFrame:
    """Dedup + clean ``raw`` once and write it to ``path`` (Parquet).

    Keeps the raw-triple sample unit and the number of raw copies beside the
    cleaned columns.  The row counts come from the table as it was committed,
    two narrow columns, so tasks that Spark runs twice cannot count twice.
    """
    dedup = raw.groupBy(*TRIPLE_COLUMNS).agg(F.count(F.lit(1)).alias(COPIES))
    cleaned = clean_triples(dedup.select(*TRIPLE_COLUMNS, sample_unit().alias(SAMPLE_UNIT), COPIES))
    cleaned.sortWithinPartitions(PREDICATE).write.mode("overwrite").parquet(path)
    written = raw.sparkSession.read.schema(cleaned.schema).parquet(path)
    if counters is not None:
        n = written.agg(F.coalesce(F.sum(COPIES), F.lit(0)).alias("raw"), F.count(F.lit(1)).alias("distinct")).first()
        counters["initCount"], counters["finalCount"] = int(n["raw"]), int(n["distinct"])
    return written


def run_exports(cleaned: DataFrame, cfg: ExportConfig, counters: dict, clock: _Clock, paths: dict) -> None:
    """The four optional exports, in a fixed order; each one is one write job."""
    base = cfg.work_dir
    triples = cleaned.select(*TRIPLE_COLUMNS)
    if cfg.export_sample:
        with clock(f"export {cfg.domain} sample"):
            in_domain = domain_triples(cleaned, cfg.domain, cleaned.select(PREDICATE), cfg.hierarchy)
            picked = F.col(SAMPLE_UNIT) < F.lit(cfg.fraction * _TWO_32)
            n = in_domain.agg(F.count(F.lit(1)).alias("domain"), F.count(F.when(picked, 1)).alias("sample")).first()
            path = f"{cfg.sample_folder or base + '/sample_'}{cfg.domain}_triples"
            if cfg.sample_mode == "hash":
                write_delimited(in_domain.where(picked).select(*TRIPLE_COLUMNS), path, sep=cfg.delimiter)
                counters["sample"] = int(n["sample"])
            else:
                # Drawn in the tasks that write, which Spark observes once each.
                seen = Observation("sample")
                sample = in_domain.sample(False, cfg.fraction, cfg.seed).select(*TRIPLE_COLUMNS)
                write_delimited(sample.observe(seen, F.count(F.lit(1)).alias("sample")), path, sep=cfg.delimiter)
                counters["sample"] = int(seen.get["sample"])
            counters["domainCount"] = int(n["domain"])
            paths["sample"] = path
    if cfg.export_matching:
        with clock("matching triples"):
            path = cfg.matching_path or f"{base}/matching_triples"
            write_delimited(matching_triples(triples, cfg.domain, cfg.hierarchy), path, sep=cfg.delimiter)
            paths["matching"] = path
    if cfg.export_full:
        with clock("full export"):
            path = cfg.full_path or f"{base}/full"
            write_delimited(triples, path, sep=cfg.delimiter)
            paths["full"] = path
    if cfg.export_unique_predicates:
        with clock("predicates export"):
            path = cfg.predicates_path or f"{base}/unique_predicates"
            write_delimited(unique_predicates(triples), path, sep=cfg.delimiter)
            paths["unique_predicates"] = path


def input_name(raw: DataFrame) -> str:
    """A name for the files that ``raw`` reads; the same files have the same name in every run."""
    files = sorted(raw.inputFiles())
    if len(files) <= 1:
        return files[0] if files else "table"
    return f"{len(files)} files {hashlib.sha256(chr(10).join(files).encode()).hexdigest()[:16]}"


def run_batch(spark: SparkSession, raw: DataFrame, cfg: ExportConfig | None = None,
              perform_counts: bool = True, checked: CheckedTriples | None = None) -> RunResult:
    """Run ingest -> dedup -> clean -> exports and return the result and metrics.

    ``raw`` is a ``Subject, Predicate, Object`` frame (``read_triples`` or the
    table adapter).  Output folders default to a fresh folder under the
    session's shared checkpoint directory.  With ``checked`` (a checked dump,
    whose ``triples`` are ``raw``) the rejected lines are written beside the
    data and counted.  The counters are recorded in a ledger beside the data.
    """
    cfg = cfg or ExportConfig()
    if cfg.work_dir is None:  # the caller's config stays as it is: its next run gets a folder of its own
        cfg = replace(cfg, work_dir=scratch_path(spark, "run"))
    clock, counters, paths = _Clock(), {}, {}
    with clock("dedup and clean"):
        cleaned = materialise_cleaned(raw, f"{cfg.work_dir}/cleaned", counters if perform_counts else None)
    paths["cleaned"] = f"{cfg.work_dir}/cleaned"
    if checked is not None:
        with clock("rejected lines"):
            paths["rejects"] = f"{cfg.work_dir}/rejects"
            checked.rejects.write.mode("overwrite").parquet(paths["rejects"])
            counters["rejectCount"] = spark.read.schema(checked.rejects.schema).parquet(paths["rejects"]).count()
    run_exports(cleaned, cfg, counters, clock, paths)
    if counters:
        paths["ledger"] = cfg.ledger_path or f"{cfg.work_dir}/ledger"
        ledger.record(spark, paths["ledger"], cfg.run_id or uuid.uuid4().hex, {cfg.input_name or input_name(raw): counters})
    tokens = triple_tokens(cleaned.select(*TRIPLE_COLUMNS))
    return RunResult(cleaned.select(*TRIPLE_COLUMNS), tokens, counters, clock.seconds, paths)


def combine_metrics(*metrics: DataFrame) -> DataFrame:
    """Add up ``stage, metric, value`` relations (counters are additive)."""
    out = metrics[0]
    for m in metrics[1:]:
        out = out.unionByName(m)
    return out.groupBy("stage", "metric").agg(F.sum("value").alias("value"))


def run_counters(raw: DataFrame, domain: str = DEFAULT_DOMAIN,
                 fraction: float = DEFAULT_SAMPLE_FRACTION, hierarchy: DataFrame | None = None) -> DataFrame:
    """The run's counters as a lazy ``metric, value`` relation.

    Counting needs no cleaned values and no texts: copies meet by keys of
    bounded size, in one shuffle, and are counted per raw predicate.  Those
    few counts then meet the domain's predicates (cleaned once per distinct
    predicate), so no row is dealt by its predicate: a domain whose rows are
    nearly all of one predicate is counted by as many tasks as any other.
    """
    raw = raw.select(*TRIPLE_COLUMNS)
    per_triple = raw.groupBy(PREDICATE, bounded_key(SUBJECT).alias("_s"), bounded_key(OBJECT).alias("_o")).agg(
        F.count(F.lit(1)).alias("n"), F.max(sample_unit() < F.lit(fraction * _TWO_32)).alias("picked")
    )
    per_predicate = per_triple.groupBy(F.col(PREDICATE).alias("_p")).agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("n_distinct"), F.count(F.when(F.col("picked"), 1)).alias("n_picked")
    )
    wanted = raw_predicates_of_domain(raw, domain, hierarchy).where(F.col(PREDICATE).isNotNull()).distinct()
    found, zero = F.col(PREDICATE).isNotNull(), F.lit(0).cast("long")
    out = per_predicate.join(wanted, F.col("_p") == F.col(PREDICATE), "left").agg(
        F.sum("n").alias("initCount"),
        F.coalesce(F.sum("n_distinct"), zero).alias("finalCount"),
        F.coalesce(F.sum(F.when(found, F.col("n_distinct"))), zero).alias("domainCount"),
        F.coalesce(F.sum(F.when(found, F.col("n_picked"))), zero).alias("sample"),
    )
    return out.unpivot([], out.columns, "metric", "value")
