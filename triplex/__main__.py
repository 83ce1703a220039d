"""Command-line batch run: ``python -m triplex --input <tsv> [options]``.

Reads the dump, dedups and cleans it once, runs the selected exports and
prints the counters and seconds per stage as JSON.  Session settings come
from ``spark-submit`` / the environment; only the application name is set.
"""

from __future__ import annotations

import argparse
import json
import os
import sys

if not __package__:  # run as a file (spark-submit triplex/__main__.py): make the package importable
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from triplex.constants import DEFAULT_DOMAIN, DEFAULT_SAMPLE_FRACTION  # noqa: E402


def parse_args(argv=None) -> argparse.Namespace:
    ap = argparse.ArgumentParser(prog="triplex", description=__doc__.splitlines()[0])
    ap.add_argument("--input", required=True, nargs="+", help="tab-separated triple files or folders")
    ap.add_argument("--mode", choices=("compat", "ntriples"), default="compat", help="quoting of the input")
    ap.add_argument("--spread", type=int, default=None,
                    help="round-robin the parsed rows over N partitions "
                         "(default for .gz inputs: the session's parallelism)")
    ap.add_argument("--domain", default=DEFAULT_DOMAIN)
    ap.add_argument("--fraction", type=float, default=DEFAULT_SAMPLE_FRACTION)
    ap.add_argument("--sample-mode", choices=("hash", "random"), default="hash")
    ap.add_argument("--seed", type=int, default=None)
    ap.add_argument("--no-sample", action="store_true", help="skip the domain sample export")
    ap.add_argument("--matching", action="store_true", help="export matching triples of the domain")
    ap.add_argument("--full", action="store_true", help="export all cleaned triples")
    ap.add_argument("--unique-predicates", action="store_true", help="export the unique predicates")
    ap.add_argument("--work-dir", default=None, help="output folder (default: under spark.checkpoint.dir)")
    ap.add_argument("--check-lines", action="store_true", help="set lines that are no triple apart and count them")
    ap.add_argument("--ledger", default=None, help="counter ledger of all runs (default: beside the run's data)")
    ap.add_argument("--run-id", default=None, help="a retry under the same id replaces the run's counters")
    ap.add_argument("--no-counts", action="store_true", help="skip the raw / dedup counters")
    return ap.parse_args(argv)


def main(argv=None, spark=None) -> dict:
    args = parse_args(argv)
    from pyspark.sql import SparkSession

    from triplex.plans.batch import ExportConfig, run_batch
    from triplex.sources.triples import read_triples, read_triples_checked

    spark = spark or SparkSession.builder.appName("triplex").getOrCreate()
    cfg = ExportConfig(
        export_sample=not args.no_sample,
        export_matching=args.matching,
        export_full=args.full,
        export_unique_predicates=args.unique_predicates,
        domain=args.domain,
        fraction=args.fraction,
        sample_mode=args.sample_mode,
        seed=args.seed,
        work_dir=args.work_dir,
        ledger_path=args.ledger,
        run_id=args.run_id,
        input_name=" ".join(args.input),
    )
    spread = args.spread
    if spread is None and any(str(p).endswith(".gz") for p in args.input):
        # gzip files cannot be split: spread the parsed rows over the cluster.
        spread = spark.sparkContext.defaultParallelism
    checked = read_triples_checked(spark, args.input, args.mode) if args.check_lines else None
    raw = checked.triples if checked else read_triples(spark, args.input, args.mode, spread=spread)
    result = run_batch(spark, raw.repartition(spread) if checked and spread else raw, cfg, not args.no_counts, checked)
    report = {"counters": result.counters, "seconds": result.seconds, "paths": result.paths}
    print(json.dumps(report, indent=2))
    return report


if __name__ == "__main__":
    main()
