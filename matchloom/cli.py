"""Command lines: train, infer or all; validate; and the test suite."""

from __future__ import annotations

import argparse
import os
import subprocess
import sys

from pyspark.sql import SparkSession

from .operators.models import HybridLinker
from .plans import jobs


def _session() -> SparkSession:
    return SparkSession.builder.appName("matchloom").getOrCreate()


def pipeline(argv: list[str]) -> int:
    parser = argparse.ArgumentParser(prog="matchloom", description="Train the linker, or link test records.")
    parser.add_argument("--mode", choices=["train", "infer", "all"], default="all")
    parser.add_argument("--s1-samples", type=int, default=25000, help="truth rows to train on")
    parser.add_argument("--target-samples", type=int, default=100000, help="targets to train among, beside those needed")
    parser.add_argument("--max-test-s1", type=int, default=None, help="records to link in a trial run")
    parser.add_argument("--data", default="dataset", help="folder with train/ and test/")
    parser.add_argument("--models", default="models", help="folder of the model and the target index")
    parser.add_argument("--output", default="output")
    parser.add_argument("--metrics", default="experiments/training_metrics.json")
    args = parser.parse_args(argv)
    spark = _session()
    if args.mode != "infer":
        linker, metrics = jobs.train_files(spark, f"{args.data}/train", args.s1_samples, args.target_samples)
        linker.save(f"{args.models}/linker")
        jobs.write_metrics(spark, metrics, args.metrics)
        print(metrics)
    if args.mode != "train":
        if not jobs.exists(spark, f"{args.models}/linker"):
            print(f"no model at {args.models}/linker: train first", file=sys.stderr)
            return 1
        jobs.link_files(spark, HybridLinker.load(spark, f"{args.models}/linker"), f"{args.data}/test", f"{args.models}/targets", args.output, args.max_test_s1)
    return 0


def validator(argv: list[str]) -> int:
    parser = argparse.ArgumentParser(prog="matchloom validate", description="Validate result files; 0 if nothing blocks.")
    parser.add_argument("--matching", "-m", default="output/matching_results.tsv")
    parser.add_argument("--candidate", "-c", default="output/candidate_pairs.tsv")
    parser.add_argument("--test-dir", "-t", default="dataset/test")
    parser.add_argument("--check-ids", action="store_true", help="look up every id in sources 2 and 3")
    args = parser.parse_args(argv)
    errors, warnings = jobs.validated(_session(), args.matching, args.candidate, args.test_dir, args.check_ids)
    for w in warnings:
        print(f"WARNING: {w}")
    for e in errors:
        print(f"ERROR: {e}")
    print(f"FAIL: {len(errors)} errors" if errors else "PASS")
    return 1 if errors else 0


def main(argv: list[str]) -> int:
    if argv[:1] == ["--test"]:
        root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        return subprocess.run([sys.executable, "-m", "pytest", os.path.join(root, "tests"), "-q"], check=False).returncode
    return validator(argv[1:]) if argv[:1] == ["validate"] else pipeline(argv)
