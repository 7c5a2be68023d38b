"""Command line: the two analyses over item / rating CSV files.

    python -m ratekit values --items movies.csv --ratings ratings.csv \\
        --values A,B,C [--n 10] [--min-count 10] [--report DIR]
    python -m ratekit cf --ratings ratings.csv [--model cosine|centered] \\
        [--min-common 5] [--k 30] [--max-user-ratings 0] [--split hash|exact|random] \\
        [--frac 0.8] [--seed N] [--report DIR]

Run with ``spark-submit -m``-style launchers or plain ``python -m`` (local
mode unless a master is configured). Only bounded results reach the driver:
the value table and lists are shown with ``show``; the one-row metrics are
collected for the metric lines.
"""

from __future__ import annotations

import argparse
import sys

from ratekit.functions.columns import split_buckets
from ratekit.session import build_session


def _values(args, spark) -> None:
    from ratekit.plans import print_list_tables, print_value_table, value_analysis, value_report_lines, write_report
    from ratekit.sources import read_items_csv, read_ratings_csv

    values = [v for v in args.values.split(",") if v]
    items = read_items_csv(spark, args.items)
    ratings = read_ratings_csv(spark, args.ratings)
    va = value_analysis(items, ratings, values, n=args.n, min_count=args.min_count)
    print("\nValues and number of items")
    print_value_table(va, args.show_values or None)
    print("\nTop lists")
    print_list_tables(va)
    if args.report:
        write_report(value_report_lines(va), args.report)
        print(f"report written to {args.report}")
    va.release()


def _cf(args, spark) -> None:
    from ratekit.plans import centered_knn, cf_report_lines, cosine_knn, model_notes, write_report
    from ratekit.sources import read_ratings_csv, rejected_ratings_csv

    ratings = read_ratings_csv(spark, args.ratings)
    if args.model == "cosine":
        cap = None
        r = cosine_knn(
            ratings, frac=args.frac, split=args.split, seed=args.seed, min_common=args.min_common, k=args.k,
            repeated=True,
        )
        model = "Item-based collaborative filtering"
        details = f"cosine similarity, min_common_users={args.min_common}, top_k={args.k}"
    else:
        cap = args.max_user_ratings if args.max_user_ratings > 0 else None
        r = centered_knn(
            ratings, frac=args.frac, split=args.split, seed=args.seed, min_common=args.min_common,
            k=args.k, max_user_ratings=cap, repeated=True,
        )
        model = "Adjusted item-based collaborative filtering"
        details = f"adjusted cosine, min_common_users={args.min_common}, top_k={args.k}, max_user_ratings={cap}"
    bad = rejected_ratings_csv(spark, args.ratings).count()
    if bad:
        print(f"Rows without a readable user, item or rating: {bad}")
    m = r.metrics.collect()[0]  # one row, kept for the report
    print(f"Train rows: {m.train_rows}, test rows: {m.test_rows}")
    print(f"Mean rating in train: {m.train_mean:.6f}")
    print(f"Baseline RMSE on test: {m.baseline_rmse:.6f}")
    print(f"{model} RMSE on test: {m.cf_rmse:.6f}")
    print(f"Fallback predictions: {m.fallback_count} of {m.test_rows}")
    print(f"Coverage: {100.0 * m.coverage:.2f}%")
    split = {
        "hash": "deterministic hash of (user, item), {1} of {0} buckets".format(*split_buckets(args.frac)),
        "exact": f"exactly round({args.frac} n) rows in hash order",
        "random": f"a draw for every row (seed {args.seed}), share {args.frac}",
    }[args.split]
    if args.report:
        write_report(
            cf_report_lines(
                r.metrics, model, details, split=split, neighbours=r.neighbours,
                notes=model_notes(args.model, args.min_common, args.k, cap),
            ),
            args.report,
        )
        print(f"report written to {args.report}")
    r.release()


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="ratekit")
    p.add_argument("--master", default=None, help="Spark master (default: from the launcher)")
    p.add_argument("--shuffle-partitions", type=int, default=None)
    sub = p.add_subparsers(dest="cmd", required=True)

    v = sub.add_parser("values", help="items per value and top-n lists per value")
    v.add_argument("--items", required=True)
    v.add_argument("--ratings", required=True)
    v.add_argument("--values", required=True, help="the chosen values, comma-separated")
    v.add_argument("--n", type=int, default=10)
    v.add_argument("--min-count", type=int, default=10)
    v.add_argument("--show-values", type=int, default=0, help="print at most this many (0 = all)")
    v.add_argument("--report", default=None, help="output folder of the markdown report")

    c = sub.add_parser("cf", help="item-based collaborative filtering evaluation")
    c.add_argument("--ratings", required=True)
    c.add_argument("--model", choices=("cosine", "centered"), default="cosine")
    c.add_argument("--split", choices=("hash", "exact", "random"), default="hash")
    c.add_argument("--frac", type=float, default=0.8)
    c.add_argument("--seed", type=int, default=None, help="another split for each seed")
    c.add_argument("--min-common", type=int, default=5)
    c.add_argument("--k", type=int, default=30)
    c.add_argument("--max-user-ratings", type=int, default=0, help="0 = no cap (centered model)")
    c.add_argument("--report", default=None)

    args = p.parse_args(argv)
    from pyspark.sql import SparkSession

    owned = SparkSession.getActiveSession() is None
    spark = build_session(master=args.master, shuffle_partitions=args.shuffle_partitions)
    try:
        {"values": _values, "cf": _cf}[args.cmd](args, spark)
    finally:
        if owned:
            spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
