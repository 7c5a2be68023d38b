"""Markdown reports as DataFrames of (section, line, text) rows.

Rendering is column expressions (format_string, replace, concat_ws), so the
rows are produced where the data lives; only the finished, bounded report
(value vocabulary + values x lists x n rows) is written as one text file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ratekit.functions.columns import md_cell, md_row
from ratekit.plans.display import value_table
from ratekit.plans.values import ValueAnalysis

_LINES = StructType(
    [
        StructField("section", LongType(), False),
        StructField("line", LongType(), False),
        StructField("text", StringType(), False),
    ]
)

# Section titles of the value report.
COUNTS_TITLE = "Items per value"
LIST_TITLES = {
    "most_rated": "{value}: top {n} by number of ratings",
    "least_rated": "{value}: top {n} by smallest number of ratings, rating_count > {m}",
    "best": "{value}: top {n} by highest average rating, rating_count > {m}",
    "worst": "{value}: top {n} by lowest average rating, rating_count > {m}",
}
LIST_COLUMNS = ("title", "rating_count", "avg_rating")


def _fixed(spark: SparkSession, rows: list[tuple[int, int, str]]) -> DataFrame:
    return spark.createDataFrame(rows, _LINES)


def _head(section: int, title: str, columns: tuple[str, ...]) -> list[tuple[int, int, str]]:
    return [
        (section, 0, ""),
        (section, 1, f"## {title}"),
        (section, 2, ""),
        (section, 3, "| " + " | ".join(columns) + " |"),
        (section, 4, "| " + " | ".join("---" for _ in columns) + " |"),
    ]


def value_report_layout(
    values: tuple[str, ...], n: int, min_count: int, title: str = "Rating report"
) -> tuple[list[tuple[int, int, str]], dict[tuple[str, str], int]]:
    """Fixed lines of the value report and the section number of each
    (value, list). Pure Python: shared by the Spark plan and its checks."""
    fixed = [
        (0, 0, f"# {title}"),
        (0, 1, ""),
        (0, 2, "Values: " + ", ".join(values) + "."),
    ]
    fixed += _head(1, COUNTS_TITLE, ("value", "item_count"))
    section_of: dict[tuple[str, str], int] = {}
    s = 2
    for v in values:
        for name in LIST_TITLES:
            section_of[(v, name)] = s
            fixed += _head(s, LIST_TITLES[name].format(value=v, n=n, m=min_count), LIST_COLUMNS)
            s += 1
    return fixed, section_of


def value_report_lines(va: ValueAnalysis, title: str = "Rating report") -> DataFrame:
    """The value report: header, the items-per-value table, then for every
    chosen value its four lists, each as a markdown table."""
    spark = va.stats.sparkSession
    fixed, section_of = value_report_layout(va.values, va.n, va.min_count, title)
    counts = value_table(va.counts).select(
        F.lit(1).cast("bigint").alias("section"),
        (F.lit(4) + F.col("line")).cast("bigint").alias("line"),
        md_row(md_cell("value"), md_cell("item_count")).alias("text"),
    )
    sec = F.create_map(
        *[x for (v, name), i in section_of.items() for x in (F.lit(f"{v}\u0000{name}"), F.lit(i))]
    )
    rows = va.lists.select(
        sec[F.concat_ws("\u0000", "value", "list_name")].cast("bigint").alias("section"),
        (F.lit(4) + F.col("rank")).cast("bigint").alias("line"),
        md_row(md_cell("title"), md_cell("rating_count"), md_cell("avg_rating", 3)).alias("text"),
    )
    return _fixed(spark, fixed).unionByName(counts).unionByName(rows)


def model_notes(model: str, min_common: int, k: int, max_user_ratings: int | None = None) -> tuple[str, ...]:
    """What the figures mean, from a model's parameters (``cosine`` or ``centered``)."""
    error = "RMSE is the root of the mean squared difference of rating and prediction over all test rows."
    if model == "cosine":
        return (
            error,
            f"Two items are similar by the cosine of their ratings over the users of both, {min_common} users at least; only positive values count.",
            f"A prediction is the similarity-weighted mean of the user's {k} most similar rated items.",
            "Without such an item the train mean is predicted.",
        )
    support = "2 or more" if max_user_ratings is None else f"2 to {max_user_ratings}"
    return (
        error,
        f"Two items are similar by the cosine of ratings less the user's mean over the users of both, {min_common} users at least.",
        f"Similarities are learned from users with {support} training ratings; every training rating is used to predict.",
        f"A prediction adds the weighted deviation on the item's {k} nearest neighbours to the user's mean, within the rating scale.",
        "Without a rated neighbour the user's mean is predicted, for an unknown user the train mean.",
    )


def cf_report_lines(
    metrics: DataFrame,
    model: str,
    details: str,
    split: str = "deterministic hash of (user, item), 80 of 100 buckets",
    neighbours: DataFrame | None = None,
    notes: tuple[str, ...] = (),
) -> DataFrame:
    """Split/baseline table, result table and notes from the one-row metrics.

    The metrics are read once; ``notes`` (see :func:`model_notes`) follow the counts.

    With the model-time ``neighbours`` table (adjusted model) the notes also
    give its row count and the number of items with learned neighbours.
    """
    spark = metrics.sparkSession
    fixed = [
        (0, 0, "# Collaborative filtering results"),
        (0, 1, ""),
        (0, 2, f"Split: {split}."),
    ]
    fixed += _head(1, "Split and baseline", ("metric", "value"))
    fixed += _head(2, "Collaborative filtering result", ("model", "rmse", "details"))
    fixed += [(3, 0, ""), (3, 1, "## Notes"), (3, 2, "")]
    fixed += [(3, 6 + k, f"- {note}") for k, note in enumerate(notes)]

    def line(section: int, no: int, *cells: Column) -> Column:
        return F.struct(
            F.lit(section).cast("bigint").alias("section"),
            F.lit(no).cast("bigint").alias("line"),
            md_row(*cells).alias("text"),
        )

    lit = lambda s: md_cell(F.lit(s))
    pct = F.format_string("%.2f%%", F.round(F.col("coverage") * F.lit(100.0), 2))
    rows = metrics.select(
        F.explode(
            F.array(
                line(1, 5, lit("train rows"), md_cell("train_rows")),
                line(1, 6, lit("test rows"), md_cell("test_rows")),
                line(1, 7, lit("mean rating in train"), md_cell("train_mean", 6)),
                line(1, 8, lit("baseline RMSE on test"), md_cell("baseline_rmse", 6)),
                line(
                    2,
                    5,
                    lit("Train mean baseline"),
                    md_cell("baseline_rmse", 6),
                    F.concat(F.lit("prediction = "), md_cell("train_mean", 6)),
                ),
                line(
                    2,
                    6,
                    lit(model),
                    md_cell("cf_rmse", 6),
                    F.concat(F.lit(details.replace("|", "\\|") + ", coverage="), pct),
                ),
                F.struct(
                    F.lit(3).cast("bigint").alias("section"),
                    F.lit(3).cast("bigint").alias("line"),
                    F.format_string(
                        "- Fallback predictions: %d of %d test rows.", F.col("fallback_count"), F.col("test_rows")
                    ).alias("text"),
                ),
            )
        ).alias("l")
    ).select("l.*")
    out = _fixed(spark, fixed).unionByName(rows)
    if neighbours is not None:
        from ratekit.operators.similarity import neighbour_summary

        nb = neighbour_summary(neighbours).select(
            F.explode(
                F.array(
                    F.struct(
                        F.lit(3).cast("bigint").alias("section"),
                        F.lit(4).cast("bigint").alias("line"),
                        F.format_string("- Top-similarity table rows: %d.", "neighbour_rows").alias("text"),
                    ),
                    F.struct(
                        F.lit(3).cast("bigint").alias("section"),
                        F.lit(5).cast("bigint").alias("line"),
                        F.format_string("- Items with learned neighbors: %d.", "learned_items").alias("text"),
                    ),
                )
            ).alias("l")
        ).select("l.*")
        out = out.unionByName(nb)
    return out


def write_report(lines: DataFrame, path: str) -> None:
    """Write the ordered report as one text file (the report is bounded)."""
    (
        lines.repartition(1)
        .sortWithinPartitions("section", "line")
        .select("text")
        .write.mode("overwrite")
        .text(path)
    )
