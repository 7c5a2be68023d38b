'''CSV with a header row, RFC-4180 quoting (doubled quotes inside quotes).

Columns are found by the names in the header, in any order and among others; a
missing one is an error. Rows whose key or rating cannot be read are not dropped in
silence: ``rejected_*`` returns them as text.

Spark's default CSV escape character is a backslash, which mis-reads a
quoted field that starts with a doubled quote and splits a quoted field with
doubled quotes at an inner comma; ``escape='"'`` reads both correctly. The
writer keeps white space at the ends of a value, writes an empty text as ``""`` and
null as nothing, so a round trip through the item reader is lossless.
'''

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

_OPTS = {"header": "true", "escape": '"', "quote": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
# Header names of each column (ours, and the MovieLens ones).
ITEM_COLUMNS = {"item_id": ("item_id", "movieId"), "title": ("title",), "tags": ("tags", "genres")}
RATING_COLUMNS = {"user_id": ("user_id", "userId"), "item_id": ("item_id", "movieId"), "rating": ("rating",)}
_TYPES = {"item_id": "bigint", "user_id": "bigint", "rating": "double"}


def _texts(spark: SparkSession, path: str, columns: dict[str, tuple[str, ...]], multi_line: bool) -> DataFrame:
    """The named columns as text; Spark prunes the others in the scan."""
    # a null mark that no text holds, so that a quoted empty text stays a text
    reader = spark.read.options(**_OPTS, nullValue="\0", emptyValue="", multiLine=str(multi_line).lower())
    header = reader.csv(path).columns  # reads the first line only: no types are inferred
    schema = StructType([StructField(f"c{k}", StringType()) for k in range(len(header))])
    at = {}
    for name, known in columns.items():
        hits = [k for k, h in enumerate(header) if h.strip().lower() in [x.lower() for x in known]]
        if len(hits) != 1:
            raise ValueError(f"{path}: header {header} needs one column named {' or '.join(known)}")
        at[name] = hits[0]
    # by position within the file's own header, so no header name can clash
    df = reader.option("enforceSchema", "true").schema(schema).csv(path)
    return df.select([F.col(f"c{k}").alias(name) for name, k in at.items()])


def _cast(name: str) -> Column:
    return F.col(name).try_cast(_TYPES[name]) if name in _TYPES else F.col(name)


def _bad(columns: dict[str, tuple[str, ...]]) -> Column:
    """True where a typed column holds no readable value."""
    bad = F.lit(False)
    for name in columns:
        if name in _TYPES:
            bad = bad | _cast(name).isNull()
    return bad


def has_line_breaks(spark: SparkSession, path: str) -> bool:
    """Whether some line holds an odd number of quotes, so that a quoted value goes on in the next.

    Lines are read in splits by all tasks, and the search ends with the first hit.
    """
    line = F.col("value")
    quotes = F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))
    return not spark.read.text(path).filter(quotes % 2 == 1).isEmpty()


def _read(
    spark: SparkSession, path: str, columns: dict[str, tuple[str, ...]], multi_line: bool | None, rejected: bool
) -> DataFrame:
    if multi_line is None:
        multi_line = has_line_breaks(spark, path)
    df = _texts(spark, path, columns, multi_line)
    if rejected:
        return df.filter(_bad(columns))
    return df.filter(~_bad(columns)).select([_cast(name).alias(name) for name in columns])


def read_items_csv(spark: SparkSession, path: str, multi_line: bool | None = None) -> DataFrame:
    """(item_id, title, tags). Files without line breaks inside quotes are read in splits; with them
    a file is one task's. By default a pass over the lines decides (see
    :func:`has_line_breaks`); ``multi_line`` states it and saves the pass."""
    return _read(spark, path, ITEM_COLUMNS, multi_line, False)


def rejected_items_csv(spark: SparkSession, path: str, multi_line: bool | None = None) -> DataFrame:
    """The rows without a readable id, as text."""
    return _read(spark, path, ITEM_COLUMNS, multi_line, True)


def read_ratings_csv(spark: SparkSession, path: str) -> DataFrame:
    """(user_id, item_id, rating); further columns are not parsed."""
    return _read(spark, path, RATING_COLUMNS, False, False)


def rejected_ratings_csv(spark: SparkSession, path: str) -> DataFrame:
    """The rows without a readable user, item or rating, as text."""
    return _read(spark, path, RATING_COLUMNS, False, True)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Distributed CSV write (one file per partition) with the same quoting."""
    df.write.mode(mode).options(**_OPTS, nullValue="", emptyValue='""').csv(path)
