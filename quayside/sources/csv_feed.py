"""Raw CSV feeds: read by header name, all columns STRING, '' for missing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.contracts import string_schema


def scan_csv(spark: SparkSession, path: str, columns, multiline: bool = False, optional=()) -> DataFrame:
    """Read a CSV feed the way a header-driven dict reader sees it.

    * columns go by the names in the header, in whatever order; fields a short
      row lacks are '', and so are ``optional`` columns the header lacks (another
      missing column is an error); columns not asked for are left out;
    * every column is STRING (casting is an explicit rule later) with its blanks
      as they are; ``escape='"'`` reads doubled quotes inside quoted JSON whole;
    * the files under ``path`` share one header: each file's is compared, and one
      that has other names or another order fails the read.

    ``multiline`` is only for feeds with quoted newlines: it disables file
    splitting, so keep it off for large feeds that do not need it.
    """
    reader = (spark.read.option("header", True).option("escape", '"').option("encoding", "UTF-8")
              .option("mode", "PERMISSIVE").option("inferSchema", False)
              .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))
    if multiline:
        reader = reader.option("multiLine", True)
    header = reader.csv(path).columns  # the first line of one file
    if missing := [c for c in columns if c not in header and c not in optional]:
        raise ValueError(f"{path}: the header lacks {missing}")
    # all of a header is compared only if all columns are parsed
    feed = reader.option("enforceSchema", False).option("columnPruning", False).schema(string_schema(header)).csv(path)
    return feed.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) if c in header else F.lit("").alias(c)
                         for c in columns])


def write_csv(df: DataFrame, path: str) -> None:
    """Land a frame as header CSV with doubled-quote escaping (landing zone);
    leading and trailing blanks survive."""
    (df.write.mode("overwrite").option("header", True).option("escape", '"')
       .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
       .option("encoding", "UTF-8").csv(path))


def scan_run_log(spark: SparkSession, path: str, columns) -> DataFrame:
    return scan_csv(spark, path, columns)
