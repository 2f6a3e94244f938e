"""JSON lines with line accounting. Rows keep their order and their original text.

Lines are read as text and parsed by column expressions, so malformed lines are counted and not
hidden. ``row_idx`` follows the lines of a file; across files it follows their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltmill.functions.jsonx import parsed
from siltmill.functions.text import strip


def lines(spark: SparkSession, path: str) -> DataFrame:
    """``(row_idx, raw)`` of every physical line, blank ones included.

    The index is a place in the file order: file, split and line within it, in one increasing number
    that is not dense. ``numbered`` makes it dense where an operator needs that.
    """
    text = spark.read.text(path).select("value", "_metadata.file_path", "_metadata.file_block_start")
    return text.select(F.struct("file_path", "file_block_start", F.monotonically_increasing_id().alias("n")).alias("row_idx"), F.col("value").alias("raw"))


def numbered(rows: DataFrame, by: str = "row_idx") -> DataFrame:
    """``rows`` with ``line_no`` from 0. Counts per file split are summed first, so lines are numbered in parallel."""
    from pyspark.sql import Window

    at = rows.withColumns({"__f": F.col(f"{by}.file_path"), "__s": F.col(f"{by}.file_block_start")})
    counts = at.groupBy("__f", "__s").agg(F.count("*").alias("__n"))  # one row a split
    before = F.coalesce(F.sum("__n").over(Window.orderBy("__f", "__s").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    own = F.row_number().over(Window.partitionBy("__f", "__s").orderBy(by)) - 1
    joined = at.withColumn("__own", own).join(counts.select("__f", "__s", before.alias("__before")), ["__f", "__s"])
    return joined.withColumn("line_no", F.col("__own") + F.col("__before")).drop("__f", "__s", "__own", "__before")


def classify(rows: DataFrame, raw: str = "raw") -> DataFrame:
    """``rows`` with ``status``: blank, invalid (no JSON), other (JSON but no object) or object."""
    v = parsed(F.col(raw))
    kind = F.schema_of_variant(v)
    status = F.when(strip(F.col(raw)) == "", "blank").when(v.isNull(), "invalid").when(kind.startswith("OBJECT"), "object").otherwise("other")
    return rows.withColumn("status", status)


def accounting(classified: DataFrame) -> DataFrame:
    """total, blank, invalid and rows; JSON that is no object counts as invalid."""
    return classified.agg(
        F.count("*").alias("total_lines"), F.count_if(F.col("status") == "blank").alias("blank_lines"),
        F.count_if(F.col("status").isin("invalid", "other")).alias("invalid_lines"), F.count_if(F.col("status") == "object").alias("json_rows"),
    )


def read_strict(spark: SparkSession, path: str, schema: str, missing_ok: bool = True) -> DataFrame:
    """Typed rows; a bad line fails the query, blank lines are skipped, a missing file is empty if allowed."""
    if missing_ok and not exists(spark, path):
        return spark.createDataFrame([], schema)
    rows = lines(spark, path).where(strip(F.col("raw")) != "")
    return rows.select("row_idx", F.from_json("raw", schema, {"mode": "FAILFAST"}).alias("r")).select("row_idx", "r.*")


def read_lenient(spark: SparkSession, path: str, schema: str, max_rows: int | None = None) -> DataFrame:
    """Typed rows of the lines that are objects, the first ``max_rows`` of them; ``raw`` is kept."""
    good = classify(lines(spark, path)).where("status = 'object'")
    good = good.orderBy("row_idx").limit(max_rows) if max_rows is not None else good
    return good.select("row_idx", "raw", F.from_json("raw", schema).alias("r")).select("row_idx", "raw", "r.*")


def read_any(spark: SparkSession, path: str) -> DataFrame:
    """``(row_idx, raw, value variant)`` of all lines that aren't blank; null where a line isn't JSON."""
    return lines(spark, path).where(strip(F.col("raw")) != "").withColumn("value", parsed(F.col("raw")))


def page(spark: SparkSession, path: str, offset: int, limit: int, most: int = 40_000) -> DataFrame:
    """Lines from physical line ``offset`` on; blank ones don't count; each is cut at ``most`` characters."""
    rows = numbered(lines(spark, path)).where((F.col("line_no") >= offset) & (strip(F.col("raw")) != ""))
    return rows.orderBy("line_no").limit(limit).select("line_no", F.left("raw", F.lit(most)).alias("raw"))


def count_lines(spark: SparkSession, path: str) -> int:
    return lines(spark, path).where(strip(F.col("raw")) != "").count()


def processed_ids(spark: SparkSession, path: str) -> DataFrame:
    """Distinct ids of an output file; bad lines and empty ids are ignored, a missing file has none."""
    if not exists(spark, path):
        return spark.createDataFrame([], "id string")
    ids = lines(spark, path).select(F.get_json_object(F.when(parsed(F.col("raw")).isNotNull(), F.col("raw")), "$.id").alias("id"))
    return ids.where("id is not null and id <> '' and id <> '0' and id <> 'false'").distinct()


def exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)
