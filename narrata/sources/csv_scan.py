"""Splittable scan of CSV files whose quoted fields may hold line ends.

Spark reads such a file in one task, since a byte range alone cannot tell whether it starts inside quotes. The number of
quotes can: a line is inside quotes if an odd number of quotes comes before it in its file. So one pass counts the quotes
of every byte range, prefix sums of their parities over the ranges of a file tell which ranges start inside a record, and
in a second pass every range puts its own lines together. Only what crosses a border is then joined over ranges.

Quotes inside a field have to be doubled, and a field with quotes has to be quoted, as RFC 4180 says. A file that ends
inside quotes ends its last record there. Blank lines between records are left out, an empty file has no record.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from narrata.session import stage

RANGE = ["file", "range"]


def physical_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(file, range, seq, line, quotes)``: lines of the byte ranges in which the files are read; ``seq`` ascends within one."""
    raw = spark.read.option("lineSep", "\n").text(path)
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return raw.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("range"),
                      F.monotonically_increasing_id().alias("seq"), F.col("value").alias("line"), quotes.alias("quotes"))


def range_states(lines: DataFrame) -> DataFrame:
    """``(file, range, open)``: 1 where the range starts inside quotes. One row a byte range is all that is sorted."""
    counts = lines.groupBy(*RANGE).agg(F.sum("quotes").alias("q"))
    before = Window.partitionBy("file").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(*RANGE, (F.coalesce(F.sum("q").over(before), F.lit(0)) % 2).alias("open"))


def records(spark: SparkSession, path: str) -> DataFrame:
    """``(file, range, number, record)``: the text of every record with the place where it starts, the headers included.

    The lines are shuffled once, by byte range, which bounds a group by the size of a range; the grouping into records
    reuses that partitioning. Joined over ranges are at most two pieces a range.
    """
    lines = physical_lines(spark, path)
    states = stage(range_states(lines))
    inside = Window.partitionBy(*RANGE).orderBy("seq")
    earlier = inside.rowsBetween(Window.unboundedPreceding, -1)
    # whether a position is inside quotes does not depend on where its range ends, so only an unknown start is an error
    known = F.coalesce("open", F.raise_error(F.lit("The byte ranges of the CSV files have changed since their quotes were counted.")).cast("long"))
    placed = lines.join(states, RANGE, "left").withColumn("before", (known + F.coalesce(F.sum("quotes").over(earlier), F.lit(0))) % 2)
    numbered = placed.withColumn("number", F.sum((F.col("before") == 0).cast("long")).over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    pieces = stage(numbered.groupBy(*RANGE, "number").agg(
        F.array_sort(F.collect_list(F.struct("seq", "line"))).alias("lines"), (F.sum("quotes") % 2).alias("odd")).select(
        *RANGE, "number", F.array_join("lines.line", "\n").alias("record"), "odd"))
    # a piece without a start continues the record that an earlier range left open
    head, left_open = F.col("number") == 0, (F.col("number") > 0) & (F.col("odd") == 1)
    cut = pieces.filter(head | left_open)
    chain = Window.partitionBy("file").orderBy("range", "number").rowsBetween(Window.unboundedPreceding, 0)
    chained = cut.withColumn("chain", F.sum(left_open.cast("long")).over(chain))
    joined = chained.groupBy("file", "chain").agg(F.array_sort(F.collect_list(F.struct("range", "number", "record"))).alias("x")).select(
        "file", F.col("x")[0]["range"].alias("range"), F.col("x")[0]["number"].alias("number"), F.array_join("x.record", "\n").alias("record"))
    whole = pieces.filter(~head & ~left_open).select(*RANGE, "number", "record")
    return whole.unionByName(joined)


def scan(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """The rows of quoted CSV files with a header each, as strings, in no fixed order.

    Without ``schema`` the columns are those of a header. A file whose header has other names raises.
    """
    if schema is None:
        schema = spark.read.option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"').csv(path).schema
    names = [f.name for f in schema.fields]
    ddl = ", ".join(f"`{n.replace('`', '``')}` string" for n in names)
    options = {"quote": '"', "escape": '"', "multiLine": "true", "lineSep": "\n"}
    ended = F.when(F.col("record").endswith("\r"), F.expr("substr(record, 1, length(record) - 1)")).otherwise(F.col("record"))
    rows = records(spark, path).withColumn("record", ended).filter("trim(record) <> ''")
    first = (F.col("range") == 0) & (F.col("number") == 1)
    bare = F.regexp_replace("record", "^\ufeff", "")
    headers = rows.filter(first).select("file", F.from_csv(bare, F.lit(ddl), options).alias("h"))
    same = F.forall(F.zip_with(F.array(*[F.col(f"h.`{n}`") for n in names]), F.array(*[F.lit(n) for n in names]), lambda a, b: a.eqNullSafe(b)), lambda x: x)
    odd = headers.filter(~same).select("file").first()
    if odd is not None:
        raise ValueError(f"The header of {odd['file']} does not name {names}.")
    return rows.filter(~first).select(F.from_csv("record", F.lit(ddl), options).alias("r")).select("r.*")
