"""Reading and writing mail archives: text files of many messages, JSON record arrays, tables sharded by year.

The text reader uses the delimiter line as record separator of Spark's splittable text source, so one archive
file of any size is read by many tasks. Line numbers are prefix sums over file blocks.

Defined results: text before the first delimiter is dropped; malformed bytes become U+FFFD; a file without a
year in its name has year 0; an empty folder gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postloom.operators.ordered import running_inside
from postloom.runtime import broadcast_if_small, cut

#: The line between messages; a parameter of every function here.
DELIMITER = "From archive@local Thu Jan  1 00:00:00 1970"
FILE_PATTERN = "*.txt"
#: Blocks of text (128 MB each as Spark reads them) whose line totals may be broadcast.
MOST_BLOCKS = 2_000_000


def year_of(path: Column) -> Column:
    """The four digits in front of the extension or of a year folder, else 0."""
    found = F.coalesce(F.nullif(F.regexp_extract(path, r"-(\d{4})\.txt\z", 1), F.lit("")), F.regexp_extract(path, r"/year=(\d{4})/", 1))
    return F.coalesce(found.try_cast("int"), F.lit(0))


def read_messages(spark: SparkSession, path: str, delimiter: str = DELIMITER, files: str = FILE_PATTERN) -> DataFrame:
    """(source_file, file_year, ordinal, line_number, true_line_number, raw) of every message.

    line_number counts one line more for each message before it, as archives numbered by the parts between
    delimiters do; true_line_number is the line of the delimiter's successor in the file.
    """
    text = spark.read.option("lineSep", f"\n{delimiter}\n").option("pathGlobFilter", files).option("recursiveFileLookup", "true").text(path)
    rows = text.select(
        F.make_valid_utf8("value").alias("value"),
        F.col("_metadata.file_path").alias("_path"),
        F.col("_metadata.file_block_start").alias("_block"),
    )
    # A file may open with a delimiter, and delimiters may stand back to back; both are parted here.
    opens = F.startswith(F.concat(F.col("value"), F.lit("\n")), F.lit(f"{delimiter}\n"))
    whole = F.concat(F.when(opens, F.lit("\n\n")).otherwise(F.lit("\n")), F.col("value"))
    rows = rows.select("_path", "_block", opens.alias("_opens"), F.posexplode(F.split(whole, f"\n\\Q{delimiter}\\E(?=\n|\\z)", -1)).alias("_part", "raw"))
    hollow = ((F.col("_part") > 0) & (F.col("raw") == "")) | ((F.col("_part") == 0) & F.col("_opens"))
    rows = rows.withColumn("_hollow", hollow).withColumn("raw", F.regexp_replace(F.regexp_replace("raw", r"\r\n?", "\n"), r"\A\n", ""))
    rows = rows.withColumn("_lines", F.when(F.col("_hollow"), 0).otherwise(F.length("raw") - F.length(F.replace("raw", F.lit("\n"), F.lit(""))) + 1))
    # Prefix sums in two steps: totals of the blocks of a file, then in reading order inside each block. Only totals are shuffled, never text.
    blocks = rows.groupBy("_path", "_block").agg(F.sum("_lines").alias("_l"), F.count("*").alias("_n"))
    before = Window.partitionBy("_path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = cut(blocks.select("_path", "_block", F.coalesce(F.sum("_l").over(before), F.lit(0)).alias("_lines_before"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_rows_before")))
    inside = running_inside(rows.select("_path", "_block", "_lines", "raw"), ["_path", "_block"], {"_at": F.lit(1), "_before": F.col("_lines")})
    placed = inside.join(broadcast_if_small(blocks, MOST_BLOCKS, MOST_BLOCKS * 128), ["_path", "_block"])
    ordinal = (F.col("_rows_before") + F.col("_at")).cast("bigint")
    true_line = (F.col("_lines_before") + F.col("_before") + ordinal + 1).cast("bigint")
    named = placed.select(F.element_at(F.split("_path", "/"), -1).alias("source_file"), year_of(F.col("_path")).alias("file_year"), ordinal.alias("ordinal"), (true_line + ordinal - 2).alias("line_number"), true_line.alias("true_line_number"), "raw")
    return named.filter("ordinal > 0")


def render_message() -> Column:
    """The text of one record, delimiter line included, for columns of the mail table."""
    line = lambda name, column: F.when(F.coalesce(column, F.lit("")) != "", F.concat(F.lit(f"{name}: "), column, F.lit("\n"))).otherwise(F.lit(""))
    bracket = lambda c: F.when(F.coalesce(F.col(c), F.lit("")) != "", F.concat(F.lit("<"), F.col(c), F.lit(">")))
    refs = F.array_join(F.transform("refs", lambda r: F.concat(F.lit("<"), r, F.lit(">"))), "\n ")
    heads = [line("From", F.col("from_raw")), line("Date", F.col("date_raw")), line("Subject", F.col("subject")), line("Message-ID", bracket("message_id")), line("In-Reply-To", bracket("in_reply_to")), line("References", refs), line("To", F.col("to_addr")), line("Cc", F.col("cc")), line("Content-Type", F.col("content_type"))]
    return F.concat(*heads, F.lit("\n"), F.coalesce(F.col("body"), F.lit("")))


def write_archive(mails: DataFrame, path: str, delimiter: str = DELIMITER, one_file: bool = False) -> None:
    """One text per partition, each message behind its delimiter line; folders by year. one_file: one text for each year, in the order of pos."""
    if one_file:
        mails = mails.repartition("file_year").sortWithinPartitions("file_year", "pos")
    text = mails.select(F.concat(F.lit(f"{delimiter}\n"), render_message()).alias("value"), F.col("file_year").alias("year"))
    text.write.mode("overwrite").partitionBy("year").text(path)


def write_json(df: DataFrame, path: str, by_year: str | None = None) -> None:
    """One JSON object per line, sharded by a year column if one is given."""
    out = df.write.mode("overwrite")
    (out.partitionBy(by_year) if by_year else out).json(path)


def read_json(spark: SparkSession, path: str, schema: str, whole_arrays: bool = False) -> DataFrame:
    """Records of JSON lines, or of files that hold one array each."""
    return spark.read.schema(schema).option("multiLine", whole_arrays).json(path)


def latest_of(spark: SparkSession, paths: list[str], schema: str) -> DataFrame:
    """The first of several stage outputs that exists."""
    for path in paths:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        if target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target):
            return read_json(spark, path, schema)
    raise FileNotFoundError(", ".join(paths))


def year_manifest(mails: DataFrame) -> DataFrame:
    """The years that have a shard."""
    return mails.filter("file_year is not null").select(F.col("file_year").alias("year")).distinct()


def flag_review(mails: DataFrame) -> DataFrame:
    """The narrow rows of flagged mails that people review."""
    return mails.filter(F.size("flags") > 0).select("pos", "id", F.col("file_year").alias("year"), F.col("source_file").alias("file"), F.col("line_number").alias("line"), "subject", "from_raw", F.array_join("flags", "\n").alias("flags"))
