"""New archive files parsed as they arrive: the parsing and first cleaning stages on a file stream.

Each message is parsed by the same column expressions as in batch; nothing is kept between batches, so the
stream needs no state and no watermark. Delimiters are those of the batch reader. Line numbers need the whole
file and are left to the batch reader.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postloom.operators.cleaning import looks_like_spam
from postloom.operators.parsing import parse_messages
from postloom.sources.archive import DELIMITER, FILE_PATTERN, year_of


def stream_messages(spark: SparkSession, path: str, delimiter: str = DELIMITER, files: str = FILE_PATTERN, files_per_batch: int = 100) -> DataFrame:
    """(source_file, file_year, raw) of every message of every file that appears under the path.

    Text before the first delimiter of a file comes as a record of its own; it has no message id, so the first
    spam predicate of ``stream_clean`` drops it.
    """
    reader = spark.readStream.format("text").option("lineSep", f"\n{delimiter}\n").option("pathGlobFilter", files).option("maxFilesPerTrigger", files_per_batch)
    rows = reader.load(path).select(F.make_valid_utf8("value").alias("value"), F.col("_metadata.file_path").alias("_path"))
    opens = F.startswith(F.concat(F.col("value"), F.lit("\n")), F.lit(f"{delimiter}\n"))
    body = F.when(opens, F.substring("value", len(delimiter) + 2, 2**31 - 1)).otherwise(F.col("value"))
    return rows.select(F.element_at(F.split("_path", "/"), -1).alias("source_file"), year_of(F.col("_path")).alias("file_year"), F.regexp_replace(body, r"\r\n?", "\n").alias("raw"))


def stream_parsed(spark: SparkSession, path: str, delimiter: str = DELIMITER, files: str = FILE_PATTERN) -> DataFrame:
    """Parsed records as an append-only stream."""
    return parse_messages(stream_messages(spark, path, delimiter, files))


def stream_clean(spark: SparkSession, path: str, delimiter: str = DELIMITER, files: str = FILE_PATTERN) -> DataFrame:
    """Parsed records that pass the first spam predicate."""
    return stream_parsed(spark, path, delimiter, files).filter(~looks_like_spam())
