"""File feeds: transaction text, terminal and blacklist sheets, feed file choice.

S4/S5 (sheets) are read by position with a fixed schema (CSV header row
skipped, ``enforceSchema`` on), S6 the ``;``-separated transaction text, S7
cleans its decimal comma in the amount column only (the reference rewrote
every comma of the whole file), S8 picks feed files.
"""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwarden.functions.columns import amount_rounded, clean_amount
from ledgerwarden.schemas import BLACKLIST_FEED, TERMINALS_FEED, TRANSACTIONS_RAW

TX_SEP = ";"


def read_transactions(spark: SparkSession, paths, sep: str = TX_SEP,
                      ts_format: str | None = None) -> DataFrame:
    """S6 + S7: typed transactions from delimited text with a header row."""
    raw = (spark.read.schema(TRANSACTIONS_RAW).option("header", True).option("sep", sep)
           .option("mode", "PERMISSIVE").csv(paths))
    return clean_transactions(raw, ts_format=ts_format)


def parse_transaction_lines(lines: DataFrame, col: str = "value", sep: str = TX_SEP) -> DataFrame:
    """The same parse as ``read_transactions`` for lines already in a DataFrame
    (e.g. a streaming text source): ``from_csv`` with the raw schema."""
    parsed = F.from_csv(F.col(col), TRANSACTIONS_RAW.simpleString()[len("struct<"):-1].replace(":", " "),
                        {"sep": sep})
    return lines.select(parsed.alias("r")).select("r.*")


def wall_clock(text: F.Column, fmt: str | None = None) -> F.Column:
    """Text -> ``timestamp_ntz`` without passing through any time zone (a
    session zone would move times inside a daylight-saving gap); NULL when
    unparsable. ISO text is cast; a pattern is parsed as a UTC instant and
    turned into wall-clock time by microsecond arithmetic."""
    if not fmt:
        return text.try_cast("timestamp_ntz")
    instant = F.try_to_timestamp(F.concat(text, F.lit(" +0000")), F.lit(f"{fmt} Z"))
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant),
                           F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"))


def clean_transactions(raw: DataFrame, keep: list[str] | None = None,
                       ts_format: str | None = None) -> DataFrame:
    """Raw string columns -> fact schema: ids and card numbers trimmed, time
    typed (ISO, or ``ts_format`` such as ``dd.MM.yyyy HH:mm:ss``; unparsable
    -> NULL), amount's decimal comma turned into a point (bad amounts -> NULL).
    ``keep`` columns pass through unchanged after the fact columns."""
    return raw.select(
        F.trim("transaction_id").alias("trans_id"),
        wall_clock(F.trim("transaction_date"), ts_format).alias("trans_date"),
        F.trim("card_num").alias("card_num"),
        F.trim("oper_type").alias("oper_type"),
        clean_amount(F.trim("amount")).alias("amt"),
        F.trim("oper_result").alias("oper_result"),
        F.trim("terminal").alias("terminal"),
        *(keep or []))


def amount_audit(raw: DataFrame) -> DataFrame:
    """What the amount column of a raw feed loses by typing, one row: ``n_rows``,
    ``n_missing`` (NULL or blank), ``n_unreadable`` (no number, or too large: typed
    as NULL) and ``n_rounded`` (more digits behind the point than are kept)."""
    text = F.trim("amount")
    missing = F.coalesce(text, F.lit("")) == ""
    return raw.select(missing.alias("m"), (~missing & clean_amount(text).isNull()).alias("u"),
                      F.coalesce(amount_rounded(text), F.lit(False)).alias("r")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if("m").alias("n_missing"),
        F.count_if("u").alias("n_unreadable"), F.count_if("r").alias("n_rounded"))


def format_transaction_lines(tx: DataFrame, sep: str = TX_SEP) -> DataFrame:
    """Fact rows -> feed text lines with a decimal comma (the landed format)."""
    amount = F.regexp_replace(F.col("amt").cast("string"), r"\.", ",")
    return tx.select(F.concat_ws(sep, "trans_id", F.col("trans_date").cast("string"), amount,
                                 "card_num", "oper_type", "oper_result", "terminal").alias("value"))


def read_terminals(spark: SparkSession, paths, fmt: str = "csv") -> DataFrame:
    """Full terminal snapshot, 4 columns by position."""
    if fmt == "parquet":
        df = spark.read.parquet(paths)
        return df.toDF(*TERMINALS_FEED.fieldNames()[: len(df.columns)])
    return spark.read.schema(TERMINALS_FEED).option("header", True).csv(paths)


def read_blacklist(spark: SparkSession, paths, fmt: str = "csv") -> DataFrame:
    """Blacklist, columns by position ``(entry_dt, passport_num)``."""
    if fmt == "parquet":
        df = spark.read.parquet(paths)
        return df.toDF(*BLACKLIST_FEED.fieldNames()[: len(df.columns)])
    return spark.read.schema(BLACKLIST_FEED).option("header", True).csv(paths)


def list_files(spark: SparkSession, directory: str) -> DataFrame:
    """File names of one directory level (metadata only, through the Hadoop
    file system of the path, so it works on HDFS/object stores alike)."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(directory)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    rows = []
    if fs.exists(path):
        for st in fs.listStatus(path):
            if st.isFile():
                rows.append((st.getPath().toString(), st.getPath().getName()))
    return spark.createDataFrame(rows, "path string, file_name string")


def business_date(file_name, pattern: str = r"(\d{8})", fmt: str = "ddMMyyyy") -> F.Column:
    """The business date written in a feed file name (``transactions_01032021.txt``)."""
    c = F.col(file_name) if isinstance(file_name, str) else file_name
    return F.try_to_date(F.regexp_extract(c, pattern, 1), fmt)


def pick_feed(files: DataFrame, words: list[str], name_col: str = "file_name") -> DataFrame:
    """S8/T1 per feed word: the reference's choice (smallest name containing
    the word) and ours (earliest business date in the name, then name)."""
    feeds = F.explode(F.array(*[F.lit(w) for w in words])).alias("feed")
    x = files.select(name_col, feeds).where(F.col(name_col).contains(F.col("feed")))
    x = x.withColumn("business_date", business_date(name_col))
    return x.groupBy("feed").agg(
        F.min(name_col).alias("first_by_name"),
        F.min(F.struct(F.col("business_date").isNull().alias("undated"), "business_date",
                       name_col))[name_col].alias("first_by_date"),
        F.min("business_date").alias("business_date"))
