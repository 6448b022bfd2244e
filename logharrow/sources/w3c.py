"""Reader of W3C extended logs: header lines name the fields of the lines that follow in the same file.

Lines are never regrouped by file. Only header lines (a few a file) are gathered; each data line takes the last header
before it in its file, so files of any size are read in parallel splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Known fields, their column names and types. Fixed values of the log format.
FIELDS = {
    "c-ip": ("client_ip", "string"), "cs-username": ("username", "string"), "cs-method": ("method", "string"), "cs-uri-stem": ("uri_stem", "string"),
    "cs-uri-query": ("uri_query", "string"), "sc-status": ("status", "long"), "sc-substatus": ("substatus", "long"), "sc-win32-status": ("win32_status", "long"),
    "time-taken": ("time_taken", "long"), "sc-bytes": ("sc_bytes", "long"), "cs-bytes": ("cs_bytes", "long"), "s-port": ("server_port", "long"),
    "cs(User-Agent)": ("user_agent", "string"), "cs(Referer)": ("referer", "string"), "cs(Cookie)": ("cookie", "string"), "cs-host": ("host", "string"),
    "cs-version": ("http_version", "string"), "s-ip": ("server_ip", "string"), "s-sitename": ("site_name", "string"), "s-computername": ("server_name", "string"),
}
REQUIRED = ("date", "time", "cs-method", "cs-uri-stem", "sc-status")
#: Header lines up to this number are broadcast.
BROADCAST_HEADERS = 50_000


def alias(field: str) -> str:
    """Column name of a field, known or not."""
    return FIELDS[field][0] if field in FIELDS else field.replace("-", "_").replace("(", "_").replace(")", "")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Non-empty lines of .log, .txt and .gz files below path (or of one file) with their place: file, block, line."""
    reader = spark.read.option("recursiveFileLookup", "true")
    if not path.lower().endswith((".log", ".txt", ".gz")):
        reader = reader.option("pathGlobFilter", "*.{log,txt,gz,LOG,TXT,GZ,Log,Txt,Gz}")
    lines = reader.text(path).select(
        F.make_valid_utf8("value").alias("raw"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line")
    )
    return lines.where("raw != ''")


def header_tokens(line: Column) -> Column:
    return F.split(F.trim(F.regexp_replace(F.regexp_replace(line, "#Fields:", ""), r"\s+", " ")), " ")


def with_headers(lines: DataFrame) -> DataFrame:
    """Data lines with `fields`, the header that governs each; lines before any header and other directives drop out."""
    headers = lines.where(F.col("raw").startswith("#Fields:")).select("file", "block", "line", header_tokens(F.col("raw")).alias("fields"))
    per_file = headers.groupBy("file").agg(F.array_sort(F.collect_list(F.struct("block", "line", "fields"))).alias("headers"))
    small = headers.limit(BROADCAST_HEADERS + 1).count() <= BROADCAST_HEADERS
    data = lines.where(~F.col("raw").startswith("#"))
    joined = data.join(F.broadcast(per_file) if small else per_file, "file")
    before = F.filter("headers", lambda h: (h["block"] < F.col("block")) | ((h["block"] == F.col("block")) & (h["line"] < F.col("line"))))
    return joined.withColumn("fields", F.try_element_at(before, F.lit(-1))["fields"]).where("fields is not null").drop("headers")


def _place(field: str) -> Column:
    """Index of the last field of this name, null if there is none."""
    found = F.array_position(F.reverse("fields"), field)
    return F.when(found > 0, F.size("fields") - found)


def _value(field: str) -> Column:
    raw = F.get("tokens", _place(field).cast("int"))
    return F.when(~raw.isin("-", ""), raw)


def spark_pattern(strftime: str) -> str:
    """Spark's pattern for a strftime format; single letters, since unpadded fields are accepted."""
    for code, letters in (("%Y", "yyyy"), ("%m", "M"), ("%d", "d"), ("%H", "H"), ("%M", "m"), ("%S", "s"), ("%y", "yy"), ("%f", "SSSSSS")):
        strftime = strftime.replace(code, letters)
    return strftime


def parse(lines: DataFrame, datetime_format: str = "%Y-%m-%d %H:%M:%S") -> DataFrame:
    """Typed columns from data lines with `fields`. Lines with another number of tokens than fields drop out.

    Adds `<name>_missing` (1 or 0; null where the header lacks the field), `timestamp` (null if it can't be parsed) and
    `extras`, a map of the fields that aren't known.
    """
    rows = lines.withColumn("tokens", F.split(F.trim(F.regexp_replace("raw", r"\s+", " ")), " ")).where(F.size("tokens") == F.size("fields"))
    date, time = _value("date"), _value("time")
    stamp = F.try_to_timestamp(F.concat_ws(" ", date, time), F.lit(spark_pattern(datetime_format)))
    out = [F.when(date.isNotNull() & time.isNotNull(), stamp).alias("timestamp")]
    for field, (name, kind) in FIELDS.items():
        value = _value(field)
        out.append((value.try_cast("long") if kind == "long" else value).alias(name))
    known = F.array(*map(F.lit, [*FIELDS, "date", "time"]))
    others = F.filter(F.sequence(F.lit(0), F.size("fields") - 1), lambda i: ~F.array_contains(known, F.get("fields", i)) & (F.array_position(F.reverse("fields"), F.get("fields", i)) == F.size("fields") - i))
    name_of = lambda f: F.regexp_replace(F.regexp_replace(f, r"[-(]", "_"), r"\)", "")
    entry = lambda i: F.struct(name_of(F.get("fields", i)).alias("key"), F.when(~F.get("tokens", i).isin("-", ""), F.get("tokens", i)).alias("value"))
    out.append(F.map_from_entries(F.transform(others, entry)).alias("extras"))
    for field, (name, _) in FIELDS.items():
        out.append(F.when(_place(field).isNotNull(), F.lit(1)).alias(f"{name}_missing"))
    parsed = rows.select(*out)
    flags = {f"{name}_missing": F.when(F.col(f"{name}_missing") == 1, F.col(name).isNull().cast("int")) for name, _ in FIELDS.values()}
    return parsed.withColumns(flags | {"timestamp_missing": F.col("timestamp").isNull().cast("int")})


def read_w3c(spark: SparkSession, path: str, datetime_format: str = "%Y-%m-%d %H:%M:%S") -> DataFrame:
    """Parsed requests of a file or of all log files below a directory. No line is read twice but the headers."""
    return parse(with_headers(read_lines(spark, path)), datetime_format)
