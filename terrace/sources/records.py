"""Records of CSV files whose rows may be ragged, read by many tasks for each file.

A file is read as lines. A line's place in its file, and whether it begins within quotes, follow from prefix sums over
the file's splits: how many lines, quotes and records are before. So a large file needs no task of its own, records are
numbered without gaps, and only splits that hold quoted line breaks or blank lines are sorted within themselves.

Quotes are doubled within quoted fields. A lone quote within an unquoted field isn't supported: it would open a field that
ends at the next one. A byte order mark goes; blank lines between records count as none; a file's first record is its header.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terrace.functions.values import spaced_json

#: The column that keeps surplus fields.
SURPLUS = "_extra_columns"


def _lines(spark: SparkSession, path: str, glob: str) -> DataFrame:
    read = spark.read.option("lineSep", "\n").option("pathGlobFilter", glob).text(path)
    rows = read.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("place"))
    blank = F.rtrim(F.col("value"), F.lit("\r")) == ""
    return rows.withColumns({"odd": (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))) % 2, "blank": blank.cast("int")})


def records(spark: SparkSession, path: str, glob: str = "*.csv") -> DataFrame:
    """file, record (1 is the header) and text of every record, with its quoted line breaks."""
    lines = _lines(spark, path, glob)
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    splits = lines.groupBy("file", "split").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first"), F.sum("odd").alias("odd_sum"), F.sum("blank").alias("n_blank"))
    splits = splits.withColumn("inside", F.coalesce(F.sum("odd_sum").over(before), F.lit(0)) % 2)
    splits = splits.withColumn("plain", (F.col("odd_sum") == 0) & (F.col("n_blank") == 0) & (F.col("inside") == 0))

    within = Window.partitionBy("file", "split").orderBy("place")
    to_here, earlier = within.rowsBetween(Window.unboundedPreceding, 0), within.rowsBetween(Window.unboundedPreceding, -1)
    sorted_ = lines.join(splits.where("NOT plain").select("file", "split", "inside"), ["file", "split"])
    sorted_ = sorted_.withColumn("within", (F.col("inside") + F.coalesce(F.sum("odd").over(earlier), F.lit(0))) % 2)
    sorted_ = sorted_.where("within = 1 OR blank = 0").withColumn("starts", (1 - F.col("within")).cast("long"))
    found = sorted_.groupBy("file", "split").agg(F.sum("starts").alias("n_starts"))
    bases = splits.join(found, ["file", "split"], "left").withColumn("n_starts", F.when(F.col("plain"), F.col("n")).otherwise(F.coalesce("n_starts", F.lit(0))))
    bases = bases.select("file", "split", "first", "plain", F.coalesce(F.sum("n_starts").over(before), F.lit(0)).alias("base"))

    text = F.rtrim(F.col("value"), F.lit("\r"))
    plain = lines.join(bases.where("plain"), ["file", "split"]).select("file", (F.col("base") + F.col("place") - F.col("first") + 1).alias("record"), text.alias("text"))
    numbered = sorted_.withColumn("nth", F.sum("starts").over(to_here)).join(bases.where("NOT plain").select("file", "split", "base"), ["file", "split"])
    numbered = numbered.select("file", "split", "place", (F.col("base") + F.col("nth")).alias("record"), "value", ((F.col("within") == 0) & (F.col("odd") == 0)).alias("whole"))
    single = numbered.where("whole").select("file", "record", text.alias("text"))
    parts = numbered.where("NOT whole").groupBy("file", "record").agg(F.sort_array(F.collect_list(F.struct("split", "place", "value"))).alias("parts"))
    joined = parts.select("file", "record", F.rtrim(F.array_join(F.transform("parts", lambda p: p["value"]), "\n"), F.lit("\r")).alias("text"))
    every = plain.unionByName(single).unionByName(joined)
    return every.withColumn("text", F.when(F.col("record") == 1, F.regexp_replace("text", "^﻿", "")).otherwise(F.col("text")))


def fields(text: Column) -> Column:
    """The fields of a record, quotes resolved."""
    raw = F.regexp_extract_all(F.concat(F.lit(","), text), F.lit(r',((?:"[^"]*+(?:""[^"]*+)*+"?)?[^,]*+)'), F.lit(1))

    def one(field: Column) -> Column:
        inner = F.regexp_extract(field, r'(?s)^"([^"]*+(?:""[^"]*+)*+)', 1)
        rest = F.regexp_extract(field, r'(?s)^"[^"]*+(?:""[^"]*+)*+"(.*)$', 1)
        return F.when(F.startswith(field, F.lit('"')), F.concat(F.replace(inner, F.lit('""'), F.lit('"')), rest)).otherwise(field)

    return F.transform(raw, one)


def _with_headers(rows: DataFrame) -> DataFrame:
    headers = rows.where("record = 1").select("file", fields(F.col("text")).alias("header"))
    return rows.where("record > 1").join(headers, "file").withColumn("fields", fields(F.col("text")))


def _value(values: Column, name: str) -> Column:
    """The value under a name, of equal names the last one's; empty where the header or the row lacks it."""
    place = F.size("header") + 1 - F.nullif(F.array_position(F.reverse("header"), name), F.lit(0))
    return F.coalesce(F.try_element_at(values, place.cast("int")), F.lit(""))


def kept(rows: DataFrame, columns: list[str]) -> DataFrame:
    """file, record, columns by each file's own header, and what is beyond the header as a JSON list, null without any.

    rows: what records returns. Short rows end in empty fields.
    """
    whole = _with_headers(rows)
    surplus = F.slice("fields", F.size("header") + 1, F.greatest(F.size("fields") - F.size("header"), F.lit(0)))
    return whole.select("file", "record", *(_value(F.col("fields"), c).alias(c) for c in columns), F.when(F.size(surplus) > 0, spaced_json(surplus)).alias(SURPLUS))


def rejoined(rows: DataFrame, columns: list[str], anchor: str, tail: int = 4) -> DataFrame:
    """file, record and columns, where surplus commas are taken as those of one unquoted field.

    In a row with more fields than its header, the last tail fields are the last ones, those before the anchor are its
    own, and all between make up the anchor. Without the anchor in the header surplus fields are dropped.
    """
    place, n = F.array_position("header", anchor).cast("int"), F.size("fields")
    whole = F.concat(F.slice("fields", F.lit(1), F.greatest(place - 1, F.lit(0))), F.array(F.array_join(F.slice("fields", F.greatest(place, F.lit(1)), F.greatest(n - tail - place + 1, F.lit(0))), ",")), F.slice("fields", F.greatest(n - tail + 1, F.lit(1)), F.lit(tail)))
    values = F.when((n > F.size("header")) & (place > 0), whole).otherwise(F.col("fields"))
    return _with_headers(rows).withColumn("fields", values).select("file", "record", *(_value(F.col("fields"), c).alias(c) for c in columns))


def loaded(rows: DataFrame, header: list[str], name: str = "n_rows") -> tuple[DataFrame, DataFrame]:
    """Rows of files whose header is exactly this one, and the count of rows of each file; raises if a header differs.

    Rows of files have their columns, file and record; surplus fields are dropped.
    """
    other = rows.where("record = 1").select("file", fields(F.col("text")).alias("header")).where(F.col("header") != F.array(*map(F.lit, header))).take(1)
    if other:
        raise ValueError(f"{other[0].file}: columns are {other[0].header}, not {header}")
    counts = rows.groupBy("file").agg((F.count(F.lit(1)) - 1).alias(name))
    return kept(rows, header).drop(SURPLUS), counts


def listing(spark: SparkSession, path: str, glob: str = "*.csv", sample_suffix: str = "_10.csv") -> DataFrame:
    """file, name, bytes, modified and place (from 1, by name) of every file, and whether it is a sample; none is opened."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select(F.col("path").alias("file"), F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))
    # As many rows as files.
    return found.withColumns({"is_sample": F.endswith("name", F.lit(sample_suffix)), "place": F.row_number().over(Window.orderBy("name", "file"))})


def manifest(tasks: DataFrame, file: Column, key: str, name: str) -> DataFrame:
    """number, file, first and last key, all keys in the order of the file, and the first and last non-empty name of each batch file.

    tasks: read from batch files, with record, the line within the file. Files without a number in their name are an error
    of the caller's and come with a null number.
    """
    rows = tasks.withColumn("file", file)
    named = F.when(F.coalesce(F.col(name), F.lit("")) != "", F.col(name))
    grouped = rows.groupBy("file").agg(
        F.min(key).alias("first_key"), F.max(key).alias("last_key"), F.transform(F.sort_array(F.collect_list(F.struct("record", F.col(key).alias("k")))), lambda x: x["k"]).alias("keys"),
        F.min_by(name, F.when(named.isNotNull(), F.col("record"))).alias("first_name"), F.max_by(F.coalesce(F.col(name), F.lit("")), "record").alias("last_name"),
    )
    return grouped.withColumn("number", F.nullif(F.regexp_extract("file", r"batch_(\d+)", 1), F.lit("")).cast("int"))
