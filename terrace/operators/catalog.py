"""Profiles of tables and what their columns' names say about keys and joins."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.functions.values import inferred_type


def profile(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """column_name, sample (the value of the least key that isn't blank), n_filled and the type that its name implies.

    One pass over the table: a minimum by key for each column.
    """
    filled = {c: F.when(F.trim(F.col(c).cast("string")) != "", F.col(c).cast("string")) for c in columns}
    found = df.agg(*(F.struct(F.lit(c).alias("column_name"), F.min_by(v, F.when(v.isNotNull(), F.col(key))).alias("sample"), F.count(v).alias("n_filled")).alias(f"_{i}") for i, (c, v) in enumerate(filled.items())))
    rows = found.select(F.explode(F.array(*(F.col(f"_{i}") for i in range(len(columns))))).alias("x")).select("x.*")
    return rows.withColumn("inferred_type", inferred_type(F.col("column_name")))


def key_index(tables: dict[str, DataFrame]) -> DataFrame:
    """For each column name without its table prefix that ends in key or id: the tables that hold it, joined by pipes."""
    spark = next(iter(tables.values())).sparkSession
    names = [(t, c, c.split("_", 1)[1] if c.split("_", 1)[0] in {x[0] for x in tables} | {x[:2] for x in tables} and "_" in c else c) for t, df in tables.items() for c in df.columns]
    rows = spark.createDataFrame([(t, c, k) for t, c, k in names if k.endswith(("key", "_id"))], "table_name string, column_name string, key_name string")
    return rows.groupBy("key_name").agg(F.count(F.lit(1)).alias("n_tables"), F.array_join(F.sort_array(F.collect_list("table_name")), "|").alias("tables"))


def resolved(references: DataFrame, key: str, kinds: dict[str, DataFrame]) -> DataFrame:
    """references with kind and name of every entity whose id the key holds; kinds: DataFrames of id and name.

    A key that several kinds hold gives a row for each; one that none holds gives none.
    """
    every = reduce(DataFrame.unionByName, (df.select(F.lit(k).alias("kind"), F.col("id").alias(key), "name") for k, df in kinds.items()))
    return references.join(every, key)


# Words in column names by category; the first category with a word in the name counts.
CATEGORY_WORDS = {
    "identity": ("RowID", "LastUpdated", "DealNo", "CikCode"),
    "name": ("Name", "AlsoKnownAs", "FormerName", "LegalName"),
    "status": ("Status", "Type", "Class", "Category", "IsPrimary", "IsCurrent", "IsLead", "IsOnBoard", "Universe"),
    "time": ("Date", "Year", "Quarter", "Vintage", "Period", "Frequency", "Tenor"),
    "amount": ("Amount", "Size", "Valuation", "Revenue", "Profit", "Income", "EBIT", "EBITDA", "Debt", "EV", "NAV", "IRR", "DPI", "TVPI", "RVPI", "Price", "Capital", "Commitment", "AUM", "DryPowder", "Shares", "MarketCap", "Multiple", "Ratio", "Percent", "Percentage", "Value"),
    "place": ("HQ", "Address", "Location", "City", "State", "Province", "PostCode", "Country", "Phone", "Fax", "Email", "Region", "Website", "URL", "Domiciles"),
    "person": ("Person", "CEO", "LeadPartner", "PrimaryContact", "FullTitle", "Title", "Position", "RoleOnBoard", "Advisory", "Prefix", "Suffix", "Biography", "Education", "Degree", "Major", "Gender"),
    "holding": ("Holding", "Percent", "Representing", "ParentCompany", "Affiliate", "Similar", "Competitor", "InvestorOwnership", "ServiceTo", "CoInvestor", "Co_Investor", "Partial_Full", "Acquired", "Exit"),
    "industry": ("Industry", "Vertical", "Naics", "Sic", "Morningstar", "TradeAssociations", "EmergingSpaces"),
}
# Words of names whose values are decimals.
DECIMAL_WORDS = ("Amount", "Size", "Value", "Valuation", "Revenue", "Profit", "Income", "Debt", "EBIT", "EBITDA", "AUM", "IRR", "DPI", "TVPI", "RVPI", "NAV", "Price", "Ratio", "Percent", "Percentage", "Shares", "Capital", "Commitment", "Multiple")


def _holds(name: Column, words: tuple[str, ...]) -> Column:
    return F.regexp_like(name, F.lit("|".join(words)))


def category(name: Column) -> Column:
    """The category of a column by its name; text for the rest. Ids are known by their end or as a whole."""
    out = F.lit("text")
    for kind, words in reversed(CATEGORY_WORDS.items()):
        if kind != "identity":
            out = F.when(_holds(name, words), kind).otherwise(out)
    identity = name.isin(*CATEGORY_WORDS["identity"]) | F.endswith(name, F.lit("ID"))
    return F.when(name == "RaisedToDate", "amount").when(identity, "identity").otherwise(out)


def documented_type(name: Column) -> Column:
    """DATE, INTEGER, DECIMAL or TEXT by a column's name in capitalised words."""
    whole = F.endswith(name, F.lit("Year")) | F.endswith(name, F.lit("Count")) | name.isin("Vintage", "DealNo")
    return F.when((name == "LastUpdated") | F.contains(name, F.lit("Date")), "DATE").when(whole, "INTEGER").when(_holds(name, DECIMAL_WORDS), "DECIMAL").otherwise("TEXT")


def columns_by_category(columns: DataFrame, table: str, column: str, place: str) -> DataFrame:
    """For each table and category with columns: place of the category, and its columns in order, joined by commas."""
    order = F.create_map(*(F.lit(x) for i, k in enumerate([*CATEGORY_WORDS, "text"]) for x in (k, i)))
    named = columns.withColumn("category", category(F.col(column)))
    listed = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(place, column))), lambda x: x[column]), ",").alias("columns")
    return named.groupBy(table, "category").agg(listed).withColumn("category_place", F.element_at(order, F.col("category")))


def longest_prefix(names: DataFrame, name: str, prefixes: DataFrame, prefix: str, proper: bool = False) -> DataFrame:
    """names with the columns of the longest prefix that each begins with, null without one.

    Each distinct name goes to the join with its own prefixes, as many as the longest known one has characters, so that
    names and prefixes meet by equality. proper: whether a name has to be longer than its prefix. prefixes has each once.
    """
    columns = [c for c in prefixes.columns if c != prefix]
    longest = prefixes.agg(F.coalesce(F.max(F.length(prefix)), F.lit(0)).alias("_most"))
    once = names.select(F.col(name).alias("_name")).where("_name IS NOT NULL").distinct().join(F.broadcast(longest))
    sizes = F.sequence(F.lit(0), F.least(F.col("_most"), F.length("_name") - F.lit(int(proper))))
    parts = once.where(F.length("_name") >= int(proper)).select("_name", F.explode(F.transform(sizes, lambda n: F.substring("_name", F.lit(1), n))).alias(prefix))
    found = parts.join(prefixes, prefix).groupBy("_name").agg(F.max_by(F.struct(prefix, *columns), F.length(prefix)).alias("_hit"))
    return names.join(found, F.col(name) == F.col("_name"), "left").select(*(F.col(c) for c in names.columns), F.col(f"_hit.{prefix}").alias(prefix), *(F.col(f"_hit.{c}").alias(c) for c in columns))


def described(tables: DataFrame, table: str, given: DataFrame, subjects: DataFrame, relations: DataFrame, end: str = "Relation", joint: str = "{}") -> DataFrame:
    """tables with a description: one that is given, else one by the parts of its name, else null.

    given: table and description. A table whose name ends so is a relation of the longest subject (subjects: subject and
    label) that its name begins with and that leaves a rest; relations (rest and pattern) describe it, the label in place
    of joint. Where the rest isn't known, the relation's pattern with an empty rest counts.
    """
    own = tables.join(given.select(F.col(table), F.col("description").alias("_given")), table, "left")
    base = own.withColumn("_base", F.when(F.endswith(table, F.lit(end)), F.substr(F.col(table), F.lit(1), F.length(table) - len(end))))
    split = longest_prefix(base, "_base", subjects, "subject", proper=True).withColumn("_rest", F.substr("_base", F.length("subject") + 1))
    known = split.join(relations.select(F.col("rest").alias("_rest"), F.col("pattern").alias("_pattern")), "_rest", "left")
    # One row.
    other = relations.where("rest = ''").agg(F.max("pattern").alias("_other"))
    told = F.replace(F.coalesce("_pattern", F.when(F.col("subject").isNotNull(), F.col("_other"))), F.lit(joint), F.col("label"))
    return known.join(F.broadcast(other)).select(*tables.columns, F.coalesce("_given", told).alias("description"))


def join_note(column: Column, notes: dict[str, str], row_id: str, updated: str, id_like: str) -> Column:
    """What a column can be joined with: a known note, else one for row ids, times of update and other ids; else empty."""
    known = F.create_map(*(F.lit(x) for kv in notes.items() for x in kv)) if notes else F.create_map().cast("map<string,string>")
    return F.coalesce(F.try_element_at(known, column), F.when(column == "RowID", row_id).when(column == "LastUpdated", updated).when(F.endswith(column, F.lit("ID")), id_like).otherwise(""))


def bounded_profile(spark: SparkSession, files: list[str], read: Callable[[str], DataFrame], most: int = 5000, step: int = 200) -> tuple[DataFrame, int]:
    """column_name and sample of every column: its first value that isn't blank within the first records; and the files opened.

    files in order, each read by read. Records are taken in growing steps from the front of a file, so that Spark runs
    tasks for the first splits only, and no further file is opened once every column has a sample or most records
    are seen. At most that many records come to the driver. Columns without a value have an empty sample.
    """
    samples: dict[str, str] = {}
    left, opened = most, 0
    for file in files:
        rows = read(file)
        samples |= {c: "" for c in rows.columns if c not in samples}
        opened, seen, size = opened + 1, 0, step
        while left > seen and any(not samples[c] for c in rows.columns):
            size = min(size, left)
            taken = rows.select(*(F.col(c).cast("string").alias(c) for c in rows.columns)).take(size)
            for row in taken[seen:]:
                samples |= {c: row[c].strip() for c in rows.columns if not samples[c] and (row[c] or "").strip()}
            fewer, seen, size = len(taken) < size, len(taken), size * 5
            if fewer or seen >= left:
                break
        left -= seen
        if left <= 0 or all(samples.values()):
            break
    return spark.createDataFrame(list(samples.items()), "column_name string, sample string"), opened
