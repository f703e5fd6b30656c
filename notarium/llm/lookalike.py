"""Problem 4: text that looks the same in one form, and the records whose values look alike.

Null values stay null and take part in no pair; values of nothing but white
space or invisible characters are empty and take part in none either; repeated
rows count once; further columns are kept by ``one_form`` and ignored by
``alike``; ties and order play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import keep, ship, table
from .batches import slices
from .codepoints import fold


def _mapper(columns: list[str], suffix: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, columns):
            arrays = list(batch.columns)
            names = list(batch.schema.names)
            for c in columns:
                arrays.append(fold(batch.column(names.index(c))).cast(pa.string()))
            yield pa.RecordBatch.from_arrays(arrays, [*names, *(c + suffix for c in columns)])

    return run


def one_form(df: DataFrame, columns: list[str], suffix: str = "_form") -> DataFrame:
    """Add to each named string column its form as it looks; every other column stays."""
    ship(df.sparkSession)
    schema = T.StructType([*df.schema.fields, *(T.StructField(c + suffix, T.StringType()) for c in columns)])
    return df.mapInArrow(_mapper(columns, suffix), schema)


def _blank(c: Column) -> Column:
    return F.coalesce(F.trim(F.regexp_replace(c, "[\\s]+", "")) == "", F.lit(True))


def forms(values: DataFrame) -> DataFrame:
    """(field, id, value) to (field, id, form, raw): 128-bit keys of the form and of the value itself."""
    ship(values.sparkSession)
    made = one_form(values, ["value"])
    key = lambda c: F.unhex(F.substring(F.sha2(c, 256), 1, 32))
    return made.where(~_blank(F.col("value_form"))).select("field", "id", key(F.col("value_form")).alias("form"), key(F.col("value")).alias("raw"))


def alike(values: DataFrame) -> DataFrame:
    """Pairs of ids whose values look the same but differ: (field, id_a, id_b).

    Values are grouped by form first; only forms with several different values
    go on.  Equal values are never paired, so a hot value costs one row a
    member, and only differing members meet.
    """
    seen = keep(forms(values))
    several = seen.groupBy("field", "form").agg(F.min("raw").alias("low"), F.max("raw").alias("high")).where("low <> high").select("field", "form")
    members = seen.join(several, ["field", "form"]).distinct()
    kinds = members.select("field", "form", "raw").distinct()
    a = kinds.withColumnRenamed("raw", "raw_a")
    b = kinds.withColumnRenamed("raw", "raw_b")
    differing = a.join(b, ["field", "form"]).where("raw_a < raw_b")
    left = members.select("field", F.col("raw").alias("raw_a"), F.col("id").alias("one"))
    right = members.select("field", F.col("raw").alias("raw_b"), F.col("id").alias("two"))
    pairs = differing.join(left, ["field", "raw_a"]).join(right, ["field", "raw_b"]).where("one <> two")
    return pairs.select("field", F.least("one", "two").alias("id_a"), F.greatest("one", "two").alias("id_b")).distinct()


def _values(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "manifest").select(F.lit("filename").alias("field"), F.col("doc_id").alias("id"), F.col("filename").alias("value"))
    bodies = table(spark, sf_dir, "cleaned").select(F.lit("body").alias("field"), F.col("doc_id").alias("id"), F.col("body").alias("value"))
    return names.unionByName(bodies).where(F.col("value").isNotNull() & F.col("id").isNotNull())


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(field, doc_id_a, doc_id_b) of file names and bodies that look the same but differ in code points."""
    return alike(_values(spark, sf_dir)).select("field", F.col("id_a").alias("doc_id_a"), F.col("id_b").alias("doc_id_b"))


def p4_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per field and record the digest of the one form, and whether the value had it already."""
    made = one_form(_values(spark, sf_dir), ["value"])
    return made.select("field", F.col("id").alias("doc_id"), F.sha2("value_form", 256).alias("form_sha256"), (F.col("value") == F.col("value_form")).alias("unchanged")).distinct()


QUERIES = {"p4_found": p4_found, "p4_forms": p4_forms}
SQL: dict[str, str] = {}
