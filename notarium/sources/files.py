"""Sources and sinks: notes, JSON lines, JSON arrays, pipe tables, YAML dimensions, snapshots, dead letters."""

from __future__ import annotations

import re
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.documents import map_texts, slug, split_front_matter
from ..session import keep, ship

MANIFEST = "doc_id string, path string, filename string, size_bytes bigint, modified_at timestamp, sha256 string, line_count int, word_count int, char_count int"


def notes(spark: SparkSession, folder: str, glob: str = "*.md", exclude: list[str] | None = None) -> DataFrame:
    """(path, filename, size_bytes, modified_at, content) of the files below a folder.

    ``exclude`` holds shell patterns that a file's name or its path below the
    folder must not match.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(folder)
    below = F.regexp_replace("path", "^.*?" + re.escape(folder.rstrip("/").removeprefix("file:")) + "/", "")
    out = files.select(below.alias("path"), F.regexp_replace("path", "^.*/", "").alias("filename"), F.col("length").alias("size_bytes"), F.col("modificationTime").alias("modified_at"), "content")
    for pattern in exclude or []:
        like = "^" + "".join(".*" if c == "*" else "." if c == "?" else re.escape(c) for c in pattern) + "$"
        out = out.where(~(F.col("filename").rlike(like) | F.col("path").rlike(like)))
    return out


def manifest_of(files: DataFrame) -> DataFrame:
    """The manifest of scanned notes: ``D_`` and the slug of the name; equal ones get ``_2``, ``_3`` in path order."""
    from ..operators.build import numbered

    ship(files.sparkSession)
    text = F.decode("content", "utf-8")
    lines = F.size(F.split(F.regexp_replace(text, r"\r\n|[\r\x0B\f\x1C-\x1E\u0085\u2028\u2029]", "\n"), "\n", -1)) - F.when(text.rlike(r"[\n\r]\z") | (text == ""), 1).otherwise(0)
    words = F.size(F.filter(F.split(text, r"(?U)\s+"), lambda w: w != ""))
    rows = files.select("path", "filename", "size_bytes", "modified_at", F.sha2("content", 256).alias("sha256"), lines.alias("line_count"), words.alias("word_count"), F.length(text).alias("char_count"))
    slugs = map_texts(rows, "path", "filename", lambda t: [("D_" + slug(t.rsplit(".", 1)[0]),)], "doc_id string").withColumnRenamed("id", "path")
    return numbered(rows.join(slugs, "path"), "doc_id", "path").select(*(c.split(" ")[0] for c in MANIFEST.split(", ")))


def cleaned_of(files: DataFrame) -> DataFrame:
    """(path, body, frontmatter, normalized_sha256): front matter as JSON text, and the body in its normal form."""
    import json

    from ..functions.documents import normal_body

    def split(t: str):
        fields, body = split_front_matter(t)
        return [(normal_body(body), json.dumps(fields, ensure_ascii=False, sort_keys=True, default=str))]

    rows = files.select("path", F.decode("content", "utf-8").alias("text"))
    out = map_texts(rows, "path", "text", split, "body string, frontmatter string").withColumnRenamed("id", "path")
    return out.withColumn("normalized_sha256", F.sha2("body", 256))


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One JSON object a line under a fixed schema; blank lines are skipped and lines that don't parse become null rows' dead letters."""
    return spark.read.schema(schema + ", _corrupt string").option("columnNameOfCorruptRecord", "_corrupt").json(path)


def json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A file that is one JSON array."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def pipe_table(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """The rows of a Markdown pipe table as strings; the header and its rule are dropped."""
    line = F.trim("value")
    rows = spark.read.text(path).where(F.startswith(line, F.lit("|")) & ~line.rlike(r"^[|: -]+$"))
    cells = F.transform(F.split(F.regexp_replace(line, r"^\||\|$", ""), r"\|", -1), lambda c: F.trim(c))
    out = rows.select(cells.alias("c")).where(F.size("c") == len(columns))
    out = out.select(*(F.col("c")[i].alias(n) for i, n in enumerate(columns)))
    return out.where(" or ".join(f"lower({n}) <> '{n.lower()}'" for n in columns))


def dimension(spark: SparkSession, path: str, key: str) -> DataFrame:
    """(name, value) of a list or mapping in a YAML file kept by hand."""
    import yaml

    found = yaml.safe_load(Path(path.removeprefix("file:")).read_text("utf-8"))[key]
    rows = [(str(k), None if v is None else str(v)) for k, v in found.items()] if isinstance(found, dict) else [(str(x), str(x)) for x in found]
    return spark.createDataFrame(rows, "name string, value string")


def snapshots(spark: SparkSession, pattern: str, schema: str) -> DataFrame:
    """Rows of snapshot files with ``snapshot_ts`` from the name of the file or its folder."""
    rows = spark.read.schema(schema).json(pattern).select("*", F.col("_metadata.file_path").alias("_f"))
    return rows.withColumn("snapshot_ts", F.to_timestamp(F.regexp_extract("_f", r"(\d{8}_\d{6})[^/]*(?:/[^/]*)?$", 1), "yyyyMMdd_HHmmss")).drop("_f")


def families(files: DataFrame) -> DataFrame:
    """(stem, md, body, frontmatter, meta): which variants of each draft there are."""
    name = r"^(.*?)(\.body\.md|\.frontmatter\.json|\.meta\.json|\.md)$"
    x = files.select(F.regexp_extract("filename", name, 1).alias("stem"), F.regexp_extract("filename", name, 2).alias("v")).where("stem <> ''")
    has = lambda v: F.bool_or(F.col("v") == v)
    return x.groupBy("stem").agg(has(".md").alias("md"), has(".body.md").alias("body"), has(".frontmatter.json").alias("frontmatter"), has(".meta.json").alias("meta"))


def decisions(lines: DataFrame) -> DataFrame:
    """(item, decision, value) of a filled review sheet: lines (line_no, line) with ``### item`` headings and ``decision:`` and ``value:`` lines; empty decisions are left out."""
    from pyspark.sql import Window

    w = Window.partitionBy("sheet").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    item = F.when(F.col("line").rlike("^### "), F.regexp_replace("line", "^### +", ""))
    x = lines.withColumn("item", F.last(item, ignorenulls=True).over(w)).where("item is not null")
    get = lambda k: F.max(F.when(F.col("line").rlike(f"^{k}:"), F.trim(F.regexp_replace("line", f"^{k}:", ""))))
    return x.groupBy("sheet", "item").agg(get("decision").alias("decision"), get("value").alias("value")).where("decision <> ''")


def split_errors(df: DataFrame, is_error: str, errors_path: str) -> DataFrame:
    """Append the rows for which ``is_error`` holds to a dead-letter table and go on with the rest."""
    df.where(is_error).write.mode("append").json(errors_path)
    return df.where(f"not coalesce({is_error}, false)")


def write_changed(new: DataFrame, folder: str, key: str, text: str) -> DataFrame:
    """(key, state) of a write that touches only what changed: ``new``, ``changed``, ``same``, ``absent``.

    The table in ``folder`` has versions; the rows that a version replaces go to ``archive`` before it is
    written, and rows whose key ``new`` lacks stay.  A null text is a text of its own.
    """
    spark = new.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    done = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
    last = max((int(n[1:]) for n in done if n.startswith("v") and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{n}/_SUCCESS"))), default=-1)
    have = spark.read.schema(new.schema).parquet(f"{folder}/v{last}") if last >= 0 else new.where("false")
    digest = F.coalesce(F.sha2(text, 256), F.lit("")).alias("sha")
    both = new.select(F.col(key), digest, F.lit(True).alias("_n")).join(have.select(F.col(key), digest.alias("_old"), F.lit(True).alias("_h")), key, "full")
    state = F.when(F.col("_n").isNull(), "absent").when(F.col("_h").isNull(), "new").when(F.col("sha") == F.col("_old"), "same").otherwise("changed")
    states = keep(both.select(key, state.alias("state")))
    changed = states.where("state = 'changed'").select(key)
    have.join(changed, key, "left_semi").withColumn("version", F.lit(last)).write.mode("append").parquet(f"{folder}/archive")
    stay = have.join(states.where("state in ('same', 'absent')").select(key), key, "left_semi")
    fresh = new.join(states.where("state in ('new', 'changed')").select(key), key, "left_semi")
    stay.unionByName(fresh).write.mode("overwrite").parquet(f"{folder}/v{last + 1}")
    return states


def write_json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_vectors(df: DataFrame, path: str) -> None:
    """Embeddings as Parquet with 32-bit floats."""
    df.withColumn("embedding", F.col("embedding").cast("array<float>")).write.mode("overwrite").option("compression", "snappy").parquet(path)


def answers(df: DataFrame, prompt_col: str, client) -> DataFrame:
    """Add ``answer`` of a client given with the call: a function of a prompt. Prompts go in Arrow batches."""
    ship(df.sparkSession)

    @F.pandas_udf("string")
    def ask(prompts: pd.Series) -> pd.Series:
        return prompts.map(client, na_action="ignore")

    return df.withColumn("answer", ask(prompt_col))
