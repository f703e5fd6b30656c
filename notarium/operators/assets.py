"""Assets of notes, and a log of runs."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def asset_folders(notes: DataFrame, folders: DataFrame) -> DataFrame:
    """(stem, folder, state) of the folder that holds a note's images.

    notes (stem, parent); folders (parent, folder, images).  A folder named
    like the note comes first, then ``assets``, then the only folder with
    images; several without a name that fits are ambiguous (quarantine), none
    is ``none``.
    """
    x = notes.join(folders.where("images > 0"), "parent", "left")
    place = F.when(F.col("folder").isin("assets"), 2).when(F.col("folder").isNotNull(), 3)
    place = F.when((F.col("folder") == F.col("stem")) | (F.col("folder") == F.concat("stem", F.lit("_assets"))) | (F.col("folder") == F.concat("stem", F.lit(".assets"))), 1).otherwise(place)
    w = Window.partitionBy("parent", "stem")
    best = x.withColumn("place", place).withColumn("least", F.min("place").over(w)).where("least is null or place = least")
    out = best.groupBy("parent", "stem").agg(F.min("folder").alias("folder"), F.count("folder").alias("n"), F.min("least").alias("least"))
    state = F.when(F.col("n") == 0, "none").when((F.col("least") == 3) & (F.col("n") > 1), "quarantine").otherwise("found")
    return out.select("parent", "stem", F.when(state == "found", F.col("folder")).alias("folder"), state.alias("state"))


def run_row(spark: SparkSession, stage: str, inputs: DataFrame, key: str, parameters: dict, seconds: float) -> DataFrame:
    """One row of the run log: a mark of the inputs that does not depend on order, their number, the parameters, and the time.

    A stage may be skipped when mark and parameters are those of an earlier
    run; parameters are part of the key.
    """
    mark = inputs.agg(F.count("*").alias("rows"), F.expr(f"sum(cast(xxhash64({key}) as decimal(38, 0)))").alias("mark"), F.expr(f"bit_xor(xxhash64({key}, 7))").alias("other"))
    text = json.dumps(parameters, sort_keys=True)
    return mark.select(F.lit(stage).alias("stage"), "rows", F.sha2(F.concat_ws("|", F.col("rows").cast("string"), F.coalesce("mark", F.lit(0)).cast("string"), F.coalesce("other", F.lit(0)).cast("string"), F.lit(text)), 256).alias("run_key"), F.lit(text).alias("parameters"), F.lit(seconds).alias("seconds"))
