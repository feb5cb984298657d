"""Places and running sums in a global order, without a window over all rows.

Rows are sorted by range into partitions that follow each other and written
once; a row's place is its place in its partition plus the rows (or sums) of
the partitions before, of which there is one number each.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankforge.session import materialize

_IN_PART = (1 << 33) - 1


def numbered(df: DataFrame, *order, name: str = "place") -> DataFrame:
    """Number the rows from 0 in ``order``."""
    rows = materialize(df.orderBy(*order)).withColumn("_id", F.monotonically_increasing_id()) \
        .withColumn("_part", F.shiftright("_id", 33))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)       # one row per partition
    parts = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")) \
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return rows.join(F.broadcast(parts), "_part") \
        .withColumn(name, F.col("_before") + F.col("_id").bitwiseAND(F.lit(_IN_PART))).drop("_id", "_part", "_before")


def summed_before(df: DataFrame, value: str, *order, name: str = "before") -> DataFrame:
    """Add ``name``: the sum of the whole numbers ``value`` over all earlier rows."""
    rows = materialize(df.orderBy(*order))

    def run(frames):
        total, part = 0, None
        for pdf in frames:
            from pyspark import TaskContext
            part = TaskContext.get().partitionId() if part is None else part
            upto = total + pdf[value].cumsum()
            yield pdf.assign(_in=upto - pdf[value], _part=part)
            total = int(upto.iloc[-1]) if len(pdf) else total

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", _in long, _part int"
    inside = materialize(rows.mapInPandas(run, schema))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)       # one row per partition
    parts = inside.groupBy("_part").agg(F.sum(value).alias("_s")) \
        .select("_part", F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_before"))
    return inside.join(F.broadcast(parts), "_part").withColumn(name, F.col("_before") + F.col("_in")).drop("_in", "_part", "_before")
