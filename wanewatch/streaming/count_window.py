"""Count-based window of a stream: the newest n values per group, kept as state.

A group is spread over salts, each with its own state of at most n values; the newest n of
the group are among those. So a group with a third of all rows is worked on by many tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

OUTPUT_DDL = "grp string, salt bigint, seen bigint, orders array<bigint>, vals array<double>"
STATE_DDL = "seen bigint, orders array<bigint>, vals array<double>"


def count_window(
    stream: DataFrame, group: str, order: str, value: str, n: int, salts: int = 16
) -> DataFrame:
    """Per (group, salt) and micro-batch: rows seen and the newest n (order, value) pairs.

    ``order`` is a bigint, unique within a group. Rows are folded in chunk by chunk.
    """

    def update(
        key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        seen, orders, vals = state.get if state.exists else (0, [], [])
        kept = pd.DataFrame({"o": list(orders), "v": list(vals)})
        for chunk in chunks:
            seen += len(chunk)
            fresh = pd.DataFrame({"o": chunk["_order"], "v": chunk["_value"]})
            kept = (pd.concat([kept, fresh]) if len(kept) else fresh).nlargest(n, "o")
        newest = ([int(o) for o in kept["o"]], [float(v) for v in kept["v"]])
        state.update((int(seen), *newest))
        yield pd.DataFrame(
            {
                "grp": [key[0]],
                "salt": [key[1]],
                "seen": [int(seen)],
                "orders": [newest[0]],
                "vals": [newest[1]],
            }
        )

    keyed = stream.select(
        F.col(group).cast("string").alias("_group"),
        F.col(order).cast("bigint").alias("_order"),
        F.col(value).cast("double").alias("_value"),
    ).withColumn("_salt", F.pmod("_order", F.lit(salts)).cast("bigint"))
    return keyed.groupBy("_group", "_salt").applyInPandasWithState(
        update, OUTPUT_DDL, STATE_DDL, "update", GroupStateTimeout.NoTimeout
    )


def merge_count_windows(salted: DataFrame, n: int) -> DataFrame:
    """(grp, seen, kept, mean, std) of the newest n rows from the newest salted states."""
    seen = salted.groupBy("grp").agg(F.sum("seen").alias("seen"))
    w = Window.partitionBy("grp").orderBy(F.col("o").desc())
    newest = (
        salted.select("grp", F.inline(F.arrays_zip(F.col("orders").alias("o"), F.col("vals").alias("v"))))
        .withColumn("_rn", F.row_number().over(w))
        .where(F.col("_rn") <= n)
        .groupBy("grp")
        .agg(F.count("*").alias("kept"), F.avg("v").alias("mean"), F.stddev_pop("v").alias("std"))
    )
    return seen.join(newest, "grp")
