"""Order statistics by radix narrowing on order-preserving 64-bit keys.

The bits of a double, with all but the sign flipped for negative numbers, order as a signed
integer like the numbers themselves.  Four rounds fix 16 bits each: a round counts the rows that
share the bits found so far by their next 16 bits, at most 65,536 counts for each wanted rank,
and the running count names the digit that holds the rank.  No task ever gets the rows of an
interval, however many rows one prefix or one value has.
"""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from strata.runtime import pin

DIGIT = 16
ROUNDS = 64 // DIGIT
_LOW = np.int64(0x7FFFFFFFFFFFFFFF)


def keys_of(values: np.ndarray) -> np.ndarray:
    """Signed integers in the order of the doubles; both zeros are one."""
    bits = (values + 0.0).view(np.int64)
    return np.where(bits < 0, bits ^ _LOW, bits)


def value_of(key: int) -> float:
    """The double of a key."""
    bits = np.array([key], np.int64)
    return float(np.where(bits < 0, bits ^ _LOW, bits).view(np.float64)[0])


@F.arrow_udf(LongType())
def order_key(values: pa.Array) -> pa.Array:
    return pa.array(keys_of(values.to_numpy(zero_copy_only=False).astype(np.float64)))


def values_at(rows: DataFrame, wanted: Mapping[object, tuple[int, int]]) -> dict[object, float]:
    """The value at each wanted (slot, 0-based rank) of ``rows`` (slot int, value double, without NULL and NaN).

    The rows are counted per slot and value and stored as keys once.  A round brings one row per
    wanted rank to the driver.
    """
    if not wanted:
        return {}
    spark = rows.sparkSession
    counted = rows.groupBy("slot", (F.col("value") + F.lit(0.0)).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    keyed = pin(counted.select("slot", order_key("value").alias("key"), "n"))
    # group: slot and the bits known so far; ranks count inside the group
    state = {target: (slot, None, rank) for target, (slot, rank) in wanted.items()}
    for step in range(1, ROUNDS + 1):
        groups = sorted({(slot, -1 if prefix is None else prefix) for slot, prefix, _ in state.values()})
        number = {g: i for i, g in enumerate(groups)}
        known = spark.createDataFrame([(i, s, p) for (s, p), i in number.items()], "grp int, slot int, prefix long")
        digit = F.shiftright("key", 64 - DIGIT * step)
        if step == 1:
            part = keyed.join(F.broadcast(known.drop("prefix")), "slot")  # a row per wanted rank at most
        else:
            part = keyed.withColumn("prefix", F.shiftright("key", 64 - DIGIT * (step - 1))).join(F.broadcast(known), ["slot", "prefix"])
        counts = part.groupBy("grp", digit.alias("digit")).agg(F.sum("n").alias("n"))
        before = Window.partitionBy("grp").orderBy("digit").rowsBetween(Window.unboundedPreceding, 0)
        upto = counts.withColumn("upto", F.sum("n").over(before))  # at most 2^16 rows of a group
        asked = [(number[slot, -1 if prefix is None else prefix], rank) for slot, prefix, rank in state.values()]
        ranks = spark.createDataFrame(sorted(set(asked)), "grp int, rank long")
        inside = (F.col("rank") < F.col("upto")) & (F.col("rank") >= F.col("upto") - F.col("n"))
        found = {
            (r["grp"], r["rank"]): (r["digit"], r["rank"] - (r["upto"] - r["n"]))
            for r in upto.join(F.broadcast(ranks), "grp").filter(inside).select("grp", "rank", "digit", "upto", "n").collect()
        }
        state = {
            target: (slot, *found[number[slot, -1 if prefix is None else prefix], rank]) for target, (slot, prefix, rank) in state.items()
        }
    return {target: value_of(key) for target, (_, key, _) in state.items()}
