"""Joins that keep their balance when one key holds a large share of the rows.

A plain equi-join is left to adaptive execution, which splits what it finds to be skewed
while the join runs. Where that is not enough, the caller names the hot keys and gets the
salted form. No function here reads data while a plan is built.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALTS = 64
HOWS = ("inner", "left", "left_semi", "left_anti")

_SALT = "_salt"


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    how: str = "inner",
    hot: Column | None = None,
    salts: int = SALTS,
) -> DataFrame:
    """Equi-join that spreads the rows of hot keys over ``salts`` tasks.

    ``hot`` is a condition on the key columns; without one every key is spread. A hot row
    of the left gets a salt from a hash of all its columns, so that it does not matter how
    the left is partitioned or sorted and a task that runs again chooses the same; only rows
    that are equal in every column stay together. Right rows of hot keys are repeated once
    per salt, so each pair still meets exactly once.
    """
    if how not in HOWS:
        raise ValueError(f"unsupported join type: {how}")
    is_hot = F.lit(True) if hot is None else F.coalesce(hot, F.lit(False))
    spread = F.pmod(F.xxhash64(*left.columns), F.lit(salts)).cast("int")
    salted_left = left.withColumn(_SALT, F.when(is_hot, spread).otherwise(F.lit(0)))
    all_salts = F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    salted_right = right.withColumn(_SALT, F.explode(all_salts))
    return salted_left.join(salted_right, [*on, _SALT], how).drop(_SALT)


def skew_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    how: str = "inner",
    hot: Column | None = None,
    salts: int = SALTS,
) -> DataFrame:
    """Equi-join (inner, left, left_semi, left_anti), salted where the caller names ``hot`` keys."""
    if how not in HOWS:
        raise ValueError(f"unsupported join type: {how}")
    return left.join(right, on, how) if hot is None else salted_join(left, right, on, how, hot, salts)


def null_safe_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Equi-join in which NULL keys match each other; the key columns appear once.

    NULL is a value of its own in the keys: each side adds for every key whether it
    is NULL and a text that is never NULL.
    """
    flags = [f"_null_{k}" for k in on]

    def keyed(df: DataFrame) -> DataFrame:
        return df.withColumns({f"_null_{k}": F.col(k).isNull() for k in on})

    filled = keyed(right).withColumns({k: F.coalesce(F.col(k), F.lit("")) for k in on})
    kept = [k for k in left.columns]
    rest = [c for c in right.columns if c not in on]
    marked = keyed(left).withColumns({f"_key_{k}": F.coalesce(F.col(k), F.lit("")) for k in on})
    joined = skew_join(
        marked, filled.withColumnsRenamed({k: f"_key_{k}" for k in on}), [f"_key_{k}" for k in on] + flags, how
    )
    return joined.select(*kept, *rest)
