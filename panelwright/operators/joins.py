"""Joins that keep the rows of the left side, lookups and upserts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.panel import Panel


def shared_keys(skeleton: DataFrame, keys: Sequence[str]) -> list[str]:
    found = [k for k in keys if k in skeleton.columns]
    if not found:
        raise ValueError(f"the skeleton has none of the keys {list(keys)}")
    return found


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def check_unique(tables: Sequence[tuple[DataFrame, Sequence[str]]]) -> None:
    """Raise if a table has a key twice; one job for all tables."""
    found = None
    for i, (table, keys) in enumerate(tables):
        twice = duplicate_keys(table, keys).select(F.lit(i).alias("table")).limit(1)
        found = twice if found is None else found.unionByName(twice)
    bad = [] if found is None else sorted(r[0] for r in found.collect())
    if bad:
        raise ValueError(f"joining on {list(tables[bad[0]][1])} would change the row count")


def left_join_keeping_rows(
    skeleton: DataFrame,
    table: DataFrame,
    keys: Sequence[str],
    cols: Sequence[str] | None = None,
    check: bool = False,
) -> DataFrame:
    """Left-join a table on the keys it shares with the skeleton.

    The table may be coarser than the skeleton: a yearly or a group-only table
    is spread over the finer rows by the join. The number of rows must not
    change, which holds exactly when the table's keys are unique; `check`
    looks for a duplicate key before the join is built, on the table alone.
    """
    on = shared_keys(skeleton, keys)
    if cols is not None:
        table = table.select(*keys, *[c for c in cols if c in table.columns])
    if check:
        check_unique([(table, on)])
    return skeleton.join(table, on, "left")


def join_tables(
    skeleton: DataFrame,
    tables: Sequence[tuple[DataFrame, Sequence[str]]],
    cols: Sequence[str] | None = None,
    check: bool = False,
) -> DataFrame:
    """Left-join (table, keys) pairs of mixed resolution, in order. `check`
    looks at the keys of all tables in one job."""
    joins = []
    for table, keys in tables:
        wanted = cols
        if cols is not None:
            wanted = [c for c in cols if c in table.columns and c not in keys]
            if not wanted:
                continue
        joins.append((table, keys, wanted))
    if check:
        check_unique([(table, shared_keys(skeleton, keys)) for table, keys, _ in joins])
    out = skeleton
    for table, keys, wanted in joins:
        out = left_join_keeping_rows(out, table, keys, wanted)
    return out


def salted_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join that spreads hot left keys over several tasks.

    A count per key, combined before the shuffle, finds the keys that hold more
    than a fair share of the left side, its rows per shuffle partition. There
    are fewer such keys than partitions, which bounds their broadcast. A hot
    key gets as many salts as it has fair shares: its left rows are dealt out
    over them, its right rows are repeated once per salt. A left row with a
    missing key has no partner and goes anywhere.
    """
    if how not in ("inner", "left"):
        raise ValueError("salted_join knows inner and left joins")
    partitions = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = left.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    fair = counts.agg(F.sum("_n")).scalar() / F.lit(float(partitions))
    hot = counts.filter(F.col("_n") > fair).select(*on, F.ceil(F.col("_n") / fair).cast("int").alias("_salts"))
    # From the row itself and its partition, so that a task that runs again
    # sends its rows the same way.
    number = F.xxhash64(*left.columns, F.spark_partition_id())
    no_key = F.lit(False)
    for c in on:
        no_key = no_key | F.col(c).isNull()
    salts = F.when(no_key, F.lit(partitions)).otherwise(F.coalesce("_salts", F.lit(1)))
    salted_left = (
        left.withColumn("_number", number)
        .join(F.broadcast(hot), list(on), "left")
        .withColumn("_salt", F.pmod("_number", salts).cast("int"))
        .drop("_number", "_salts")
    )
    every = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    salted_right = (
        right.join(F.broadcast(hot), list(on), "left").withColumn("_salt", F.explode(every)).drop("_salts")
    )
    return salted_left.join(salted_right, [*on, "_salt"], how).drop("_salt")


def latest_per_code(lookup: DataFrame, code: str, id_col: str) -> DataFrame:
    """Of duplicate codes keep the highest id."""
    return lookup.groupBy(code).agg(F.max(id_col).alias(id_col))


def join_latest_code(
    df: DataFrame, lookup: DataFrame, code: str, id_col: str, how: str = "inner"
) -> DataFrame:
    """Attach the newest id of a code. One code may hold most rows, so salted."""
    return salted_join(df, latest_per_code(lookup, code, id_col), [code], how)


def update_from(
    target: DataFrame, source: DataFrame, on: Sequence[str], cols: Sequence[str]
) -> DataFrame:
    """Set columns on rows that have a match, keep the old value on the others."""
    new = source.select(*on, *[F.col(c).alias(f"_new_{c}") for c in cols])
    joined = target.join(new, list(on), "left")
    return joined.select(
        *[
            F.coalesce(f"_new_{c}", c).alias(c) if c in cols else F.col(c)
            for c in target.columns
        ]
    )


def assign_into(
    target: DataFrame, source: DataFrame, panel: Panel, check: bool = False
) -> DataFrame:
    """Upsert by panel key: overwrite only where the source has a value.

    Columns the target lacks are added. With `check`, a source key that the
    target does not have is an error; without, such rows are left out.
    """
    cols = panel.values(source)
    if check and not keys_missing_in(source, target, panel.keys).isEmpty():
        raise ValueError("the source has keys that the target lacks")
    new = source.select(*panel.keys, *[F.col(c).alias(f"_new_{c}") for c in cols])
    joined = target.join(new, panel.keys, "left")
    kept = [
        F.coalesce(F.col(f"_new_{c}"), F.col(c)).alias(c) if c in cols else F.col(c)
        for c in target.columns
    ]
    added = [F.col(f"_new_{c}").alias(c) for c in cols if c not in target.columns]
    return joined.select(*kept, *added)


def assign_all_into(
    target: DataFrame, sources: Sequence[DataFrame], panel: Panel
) -> DataFrame:
    """Upsert several sources one after the other, with one aggregate and join.

    The value of the last source that has one wins, and the target's own value
    stays where none has. Sources may have different columns and keys.
    """
    numbered = [s.withColumn("_turn", F.lit(i)) for i, s in enumerate(sources)]
    stacked = numbered[0]
    for frame in numbered[1:]:
        stacked = stacked.unionByName(frame, allowMissingColumns=True)
    cols = [c for c in stacked.columns if c not in (*panel.keys, "_turn")]
    last = stacked.groupBy(*panel.keys).agg(
        *[
            F.max_by(c, F.when(F.col(c).isNotNull(), F.col("_turn"))).alias(c)
            for c in cols
        ]
    )
    return assign_into(target, last, panel)


def keys_missing_in(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of the left side that the right side does not have."""
    return left.select(*keys).join(right.select(*keys), list(keys), "left_anti")


def only_members(df: DataFrame, members: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key is in the member list."""
    return df.join(members.select(*on), list(on), "left_semi")


def drop_members(df: DataFrame, members: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key is not in the member list, for lists of any length."""
    return df.join(members.select(*on), list(on), "left_anti")


def spread_to_fine_cells(
    coarse: DataFrame, cell_map: DataFrame, parent: str, cell: str
) -> DataFrame:
    """Give the value of a coarse cell to each fine cell it covers."""
    return coarse.join(cell_map.select(parent, cell), parent).drop(parent)


def lookup_column(mapping: Mapping[object, object], key: Column) -> Column:
    """A small fixed mapping as one map literal looked up per row."""
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), key)
