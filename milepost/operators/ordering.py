"""Positions and running sums over an order, without one task per group.

`row_number() over (order by ...)` puts the whole table, and with a partition
clause the whole group, on one task. Here rows are range-partitioned by group and
order, so even one group (all members tied at zero points) spreads over many
tasks; the counts per slice are then summed up.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from milepost.session import stage

# Slices are one row per (group, task). Up to this many are broadcast, checked by counting.
BROADCAST_SLICES = 200_000

_TASK_BITS = 33  # monotonically_increasing_id: task number above, row within the task below


def positions(
    df: DataFrame,
    order: list[Column],
    group: list[str] = (),
    index: str = "_index",
    running: dict[str, Column] | None = None,
    totals: dict[str, Column] | None = None,
    attach: DataFrame | None = None,
) -> DataFrame:
    """Add the 1-based position of each row within its group.

    order:   must be total within a group; it decides the result
    running: name -> value, adds the running sum up to and including the row
    totals:  name -> value, adds the group's total
    attach:  (group columns, others), unique by group: adds the others, and leaves
             out groups it lacks. Joined to the slices, so a large group is not skewed.

    The ranged rows are written to the shared folder first: range bounds come
    from a sample and must not be drawn again when an executor is lost.
    """
    running, totals = running or {}, totals or {}
    keys = [F.col(g).asc() for g in group] + list(order)
    ranged = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    ranged = ranged.withColumn("_slot", F.monotonically_increasing_id())
    rows = stage(ranged, "ranged")
    rows = rows.withColumn("_task", F.shiftright("_slot", _TASK_BITS).cast("int")).withColumn(
        "_at", F.col("_slot").bitwiseAND(F.lit((1 << _TASK_BITS) - 1))
    )

    # A group is contiguous within a task, so a slice is (group, task).
    slices = rows.groupBy(*group, "_task").agg(
        F.count(F.lit(1)).alias("_rows"),
        F.min("_at").alias("_from"),
        *[F.sum(value).alias(f"_sum_{name}") for name, value in running.items()],
        *[F.sum(value).alias(f"_total_{name}") for name, value in totals.items()],
    )
    # At most one row per task within a group.
    whole = Window.partitionBy(*group)
    earlier = whole.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    attached = [c for c in attach.columns if c not in group] if attach is not None else []
    if attach is not None:
        slices = slices.join(attach, list(group))
    slices = slices.select(
        *attached,
        *[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)],
        F.col("_task").alias("_slice"),
        (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_from")).alias("_shift"),
        *[F.coalesce(F.sum(f"_sum_{n}").over(earlier), F.lit(0)).alias(f"_before_{n}") for n in running],
        *[F.sum(f"_total_{n}").over(whole).alias(f"_total_{n}") for n in totals],
    )
    if group:
        slices = stage(slices, "slices")
        if slices.count() <= BROADCAST_SLICES:
            slices = F.broadcast(slices)
    else:
        slices = F.broadcast(slices)  # one row per task

    same = F.col("_task") == F.col("_slice")
    for i, g in enumerate(group):
        same = same & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    placed = rows.join(slices, same)

    within = Window.partitionBy(*group, "_task").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    return placed.select(
        *df.columns,
        (F.col("_at") + F.col("_shift") + 1).alias(index),
        *[
            (F.col(f"_before_{n}") + F.coalesce(F.sum(value).over(within), F.lit(0))).alias(n)
            for n, value in running.items()
        ],
        *[F.col(f"_total_{n}").alias(n) for n in totals],
        *attached,
    )
