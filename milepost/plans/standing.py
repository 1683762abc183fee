"""All-time ranks that are kept up to date, instead of ranking everybody again.

Members are stored by band of points. A member's rank is the number of members in higher bands,
which the table's commits know without any reading, plus the place within the band. When points change,
only the bands that a member leaves or enters are read and placed anew.
"""

from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from milepost.operators.ordering import positions
from milepost.operators.versions import Commit, VersionedTable
from milepost.schemas import layout

BAND_MEMBERS = 100_000  # of a band, about; members of equal points share one
MOST_BANDS = 10_000
ACCURACY = 100_000  # of the quantiles that bound the bands
STORED = layout("id string, phone string, totalpoints bigint, band int, place bigint")


class Standing:
    """Ranked members below `path`. Order: most points, then phone, then id (nulls first)."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.table = VersionedTable(spark, path, STORED, by=["band"], sort=["place"])

    def _band(self, points: Column, edges: list[int]) -> Column:
        """The number of edges above the points. Edges fall; whole rows of them are skipped by their last."""
        width = max(int(len(edges) ** 0.5), 1)
        rows = [edges[i : i + width] for i in range(0, len(edges), width)]
        if not rows:
            return F.lit(0)
        above = lambda values: F.size(F.filter(values, lambda e: e > points))
        skipped = above(F.array(*[F.lit(r[-1]).cast("bigint") for r in rows]))
        inside = F.get(F.array(*[F.array(*[F.lit(e).cast("bigint") for e in r]) for r in rows]), skipped)
        return (skipped * width + F.when(skipped < len(rows), above(inside)).otherwise(0)).cast("int")

    def _placed(self, members: DataFrame, edges: list[int]) -> DataFrame:
        banded = members.select("id", "phone", "totalpoints").withColumn("band", self._band(F.col("totalpoints"), edges))
        order = [F.desc("totalpoints"), F.asc_nulls_first("phone"), F.asc_nulls_first("id")]
        return positions(banded, order, ["band"], index="place").select(*STORED.names)

    def build(self, members: DataFrame, band_members: int = BAND_MEMBERS) -> Commit:
        """Rank everybody: (id, phone, totalpoints); missing points count as 0."""
        members = members.withColumn("totalpoints", F.coalesce("totalpoints", F.lit(0)).cast("bigint"))
        bands = min(-(-members.count() // band_members), MOST_BANDS)
        shares = [i / bands for i in range(1, bands)]
        found = members.agg(F.percentile_approx("totalpoints", shares, ACCURACY)).first()[0] if shares else []
        edges = sorted(set(found or []), reverse=True)
        return self.table.replace_all(self._placed(members, edges), {"edges": edges})

    def offsets(self, commit: Commit) -> dict[int, int]:
        """Members in higher bands, per band: sums over the row counts of the commit."""
        rows = {int(slot.split("=")[1]): sum(r.rows for r in runs) for slot, runs in commit.slots.items()}
        order = sorted(rows)
        return dict(zip(order, accumulate([0, *(rows[b] for b in order)])))

    def ranks(self, commit: Commit | None = None) -> DataFrame:
        """(id, phone, totalpoints, rank) of everybody."""
        commit = commit or self.table.last()
        higher = self.spark.createDataFrame(list(self.offsets(commit).items()), "_band int, _higher bigint")
        rows = self.table.read(commit=commit).join(F.broadcast(higher), F.col("band") == F.col("_band"))  # MOST_BANDS rows
        return rows.select("id", "phone", "totalpoints", (F.col("_higher") + F.col("place")).cast("int").alias("rank"))

    def change(self, changes: DataFrame) -> list[str]:
        """Apply (id, phone, old_points, new_points), one row per member; returns the bands that were read.

        old_points is what the table holds (missing points are stored as 0); null for a new member. new_points null: the member leaves.
        """
        base = self.table.last()
        edges = base.notes["edges"]
        band = lambda c: self._band(F.col(c), edges)
        touched = changes.select(F.explode(F.array(*[F.when(F.col(c).isNotNull(), band(c)) for c in ("old_points", "new_points")])).alias("band"))
        touched = touched.filter(F.col("band").isNotNull())
        slots = self.table.slots_of(touched, base)
        if not slots:
            return []
        gone = changes.select(F.col("id").alias("_id"), F.col("phone").alias("_phone"))
        same = F.col("id").eqNullSafe(F.col("_id")) & F.col("phone").eqNullSafe(F.col("_phone"))
        left = self.table.read(slots, base).join(gone, same, "left_anti").select("id", "phone", "totalpoints")
        come = changes.filter(F.col("new_points").isNotNull()).select("id", "phone", F.col("new_points").cast("bigint").alias("totalpoints"))
        self.table.replace(self._placed(left.unionByName(come), edges), slots, base)
        self.table.clean()
        return slots

    def moved(self, before: Commit, after: Commit | None = None) -> DataFrame:
        """(id, phone, old_rank, new_rank) of the members whose rank differs between two versions."""
        old = self.ranks(before).select(F.col("id").alias("_id"), F.col("phone").alias("_phone"), F.col("rank").alias("old_rank"))
        same = F.col("id").eqNullSafe(F.col("_id")) & F.col("phone").eqNullSafe(F.col("_phone"))
        both = self.ranks(after).join(old, same, "left")
        return both.filter(~F.col("rank").eqNullSafe(F.col("old_rank"))).select("id", "phone", "old_rank", F.col("rank").alias("new_rank"))

