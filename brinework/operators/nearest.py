"""Exact nearest rows by a tree of boxes, whatever the distance between the two tables' rows.

The targets' tree has a fixed number of levels, each a table of square boxes: the targets' own extent,
how many there are, and the greatest ``capacity`` among them. Seekers are gathered into boxes of the
last level's size, and these go down one level at a time by a join with the children of the boxes
they have met. A box with too small a capacity has no target for them and goes at once; of the
others, those stay that come no farther than the farthest point of the best one. Seekers then choose
among their own box's few, and each meets the targets of a box as one list, of which it keeps the
best; no pair of rows is shuffled or sorted. The number of joins is that of the levels, and follows
from the targets alone, so a seeker far away costs no more than one nearby.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brinework.session import cut

#: Bits of an address on each axis, levels that one join goes down, and targets that a box of the last level holds if they are not on one spot.
BITS, STRIDE, LEAF = 20, 2, 16
#: Boxes of a level that every executor may hold.
FEW_BOXES = 4096


def unit_vector(lon: str = "lon", lat: str = "lat") -> list[Column]:
    """A place on the unit sphere; straight-line distances there are in the order of those along the surface."""
    a, b = F.radians(lat), F.radians(lon)
    return [F.cos(a) * F.cos(b), F.cos(a) * F.sin(b), F.sin(a)]


class BoxTree:
    """Targets with coordinate columns, and the tables of their boxes."""

    def __init__(self, targets: DataFrame, axes: list[str], capacity: str | None = None):
        """Targets without a coordinate are left out. ``empty`` tells that there are none."""
        self.axes, self.capacity = axes, capacity
        known = targets.where(" and ".join(f"`{a}` is not null and not isnan(`{a}`)" for a in axes))
        ends = known.agg(F.count(F.lit(1)), *[f(a) for a in axes for f in (F.min, F.max)], *([F.max(capacity)] if capacity else [])).first()  # one row
        self.empty, self.greatest = ends[0] == 0, ends[-1] if capacity else None
        if self.empty:
            return
        self.lows, sides = [ends[1 + 2 * k] for k in range(len(axes))], [ends[2 + 2 * k] - ends[1 + 2 * k] for k in range(len(axes))]
        self.scale = max(sides) or 1.0  # of all axes, so that boxes are square
        spots = {f"__a{k}": F.least(F.lit((1 << BITS) - 1), self._address(a, k, BITS)) for k, a in enumerate(axes)}
        self.addressed = known.withColumns(spots)
        self.level = self._start(ends[0], sides)
        self.leaves = cut(self._boxes(self.addressed, self.level, first=True))
        while self.level + STRIDE <= BITS and self.leaves.where(F.col("__n") > LEAF).limit(1).count():
            # some box is crowded: a finer last level, as long as that parts its targets
            finer = cut(self._boxes(self.addressed, self.level + STRIDE, first=True))
            parted = finer.agg(F.max("__n")).first()[0] < self.leaves.agg(F.max("__n")).first()[0]
            self.leaves, self.level = finer, self.level + STRIDE
            if not parted:
                break

    def _start(self, n: int, sides: list[float]) -> int:
        """The level whose boxes hold a leaf's targets if these lie evenly on the two longest sides."""
        long, short = [*sorted(sides, reverse=True), 0.0][:2]
        side = max(math.sqrt(long * short * LEAF / n), long * LEAF / n)
        level = math.log2(self.scale / side) if 0 < side < self.scale else 0.0
        return min(BITS, STRIDE * math.ceil(level / STRIDE))

    def _address(self, axis: str, k: int, level: int) -> Column:
        return F.floor((F.col(axis) - self.lows[k]) / self.scale * (1 << level)).cast("bigint")

    def _key(self, level: int, source: int = BITS) -> Column:
        """A box's address as one number; at most 60 bits."""
        return sum((F.shiftright(f"__a{k}", source - level).cast("bigint") * (1 << (BITS * k)) for k in range(len(self.axes))), F.lit(0).cast("bigint"))

    def _boxes(self, rows: DataFrame, level: int, first: bool = False, source: int = BITS) -> DataFrame:
        lows, highs = ([F.min(a if first else f"__l{k}").alias(f"__l{k}") for k, a in enumerate(self.axes)], [F.max(a if first else f"__h{k}").alias(f"__h{k}") for k, a in enumerate(self.axes)])
        most = F.max(self.capacity if first and self.capacity else F.lit(0.0) if first else "__most").alias("__most")
        own = [F.shiftright(f"__a{k}", source - level).alias(f"__a{k}") for k in range(len(self.axes))]
        return rows.groupBy(*own).agg((F.count(F.lit(1)) if first else F.sum("__n")).alias("__n"), most, *lows, *highs)

    @staticmethod
    def _reach(sides: list[tuple[Column, Column, Column, Column]]) -> tuple[Column, Column]:
        """The least and the greatest distance between two boxes, given by their (low, high, low, high) on each axis."""
        gaps = [(F.greatest(a - d, c - b, F.lit(0.0)), F.greatest(b - c, d - a)) for a, b, c, d in sides]
        least, most = (F.sqrt(sum((g[i] * g[i] for g in gaps), F.lit(0.0))) for i in (0, 1))
        return least, most

    def _met(self, placed: DataFrame, axes: list[str], need: str | None, slack: float) -> DataFrame:
        """(own, box, its ends): the boxes of the last level in which a seeker of each own box may find its target."""
        span = range(len(axes))
        ends = [f"__{e}{k}" for e in "uv" for k in span]
        front = placed.groupBy("__own").agg(*[F.min(a).alias(f"__u{k}") for k, a in enumerate(axes)], *[F.max(a).alias(f"__v{k}") for k, a in enumerate(axes)])
        front = front.withColumns({"__box": F.lit(0).cast("bigint"), "__best": F.lit(math.inf)})
        level, tables = 0, {self.level: self.leaves}
        for below in range(self.level - STRIDE, 0, -STRIDE):
            tables[below] = self._boxes(tables[below + STRIDE], below, source=below + STRIDE)
        least, most = self._reach([tuple(F.col(f"__{e}{k}") for e in "lhuv") for k in span])
        own = Window.partitionBy("__own")
        while level < self.level:
            level += STRIDE
            children = tables[level].select(self._key(level - STRIDE, level).alias("__box"), self._key(level, level).alias("__to"), "__most", *[f"__{e}{k}" for k in span for e in "lh"])
            if 1 << level * len(self.axes) <= FEW_BOXES:
                children = F.broadcast(children)
            met = front.join(children, "__box")
            if need:
                met = met.where(F.col(f"__own.{need}").isNull() | (F.col("__most") >= F.col(f"__own.{need}")))
            met = met.drop("__box").withColumnRenamed("__to", "__box").withColumns({"__least": least, "__far": most}).where(F.col("__least") <= F.col("__best") + slack)
            # of the boxes that hold a target for the seekers, each proves one within its farthest point
            met = met.withColumn("__best", F.least("__best", F.min("__far").over(own))).where(F.col("__least") <= F.col("__best") + slack)
            front = met.select("__own", *ends, "__box", "__best")
        return met

    def nearest(self, seekers: DataFrame, axes: list[str], need: str | None, order: Callable[[Callable[[str], Column]], list[Column]], out: list[str], slack: float) -> DataFrame:
        """The seekers with a struct ``found`` of the target columns ``out``, least by ``order``; a seeker without any target has no row.

        ``order`` gives expressions over the seeker's columns and those of a target, which it gets
        by name from its argument; they never put a target before one that is nearer by more than
        ``slack`` on the axes. ``need`` is the capacity a target must have. Seekers that are equal
        in all columns are one, and none lacks a place.
        """
        keys = seekers.columns
        placed = seekers.withColumns({f"__p{k}": self._address(a, k, self.level) for k, a in enumerate(axes)})
        if self.level:
            own = F.struct(*[f"__p{k}" for k in range(len(axes))], *([need] if need else [])).alias("__own")
            placed = placed.select(*keys, own)
            # a seeker sees the boxes that its own box has met as one short list
            ends = [f"__{e}{k}" for k in range(len(axes)) for e in "lh"]
            near = self._met(placed, axes, need, slack).groupBy("__own").agg(F.collect_list(F.struct("__box", *ends)).alias("__near"))
            reach = lambda n: self._reach([(n[f"__l{k}"], n[f"__h{k}"], F.col(a), F.col(a)) for k, a in enumerate(axes)])
            seen = placed.join(near, "__own").select(*keys, "__near", F.array_min(F.transform("__near", lambda n: reach(n)[1])).alias("__best"))
            front = seen.select(*keys, "__best", F.explode("__near").alias("__n")).where(reach(F.col("__n"))[0] <= F.col("__best") + slack).select(*keys, "__n.__box")
        else:
            front = seekers.withColumn("__box", F.lit(0).cast("bigint"))
        rows = self.addressed.select(self._key(self.level).alias("__box"), F.struct(*dict.fromkeys([*self.axes, *([self.capacity] if need else []), *out])).alias("__t"))
        leaves = rows.groupBy("__box").agg(F.collect_list("__t").alias("__ts"))

        def candidate(t: Column) -> Column:
            return F.struct(*[o.alias(f"__o{k}") for k, o in enumerate(order(lambda c: t[c]))], *[t[c].alias(c) for c in out])

        def better(held: Column, t: Column) -> Column:
            apart = F.sqrt(sum(((t[b] - F.col(a)) * (t[b] - F.col(a)) for a, b in zip(axes, self.axes)), F.lit(0.0)))
            worse = apart > held["near"] + slack
            if need:
                worse = worse | F.coalesce(t[self.capacity] < F.col(need), F.lit(False)) | (t[self.capacity].isNull() & F.col(need).isNotNull())
            return F.when(worse, held).otherwise(F.struct(F.least(held["near"], apart).alias("near"), F.least(held["best"], candidate(t)).alias("best")))

        nothing = F.struct(F.lit(math.inf).alias("near"), F.when(F.lit(False), candidate(F.get("__ts", F.lit(0)))).alias("best"))
        pairs = front.join(leaves, "__box").select(*keys, F.aggregate("__ts", nothing, better)["best"].alias("__b"))
        return pairs.groupBy(*keys).agg(F.min("__b").alias("__b")).where("__b is not null").select(*keys, F.struct(*[f"__b.{c}" for c in out]).alias("found"))
