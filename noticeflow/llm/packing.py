"""Filling containers of one capacity with items, little space unused.

Item sizes are whole numbers from 1 to the capacity, so an instance of any
length is its histogram: at most ``capacity`` rows, which is the proven bound of
what reaches the driver. There the plan is made, on sizes with multiplicities:

1. Reduction after Martello and Toth. For the largest size left, a set of at
   most three items is fixed if it provably dominates every other filling of a
   container that holds that size: the item alone where nothing else fits; the
   item and the largest that fits beside it where they fill the container
   exactly, or no two items fit beside it, or no two that fit have a larger
   sum; the item and two others where no three fit and the two are at least as
   large, one by one, as any two that fit. All copies are fixed at once.
2. Best fit decreasing on what is left, again for all copies of a size at once:
   the fullest container that can take the size is filled with it.

A plan is a list of classes (number of equal containers, contents); its length
depends on the capacity, not on the number of items. Items are then matched to
the plan by their rank within their size. Ranks are counted in salted parts of
each size, so that a size that holds a third of all items is spread too.

Items larger than the capacity are cut into full containers and a rest that is
packed like any item; no other item is cut. Defined cases: items without size
(null or 0) need no container and come with a null one; equal ids are items of
their own; an empty table yields nothing.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Parts into which the ranking of one size is cut.
SALT = 64

#: (containers, ((size, copies in each container), ...))
PackingClass = tuple[int, tuple[tuple[int, int], ...]]


def _largest(sizes: list[int], most: int) -> int | None:
    """The largest of the ascending sizes that is at most ``most``."""
    i = bisect_left(sizes, most + 1)
    return sizes[i - 1] if i else None


class _Histogram:
    """Sizes with their counts; ``sizes`` ascending, only those with items left."""

    def __init__(self, counts: Mapping[int, int]):
        self.count = {s: n for s, n in counts.items() if n > 0}
        self.sizes = sorted(self.count)

    def take(self, size: int, n: int) -> None:
        self.count[size] -= n
        if not self.count[size]:
            del self.count[size]
            del self.sizes[bisect_left(self.sizes, size)]

    def smallest(self, k: int) -> list[int]:
        """The k smallest items, with repetition; fewer if there are fewer."""
        got: list[int] = []
        for s in self.sizes:
            got += [s] * min(self.count[s], k - len(got))
            if len(got) == k:
                break
        return got

    def best_pair(self, space: int) -> int:
        """The largest sum of two items that is at most ``space``; 0 if no two fit."""
        best, lo, hi = 0, 0, len(self.sizes) - 1
        while lo <= hi:
            s = self.sizes[lo] + self.sizes[hi]
            if s > space or (lo == hi and self.count[self.sizes[lo]] < 2):
                hi -= 1
                continue
            best = max(best, s)
            lo += 1
        return best

    def best_lesser(self, space: int) -> int:
        """The largest y of any two items x >= y with x + y at most ``space``; 0 if no two fit."""
        y = _largest(self.sizes, space // 2)
        while y is not None:
            if self.count[y] > 1:
                return y
            i = bisect_left(self.sizes, y)
            if i + 1 < len(self.sizes) and self.sizes[i + 1] + y <= space:
                return y
            y = self.sizes[i - 1] if i else None
        return 0


def reduce_dominated(h: _Histogram, capacity: int) -> list[PackingClass]:
    """Fix dominating sets, taking their items out of ``h``."""
    fixed: list[PackingClass] = []
    at = len(h.sizes) - 1
    while at >= 0:
        if at >= len(h.sizes):
            at = len(h.sizes) - 1
            continue
        j = h.sizes[at]
        n_j, space = h.count[j], capacity - j
        h.take(j, 1)  # one copy is in the container; the others may go beside it
        k = _largest(h.sizes, space)
        chosen: list[int] | None = None
        if k is None:
            chosen = []
        else:
            least = h.smallest(3)
            if k == space or len(least) < 2 or least[0] + least[1] > space:
                chosen = [k]
            elif len(least) < 3 or sum(least) > space:
                if k >= h.best_pair(space):
                    chosen = [k]
                else:
                    h.take(k, 1)
                    b = _largest(h.sizes, space - k)
                    h_back(h, k)
                    if b is not None and b >= h.best_lesser(space):
                        chosen = [k, b]
        h_back(h, j)
        if chosen is None:
            at -= 1
            continue
        need: dict[int, int] = {}
        for s in (j, *chosen):
            need[s] = need.get(s, 0) + 1
        # copies can be fixed together as long as no exhausted size changes the choice
        n = n_j if not chosen else min(h.count[s] // c for s, c in need.items())
        for s, c in need.items():
            h.take(s, n * c)
        fixed.append((n, tuple(sorted(need.items(), reverse=True))))
        at = bisect_left(h.sizes, j + 1) - 1 if h.sizes else -1
    return fixed


def h_back(h: _Histogram, size: int) -> None:
    """Put one item back."""
    if size in h.count:
        h.count[size] += 1
    else:
        h.count[size] = 1
        insort(h.sizes, size)


def best_fit(counts: Mapping[int, int], capacity: int) -> list[PackingClass]:
    """Best fit decreasing, all copies of a size at once."""
    open_: dict[int, list[PackingClass]] = {}  # space left -> containers
    spaces: list[int] = []
    done: list[PackingClass] = []

    def put(space: int, n: int, contents: tuple[tuple[int, int], ...]) -> None:
        if not n:
            return
        if not space:
            done.append((n, contents))
            return
        if space not in open_:
            open_[space] = []
            insort(spaces, space)
        open_[space].append((n, contents))

    for s in sorted(counts, reverse=True):
        m = counts[s]
        while m:
            i = bisect_left(spaces, s)
            if i < len(spaces):
                space = spaces[i]
                n, contents = open_[space].pop()
                if not open_[space]:
                    del open_[space], spaces[i]
            else:
                space, contents = capacity, ()
                n = -(-m // (capacity // s))
            each = space // s  # the fullest container stays the fullest until it is full
            full = min(n, m // each)
            put(space - each * s, full, (*contents, (s, each)))
            m -= full * each
            if full < n:
                part = m if m < each else 0
                if part:
                    put(space - part * s, 1, (*contents, (s, part)))
                    m = 0
                put(space, n - full - (1 if part else 0), contents) if contents else None
    for space in spaces:
        done += open_[space]
    return done


def plan(counts: Mapping[int, int], capacity: int) -> list[PackingClass]:
    """Classes of containers that hold exactly the items counted."""
    h = _Histogram(counts)
    fixed = reduce_dominated(h, capacity)
    return fixed + best_fit(h.count, capacity)


def pack(items: DataFrame, specs: Mapping[int, int]) -> DataFrame:
    """(container_id, id, piece_no, tokens, container) of items (id, size) for each kind of container.

    ``items`` is read three times; give it materialized. ``specs`` is kind ->
    capacity. ``container`` names a container within its kind; null for items
    without size.
    """
    spark = items.sparkSession
    specs = {k: c for k, c in specs.items() if k is not None and c is not None and c > 0}
    if not specs:
        return items.sparkSession.createDataFrame([], f"container_id int, id {dict(items.dtypes)['id']}, piece_no bigint, tokens bigint, container string")
    kinds = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.lit(c).cast("bigint").alias("c")) for k, c in specs.items()]))
    sized = items.select("id", F.coalesce(F.col("size"), F.lit(0)).cast("bigint").alias("size"), kinds.alias("s")).select("id", "size", F.col("s.k").alias("container_id"), F.col("s.c").alias("capacity"))
    whole = F.when(F.col("size") > F.col("capacity"), F.floor(F.col("size") / F.col("capacity"))).otherwise(F.lit(0)).cast("bigint")
    cut = sized.withColumn("whole", whole).withColumn("rest", F.col("size") - F.col("whole") * F.col("capacity"))

    salt = F.pmod(F.xxhash64("id"), F.lit(SALT)).cast("int")
    rests = cut.where("size > 0").withColumn("salt", salt)
    parts = rests.groupBy("container_id", "rest", "salt").agg(F.count(F.lit(1)).alias("n"))
    rows = parts.where("rest > 0").groupBy("container_id", "rest").agg(F.sum("n").alias("n")).collect()  # at most the sum of the capacities
    ranges = []
    for k, c in specs.items():
        upto: dict[int, int] = {}
        for no, (n, contents) in enumerate(plan({r["rest"]: r["n"] for r in rows if r["container_id"] == k}, c)):
            for s, each in contents:
                lo = upto.get(s, 0)
                ranges.append((k, s, lo, no, each))
                upto[s] = lo + n * each
    table = spark.createDataFrame(ranges, "container_id int, rest bigint, lo bigint, class int, each bigint")
    table = table.groupBy("container_id", "rest").agg(F.array_sort(F.collect_list(F.struct("lo", "class", "each"))).alias("ranges"))

    before = F.sum("n").over(Window.partitionBy("container_id", "rest").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1))
    offsets = parts.select("container_id", "rest", "salt", F.coalesce(before, F.lit(0)).alias("offset"))
    ranked = rests.withColumn("n", F.row_number().over(Window.partitionBy("container_id", "rest", "salt").orderBy("id")))
    ranked = ranked.join(offsets, ["container_id", "rest", "salt"]).withColumn("rank", F.col("offset") + F.col("n") - 1)
    at = F.element_at(F.filter("ranges", lambda r: r["lo"] <= F.col("rank")), -1)
    placed = ranked.join(table, ["container_id", "rest"]).withColumn("at", at)
    name = F.concat_ws("-", F.col("at.class").cast("string"), F.floor((F.col("rank") - F.col("at.lo")) / F.col("at.each")).cast("string"))
    packed = placed.select("container_id", "id", F.col("whole").alias("piece_no"), F.col("rest").alias("tokens"), name.alias("container"))

    pieces = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("whole") - 1)).alias("piece_no")
    full = ranked.where("whole > 0").select("container_id", "id", F.col("capacity").alias("tokens"), "rest", "rank", pieces)
    own = F.concat_ws("-", F.lit("full"), *[F.col(c).cast("string") for c in ("rest", "rank", "piece_no")])
    full = full.select("container_id", "id", "piece_no", "tokens", own.alias("container"))
    none = cut.where("size <= 0").select("container_id", "id", F.lit(0).cast("bigint").alias("piece_no"), F.lit(0).cast("bigint").alias("tokens"), F.lit(None).cast("string").alias("container"))
    return packed.unionByName(full).unionByName(none)
