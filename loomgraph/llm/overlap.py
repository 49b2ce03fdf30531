"""Overlap sizes between many large sets: galloping intersection of delta-encoded sorted runs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomgraph.common import discard, join_counted, materialize

#: Members of the largest set that fall into one identifier range, about; so it bounds the length of a run.
RUN_LENGTH = 32_768
#: A run this many times longer than the other is searched exponentially instead of merged.
GALLOP_RATIO = 16
#: Partners of one set that are intersected in one group; a set with more is repeated for several groups.
PARTNERS = 4_096
#: A member of more sets than this is spread over several groups when candidates are sought.
SETS_OF_MEMBER = 4_096
#: Tables of up to so many (key, number) rows are broadcast, about 100 MB; larger ones are joined by a shuffle.
BROADCAST_ROWS = 1_000_000
#: Members of a set, at least and as a share, that its prefix has beyond the shortest one: a candidate must share so many of it, not just one.
LEAST_HITS, BEYOND = 6, 1 / 16
#: Parts of the members of one degree.
LEVELS = 64


def merge_count(a: np.ndarray, b: np.ndarray) -> int:
    """Shared members of two strictly increasing runs by linear merge (a stable sort joins two sorted runs in one pass)."""
    both = np.concatenate((a, b))
    both.sort(kind="stable")
    return int(np.count_nonzero(both[1:] == both[:-1]))


def gallop_count(small: np.ndarray, large: np.ndarray) -> int:
    """Shared members by exponential search: probes 1, 2, 4, ... from the start, then halving, for all of ``small`` together."""
    n = len(large)
    if not n or not len(small):
        return 0
    low = np.zeros(len(small), np.int64)
    step = 1
    ahead = large[0] < small  # the first member not below small lies beyond low
    while ahead.any():
        probe = low + step
        ahead &= (probe < n) & (large[np.minimum(probe, n - 1)] < small)
        low[ahead] = probe[ahead]
        step *= 2
    high = np.minimum(low + step, n - 1)
    while (open_ := low < high).any():
        mid = (low + high) >> 1
        below = large[mid] < small
        low = np.where(open_ & below, mid + 1, low)
        high = np.where(open_ & ~below, mid, high)
    return int(np.count_nonzero(large[low] == small))


def shared_count(a: np.ndarray, b: np.ndarray) -> int:
    if len(a) > len(b):
        a, b = b, a
    return gallop_count(a, b) if len(b) > GALLOP_RATIO * len(a) else merge_count(a, b)


def _intersect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (larger, range, part, kind): the run of the larger set (kind 0), then those of its partners (kind 1)."""
    at, run = None, None
    for b in batches:
        d = b.to_pydict() if b.num_rows == 0 else None
        if d is not None:
            continue
        larger, rng, part, kind, smaller = (b.column(i).to_pylist() for i in range(5))
        runs = b.column(5)
        ends, values = runs.offsets.to_numpy(), runs.values.to_numpy(zero_copy_only=False)
        out: tuple[list, list, list] = ([], [], [])
        for i, key in enumerate(zip(larger, rng, part, strict=True)):
            members = np.cumsum(values[ends[i] : ends[i + 1]])
            if kind[i] == 0:
                at, run = key, members
            elif key == at and (n := shared_count(members, run)):
                for column, x in zip(out, (smaller[i], key[0], n), strict=True):
                    column.append(x)
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], names=["smaller", "larger", "n"])


def _small(df: DataFrame) -> DataFrame:
    """A written table, marked for broadcasting if its rows are few."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def overlaps(members: DataFrame, min_size: int = 50, min_share: float = 0.5) -> DataFrame:
    """set_a, set_b, n_a, n_b, n_shared of each pair of sets that have at least min_size members each and whose shared
    members are at least min_share (above 0) of the smaller set. set_a comes first by code point.

    members: set_id STRING, member STRING. Null sets and members don't count, repeats count once, other columns are
    ignored. An empty table gives no rows. Sets and members are compared by 64-bit hashes (a billion of them: 3 % chance of one
    collision, which would shift a count by one).

    1. Sets below min_size go, those with fewer rows before anything is shuffled; so do members of a single set, shared with none.
    2. Which pairs to intersect follows from a prefix bound that misses nothing: of a set of n members, of which the pair must share
       s = ceil(min_share * n), take any p as its prefix; the partner holds at least p + s - n of these. The prefix is made of
       the members that lie in the fewest sets, so those of many sets, which would make many pairs, are in few prefixes. It has n - s
       members and BEYOND of the set more: fewer would find less, more would list more of each intersection than needed.
    3. The members of each set are sorted, delta-encoded runs, one per identifier range. For each pair and range the two runs
       are merged or, where their lengths differ much, searched exponentially; the counts are summed over the ranges.
    """
    rows = members.select("set_id", F.xxhash64("set_id").alias("s"), F.xxhash64("member").alias("m")).filter("set_id IS NOT NULL AND member IS NOT NULL")
    names = materialize(rows.groupBy("s", "set_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_size).select("s", "set_id"), "set-names")
    pairs = materialize(rows.join(_small(names).select("s"), "s", "left_semi").select("s", "m").distinct(), "memberships")
    sizes = materialize(pairs.groupBy("s").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_size), "sizes")
    large = pairs.join(_small(sizes), "s")
    degree = materialize(large.groupBy("m").agg(F.count(F.lit(1)).cast("int").alias("degree")).filter("degree > 1"), "degrees")
    kept = materialize(join_counted(large, degree, ["m"], "degree").select("s", "n", "m", "degree"), "audience")
    discard(pairs)

    need = F.ceil(F.lit(min_share) * F.col("n"))  # what a pair must share
    # rarest first; members of one degree in LEVELS parts by hash, so that a prefix ends within a degree
    level = F.col("degree") * F.lit(LEVELS).cast("bigint") + F.pmod(F.xxhash64("m", "s"), F.lit(LEVELS))
    by_level = kept.groupBy("s", "n", level.alias("level")).agg(F.count(F.lit(1)).alias("c"))
    so_far = F.sum("c").over(Window.partitionBy("s").orderBy("level"))
    in_all = F.sum("c").over(Window.partitionBy("s"))
    steps = by_level.select("s", "n", "level", (F.col("n") - in_all + so_far).alias("p"))
    wanted = F.least(F.col("n"), F.col("n") - need + F.greatest(F.lit(LEAST_HITS), F.ceil(F.col("n") * F.lit(BEYOND))))
    prefix = steps.filter(F.col("p") >= wanted).groupBy("s").agg(F.min("level").alias("cut"), F.min(F.col("p") + need - F.col("n")).alias("least"))
    prefix = materialize(prefix, "prefixes")
    salts = F.ceil(F.col("degree") / SETS_OF_MEMBER).cast("int")
    small = kept.join(_small(prefix), "s").filter(level <= F.col("cut")).select(
        F.col("s").alias("smaller"), F.col("n").alias("n_small"), "m", "least", F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt")
    )
    other = kept.select(F.col("s").alias("larger"), F.col("n").alias("n_large"), "m", F.pmod(F.xxhash64("s"), salts).cast("int").alias("salt"))
    bigger = "n_large > n_small OR (n_large = n_small AND larger > smaller)"
    candidates = materialize(
        small.join(other, ["m", "salt"]).filter(bigger).groupBy("smaller", "larger", "n_small", "n_large", "least")
        .agg(F.count(F.lit(1)).alias("hits")).filter("hits >= least").drop("hits", "least"),
        "candidates",
    )

    # identifier ranges: the high bits of the hash
    top = sizes.agg(F.max("n").alias("n")).first().n or 0
    bits = max(0, int(np.ceil(np.log2(max(1, top) / RUN_LENGTH)))) if top else 0
    rng = F.shiftrightunsigned(F.col("m"), 64 - bits).cast("bigint") if bits else F.lit(0).cast("bigint")
    in_pairs = candidates.select(F.explode(F.array("smaller", "larger")).alias("s")).distinct()
    deltas = lambda a: F.transform(a, lambda x, i: F.when(i == 0, x).otherwise(x - F.get(a, i - 1)))
    runs = (
        kept.join(in_pairs, "s", "left_semi").groupBy("s", rng.alias("rng")).agg(F.sort_array(F.collect_list("m")).alias("ms"))
        .select("s", "rng", deltas(F.col("ms")).alias("run"))
    )
    parts = candidates.groupBy("larger").agg(F.ceil(F.count(F.lit(1)) / PARTNERS).cast("int").alias("parts"))
    partners = (
        candidates.select("smaller", "larger").join(parts, "larger")
        .join(runs, F.col("s") == F.col("smaller"))
        .select("larger", "rng", F.pmod(F.xxhash64("smaller"), F.col("parts")).cast("int").alias("part"), F.lit(1).alias("kind"), "smaller", "run")
    )
    whole = parts.join(runs, F.col("s") == F.col("larger")).select(
        "larger", "rng", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("kind"), F.lit(None).cast("bigint").alias("smaller"), "run"
    )
    counted = (
        whole.unionByName(partners).repartition("larger", "rng", "part").sortWithinPartitions("larger", "rng", "part", "kind")
        .mapInArrow(_intersect, "smaller bigint, larger bigint, n bigint")
        .groupBy("smaller", "larger").agg(F.sum("n").alias("n_shared"))
    )
    found = counted.join(candidates, ["smaller", "larger"]).filter(F.col("n_shared") >= F.ceil(F.lit(min_share) * F.col("n_small")))
    called = lambda c: names.select(F.col("s").alias(c), F.col("set_id").alias(f"{c}_id"))
    first = F.col("smaller_id") < F.col("larger_id")
    return (
        found.join(called("smaller"), "smaller").join(called("larger"), "larger")
        .select(
            F.least("smaller_id", "larger_id").alias("set_a"), F.greatest("smaller_id", "larger_id").alias("set_b"),
            F.when(first, F.col("n_small")).otherwise(F.col("n_large")).alias("n_a"),
            F.when(first, F.col("n_large")).otherwise(F.col("n_small")).alias("n_b"), "n_shared",
        )
    )
