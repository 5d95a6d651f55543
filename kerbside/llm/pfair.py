"""Operator 5: mixing sources to target weights with Pfair scheduling.

A source's documents, in a shuffled order, are a stream of blocks of ``BLOCK`` documents.  Block k of a source
of weight w is released at slot floor(k / w) and due at slot ceil((k + 1) / w); one block runs a slot, the
one that is due first among those released.  Weights are fractions of ``PARTS``, so the schedule repeats every
``PARTS`` slots: only one period is scheduled, on a list as long as that, and every document then computes its own
positions.  After any number of slots each source has had its weighted share to within less than one block.

Sources that run out before the largest one has been read once start over (``mix_epoch`` counts), so every
document is in the mix and the mix keeps the target weights to its end.
"""

from __future__ import annotations

import heapq
import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

BLOCK = 16
PARTS = 1000
ALPHA = 0.7
_BUCKET_ROWS = 5_000
_MOST_BUCKETS = 65_536


def weight_parts(weights: list[float], parts: int) -> list[int]:
    """Whole parts in proportion to the weights, one at least, that add up to ``parts`` (largest remainders)."""
    spare = parts - len(weights)
    exact = [w / sum(weights) * spare for w in weights]
    whole = [math.floor(x) for x in exact]
    by_rest = sorted(range(len(weights)), key=lambda i: (whole[i] - exact[i], i))
    for i in by_rest[: spare - sum(whole)]:
        whole[i] += 1
    return [x + 1 for x in whole]


def one_period(parts: list[int]) -> list[list[int]]:
    """Slots of each source's blocks in one period of ``sum(parts)`` slots, earliest deadline first."""
    total = sum(parts)
    release = lambda s, k: k * total // parts[s]
    due = lambda s, k: -(-(k + 1) * total // parts[s])
    slots: list[list[int]] = [[] for _ in parts]
    waiting = [(0, s) for s in range(len(parts))]
    heapq.heapify(waiting)
    ready: list[tuple[int, int]] = []
    for t in range(total):
        while waiting and waiting[0][0] <= t:
            s = heapq.heappop(waiting)[1]
            heapq.heappush(ready, (due(s, len(slots[s])), s))
        deadline, s = heapq.heappop(ready)
        if t >= deadline:
            raise AssertionError("a block missed its deadline")
        slots[s].append(t)
        if len(slots[s]) < parts[s]:
            heapq.heappush(waiting, (release(s, len(slots[s])), s))
    return slots


def pfair_mix(documents: DataFrame, weights: dict[str | None, float] | None = None, block: int = BLOCK, parts: int = PARTS, alpha: float = ALPHA) -> DataFrame:
    """``documents`` with ``mix_position`` (from 0, without gaps) and ``mix_epoch`` (0: first time the document is read).

    ``weights`` by source; without them a source of n documents weighs n ** ``alpha``.  A source that is not in ``weights``
    raises, as does a weight that is not positive.  A null source is a source.  The order within a source is by a hash of doc_id and text;
    repeated rows each have a place of their own.  Input columns named like the new ones are replaced.
    The driver holds one row a source and one period of the schedule.
    """
    spark = documents.sparkSession
    columns = [c for c in documents.columns if c not in ("mix_position", "mix_epoch")]
    docs = documents.select(columns)
    counts = [(r["source"], r["count"]) for r in docs.groupBy("source").count().collect()]
    counts.sort(key=lambda x: (x[0] is None, x[0]))
    if weights is not None and (lost := [s for s, _ in counts if not weights.get(s, 0) > 0]):
        raise ValueError(f"no positive weight for sources {lost}")
    own = [weights[s] if weights is not None else n**alpha for s, n in counts]
    shares = weight_parts(own, max(parts, 4 * len(counts))) if counts else []
    period = sum(shares)
    slots = one_period(shares)
    slot_of = lambda i, k: k // shares[i] * period + slots[i][k % shares[i]]
    end = max((slot_of(i, (n - 1) // block) + 1 for i, (_, n) in enumerate(counts)), default=0)
    table = []
    for i, (source, n) in enumerate(counts):
        blocks = end // period * shares[i] + sum(t < end % period for t in slots[i])
        table.append((source, n, shares[i], slots[i], -(-blocks * block // n), min(_MOST_BUCKETS, -(-n // _BUCKET_ROWS))))
    plan = spark.createDataFrame(
        table,
        T.StructType([
            T.StructField("_mix_of", T.StringType()), T.StructField("_mix_n", T.LongType()), T.StructField("_mix_parts", T.LongType()),
            T.StructField("_mix_slots", T.ArrayType(T.IntegerType())), T.StructField("_mix_times", T.LongType()), T.StructField("_mix_buckets", T.LongType()),
        ]),
    )  # one row a source
    marked = (
        docs.withColumn("_mix_hash", F.xxhash64("doc_id", "text"))
        .join(F.broadcast(plan.select("_mix_of", "_mix_buckets")), F.col("source").eqNullSafe(F.col("_mix_of")))
        .withColumn("_mix_bucket", F.expr("pmod(_mix_hash, _mix_buckets)"))
        .withColumn("_mix_source", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")))
    )
    sizes = marked.groupBy("_mix_source", "_mix_bucket").agg(F.count("*").alias("_mix_size"))
    before = Window.partitionBy("_mix_source").orderBy("_mix_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_mix_source", "_mix_bucket", F.coalesce(F.sum("_mix_size").over(before), F.lit(0)).alias("_mix_before"))
    inside = Window.partitionBy("_mix_source", "_mix_bucket").orderBy("_mix_hash", "doc_id")
    ranked = (
        marked.withColumn("_mix_inside", F.row_number().over(inside) - 1)
        .join(offsets, ["_mix_source", "_mix_bucket"])
        .select(*[F.col(c) for c in columns], (F.col("_mix_before") + F.col("_mix_inside")).alias("_mix_rank"))
    )
    placed = (
        ranked.join(F.broadcast(plan), F.col("source").eqNullSafe(F.col("_mix_of")))
        .withColumn("mix_epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_mix_times") - 1)))
        .withColumn("_mix_place", F.col("_mix_rank") + F.col("mix_epoch") * F.col("_mix_n"))
        .withColumn("_mix_block", F.expr(f"_mix_place div {block}"))
        .withColumn("_mix_slot", F.expr(f"_mix_block div _mix_parts * {period} + _mix_slots[cast(_mix_block % _mix_parts as int)]"))
        .filter(F.col("_mix_slot") < end)
        .withColumn("mix_position", F.expr(f"_mix_slot * {block} + _mix_place % {block}"))
    )
    return placed.select(*columns, "mix_position", "mix_epoch")
