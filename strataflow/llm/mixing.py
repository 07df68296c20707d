"""Mix sources to target weights along a curriculum that changes with time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataflow.llm.common import WORD, numbered, ranked_within, row_key, spare_name
from strataflow.session import stage

Knots = Sequence[tuple[float, float]]

#: Weight over the time of training, from 0 to 1, for the first, second and
#: third source of each run of three: fades out, stays, comes in.
FADE: Knots = ((0.0, 3.0), (0.5, 2.0), (1.0, 1.0))
LEVEL: Knots = ((0.0, 1.0), (1.0, 1.0))
RISE: Knots = ((0.0, 1.0), (0.5, 2.0), (1.0, 3.0))


def time_of(share: Column, knots: Knots) -> Column:
    """The time by which ``share`` of a source's demand has come up.

    The schedule is linear between knots, so its integral is a parabola in each
    piece; the piece is found by the integral up to its ends, and solved.
    """
    pieces, total = [], 0.0
    for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
        if t1 <= t0 or w0 < 0 or w1 < 0:
            raise ValueError("knots need rising times and weights of 0 or more")
        area = (t1 - t0) * (w0 + w1) / 2
        pieces.append((total, total + area, t0, t1, w0, w1))
        total += area
    if total <= 0:
        raise ValueError("a schedule needs some weight")
    need = share * F.lit(total)
    out = F.lit(float(knots[-1][0]))
    for begin, end, t0, t1, w0, w1 in reversed(pieces):
        slope, rest = (w1 - w0) / (t1 - t0), need - F.lit(begin)
        if slope == 0:
            at = F.lit(t0) + rest / F.lit(w0) if w0 else F.lit(t0)
        else:
            root = F.sqrt(F.greatest(F.lit(w0 * w0) + F.lit(2 * slope) * rest, F.lit(0.0)))
            at = F.lit(t0) + (root - F.lit(w0)) / F.lit(slope)
        out = F.when(need <= F.lit(end), at).otherwise(out)
    return F.least(F.greatest(out, F.lit(0.0)), F.lit(1.0))


def source_targets(
    sized: DataFrame, weights: Sequence[float], share: float, most: float
) -> DataFrame:
    """source, rank, source_size and target for each source of ``sized``.

    Each round gives what is left to the sources below their limit, by weight;
    those it puts above are held at it.  Rounds end when none is above.  Only
    sums reach the driver.
    """
    sums = sized.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    rows, ranges = numbered(sums, [F.asc_nulls_last("source")], "sources")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    first = ranges.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_first"))
    rank = F.col("_first") + F.col("_at")
    weight = F.lit(float(weights[-1]))
    for k, w in enumerate(weights[:-1]):
        weight = F.when(rank % len(weights) == k, F.lit(float(w))).otherwise(weight)
    ranked = stage(
        rows.join(first, "_part").select("source", rank.alias("rank"), "source_size", weight.alias("weight")),
        "source_ranks",
    )
    limit = F.lit(float(most)) * F.col("source_size")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level, held = 0.0, -1
    while True:
        full = F.col("weight") * F.lit(level) > limit
        n, capped, open_weight = ranked.agg(
            F.count_if(full),
            F.coalesce(F.sum(F.when(full, limit)), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)),
        ).first()
        if n == held or not open_weight:
            break
        held, level = n, (share * total - capped) / open_weight
    return ranked.select(
        "source", "rank", "source_size", F.least(limit, F.col("weight") * F.lit(level)).alias("target")
    )


def plan(
    docs: DataFrame,
    *,
    weights: Sequence[float] = (5, 2, 1),
    schedules: Sequence[Knots] = (FADE, LEVEL, RISE),
    share: float = 1.5,
    most: float = 2.0,
    keep: Sequence[str] = (),
) -> DataFrame:
    """One row per document: its key, size, source's size and target, copies and their positions.

    The sources, by code point and NULL last, weigh ``weights`` in turn and share
    ``share`` of all words; none gets more than ``most`` times its own words.
    A source is read in an order given by a hash of id and text, again and again
    until its target is met; a copy is taken if its middle lies before the
    target, so documents stay whole and each source misses its target by half a
    document at most.  ``positions`` are the times at which the curriculum asks
    for the middle of each copy, from 0 to 1.

    NULL and empty texts have size 0; they are taken once, at the place they
    stand in.  Rows that repeat an id or a whole row are separate documents.
    Extra columns are ignored, but for those of ``keep``, which are carried along
    and settle ties.  An empty table gives no rows.  A hot source is
    spread over all ranges of the sort.
    """
    spark = docs.sparkSession
    sized = stage(
        docs.select(
            "doc_id",
            "source",
            F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
            row_key(F.col("doc_id"), F.col("text")).alias("key"),
            *keep,
        ),
        "sizes",
    )
    targets = stage(source_targets(sized, weights, share, most), "targets")
    ordered = sized.join(targets, sized["source"].eqNullSafe(targets["source"])).drop(targets["source"])
    rows, _ = numbered(ordered, ["rank", "key", "doc_id", "size", *keep], "mixing_order")
    # Words before each (range, source): a range and a source can meet once per boundary.
    runs = rows.groupBy("_part", "rank").agg(F.sum("size").alias("_words"))
    earlier = Window.partitionBy("rank").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = runs.select("_part", "rank", F.coalesce(F.sum("_words").over(earlier), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_part", "rank").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    begun = (
        rows.withColumn("_in", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(starts, ["_part", "rank"])
        .withColumn("_middle", F.col("_start") + F.col("_in") + F.col("size") / F.lit(2.0))
    )
    offset = [F.col("_middle") + F.lit(float(k)) * F.col("source_size") for k in range(int(-(-most // 1)))]
    share_of = [o / F.col("target") for o in offset]

    def position(x: Column) -> Column:
        out = time_of(x, schedules[-1])
        for k, knots in enumerate(schedules[:-1]):
            out = F.when(F.col("rank") % len(schedules) == k, time_of(x, knots)).otherwise(out)
        return out

    taken = [F.when(o < F.col("target"), position(x)) for o, x in zip(offset, share_of)]
    worded = F.array_compact(F.array(*taken))
    place = F.when(F.col("target") > 0, position(F.least(share_of[0], F.lit(1.0)))).otherwise(F.lit(0.0))
    positions = F.when(F.col("size") > 0, worded).otherwise(F.array(place))
    return begun.withColumn("positions", positions).select(
        "doc_id", "key", "size", "source_size", "target",
        F.size("positions").alias("copies"),
        (F.col("size") * F.size("positions")).cast("long").alias("taken"),
        "positions",
        *keep,
    )


def mix(docs: DataFrame, **settings) -> DataFrame:
    """``docs`` as the curriculum plays them: copies in the order of their positions.

    Same columns, one row per copy, range-sorted by position, then by key.
    ``settings`` are those of :func:`plan`.  A row is known by all its columns;
    rows that repeat a whole row are numbered and take one row of the plan each,
    so none is lost, however many they are, and no task gathers them.
    """
    key, position = spare_name(docs, "_key"), spare_name(docs, "_position")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    keyed = docs.withColumn(key, row_key(*columns))
    planned = plan(keyed, keep=[key], **settings).select(F.col(key).alias("whole"), "positions")
    planned = stage(planned, "mixing_plan")
    repeated = stage(planned.groupBy("whole").count().where("count > 1").select("whole"), "mixing_repeated")
    asked = planned.where(F.size("positions") > 0)
    some = not repeated.isEmpty()
    if some:
        asked = asked.join(repeated, "whole", "left_anti")
    copies = keyed.join(asked.select(F.col("whole").alias(key), F.col("positions").alias(position)), key)
    if some:
        packed = keyed.select(F.col(key).alias("whole"), F.struct(*columns).alias("row")).join(repeated, "whole")
        rows = ranked_within(packed, ["whole"], [], "mixing_copies")
        turns = ranked_within(planned.join(repeated, "whole"), ["whole"], ["positions"], "mixing_turns")
        dealt = rows.join(turns, ["whole", "_nth"]).where(F.size("positions") > 0)
        dealt = dealt.select("row.*", F.col("whole").alias(key), F.col("positions").alias(position))
        copies = copies.unionByName(dealt)
    copies = copies.withColumn(position, F.explode(position))
    order = [position, key]
    return copies.repartitionByRange(*order).sortWithinPartitions(*order).select(columns)
