"""Hard negatives by shared lists: anchors in clusters, one sorted candidate list for each cluster.

No anchor of a cluster is further from the cluster's direction than its widest
anchor, so that a candidate's length and its angle to that direction bound its
inner product with every anchor there. Candidates are sorted by this bound once
for each cluster. All anchors of the cluster walk the same list, in blocks of
growing size; an anchor ends where the bound of what follows is below the last
of its best so far. So results are exact, whatever the clusters are.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearbook.llm import exact
from clearbook.llm.tables import ship_package
from clearbook.sources.sinks import staged

# Relative room for rounding in the bounds, which are doubles.
SLACK = 1e-7
FOUND = "anchor long, band int, score long, id long"


def _unit(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Directions and lengths; a vector of zeros has no direction."""
    values = rows.astype(np.float64)
    lengths = np.sqrt((values * values).sum(axis=1))
    return values / np.where(lengths, lengths, 1.0)[:, None], lengths


def cluster_directions(rows: np.ndarray, clusters: int, rounds: int = 10) -> np.ndarray:
    """Directions of some clusters of rows; which they are matters for speed alone."""
    units, lengths = _unit(rows)
    units = units[lengths > 0]
    if not len(units):
        return np.zeros((1, rows.shape[1]))
    chosen = [0]
    for _ in range(min(clusters, len(units)) - 1):
        chosen.append(int((units @ units[chosen].T).max(axis=1).argmin()))
    directions = units[chosen]
    for _ in range(rounds):
        nearest = (units @ directions.T).argmax(axis=1)
        for k in range(len(directions)):
            if (nearest == k).any():
                total = units[nearest == k].sum(axis=0)
                directions[k] = total / (np.linalg.norm(total) or 1.0)
    return directions


def _assigned(anchors: DataFrame, directions: np.ndarray, width: int) -> DataFrame:
    """Add each anchor's ``cluster``, ``norm`` and ``angle`` to the cluster's direction."""
    schema = exact.extended(anchors.schema, "cluster int, norm double, angle double")

    def assign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units, lengths = _unit(exact.rows_of(batch["ints"], width))
            cosines = units @ directions.T
            cluster = cosines.argmax(axis=1)
            angle = np.where(lengths > 0, np.arccos(np.clip(cosines[np.arange(len(units)), cluster], -1, 1)), 0.0)
            more = [pa.array(cluster, pa.int32()), pa.array(lengths), pa.array(angle)]
            yield pa.record_batch([*batch.columns, *more], schema=pa.schema([*batch.schema, ("cluster", pa.int32()), ("norm", pa.float64()), ("angle", pa.float64())]))

    return anchors.mapInArrow(assign, schema)


def _lists(rows: DataFrame, directions: np.ndarray, widest: dict[int, float], width: int) -> DataFrame:
    """Every candidate once in the list of each cluster, with its ``bound`` for an anchor of length one."""
    schema = exact.extended(rows.schema, "cluster int, bound double")

    def bounds(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units, lengths = _unit(exact.rows_of(batch["ints"], width))
            angles = np.arccos(np.clip(units @ directions.T, -1, 1))
            for cluster, angle in widest.items():
                bound = lengths * (np.cos(np.maximum(0.0, angles[:, cluster] - angle)) + SLACK)
                more = [pa.array(np.full(len(bound), cluster), pa.int32()), pa.array(bound)]
                yield pa.record_batch([*batch.columns, *more], schema=pa.schema([*batch.schema, ("cluster", pa.int32()), ("bound", pa.float64())]))

    order = ["cluster", F.desc("bound"), "id"]
    return rows.mapInArrow(bounds, schema).repartitionByRange(*order).sortWithinPartitions(*order)


def _best(row: np.ndarray, score: np.ndarray, ids: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first ``most`` of each row: higher scores first, then smaller ids."""
    order = np.lexsort((ids, -score, row))
    row, score, ids = row[order], score[order], ids[order]
    starts = np.searchsorted(row, row, side="left")
    kept = np.arange(len(row)) - starts < most
    return row[kept], score[kept], ids[kept]


def _walker(width: int, wanted: int, same_label: bool, chunk: int = 1024):
    """A function that walks one slice of a list with one group of anchors."""

    def walk(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        schema = pa.schema([("anchor", pa.int64()), ("band", pa.int32()), ("score", pa.int64()), ("id", pa.int64())])
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        keys, own, label = (left[name].to_numpy() for name in ("anchor", "anchor_id", "label_key"))
        norm, rows = left["norm"].to_numpy(), exact.rows_of(left["ints"], width)
        # Bands of one anchor have numbers from 1 on; a place without a band is empty for good.
        bands = left["bands"].to_pylist()
        most = max(len(b) for b in bands)
        low = np.ones((len(bands), most), dtype=np.int64)
        high, bar = np.zeros_like(low), np.zeros_like(low)
        number = np.zeros_like(low)
        for k, listed in enumerate(bands):
            for j, band in enumerate(listed):
                number[k, j], low[k, j], high[k, j], bar[k, j] = band["band"], band["low"], band["high"], band["bar"]
        bound = right["bound"].to_numpy()
        order = np.argsort(-bound, kind="stable")
        bound = bound[order]
        ids, labels = right["id"].to_numpy()[order], right["label_key"].to_numpy()[order]
        values = exact.rows_of(right["ints"], width)[order]
        kept = [(np.zeros(0, dtype=np.int64),) * 3 for _ in range(most)]
        for at in range(0, len(ids), chunk):
            lowest = np.where(low <= high, np.maximum(low, bar).astype(np.float64), np.inf).min(axis=1)
            active = np.flatnonzero(norm * bound[at] >= lowest)
            if not len(active):
                break
            part = slice(at, at + chunk)
            scores = exact.products(rows[active], values[part])
            alike = label[active, None] == labels[None, part]
            fits = (alike if same_label else ~alike) & (own[active, None] != ids[None, part])
            for j in range(most):
                least = np.maximum(low, bar)[active, j, None]
                row, col = np.nonzero(fits & (scores >= least) & (scores <= high[active, j, None]))
                if not len(row):
                    continue
                new = (active[row], scores[row, col], ids[part][col])
                kept[j] = _best(*(np.concatenate(pair) for pair in zip(kept[j], new, strict=True)), wanted)
                full, count = np.unique(kept[j][0], return_counts=True)
                last = np.searchsorted(kept[j][0], full, side="right") - 1
                full, last = full[count == wanted], last[count == wanted]
                bar[full, j] = np.maximum(bar[full, j], kept[j][1][last])
        columns = [[], [], [], []]
        for j, (row, score, found) in enumerate(kept):
            for column, values_of in zip(columns, (keys[row], number[row, j], score, found), strict=True):
                column.append(values_of)
        return pa.table([pa.array(np.concatenate(c), f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return walk


def _walked(anchors: DataFrame, bands: DataFrame, lists: DataFrame, blocks: list[dict], wanted: int, same_label: bool, width: int, group: int) -> DataFrame:
    """``anchor``, ``band`` and ``best``, the first ``wanted`` of each band (``low`` to ``high``) in order.

    Between blocks the best so far are a written table. A task takes one slice of
    a block and one group of the anchors that still walk, so neither a cluster
    nor a bound that many candidates share is ever in one task.
    """
    best = None
    for block in blocks:
        if best is None:
            barred = bands.withColumn("bar", F.col("low"))
        else:
            last = F.when(F.size("best") == wanted, -F.element_at("best", -1)["minus"])
            barred = bands.join(best.select("anchor", "band", last.alias("last")), ["anchor", "band"], "left").select(
                "anchor", "band", "low", "high", F.greatest("low", F.coalesce("last", "low")).alias("bar")
            )
        open_bands = barred.where(F.col("low") <= F.col("high")).groupBy("anchor").agg(
            F.sort_array(F.collect_list(F.struct("band", "low", "high", "bar"))).alias("bands"), F.min("bar").alias("lowest")
        )
        ahead = F.get(F.array(*[F.lit(x) for x in block["above"]]), "cluster")
        walking = anchors.join(open_bands, "anchor").where(F.col("norm") * ahead >= F.col("lowest"))
        walking = staged(walking, "walking")
        groups = dict.fromkeys(range(len(block["above"])), 0)
        groups |= {c: -(-n // group) for c, n in walking.groupBy("cluster").count().collect()}
        if not any(groups.values()):
            break
        n_groups = F.get(F.array(*[F.lit(groups[c]) for c in sorted(groups)]), "cluster")
        n_slices = F.get(F.array(*[F.lit(n) for n in block["slices"]]), "cluster")

        def up_to(count):
            return F.explode(F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>")))

        members = walking.withColumn("part", F.pmod(F.xxhash64("anchor"), n_groups).cast("int")).withColumn("slice", up_to(n_slices))
        above = F.get(F.array(*[F.lit(x) for x in block["above"]]), "cluster")
        below = F.get(F.array(*[F.lit(x) for x in block["below"]]), "cluster")
        listed = lists.where((F.col("bound") <= above) & (F.col("bound") > below))
        listed = listed.withColumn("slice", F.pmod(F.monotonically_increasing_id(), n_slices).cast("int")).withColumn("part", up_to(n_groups))
        place = ["cluster", "part", "slice"]
        found = members.groupBy(*place).cogroup(listed.groupBy(*place)).applyInArrow(_walker(width, wanted, same_label), FOUND)
        if best is not None:
            found = found.unionByName(best.select("anchor", "band", F.explode("best").alias("one")).select("anchor", "band", (-F.col("one.minus")).alias("score"), "one.id"))
        ordered = F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("minus"), "id")))
        best = staged(found.groupBy("anchor", "band").agg(F.slice(ordered, 1, wanted).alias("best")), "best")
    return best


def _blocks(lists: DataFrame, clusters: int, total: int, first: int, growth: int, per_slice: int) -> list[dict]:
    """Where the blocks of each list begin and end, by bound, and how many slices each has.

    The counts and limits of at most ``clusters`` lists come to the driver.
    """
    places, size = [], first
    while size < total:
        places.append(size)
        size = size * (growth + 1)
    shares = [1 - place / total for place in places]
    limits = {c: [None] * len(shares) for c in range(clusters)}
    if shares:
        cuts = lists.groupBy("cluster").agg(F.percentile_approx("bound", shares, 100_000).alias("cuts"))
        limits |= {c: list(cut) for c, cut in cuts.collect()}
    blocks = []
    for k in range(len(shares) + 1):
        above = [limits[c][k - 1] if k and limits[c][k - 1] is not None else float("inf") for c in range(clusters)]
        below = [limits[c][k] if k < len(shares) and limits[c][k] is not None else float("-inf") for c in range(clusters)]
        blocks.append({"above": above, "below": below})
    edges = F.array(*[F.get(F.array(*[F.lit(x) for x in b["below"]]), "cluster") for b in blocks])
    counted = lists.groupBy("cluster", F.size(F.filter(edges, lambda e: F.col("bound") <= e)).alias("block")).count()
    counts = {(row["cluster"], row["block"]): row["count"] for row in counted.collect()}
    for k, block in enumerate(blocks):
        block["slices"] = [-(-counts.get((c, k), 0) // per_slice) for c in range(clusters)]
    return blocks


def mine(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    scale: int = 256,
    one_in: int = 100,
    positives: int = 5,
    wanted: int = 10,
    low_percent: int = 30,
    high_percent: int = 90,
    clusters: int = 8,
    sample: int = 4096,
    first: int = 1024,
    growth: int = 7,
    per_slice: int = 8192,
    group: int = 512,
) -> DataFrame:
    """For each anchor (id divisible by ``one_in``) and each of its positives, the hardest negatives.

    Positives are the other rows of the anchor's label with the highest integer
    inner products, negatives rows of another label whose product is between
    ``low_percent`` and ``high_percent`` of the positive's; ties go to smaller ids.

    Rows whose id, label or vector is null, or whose vector holds null or
    non-finite components, take no part. Shorter vectors count as filled up with
    zeros; a vector of zeros scores 0 with all. Scaled components beyond ``2 ** 25``
    (64 components; less for more) stay there, so that no product leaves 64 bits.
    A row never meets one of its own id. Repeated rows are candidates
    each; equal repeated anchors are one, different rows of one id are anchors
    each. An anchor without positives, or a positive without negatives in its
    range, has no row; an empty table gives none.

    ``sample`` anchors at most, by hash, decide the directions of the clusters,
    which matter for speed alone. A slice (``per_slice`` candidates) and a group
    (about ``group`` anchors) bound a task's memory.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    named = vectors.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(F.col(label_col).cast("string")).alias("label_key"), F.col(label_col).alias("_label"), F.col(vector_col).alias("_vector"))
    usable = exact.without_gaps(named.where(F.col("id").isNotNull() & F.col("_label").isNotNull()), "_vector")
    width = exact.longest(usable, "_vector")
    # Room for a product times 100.
    most = exact.saturation(width, spare_bits=8)
    rows = staged(usable.select("id", "label_key", exact.floored(F.col("_vector"), scale, most).cast("array<int>").alias("ints")), "integers")
    total = rows.count()

    chosen = rows.where(F.col("id") % one_in == 0).withColumnRenamed("id", "anchor_id").distinct()
    key = F.xxhash64("anchor_id", "label_key", "ints").alias("anchor")
    seeds = chosen.orderBy(F.xxhash64("anchor_id"), "anchor_id", "label_key", "ints").limit(sample).select("ints").collect()
    start = np.zeros((len(seeds), width), dtype=np.int64)
    for k, (ints,) in enumerate(seeds):
        start[k, : len(ints)] = ints
    directions = cluster_directions(start, clusters)
    anchors = staged(_assigned(chosen.select(key, "anchor_id", "label_key", "ints"), directions, width), "anchors")
    widest = {c: angle for c, angle in anchors.groupBy("cluster").agg(F.max("angle")).collect()}
    anchors = anchors.drop("angle")
    lists = staged(_lists(rows, directions, widest, width), "lists")
    blocks = _blocks(lists, len(directions), total, first, growth, per_slice)

    far = 1 << 62
    whole = anchors.select("anchor", F.lit(1).alias("band"), F.lit(-far).alias("low"), F.lit(far).alias("high"))
    near = _walked(anchors, whole, lists, blocks, positives, True, width, group)
    result = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if near is None:
        return spark.createDataFrame([], result)
    place = F.posexplode("best").alias("at", "one")
    found = near.select("anchor", place).select(
        "anchor", (F.col("at") + 1).alias("band"), F.col("one.id").alias("positive_id"), (-F.col("one.minus")).alias("positive_score")
    )
    def floor_percent(percent: int) -> Column:
        scaled = f"positive_score * {percent}L"
        return F.expr(f"({scaled} - pmod({scaled}, 100L)) div 100L")

    found = staged(found.withColumns({"low": -floor_percent(-low_percent), "high": floor_percent(high_percent)}), "positives")
    hard = _walked(anchors, found.select("anchor", "band", "low", "high"), lists, blocks, wanted, False, width, group)
    if hard is None:
        return spark.createDataFrame([], result)
    ranked = hard.select("anchor", "band", F.posexplode("best").alias("at", "one"))
    named_anchors = anchors.select("anchor", "anchor_id")
    return ranked.join(found, ["anchor", "band"]).join(named_anchors, "anchor").select(
        "anchor_id",
        "positive_id",
        (F.col("at") + 1).alias("rank"),
        F.col("one.id").alias("negative_id"),
        "positive_score",
        (-F.col("one.minus")).alias("negative_score"),
    )
