"""Mixing of overlapping sources: documents by membership pattern, a min-cost flow, then seeded whole documents."""

from __future__ import annotations

from collections import deque
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterflow.llm.common import WORD, running_totals, stored

#: Weights by a source's place in code point order, repeating.
WEIGHTS = (5, 2, 1)
SHARE = Fraction(3, 2)
MAX_REPEATS = 2


def words_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets_of(sizes: dict[str | None, int], weights=WEIGHTS, share=SHARE, most=MAX_REPEATS) -> dict[str | None, Fraction]:
    """Words to take per source: shares by weight, none above ``most`` times its size, the excess shared again."""
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[n % len(weights)] for n, s in enumerate(order)}
    left, open_, targets = Fraction(sum(sizes.values())) * share, set(order), {}
    while open_:
        per = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if per * weight[s] > most * sizes[s]}
        for s in full or open_:
            targets[s] = Fraction(most * sizes[s]) if full else per * weight[s]
        left -= sum(targets[s] for s in full)
        open_ = open_ - full if full else set()
    return targets


def route(patterns: list[tuple[frozenset, int]], quotas: dict[object, int], repeats: int = MAX_REPEATS) -> list[dict]:
    """Words that each pattern gives to each of its sources: a min-cost flow by successive shortest paths.

    Every pattern can be used ``repeats`` times; the n-th use costs n a word, which keeps the costs convex: all
    patterns of a source are used once before any is used again. The graph has one node per pattern and source.
    """
    names = list(quotas)
    node = {s: 1 + len(patterns) + n for n, s in enumerate(names)}
    sink = 1 + len(patterns) + len(names)
    arcs: list[list[int]] = []  # from, to, room, cost; the arc at an odd place undoes the one before it
    out: list[list[int]] = [[] for _ in range(sink + 1)]

    def connect(a: int, b: int, room: int, cost: int) -> int:
        for x, y, r, c in ((a, b, room, cost), (b, a, 0, -cost)):
            out[x].append(len(arcs))
            arcs.append([x, y, r, c])
        return len(arcs) - 2

    gives = []
    for p, (sources, size) in enumerate(patterns, 1):
        for use in range(repeats):
            connect(0, p, size, use + 1)
        gives.append({s: connect(p, node[s], repeats * size, 0) for s in sorted(sources, key=str) if s in node})
    for s in names:
        connect(node[s], sink, quotas[s], 0)
    while True:
        cost, came, waiting, queued = {0: 0}, {}, deque([0]), {0}
        while waiting:
            at = waiting.popleft()
            queued.discard(at)
            for a in out[at]:
                _, to, room, price = arcs[a]
                if room > 0 and cost[at] + price < cost.get(to, 1 << 62):
                    cost[to], came[to] = cost[at] + price, a
                    if to not in queued:
                        waiting.append(to)
                        queued.add(to)
        if sink not in cost:
            return [{s: arcs[a + 1][2] for s, a in given.items()} for given in gives]
        path, at = [], sink
        while at:
            path.append(came[at])
            at = arcs[came[at]][0]
        room = min(arcs[a][2] for a in path)
        for a in path:
            arcs[a][2] -= room
            arcs[a ^ 1][2] += room


def plan(frame: DataFrame, members: Column, id_col: str = "doc_id", text_col: str = "text", seed: int = 0,
         weights=WEIGHTS, share=SHARE, most: int = MAX_REPEATS) -> DataFrame:
    """Per document: id, ``members`` (its sources), ``size`` in words, ``copies`` and ``taken`` words.

    ``members`` is an array of the sources a document belongs to (a null element is a source of its own, which comes
    last). Documents of one membership pattern are interchangeable to the flow, which sees one row per pattern: the
    driver holds as many rows as there are patterns, never documents. A pattern's words are taken in the seeded order
    of its documents: whole rounds first, then documents as long as they fit, then the one untaken document that brings
    the sum nearest to the flow. The order comes from a hash of seed, id and text, so reruns agree; equal rows share
    their place. Null or empty texts have no words and are taken 0. An empty table gives no rows.
    """
    rows = stored(
        frame.select(
            F.col(f"`{id_col}`").alias("id"), F.array_sort(F.array_distinct(members)).alias("members"),
            words_of(F.col(f"`{text_col}`")).alias("size"),
            F.xxhash64(F.lit(seed), F.col(f"`{id_col}`"), F.col(f"`{text_col}`")).alias("luck"),
        ).withColumn("pattern", F.to_json(F.struct("members"), {"ignoreNullFields": "false"})),
        "mix",
    )
    found = rows.groupBy("pattern").agg(F.first("members").alias("members"), F.sum("size").alias("words")).collect()
    found.sort(key=lambda r: r["pattern"])
    sizes: dict[str | None, int] = {}
    for row in found:
        for source in row["members"]:
            sizes[source] = sizes.get(source, 0) + row["words"]
    targets = targets_of(sizes, weights, share, most)
    flows = route([(frozenset(r["members"]), r["words"]) for r in found], {s: round(t) for s, t in targets.items()}, most)
    spark = frame.sparkSession
    routed = spark.createDataFrame(
        [(r["pattern"], r["words"], sum(f.values())) for r, f in zip(found, flows)],
        "of_pattern string, words long, flow long",
    ).select(
        "*", F.expr("if(words > 0, flow div words, 0)").alias("rounds"),
        F.expr("if(words > 0, flow % words, 0)").alias("rest"),
    )
    placed = running_totals(rows, ["pattern"], ["luck", "id", "size"], "size").join(
        routed, F.col("pattern") == F.col("of_pattern")
    )
    first = stored(placed.withColumn("more", (F.col("size") > 0) & (F.col("before") + F.col("size") <= F.col("rest"))), "mix")
    gaps = first.groupBy("pattern").agg(
        (F.first("rest") - F.sum(F.expr("if(more, size, 0)"))).alias("gap")
    ).select(F.col("pattern").alias("gap_pattern"), "gap")
    last = (
        first.filter("not more and size > 0").join(gaps, F.col("pattern") == F.col("gap_pattern"))
        .filter(F.abs(F.col("gap") - F.col("size")) < F.col("gap"))
        .groupBy("pattern").agg(F.min(F.struct(F.abs(F.col("gap") - F.col("size")).alias("off"), "luck", "id", "size", "place")).alias("pick"))
        .select(F.col("pattern").alias("pick_pattern"), F.col("pick.place").alias("pick_place"))
    )
    picked = F.col("more") | F.col("pick_place").isNotNull()
    copies = F.col("rounds") + F.when(picked, 1).otherwise(0)
    return first.join(
        last, (F.col("pattern") == F.col("pick_pattern")) & (F.col("place") == F.col("pick_place")), "left"
    ).select(
        F.col("id").alias(id_col), "members", "size", "luck", copies.cast("int").alias("copies"),
        (F.col("size") * copies).alias("taken"),
    )


def source_table(plans: DataFrame) -> DataFrame:
    """(of_source, source_size, target) per source, for a plan of documents that belong to one source each."""
    source = F.element_at("members", 1).alias("source")
    sizes = {r["source"]: r["words"] for r in plans.groupBy(source).agg(F.sum("size").alias("words")).collect()}
    return plans.sparkSession.createDataFrame(
        [(s, sizes[s], float(t)) for s, t in targets_of(sizes).items()], "of_source string, source_size long, target double"
    )


def mix(frame: DataFrame, source_col: str = "source", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The mixed documents: the columns of ``frame``, a row per copy taken; documents not taken are left out.

    A document is matched to its decision by the same seeded hash of id and text that ordered it. Rows that agree in
    both and in their source are taken as often as all of them together: each as often as the others, and what is left
    over by a digest of all columns, so that reruns agree. Null sources are a source; an empty table gives no rows.
    """
    plans = plan(frame, F.array(F.col(f"`{source_col}`").cast("string")), id_col, text_col)
    per = plans.groupBy(F.col("luck").alias("of_luck"), F.element_at("members", 1).alias("of_source")).agg(
        F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("rows")).filter("copies > 0")
    rows = frame.select(
        F.struct(*[F.col(f"`{c}`") for c in frame.columns]).alias("row"),
        F.col(f"`{source_col}`").cast("string").alias("its_source"),
        F.xxhash64(F.lit(0), F.col(f"`{id_col}`"), F.col(f"`{text_col}`")).alias("luck"),
    )
    one = rows.join(per, (F.col("luck") == F.col("of_luck")) & F.col("its_source").eqNullSafe(F.col("of_source")))
    alone = one.filter("rows = 1").select("row", F.col("copies").cast("long").alias("copies"))
    # Identical rows are one row with their number before anything is ordered.
    joint = one.filter("rows > 1").withColumn("whole", F.sha2(F.to_json("row").cast("binary"), 256))
    joint = joint.groupBy("luck", "its_source", "whole").agg(
        F.first("row").alias("row"), F.count(F.lit(1)).alias("same"), F.first("rows").alias("rows"), F.first("copies").alias("copies"))
    before = F.expr("coalesce(sum(same) OVER (PARTITION BY luck, its_source ORDER BY whole ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)")
    joint = joint.withColumn("over", F.expr("copies % rows") - before).select(
        "row", (F.col("same") * F.expr("copies div rows") + F.least("same", F.greatest(F.col("over"), F.lit(0)))).alias("copies"))
    taken = alone.unionByName(joint).filter("copies > 0")
    return taken.select("row", F.explode(F.expr("sequence(1L, copies)"))).select("row.*")
