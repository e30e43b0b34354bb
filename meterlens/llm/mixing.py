"""Mix sources to target weights by min-cost flow over membership patterns.

Documents may belong to several sources. They are aggregated by their membership pattern
(the sorted set of their sources), which leaves a transport problem whose size depends on
the number of patterns, not of documents: a pattern supplies its words once for nothing, a
second time at cost 1, a third time at cost 2 (convex, so repeats come last), and each
source asks for its quota. Successive shortest paths give the cheapest flow. Seeded documents then
fill every pattern's flow: whole rounds for all its documents, and the rest by hash order.

Only patterns reach the driver. Their number is checked against ``MAX_PATTERNS``; the
documents are never ordered within one task: a histogram of hash prefixes finds the bucket
where a pattern's last round ends, and only that bucket is ordered.
"""

from __future__ import annotations

import heapq
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from meterlens.llm.common import WORD, word_count
from meterlens.storage import durable

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
#: Patterns are metadata; a table with more distinct ones than this is refused, not cut.
MAX_PATTERNS = 100_000
BUCKETS = 4096


class Flow(NamedTuple):
    pattern: int
    source: int
    words: int


def targets(sizes: list[int], weights: list[int], repeats: int = MAX_REPEATS) -> list[float]:
    """Share the sum of ``sizes`` by weight, none above ``repeats`` times its size.

    What a source cannot take is shared again among the others by weight until none is
    above its limit.
    """
    out = [0.0] * len(sizes)
    free = set(range(len(sizes)))
    rest = float(sum(sizes))
    while free:
        total = sum(weights[i] for i in free)
        share = {i: rest * weights[i] / total for i in free}
        above = [i for i in free if share[i] > repeats * sizes[i]]
        if not above:
            for i in free:
                out[i] = share[i]
            return out
        for i in above:
            out[i] = float(repeats * sizes[i])
            rest -= out[i]
            free.remove(i)
    return out


def min_cost_flow(
    supply: list[int], members: list[list[int]], quotas: list[int], repeats: int = MAX_REPEATS
) -> list[Flow]:
    """Cheapest routing of pattern words to source quotas.

    A pattern's ``r``-th round has its size as capacity and ``r - 1`` as cost a word. Every
    augmentation saturates a round, a quota or a routed arc; distances are kept reduced by
    node potentials, so each search is a Dijkstra over the few arcs of the pattern graph.
    """
    n, m = len(supply), len(quotas)
    sink = 1 + n + m
    graph: list[list[list]] = [[] for _ in range(sink + 1)]

    def arc(a: int, b: int, capacity: int, cost: int) -> list:
        there = [b, capacity, cost, None]
        back = [a, 0, -cost, there]
        there[3] = back
        graph[a].append(there)
        graph[b].append(back)
        return there

    for p, words in enumerate(supply):
        for level in range(repeats):
            arc(0, 1 + p, words, level)
    routed = [
        (p, s, arc(1 + p, 1 + n + s, repeats * supply[p], 0))
        for p in range(n) for s in members[p]
    ]
    for s, quota in enumerate(quotas):
        arc(1 + n + s, sink, quota, 0)
    potential = [0] * (sink + 1)
    while True:
        best = {0: 0}
        via: dict[int, list] = {}
        heap = [(0, 0)]
        done = set()
        while heap:
            far, node = heapq.heappop(heap)
            if node in done:
                continue
            done.add(node)
            for edge in graph[node]:
                if edge[1] > 0 and edge[0] not in done:
                    reach = far + edge[2] + potential[node] - potential[edge[0]]
                    if reach < best.get(edge[0], 1 << 60):
                        best[edge[0]] = reach
                        via[edge[0]] = edge
                        heapq.heappush(heap, (reach, edge[0]))
        if sink not in via:
            break
        for node in range(sink + 1):
            potential[node] += min(best.get(node, best[sink]), best[sink])
        path = []
        node = sink
        while node:
            path.append(via[node])
            node = via[node][3][0]
        step = min(edge[1] for edge in path)
        for edge in path:
            edge[1] -= step
            edge[3][1] += step
    return [Flow(p, s, edge[3][1]) for p, s, edge in routed if edge[3][1]]


def source_weights(count: int, weights: tuple[int, ...] = WEIGHTS) -> list[int]:
    return [weights[i % len(weights)] for i in range(count)]


def mix_to_targets(
    docs: DataFrame, sources: str | Column = "source", text: str = "text", seed: int = 0,
    weights: tuple[int, ...] = WEIGHTS, repeats: int = MAX_REPEATS, key: str = "doc_id",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row per document: (key, ``keep``, size, source_size, target, taken).

    ``sources`` is a text column or an array of texts (overlapping sources). A null text has
    size 0, a null source is a source of its own, last in order; an empty array too.
    ``source_size`` and ``target`` are sums over the document's sources. ``taken`` is the
    number of words the mix takes: the document's size times its rounds, and for one
    document a pattern, on which its flow ends, the words that are left. Documents of size 0
    take 0. Repeated rows are documents of their own. The order is a hash of key and text, so
    reruns agree. An empty table gives no rows.
    """
    spark = docs.sparkSession
    column = F.col(sources) if isinstance(sources, str) else sources
    is_array = docs.select(column.alias("s")).schema["s"].dataType.typeName() == "array"
    members = column if is_array else F.array(column)
    members = F.when(F.coalesce(F.size(members), F.lit(0)) > 0, members)
    members = F.coalesce(members, F.array(F.lit(None).cast("string")))
    order = F.xxhash64(F.lit(seed), F.col(key), F.col(text))
    # Texts are read again where they are needed: storing them would cost more than counting
    # their words twice.
    placed = docs.select(
        F.col(key), *keep, F.col(text).alias("_text"),
        F.array_sort(F.array_distinct(members)).alias("_pattern"), order.alias("_order"),
    ).withColumn("_bucket", F.pmod(F.shiftright("_order", 40), F.lit(BUCKETS)))

    buckets = durable(
        placed.withColumn("size", word_count("_text")).groupBy("_pattern", "_bucket").agg(
            F.sum("size").alias("words"))
    )
    # The limit is one more than is accepted, to tell a full table from one too large.
    found = (
        buckets.groupBy("_pattern").agg(F.sum("words").alias("words"))
        .limit(MAX_PATTERNS + 1).collect()
    )
    if len(found) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} membership patterns")
    patterns = sorted(
        ((list(row["_pattern"]), int(row["words"])) for row in found),
        key=lambda p: [(s is None, (s or "").encode("utf-32-be")) for s in p[0]],
    )
    names = sorted({s for p, _ in patterns for s in p},
                   key=lambda s: (s is None, (s or "").encode("utf-32-be")))
    number = {s: i for i, s in enumerate(names)}
    sizes = [0] * len(names)
    for p, words in patterns:
        for s in p:
            sizes[number[s]] += words
    if all(len(p) == 1 for p, _ in patterns):
        shares = targets(sizes, source_weights(len(names), weights), repeats)
    else:
        total = sum(words for _, words in patterns)
        scaled = targets(sizes, source_weights(len(names), weights), repeats)
        factor = total / max(1, sum(sizes))
        shares = [x * factor for x in scaled]
    flows = min_cost_flow(
        [words for _, words in patterns], [[number[s] for s in p] for p, _ in patterns],
        [round(x) for x in shares], repeats,
    )
    taken = [0] * len(patterns)
    for flow in flows:
        taken[flow.pattern] += flow.words
    plan = spark.createDataFrame(
        [
            (p, sum(sizes[number[s]] for s in p), float(sum(shares[number[s]] for s in p)),
             taken[i] // words if words else 0, taken[i] % words if words else 0)
            for i, (p, words) in enumerate(patterns)
        ],
        "_pattern array<string>, source_size long, target double, _rounds long, _rest long",
    )
    # Where the last, partial round ends: buckets before the edge are in it, those after not.
    before = Window.partitionBy("_pattern").orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1)
    # At most BUCKETS rows a pattern; arrays with nulls only match null-safely.
    cumulative = buckets.withColumn("_before", F.coalesce(F.sum("words").over(before), F.lit(0)))
    edges = cumulative.alias("c").join(
        F.broadcast(plan.alias("p")), F.col("c._pattern").eqNullSafe(F.col("p._pattern"))
    ).where("_before <= _rest and _rest < _before + words").select(
        F.col("p._pattern").alias("_pattern"), F.col("_bucket").alias("_edge"),
        (F.col("_rest") - F.col("_before")).alias("_edge_rest"))
    # One row a pattern, at most MAX_PATTERNS.
    plan = plan.alias("p").join(
        edges.alias("e"), F.col("p._pattern").eqNullSafe(F.col("e._pattern")), "left"
    ).select("p.*", F.coalesce("_edge", F.lit(0)).alias("_edge"),
             F.coalesce("_edge_rest", F.lit(0)).alias("_edge_rest"))
    plan = durable(plan)
    joined = placed.alias("d").join(
        F.broadcast(plan.alias("p")), F.col("d._pattern").eqNullSafe(F.col("p._pattern"))
    ).drop(F.col("p._pattern"))
    size = F.col("size")
    whole = size * F.col("_rounds")
    on_edge = joined.where("_bucket = _edge and _rest > 0").withColumn("size", word_count("_text"))
    inside = joined.where("_bucket <> _edge or _rest = 0").withColumn(
        "size", word_count("_text")
    ).withColumn(
        "taken",
        whole + F.when((F.col("_bucket") < F.col("_edge")) & (F.col("_rest") > 0), size).otherwise(0))
    in_edge = Window.partitionBy("_pattern").orderBy("_order", key, "size").rowsBetween(
        Window.unboundedPreceding, -1)
    on_edge = on_edge.drop("_text").withColumn(
        "_so_far", F.coalesce(F.sum("size").over(in_edge), F.lit(0))
    ).withColumn(
        "taken", whole + F.greatest(F.lit(0), F.least(size, F.col("_edge_rest") - F.col("_so_far")))
    ).drop("_so_far")
    out = [key, *keep, "size", "source_size", "target", F.col("taken").cast("long").alias("taken")]
    return inside.select(*out).unionByName(on_edge.select(*out))


def apply_mix(mixed: DataFrame, text: str = "text", length: str = "n_chars") -> DataFrame:
    """The mix as rows: ``mixed`` is :func:`mix_to_targets` with ``text`` among ``keep``.

    A document taken ``k`` times its size gives ``k`` rows, one not taken gives none. The
    document on which a pattern's flow ends gives a row more, whose text is cut after the
    last word taken; ``length``, if there, is the code points of the text in the row.
    """
    size, taken = F.col("size"), F.col("taken")
    whole = F.when(size > 0, F.floor(taken / size)).otherwise(0).cast("int")
    left = F.when(size > 0, taken % size).otherwise(0)
    copies = F.concat(
        F.array_repeat(F.lit(0).cast("long"), whole),
        F.when(left > 0, F.array(left)).otherwise(F.array().cast("array<long>")),
    )
    rows = mixed.withColumn("_words", F.explode(copies))
    cut = F.array_join(F.slice(F.regexp_extract_all(F.col(text), F.lit(f"({WORD})"), F.lit(1)),
                               F.lit(1), F.greatest(F.col("_words"), F.lit(1)).cast("int")), " ")
    rows = rows.withColumn(text, F.when(F.col("_words") > 0, cut).otherwise(F.col(text)))
    if length in rows.columns:
        rows = rows.withColumn(
            length, F.when(F.col("_words") > 0, F.length(text).cast("long")).otherwise(F.col(length)))
    return rows.drop("_words", "size", "source_size", "target", "taken")
