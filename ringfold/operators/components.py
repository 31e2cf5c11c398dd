"""Connected components of an undirected edge list, distributed and without a driver-side graph.

In a round every task merges its share of the edges, PER_TASK or fewer, with a union-find and
puts out (node, root) for each piece it sees; the root is the node of the piece with the smallest hash of
this round. A node that several tasks saw has several roots; it keeps one, and the others are linked to that
one, as is a node that is itself a root elsewhere. These links are the next round's graph, on roots alone; as
hashes differ by round, a constant share of the nodes is expected to drop out of any graph. When one task can hold
the links, its answer is final, and each round's nodes get the root of their root, last round first.
No step needs a node's neighbours together, so a node with very many is no hot task. The
tables of a round lie in the shared folder, so no lineage piles up and a lost executor
costs the tasks it ran.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ringfold.plans.shared import cut

#: Edges that a task merges at most: some ten MB of its memory.
PER_TASK = 250_000


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", per_task: int = PER_TASK) -> DataFrame:
    """(node, component) for each node of the edges; the component is its smallest node.

    Edges may repeat and may be self-loops; edges with a null end are ignored.
    """
    pairs = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where(F.col("u").isNotNull() & F.col("v").isNotNull())
    pairs = cut(pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc-edges")
    links, rounds = pairs.where("u <> v"), []
    while True:
        tasks = -(-links.count() // per_task)
        seed = len(rounds) if tasks > 1 or rounds else None
        found = cut(links.coalesce(max(1, tasks)).mapInArrow(_Forest(per_task, seed), links.schema), "cc-roots")
        if tasks <= 1:
            break
        one = cut(found.groupBy("u").agg(F.min("v").alias("m")), "cc-one")
        rounds.append(one)
        more = found.join(one, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        both = one.join(found.select(F.col("v").alias("u")).distinct(), "u", "left_semi").select("u", F.col("m").alias("v"))
        links = cut(more.unionAll(both).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc-edges")
    for one in reversed(rounds):
        up = found.select(F.col("u").alias("m"), F.col("v").alias("c"))
        mine = one.join(up, "m", "left").select("u", F.coalesce("c", "m").alias("v"))
        found = cut(mine.unionAll(found.join(one, "u", "left_anti").select("u", "v")), "cc-roots")
    nodes = pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    placed = nodes.join(found, F.col("node") == F.col("u"), "left").select("node", F.coalesce("v", "node").alias("component"))
    if not rounds:  # one task saw all and took the smallest nodes as roots
        return placed
    placed = cut(placed, "cc-nodes")
    least = cut(placed.groupBy("component").agg(F.min("node").alias("least")), "cc-names")
    return placed.join(least, "component").select("node", F.col("least").alias("component"))


class _Forest:
    """(node, root) for the pieces of a task's edges; at most twice `most` edges are held at a time.

    The root has the smallest hash of the round `seed`, or is the smallest node if seed is None.
    """

    def __init__(self, most: int, seed: int | None) -> None:
        self.most, self.seed = most, seed

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict = {}
        first: dict = {}

        def find(x):
            while (p := parent.setdefault(x, x)) != x:
                parent[x] = x = parent[p]
            return x

        def rank(x):
            if x not in first:
                first[x] = (xxhash.xxh3_64_intdigest(str(x), self.seed), x)
            return first[x]

        def out(schema: pa.Schema) -> pa.RecordBatch:
            rows = [(x, root) for x in list(parent) if (root := find(x)) != x]
            parent.clear()
            first.clear()
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)

        schema, held = None, 0
        for batch in batches:
            schema = batch.schema
            for u, v in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                x, y = find(u), find(v)
                if x != y:
                    if (x < y) if self.seed is None else (rank(x) < rank(y)):
                        x, y = y, x
                    parent[x] = y
            held += batch.num_rows
            if held >= 2 * self.most:
                yield out(schema)
                held = 0
        if schema is not None:
            yield out(schema)


def snapshots(edges: DataFrame, most: int = 500) -> DataFrame:
    """A row a component: size, edge_count, members and transactions (the smallest `most`), first and last seen, entity types.

    edges: source_id, source_type, target_id, target_type, transaction_id, ts_us; deduplicated ones, as every edge counts.
    """
    nodes = cut(connected_components(edges, "source_id", "target_id"), "cc-nodes")
    ends = edges.select(F.explode(F.array(F.struct(F.col("source_id").alias("node"), F.col("source_type").alias("type")), F.struct(F.col("target_id").alias("node"), F.col("target_type").alias("type")))).alias("x")).select("x.*").distinct()
    types = ends.join(nodes, "node").groupBy("component").agg(F.array_sort(F.collect_set("type")).alias("entity_types"))
    sizes = nodes.groupBy("component").agg(F.count("*").alias("size"))
    placed = edges.join(nodes, edges.source_id == nodes.node).select("component", "transaction_id", "ts_us")
    parts = placed.groupBy("component").agg(F.count("*").alias("edge_count"), F.min("ts_us").alias("first_us"), F.max("ts_us").alias("last_us"))
    out = sizes.join(parts, "component").join(types, "component").join(smallest(nodes, "node", most).withColumnRenamed("ids", "member_ids"), "component")
    return out.join(smallest(placed.select("component", "transaction_id").distinct(), "transaction_id", most).withColumnRenamed("ids", "transaction_ids"), "component").withColumnRenamed("component", "component_id")


def smallest(rows: DataFrame, column: str, most: int) -> DataFrame:
    """(component, ids): the `most` smallest of distinct values in order. The rank is limited before the shuffle, so no list is held whole."""
    rank = F.row_number().over(Window.partitionBy("component").orderBy(column))
    first = rows.select("component", column, rank.alias("__r")).where(F.col("__r") <= most)
    return first.groupBy("component").agg(F.array_sort(F.collect_list(column)).alias("ids"))
