"""Connected components of a table of links, by alternating stars."""

from pyspark.sql import DataFrame, functions as F

from gaugeline.sources.tables import discard, stored


def _least(edges: DataFrame) -> DataFrame:
    """Edges with the least neighbour of ``u`` beside them: an aggregate and a join, so a node of many links is never one task's list."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    return edges.join(least, "u")


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component) of every node in ``links`` (u, v); component is the least node that can be reached.

    Large stars hang each node's larger neighbours under its least one, small stars the smaller ones;
    the rounds grow with the logarithm of the longest path.  Every round is a written table, so a lost
    executor costs one round at most.  Self-links and repeated links are allowed; rows with a null end are ignored.
    """
    links = links.where("u IS NOT NULL AND v IS NOT NULL")
    edges = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    nodes_of_loops = edges.where("u = v")
    edges = stored(edges.where("u > v"), "links")
    loops = nodes_of_loops.select(F.col("u").alias("node")).distinct()
    state = None
    for _ in range(most_rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (_least(both).where("v > u")
                 .select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct())
        small = _least(large).select(F.explode(F.array(
            F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
        before, edges = edges, stored(small.where("u > v").distinct(), "links")
        discard(before)
        now = edges.agg(F.count("*"), F.sum(F.col("u").cast("decimal(38,0)")), F.sum(F.col("v").cast("decimal(38,0)")),
                        F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == state:
            break
        state = now
    else:
        raise RuntimeError(f"components have not settled after {most_rounds} rounds")
    found = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = found.select(F.col("component").alias("node")).distinct().withColumn("component", F.col("node"))
    lone = loops.join(found.select("node").unionByName(roots.select("node")), "node", "left_anti")
    return found.unionByName(roots).unionByName(lone.withColumn("component", F.col("node")))
