"""Connected components of a large graph given by its links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staffcast.staging import stage


def roots(links: DataFrame) -> DataFrame | None:
    """``node, root`` for each node of ``links`` (columns ``a``, ``b``, numbers); None if there are no links.

    Each round maps every node to its smallest neighbour's smallest neighbour and draws the links between the
    images, until none is left: chains at least halve, stars vanish. Then the maps are applied one after the
    other. Minima are combined before the shuffle and joins have one unique side, so a node with very many
    links is no obstacle. All rounds are tables in the shared folder.
    """
    links = stage(_between(links), "links")
    maps = []
    while not links.isEmpty():
        both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("root"))
        near = stage(near, "near")
        jump = near.select(F.col("node").alias("root"), F.col("root").alias("far"))
        maps.append(stage(near.join(jump, "root").select("node", F.col("far").alias("root")), "roots"))
        for end in ("a", "b"):
            image = maps[-1].select(F.col("node").alias(end), F.col("root").alias("image"))
            links = links.join(image, end).drop(end).withColumnRenamed("image", end)
        links = stage(_between(links), "links")
    if not maps:
        return None
    out = maps[0]
    for later in maps[1:]:
        later = later.select(F.col("node").alias("root"), F.col("root").alias("image"))
        out = out.join(later, "root", "left").select("node", F.coalesce("image", "root").alias("root"))
    return stage(out, "components") if len(maps) > 1 else out


def _between(links: DataFrame) -> DataFrame:
    return links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
