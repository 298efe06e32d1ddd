"""Route new tickets, in batch or on a stream, to the nearest known cluster."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from queuelens.functions.lookup import join_lookup
from queuelens.operators import embed, nearest
from queuelens.operators.prepare import preprocess

LISTED_ROUTES = 10_000  # as many travel as a literal; more are joined


def route_tickets(tickets: DataFrame, centroids: DataFrame, config: dict, routes: DataFrame | None = None, embedder=None) -> DataFrame:
    """Add the nearest cluster and, if ``routes`` is given, its category and team.

    Stateless: each row is cleaned, embedded and compared with blocks of centroids, so the same function serves a static and a streaming frame.
    ``centroids`` is (cluster, centroid) over semantic vectors, ``routes`` (cluster,
    category, team, ...); both are static.
    """
    ready = embed.generate_embeddings(preprocess(tickets, config), config, embedder)
    routed = nearest.assign(ready, centroids).drop("semantic")
    if routes is None:
        return routed
    names = routes.select(F.col("cluster").cast("int"), "category", "team", "automation")
    rows = names.limit(LISTED_ROUTES + 1).collect()
    if len(rows) > LISTED_ROUTES:
        return join_lookup(routed, names, "cluster")
    kind = "map<string,struct<category:string,team:string,automation:boolean>>"
    table = F.from_json(F.lit(json.dumps({str(r.cluster): r.asDict() for r in rows})), kind)
    route = F.try_element_at(table, F.col("cluster").cast("string"))
    return routed.withColumns({c: route[c] for c in ("category", "team", "automation")})


def start_routing(tickets: DataFrame, centroids: DataFrame, config: dict, output: str, checkpoint: str, routes: DataFrame | None = None, embedder=None):
    """Route a stream of tickets into Parquet files; processes what is there, then stops.

    A model provider embeds the texts of each batch in place, without the vector store.
    """
    routed = route_tickets(tickets, centroids, config, routes, embedder)
    return (
        routed.writeStream.format("parquet")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
