"""Named queries on the test tables, one per operator family.

Each takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
tables. ``plans.oracle`` holds the matching SQL.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.operators import components, counting, graph, topk, windows
from tagloom.operators.partitioning import spread
from tagloom.plans import graph_inputs as gi
from tagloom.plans import listings, stateful
from tagloom.plans.oracle import LINE_MEMBERS, MAP_KEYS
from tagloom.session import drop_scratch, scratch_path
from tagloom.sinks import reports
from tagloom.sinks.gexf import gexf_lines
from tagloom.sinks.text import document_token_chunks, list_token_chunks
from tagloom.sources.lines import graph_from_lines
from tagloom.sources.pages import extract_records
from tagloom.sources.tables import table
from tagloom.streaming import windowed
from tagloom.streaming.sources import file_stream

# Window sizes used on `events` (its 30 days of data stand in for a
# seconds-long stream).
DAY = "1 day"
HALF_DAY = "12 hours"
STREAM_SLICES = 3


def documents(spark: SparkSession, sf_dir: str, *cols) -> DataFrame:
    """Columns of `documents`, spread over all cores for tokenizing."""
    return spread(table(spark, sf_dir, "documents").select(*cols))


def _lines(df: DataFrame) -> DataFrame:
    return df.select(F.col("text").alias("value"))


def _events(spark, sf_dir):
    return table(spark, sf_dir, "events")


# --- tokens ----------------------------------------------------------------

def q_token_count(spark, sf_dir):
    return counting.token_count(_lines(documents(spark, sf_dir, "text")))


def q_token_top10(spark, sf_dir):
    return topk.top_k(q_token_count(spark, sf_dir), 10)


def q_token_count_merged(spark, sf_dir):
    """Counts of two disjoint halves of the corpus, added together."""
    docs = documents(spark, sf_dir, "lang", "text")
    en = F.col("lang") == "en"
    return counting.merge_counts(
        counting.token_count(_lines(docs.filter(en))),
        counting.token_count(_lines(docs.filter(~en | F.col("lang").isNull()))))


def q_type_top10(spark, sf_dir):
    ev = _events(spark, sf_dir).select(F.col("event_type").alias("tag"))
    return topk.top_k(counting.count_values(ev), 10)


def q_token_chunks(spark, sf_dir):
    """Document tokens in (doc_id, position) order, 201 per chunk."""
    return document_token_chunks(documents(spark, sf_dir, "doc_id", "text"))


# --- batch windows ---------------------------------------------------------

def q_tumbling_top10(spark, sf_dir):
    return windows.window_top_k(_events(spark, sf_dir), "ts", "user_id", DAY, None, 10)


def q_sliding_count(spark, sf_dir):
    return windows.window_count(_events(spark, sf_dir), "ts", "user_id", DAY, HALF_DAY)


def q_sliding_top10(spark, sf_dir):
    return windows.window_top_k(_events(spark, sf_dir), "ts", "user_id", DAY, HALF_DAY, 10)


def q_sliding_report(spark, sf_dir):
    return reports.topk_report(q_sliding_top10(spark, sf_dir), ["window_start", "window_end"])


def q_sliding_topk_json(spark, sf_dir):
    return reports.topk_json(q_sliding_top10(spark, sf_dir), ["window_start", "window_end"])


def q_sliding_count_maps(spark, sf_dir):
    """Each window's user -> count map (keys ascending), as JSON text."""
    maps = counting.counts_as_map(q_sliding_count(spark, sf_dir), ["window_start", "window_end"], max_keys=MAP_KEYS)
    return maps.select("window_start", "window_end", "part", F.to_json("counts").alias("json"))


def q_sliding_count_pairs(spark, sf_dir):
    """The same as lists of (key, value) pairs."""
    pairs = counting.counts_as_pairs(q_sliding_count(spark, sf_dir), ["window_start", "window_end"], max_keys=MAP_KEYS)
    return pairs.select("window_start", "window_end", "part", F.to_json("pairs").alias("json"))


def q_type_counts_sorted(spark, sf_dir):
    """All event types, most frequent first (sort_desc)."""
    ev = _events(spark, sf_dir).select(F.col("event_type").alias("tag"))
    return topk.sort_desc(counting.count_values(ev))


def q_window_value_stats(spark, sf_dir):
    """Other aggregates per daily window and type (window_agg)."""
    return windows.window_agg(_events(spark, sf_dir).select("ts", "event_type", "value"), "ts", DAY, None, ["event_type"],
                              F.count(F.lit(1)).alias("n"), F.max("value").alias("top"), F.min("value").alias("low"))


def q_type_window_report(spark, sf_dir):
    """Daily top-10 event types (only 5 exist) as the keyed report."""
    ranked = windows.window_top_k(_events(spark, sf_dir), "ts", "event_type", DAY, None, 10)
    return reports.keyed_topk_report(ranked)


# --- streaming (availableNow into a fresh folder, then read back) ----------

def _stream_events(spark, sf_dir):
    return file_stream(spark, os.path.join(sf_dir, "events.parquet"))


def q_stream_sliding_count(spark, sf_dir):
    counts = windowed.window_counts(_stream_events(spark, sf_dir), "ts", "user_id", DAY, HALF_DAY)
    out, ck = scratch_path(spark, "stream-count"), scratch_path(spark, "stream-count-ckpt")
    windowed.run_until_done(windowed.start_to_parquet(counts, out, ck))
    drop_scratch(spark, ck)
    return spark.read.parquet(out)


def q_stream_sliding_top10(spark, sf_dir):
    counts = windowed.window_counts(_stream_events(spark, sf_dir), "ts", "user_id", DAY, HALF_DAY)
    out, ck = scratch_path(spark, "stream-top"), scratch_path(spark, "stream-top-ckpt")
    windowed.run_until_done(windowed.start_window_top_k(counts, out, ck, 10))
    drop_scratch(spark, ck)
    return spark.read.parquet(out).drop("batch_id")


def q_stream_sliding_batches(spark, sf_dir):
    """The same counts over several micro-batches: the events arrive as
    ``STREAM_SLICES`` slices of their time span, each appended to a watched
    folder and drained by a run of the stream that goes on from the same
    checkpoint. Windows that span slices live on in the state."""
    events = _events(spark, sf_dir).select("ts", "user_id")
    src, out, ck = (scratch_path(spark, f"stream-batches-{x}") for x in ("in", "out", "ckpt"))
    lo, hi = events.agg(F.min("ts"), F.max("ts")).first()
    step = (hi - lo) / STREAM_SLICES
    for i in range(STREAM_SLICES):
        late = F.col("ts") >= F.lit(lo + i * step)
        early = F.lit(True) if i == STREAM_SLICES - 1 else F.col("ts") < F.lit(lo + (i + 1) * step)
        events.filter(late & early).write.mode("append").parquet(src)
        counts = windowed.window_counts(file_stream(spark, src, schema=events.schema), "ts", "user_id", DAY, HALF_DAY)
        windowed.run_until_done(windowed.start_to_parquet(counts, out, ck))
    drop_scratch(spark, src)
    drop_scratch(spark, ck)
    return spark.read.parquet(out)


def q_stream_interval_top10(spark, sf_dir):
    """Micro-batch word count + top 10 over documents read as a stream."""
    lines = _lines(file_stream(spark, os.path.join(sf_dir, "documents.parquet")))
    out, ck = scratch_path(spark, "stream-interval"), scratch_path(spark, "stream-interval-ckpt")
    windowed.run_until_done(windowed.start_interval_top_k(lines, out, ck, 10))
    drop_scratch(spark, ck)
    return spark.read.parquet(out).drop("batch_id")


# --- supply graph (lineitem: part shipped by supplier) ---------------------

def q_supply_edges(spark, sf_dir):
    return gi.supply_graph(spark, sf_dir).edges


def q_supply_vertices(spark, sf_dir):
    return gi.supply_graph(spark, sf_dir).vertices


def q_supply_triplets(spark, sf_dir):
    return graph.triplets(gi.supply_graph(spark, sf_dir))


def q_supply_degrees(spark, sf_dir):
    return graph.degrees(gi.supply_graph(spark, sf_dir))


def q_supply_low_degree_edges(spark, sf_dir):
    return graph.low_degree_subgraph(gi.supply_graph(spark, sf_dir)).edges


def q_supply_components(spark, sf_dir):
    return components.connected_components(gi.supply_graph(spark, sf_dir))


def q_supply_component_sizes(spark, sf_dir):
    return components.component_sizes(q_supply_components(spark, sf_dir))


def q_supply_component_lines(spark, sf_dir):
    return components.isolated_groups(q_supply_components(spark, sf_dir), LINE_MEMBERS)


def q_supply_subgraph(spark, sf_dir):
    """Vertices without "blue" parts, edges seen at least 4 times whose both ends stay."""
    g = graph.subgraph(gi.supply_graph(spark, sf_dir), ~F.col("label").startswith("blue"),
                       F.col("weight") >= 4)
    return g.edges


def q_supply_lines_triplets(spark, sf_dir):
    """The graph built from text lines: raw edge lines counted, then parsed;
    vertex lines parsed with the JVM split (a label ends at its first blank)."""
    v_lines, e_lines = gi.supply_lines(spark, sf_dir)
    return graph.triplets(graph_from_lines(v_lines, e_lines, gi.SUPPLY_THRESHOLD, raw_line=True))


# --- merged graph (three lineitem slices merged by label) ------------------

def q_merged_vertices(spark, sf_dir):
    return graph.merged_vertices(gi.supply_slices(spark, sf_dir)[0])


def q_merged_edges(spark, sf_dir):
    return gi.merged_supply_graph(spark, sf_dir).edges


def q_merged_edges_reversed(spark, sf_dir):
    return gi.merged_supply_graph(spark, sf_dir, reverse=True).edges


def q_merged_low_degree(spark, sf_dir):
    return graph.low_degree_vertices(gi.merged_supply_graph(spark, sf_dir))


def q_merged_low_degree_edges(spark, sf_dir):
    return graph.low_degree_subgraph(gi.merged_supply_graph(spark, sf_dir)).edges


def q_merged_low_degree_induced(spark, sf_dir):
    return graph.low_degree_induced(gi.merged_supply_graph(spark, sf_dir)).edges


def q_merged_components(spark, sf_dir):
    return components.connected_components(gi.merged_supply_graph(spark, sf_dir))


def q_merged_component_sizes(spark, sf_dir):
    return components.component_sizes(q_merged_components(spark, sf_dir))


def q_merged_component_lines(spark, sf_dir):
    return components.isolated_groups(q_merged_components(spark, sf_dir), LINE_MEMBERS)


def q_merged_gexf(spark, sf_dir):
    return gexf_lines(gi.merged_supply_graph(spark, sf_dir))


# --- loyalty graph (orders: customer buys in its block) ----------------------

def q_loyalty_edges(spark, sf_dir):
    return gi.loyalty_graph(spark, sf_dir).edges


def q_loyalty_low_degree(spark, sf_dir):
    return graph.low_degree_vertices(gi.loyalty_graph(spark, sf_dir))


def q_loyalty_low_degree_edges(spark, sf_dir):
    return graph.low_degree_subgraph(gi.loyalty_graph(spark, sf_dir)).edges


def q_loyalty_low_degree_induced(spark, sf_dir):
    return graph.low_degree_induced(gi.loyalty_graph(spark, sf_dir)).edges


def q_loyalty_components(spark, sf_dir):
    return components.connected_components(gi.loyalty_graph(spark, sf_dir))


def q_loyalty_component_lines(spark, sf_dir):
    return components.isolated_groups(q_loyalty_components(spark, sf_dir), LINE_MEMBERS)


# --- activity graph (events: user did event type) --------------------------

def q_activity_edges(spark, sf_dir):
    return graph.triplets(gi.activity_graph(spark, sf_dir))


def q_activity_components(spark, sf_dir):
    return components.connected_components(gi.activity_graph(spark, sf_dir))


# --- pages -----------------------------------------------------------------

def q_page_fields(spark, sf_dir):
    return extract_records(spread(table(spark, sf_dir, "pages")))


def q_page_tag_top10(spark, sf_dir):
    tags = q_page_fields(spark, sf_dir).select(F.explode("tags").alias("tag"))
    return topk.top_k(counting.count_values(tags), 10)


def q_page_tag_chunks(spark, sf_dir):
    """Page tags in (page_id, position) order, 201 per chunk file."""
    return list_token_chunks(q_page_fields(spark, sf_dir).select("page_id", "tags"), "page_id", "tags")


QUERIES = {
    "token_count": q_token_count,
    "token_top10": q_token_top10,
    "token_count_merged": q_token_count_merged,
    "type_top10": q_type_top10,
    "tumbling_top10": q_tumbling_top10,
    "sliding_count": q_sliding_count,
    "sliding_top10": q_sliding_top10,
    "sliding_report": q_sliding_report,
    "sliding_topk_json": q_sliding_topk_json,
    "sliding_count_maps": q_sliding_count_maps,
    "stream_sliding_count": q_stream_sliding_count,
    "stream_sliding_top10": q_stream_sliding_top10,
    "stream_interval_top10": q_stream_interval_top10,
    "supply_edges": q_supply_edges,
    "supply_vertices": q_supply_vertices,
    "supply_triplets": q_supply_triplets,
    "supply_degrees": q_supply_degrees,
    "supply_components": q_supply_components,
    "merged_vertices": q_merged_vertices,
    "merged_edges": q_merged_edges,
    "merged_edges_reversed": q_merged_edges_reversed,
    "merged_low_degree": q_merged_low_degree,
    "merged_low_degree_edges": q_merged_low_degree_edges,
    "merged_low_degree_induced": q_merged_low_degree_induced,
    "merged_components": q_merged_components,
    "merged_component_sizes": q_merged_component_sizes,
    "merged_component_lines": q_merged_component_lines,
    "merged_gexf": q_merged_gexf,
    "activity_edges": q_activity_edges,
    "activity_components": q_activity_components,
    "supply_low_degree_edges": q_supply_low_degree_edges,
    "supply_component_sizes": q_supply_component_sizes,
    "supply_component_lines": q_supply_component_lines,
    "supply_subgraph": q_supply_subgraph,
    "supply_lines_triplets": q_supply_lines_triplets,
    "page_fields": q_page_fields,
    "page_tag_top10": q_page_tag_top10,
    "page_tag_chunks": q_page_tag_chunks,
    "token_chunks": q_token_chunks,
    "sliding_count_pairs": q_sliding_count_pairs,
    "type_counts_sorted": q_type_counts_sorted,
    "window_value_stats": q_window_value_stats,
    "stream_sliding_batches": q_stream_sliding_batches,
    "loyalty_edges": q_loyalty_edges,
    "loyalty_low_degree": q_loyalty_low_degree,
    "loyalty_low_degree_edges": q_loyalty_low_degree_edges,
    "loyalty_low_degree_induced": q_loyalty_low_degree_induced,
    "loyalty_components": q_loyalty_components,
    "loyalty_component_lines": q_loyalty_component_lines,
    "type_window_report": q_type_window_report,
}

QUERIES.update(stateful.QUERIES)
QUERIES.update(listings.QUERIES)
