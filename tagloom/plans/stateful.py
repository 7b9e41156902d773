"""Registered queries of record scans, keyed state, user aggregates, the
custom sink and step-by-step merging, with their SQL."""

from __future__ import annotations

import os

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.functions.timecols import ntz_micros
from tagloom.operators.accumulate import Spread, ValueCounts, accumulate
from tagloom.operators.graph import Graph, merge_many, triplets
from tagloom.operators.merging import merge_into
from tagloom.operators.windows import with_window
from tagloom.plans import graph_inputs as gi
from tagloom.session import arrow_bytes, drop_scratch, scratch_path
from tagloom.sources.objects import read_concat_objects, read_items_json
from tagloom.sources.scan import BATCH_BYTES
from tagloom.sources.tables import table
from tagloom.streaming import keyed, sink, windowed
from tagloom.streaming.sources import file_stream

DAY, HALF_DAY, LONG = "1 day", "12 hours", "64 days"
SLICES = 3
DOCUMENTS = 4               # JSON documents that the records are dealt to
LATE_USERS = 10             # events of every tenth user come one slice late


# --- records -------------------------------------------------------------------

def _questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as question records; braces and quotes beside the texts."""
    docs = table(spark, sf_dir, "documents")
    return docs.select(
        F.col("doc_id").cast("string").alias("links"), F.col("n_chars").cast("string").alias("views"),
        F.array(F.concat(F.lit("it's }{ "), F.coalesce("lang", F.lit("")), F.lit(' "}')), F.coalesce("source", F.lit(""))).alias("votes"),
        F.array(F.coalesce("text", F.lit(""))).alias("questions"), F.array(F.lit("{"), F.lit("\\'")).alias("tags"))


def _literal(c) -> Column:
    """A text as a Python string literal in single quotes."""
    for plain, escaped in (("\\", "\\\\"), ("'", "\\'"), ("\n", "\\n"), ("\r", "\\r")):
        c = F.replace(c, F.lit(plain), F.lit(escaped))
    return F.concat(F.lit("'"), c, F.lit("'"))


def q_concat_records(spark, sf_dir):
    """Documents written back to back as Python literals (every fourth on a
    line of its own) and read back whole."""
    q, path = _questions(spark, sf_dir), scratch_path(spark, "concat")
    fields = [F.concat(F.lit(f"'{f.name}': "), _literal(F.col(f.name)) if f.dataType.simpleString() == "string" else
                       F.concat(F.lit("["), F.array_join(F.transform(f.name, _literal), ", "), F.lit("]"))) for f in q.schema]
    text = F.concat(F.when(F.col("links").cast("long") % 4 == 0, "\n").otherwise(""), F.lit("{"), F.concat_ws(", ", *fields))
    q.select(text.alias("value")).write.option("lineSep", "}").text(path)
    return _read_back(read_concat_objects(spark, path).select("record.*"))


def _read_back(rows: DataFrame) -> DataFrame:
    return rows.select("links", "views", F.array_join("votes", "|").alias("votes"),
                       F.sha2(F.get("questions", F.lit(0)), 256).alias("text_sha256"), F.array_join("tags", "|").alias("tags"))


def _document(batches):
    """One JSON document of a task's records, line by line."""
    begun = False
    for b in batches:
        j = b.column(0)
        if not begun and len(j):
            begun = True
            yield pa.RecordBatch.from_arrays([pa.array(['{"items": [' + j[0].as_py()])], names=["value"])
            j = j[1:]
        if len(j):
            yield pa.RecordBatch.from_arrays([pc.binary_join_element_wise("", j, ",")], names=["value"])
    if begun:
        yield pa.RecordBatch.from_arrays([pa.array(["]}"])], names=["value"])


def q_items_records(spark, sf_dir):
    """The same records as a few JSON documents, read back by as many tasks
    as the documents have splits."""
    q, path = _questions(spark, sf_dir), scratch_path(spark, "items")
    dealt = (q.select(F.pmod(F.xxhash64("links"), F.lit(DOCUMENTS)).cast("int").alias("p"), F.to_json(F.struct(*q.columns)).alias("j"))
             .repartitionById(DOCUMENTS, F.col("p")))
    with arrow_bytes(spark, BATCH_BYTES):
        dealt.select("j").mapInArrow(_document, "value string").write.text(path)
    items = _read_back(read_items_json(spark, path))
    drop_scratch(spark, path)           # the scan keeps what it has read
    return items


_RECORDS = """
  select cast(doc_id as varchar) as links, cast(n_chars as varchar) as views,
         'it''s }{ ' || coalesce(lang, '') || ' "}|' || coalesce(source, '') as votes,
         sha256(coalesce(text, '')) as text_sha256, '{|\\''' as tags
  from documents"""


# --- streams -------------------------------------------------------------------

def _sliced(events: DataFrame) -> tuple[DataFrame, int]:
    """Events with the slice they arrive in: thirds of their time span, but
    every tenth user's events one slice late."""
    us = events.withColumn("us", ntz_micros("ts"))
    lo, hi = us.agg(F.min("us"), F.max("us")).first()
    step = (hi - lo) // SLICES + 1
    at = F.floor((F.col("us") - lo) / step).cast("int") + (F.col("user_id") % LATE_USERS == 0).cast("int")
    return us.withColumn("slice", at).drop("us"), SLICES + 1


def q_stream_keyed_windows(spark, sf_dir):
    """Top 10 users of each closed window from keyed state with timers, and
    the rows that came after their window had closed (``late``). Events
    arrive in slices, out of order; each slice is a run of the stream that
    goes on from the same checkpoint."""
    events, n = _sliced(table(spark, sf_dir, "events").select("ts", "user_id"))
    src, out, ck = (scratch_path(spark, f"stream-keyed-{x}") for x in ("in", "out", "ckpt"))
    for i in range(n):
        events.filter(F.col("slice") == i).drop("slice").write.mode("append").parquet(src)
        stream = file_stream(spark, src, schema=events.drop("slice").schema)
        lists = keyed.keyed_window_lists(stream, "ts", "user_id", DAY, HALF_DAY, k=10)
        windowed.run_until_done(keyed.start_keyed_top_k(lists, out, ck, 10))
    drop_scratch(spark, src)
    drop_scratch(spark, ck)
    cols = ["window_start", "window_end", "tag", "cnt"]
    late = spark.read.parquet(f"{out}/late").groupBy(*cols[:3]).agg(F.sum("cnt").alias("cnt"))
    return (spark.read.parquet(f"{out}/top").select(F.lit("top").alias("kind"), *cols, "rnk")
            .unionByName(late.select(F.lit("late").alias("kind"), *cols, F.lit(None).cast("long").alias("rnk"))))


def q_stream_rich_sink(spark, sf_dir):
    """Sliding counts streamed into the custom sink, then read back."""
    counts = windowed.window_counts(file_stream(spark, os.path.join(sf_dir, "events.parquet")), "ts", "user_id", DAY, HALF_DAY)
    out, ck = scratch_path(spark, "stream-sink"), scratch_path(spark, "stream-sink-ckpt")
    windowed.run_until_done(sink.start_rich_sink(counts, out, ck))
    drop_scratch(spark, ck)
    return sink.read_rich_sink(spark, out, counts.schema).drop("batch_id")


def q_stream_interval_batches(spark, sf_dir):
    """Word count and top 10 of each of several micro-batches, with nothing
    carried from one to the next."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("value"))
    src, out, ck = (scratch_path(spark, f"stream-intervals-{x}") for x in ("in", "out", "ckpt"))
    for i in range(SLICES):
        docs.filter(F.col("doc_id") % SLICES == i).select("value").write.mode("append").parquet(src)
        lines = file_stream(spark, src, schema="value string")
        windowed.run_until_done(windowed.start_interval_top_k(lines, out, ck, 10))
    drop_scratch(spark, src)
    drop_scratch(spark, ck)
    return spark.read.parquet(out).select(F.col("batch_id").cast("long").alias("batch_id"), "tag", "cnt", "rnk")


_DAY_US, _HALF_US, _LONG_US = 86_400_000_000, 43_200_000_000, 64 * 86_400_000_000
_KEYED = f"""
  with b as (select min(epoch_us(ts)) as lo, (max(epoch_us(ts)) - min(epoch_us(ts))) // {SLICES} + 1 as step from events),
  ev as (select epoch_us(ts) as us, user_id as tag,
                (epoch_us(ts) - lo) // step + case when user_id % {LATE_USERS} = 0 then 1 else 0 end as slice from events, b),
  mx as (select slice, max(us) // 1000 * 1000 as top from ev group by slice),
  wm as (select a.slice, coalesce(max(b.top), 0) as mark from mx a left join mx b on b.slice < a.slice group by a.slice),
  win as (select (us // {_HALF_US} - k) * {_HALF_US} as ws, tag, slice from ev, (select unnest([0, 1]) as k)),
  judged as (select ws, ws + {_DAY_US} as we, tag, ws + {_DAY_US} <= mark as late from win join wm using (slice)),
  cnt as (select late, ws, we, tag, cast(count(*) as bigint) as cnt from judged group by all),
  ranked as (select *, row_number() over (partition by ws order by cnt desc, tag) as rnk from cnt
             where not late and we <= (select max(top) from mx))
  select 'top' as kind, make_timestamp(ws) as window_start, make_timestamp(we) as window_end, tag, cnt, rnk
  from ranked where rnk <= 10
  union all
  select 'late', make_timestamp(ws), make_timestamp(we), tag, cnt, null from cnt where late"""


# --- user aggregates ------------------------------------------------------------

def _windows(spark, sf_dir, *cols):
    """Events in daily windows sliding by half a day, and in windows of 64
    days, which hold nearly all of them."""
    ev = table(spark, sf_dir, "events").select("ts", *cols)
    both = with_window(ev, "ts", DAY, HALF_DAY).unionByName(with_window(ev, "ts", LONG))
    return both.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *cols)


def q_window_user_counts(spark, sf_dir):
    """A user aggregate per window: event types with counts, largest first."""
    return accumulate(_windows(spark, sf_dir, "event_type"), ["window_start", "window_end"], ValueCounts("event_type"))


def q_window_user_spread(spark, sf_dir):
    """Another one: number, sum and sum of squares of the users' ids."""
    return accumulate(_windows(spark, sf_dir, "user_id"), ["window_start", "window_end"], Spread("user_id"))


_WINDOWED = f"""
  select make_timestamp((epoch_us(ts) // {_HALF_US} - k) * {_HALF_US}) as window_start,
         make_timestamp((epoch_us(ts) // {_HALF_US} - k) * {_HALF_US} + {_DAY_US}) as window_end, *
  from events, (select unnest([0, 1]) as k)
  union all
  select make_timestamp(epoch_us(ts) // {_LONG_US} * {_LONG_US}), make_timestamp(epoch_us(ts) // {_LONG_US} * {_LONG_US} + {_LONG_US}), *, 0
  from events"""


# --- graphs ---------------------------------------------------------------------

def _slice_graphs(spark, sf_dir) -> list[Graph]:
    stacked, n = gi.supply_slices(spark, sf_dir)
    return [Graph(stacked.vertices.filter(F.col("gid") == i).select("id", "label"),
                  stacked.edges.filter(F.col("gid") == i).select("src", "dst", "weight")) for i in range(n)]


def _by_label(g: Graph) -> DataFrame:
    t = triplets(g)
    return t.select("src_label", "dst_label", "weight")


def q_merged_in_steps(spark, sf_dir):
    """The slice graphs merged one after the other with a stored label
    dictionary; edges by label."""
    graphs = _slice_graphs(spark, sf_dir)
    merged = Graph(spark.createDataFrame([], "id long, label string"), spark.createDataFrame([], "src long, dst long, weight long"))
    for g in graphs:
        merged = merge_into(merged, g)
    return _by_label(merged)


def q_merged_three_way(spark, sf_dir):
    """The same graphs merged at once from single graphs."""
    return _by_label(merge_many(_slice_graphs(spark, sf_dir)))


QUERIES = {
    "concat_records": q_concat_records,
    "items_records": q_items_records,
    "stream_keyed_windows": q_stream_keyed_windows,
    "stream_rich_sink": q_stream_rich_sink,
    "stream_interval_batches": q_stream_interval_batches,
    "window_user_counts": q_window_user_counts,
    "window_user_spread": q_window_user_spread,
    "merged_in_steps": q_merged_in_steps,
    "merged_three_way": q_merged_three_way,
}


def sql(known: dict[str, str], tokens: str) -> dict[str, str]:
    """SQL of these queries; ``known`` are those of the others, ``tokens``
    the token list of a text."""
    return {
        "concat_records": _RECORDS,
        "items_records": _RECORDS,
        "stream_keyed_windows": _KEYED,
        "stream_rich_sink": known["stream_sliding_count"],
        "stream_interval_batches": f"""
          with t as (select cast(doc_id % {SLICES} as bigint) as batch_id, tag, count(*) as cnt from (
            select doc_id, unnest({tokens}) as tag from documents) group by all)
          select * from (select *, row_number() over (partition by batch_id order by cnt desc, tag) as rnk from t) where rnk <= 10""",
        "window_user_counts": f"""
          select window_start, window_end, row_number() over (partition by window_start, window_end order by cnt desc, value) - 1 as pos,
                 value, cnt
          from (select window_start, window_end, event_type as value, count(*) as cnt from ({_WINDOWED}) group by all)""",
        "window_user_spread": f"""
          select window_start, window_end, count(user_id) as n, cast(sum(cast(user_id as hugeint)) as varchar) as total,
                 cast(sum(cast(user_id as hugeint) * user_id) as varchar) as squares
          from ({_WINDOWED}) group by all""",
        "merged_in_steps": _merged_sql(known),
        "merged_three_way": _merged_sql(known),
    }


def _merged_sql(known: dict[str, str]) -> str:
    return f"""
      select v.label as src_label, w.label as dst_label, e.weight
      from ({known['merged_edges']}) e join ({known['merged_vertices']}) v on v.id = e.src
      join ({known['merged_vertices']}) w on w.id = e.dst"""
