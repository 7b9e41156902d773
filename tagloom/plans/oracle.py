"""DuckDB SQL for each named query (same column names)."""

from __future__ import annotations

from tagloom.plans.listings import sql as listings_sql
from tagloom.plans.stateful import sql as stateful_sql

# Sizes the registered queries use, small enough that both sides of them occur.
LINE_MEMBERS = 20       # ids of a component line
MAP_KEYS = 20           # keys of a count map

# Tokens of documents.text split like a JVM String.split(" ").
_TOKEN_LIST = """case when rtrim(text, ' ') = '' and text <> '' then []::varchar[]
                     else string_split(rtrim(text, ' '), ' ') end"""
_TOKENS = f"select unnest({_TOKEN_LIST}) as tag from documents"
_TOKEN_COUNT = f"select tag, count(*) as cnt from ({_TOKENS}) group by tag"

_DAY_US = 86400000000
_HALF_DAY_US = 43200000000

# Sliding 1 day / 12 h windows over events.user_id.
_SLIDING_COUNT = f"""
  with w as (
    select make_timestamp(((epoch_us(ts) // {_HALF_DAY_US}) - k) * {_HALF_DAY_US}) as window_start,
           user_id as tag
    from events, (select unnest([0, 1]) as k))
  select window_start, window_start + interval 1 day as window_end, tag, count(*) as cnt
  from w group by window_start, tag
"""
_SLIDING_TOP10 = f"""
  select window_start, window_end, tag, cnt, rnk from (
    select *, row_number() over (partition by window_start order by cnt desc, tag) as rnk
    from ({_SLIDING_COUNT})) where rnk <= 10
"""

SQL = {
    "token_count": _TOKEN_COUNT,
    "token_top10": f"""
      select tag, cnt, rnk from (
        select *, row_number() over (order by cnt desc, tag) as rnk from ({_TOKEN_COUNT}))
      where rnk <= 10""",
    "token_count_merged": _TOKEN_COUNT,
    "type_top10": """
      select tag, cnt, rnk from (
        select *, row_number() over (order by cnt desc, tag) as rnk from (
          select event_type as tag, count(*) as cnt from events group by event_type))
      where rnk <= 10""",
    "tumbling_top10": f"""
      select window_start, window_start + interval 1 day as window_end, tag, cnt, rnk from (
        select *, row_number() over (partition by window_start order by cnt desc, tag) as rnk
        from (select make_timestamp((epoch_us(ts) // {_DAY_US}) * {_DAY_US}) as window_start,
                     user_id as tag, count(*) as cnt
              from events group by window_start, tag))
      where rnk <= 10""",
    "sliding_count": _SLIDING_COUNT,
    "sliding_top10": _SLIDING_TOP10,
    "sliding_report": f"""
      select window_start, window_end,
             '----------' || chr(10)
             || string_agg('No. ' || rnk || ' tag:' || tag || ' The num of it is:  ' || cnt || chr(10), ''
                           order by rnk)
             || '--------------------' || chr(10) as report
      from ({_SLIDING_TOP10}) group by window_start, window_end""",
    "sliding_topk_json": f"""
      select window_start, window_end,
             '[' || string_agg('{{"name":"' || tag || '","count":' || cnt || '}}', ',' order by rnk) || ']'
               as json
      from ({_SLIDING_TOP10}) group by window_start, window_end""",
}

# A streaming window is emitted once the watermark (max event time,
# delay 0) has passed its end.
_CLOSED = "window_end <= (select max(ts) from events)"

SQL.update({
    "stream_sliding_count": f"select * from ({_SLIDING_COUNT}) where {_CLOSED}",
    "stream_sliding_top10": f"select * from ({_SLIDING_TOP10}) where {_CLOSED}",
    "stream_interval_top10": SQL["token_top10"],
})

# --- graphs ----------------------------------------------------------------
_B = 10 ** 12
_SUPPLY_LABELS = f"""(select id, min(label) as label from (
    select p_partkey as id, p_name as label from part
    union all select s_suppkey + {_B}, s_name from supplier) group by id)"""


def _supply_edges(num: int, where: str = "") -> str:
    return f"""(select l_partkey as src, l_suppkey + {_B} as dst, count(*) as weight
               from lineitem {where} group by l_partkey, l_suppkey having count(*) > {num})"""


def _vertices_of(edges: str, labels: str) -> str:
    return f"""(select i.id, coalesce(l.label, '') as label from
               (select src as id from {edges} union select dst from {edges}) i
               left join {labels} l on l.id = i.id)"""


def _components(edges: str, vertices: str) -> str:
    """Least reachable id per vertex (labels only move to larger ids)."""
    return f"""(with recursive u as (select src as a, dst as b from {edges}
                                   union select dst, src from {edges}),
                 r(a, l) as (select id, id from {vertices}
                             union select u.b, r.l from r join u on u.a = r.a where r.l < u.b)
               select a as id, min(l) as component from r group by a)"""


def _component_lines(components: str, per_line: int = LINE_MEMBERS) -> str:
    return f"""
      select component, chunk, string_agg(cast(id as varchar), ', ' order by id) as members from (
        select component, id,
               (row_number() over (partition by component order by id) - 1) // {per_line} as chunk
        from {components})
      group by component, chunk"""


_SE = _supply_edges(2)
_SV = _vertices_of("se", _SUPPLY_LABELS)

# Three slices (l_returnflag), threshold > 1, merged by label.
_MERGED = f"""
  s as (select l_returnflag as f, l_partkey as src, l_suppkey + {_B} as dst, count(*) as w
        from lineitem
        group by l_returnflag, l_partkey, l_suppkey having count(*) > 1),
  vl as {_SUPPLY_LABELS},
  sl as (select s.f, s.w, coalesce(a.label, '') as sl, coalesce(b.label, '') as dl
         from s left join vl a on a.id = s.src left join vl b on b.id = s.dst),
  mv as (select row_number() over (order by label) - 1 as id, label
         from (select sl as label from sl union select dl from sl)),
  me0 as (select va.id as src, vb.id as dst, sl.w, sl.f from sl
          join mv va on va.label = sl.sl join mv vb on vb.label = sl.dl),
  me as (select src, dst, cast(sum(w) as bigint) as weight from me0 group by src, dst),
  deg as (select id, count(*) as degree from (select src as id from me union all select dst from me)
          group by id),
  low as (select id from deg where degree <= 2)
"""

_ACTIVITY = f"""
  ty as (select row_number() over (order by event_type) - 1 + {_B} as id, event_type as label
         from (select distinct event_type from events)),
  ae as (select e.user_id as src, ty.id as dst, count(*) as weight
         from events e join ty on ty.label = e.event_type
         group by e.user_id, ty.id having count(*) > 15),
  av as {_vertices_of("ae", "ty")}
"""

SQL.update({
    "supply_edges": f"select * from {_SE}",
    "supply_vertices": f"with se as {_SE} select * from {_SV}",
    "supply_triplets": f"""with se as {_SE}, sv as {_SV}
      select se.src, a.label as src_label, se.dst, b.label as dst_label, se.weight
      from se join sv a on a.id = se.src join sv b on b.id = se.dst""",
    "supply_degrees": f"""with se as {_SE}
      select id, count(*) as degree from (select src as id from se union all select dst from se)
      group by id""",
    "supply_components": f"with se as {_SE}, sv as {_SV} select * from {_components('se', 'sv')}",
    "merged_vertices": f"with {_MERGED} select id, label from mv",
    "merged_edges": f"with {_MERGED} select src, dst, weight from me",
    "merged_edges_reversed": f"""with {_MERGED}
      select src, dst, cast(sum(w) as bigint) as weight from (
        select case when f = last then dst else src end as src,
               case when f = last then src else dst end as dst, w
        from me0, (select max(l_returnflag) as last from lineitem))
      group by src, dst""",
    "merged_low_degree": f"with {_MERGED} select id from low",
    "merged_low_degree_edges": f"""with {_MERGED}
      select * from me where src in (select id from low) or dst in (select id from low)""",
    "merged_low_degree_induced": f"""with {_MERGED}
      select * from me where src in (select id from low) and dst in (select id from low)""",
    "merged_components": f"with {_MERGED} select * from {_components('me', 'mv')}",
    "merged_component_sizes": f"""with {_MERGED}
      select component, count(*) as size from {_components('me', 'mv')} group by component""",
    "merged_component_lines": f"with {_MERGED} {_component_lines(_components('me', 'mv'))}",
    "merged_gexf": f"""with {_MERGED}
      select * from (values
        (0, 0, 0, '<?xml version="1.0" encoding="UTF-8"?>'),
        (0, 1, 0, '<gexf xmlns="http://www.gexf.net/1.2draft" version="1.2">'),
        (0, 2, 0, '<graph mode="static" defaultedgetype="directed">'),
        (0, 3, 0, '<nodes>'),
        (2, 0, 0, '</nodes>'),
        (2, 1, 0, '<edges>'),
        (4, 0, 0, '</edges>'),
        (4, 1, 0, '</graph>'),
        (4, 2, 0, '</gexf>')) t(section, k1, k2, line)
      union all
      select 1, id, 0, '<node id="' || id || '" label="'
             || replace(replace(replace(replace(label, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;')
             || '" />' from mv
      union all
      select 3, src, dst, '<edge source="' || src || '" target="' || dst || '" weight="' || weight || '"/>'
      from me""",
    "activity_edges": f"""with {_ACTIVITY}
      select ae.src, a.label as src_label, ae.dst, b.label as dst_label, ae.weight
      from ae join av a on a.id = ae.src join av b on b.id = ae.dst""",
    "activity_components": f"with {_ACTIVITY} select * from {_components('ae', 'av')}",
})

_SUPPLY_LOW = f"""se as {_SE},
  low as (select id from (select src as id from se union all select dst from se)
          group by id having count(*) <= 2)"""
SQL.update({
    "supply_low_degree_edges": f"""with {_SUPPLY_LOW}
      select * from se where src in (select id from low) or dst in (select id from low)""",
    "supply_component_sizes": f"""with se as {_SE}, sv as {_SV}
      select component, count(*) as size from {_components('se', 'sv')} group by component""",
    "supply_component_lines": f"with se as {_SE}, sv as {_SV} {_component_lines(_components('se', 'sv'))}",
})



def _decoded(text: str) -> str:
    """Named entities decoded; ``&amp;`` last, so nothing is decoded twice."""
    for name, char in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("apos", "''"), ("#39", "''"), ("nbsp", "\u00a0"),
                       ("amp", "&")):
        text = f"replace({text}, '&{name};', '{char}')"
    return text


def _between(a: str, b: str) -> str:
    """Text between the first ``a`` and the next ``b``; null without either."""
    rest = f"substr(html, strpos(html, '{a}') + {len(a)})"
    return f"""case when strpos(html, '{a}') > 0 and strpos({rest}, '{b}') > 0
               then {_decoded(f"substr({rest}, 1, strpos({rest}, '{b}') - 1)")} end"""


# List items are cut out by position, not with the query's patterns.
_PAGE_FIELDS = f"""
  select page_id, {_between('<title>', '</title>')} as title, {_between('<h1>', '</h1>')} as heading,
         list_transform(items, lambda x: {_decoded("substr(x, strpos(x, '\">') + 2)")}) as tags,
         list_transform(items, lambda x: {_decoded("substr(x, 1, strpos(x, '\">') - 1)")}) as links
  from (select page_id, html,
               list_transform(list_filter(string_split(html, '<li><a href="/')[2:], lambda x: strpos(x, '</a></li>') > 0),
                              lambda x: substr(x, 1, strpos(x, '</a></li>') - 1)) as items
        from pages)"""

SQL.update({
    "page_fields": _PAGE_FIELDS,
    "page_tag_top10": f"""
      select tag, cnt, rnk from (
        select *, row_number() over (order by cnt desc, tag) as rnk from (
          select tag, count(*) as cnt from (select unnest(tags) as tag from ({_PAGE_FIELDS}))
          group by tag))
      where rnk <= 10""",
    "token_chunks": """
      with l as (select doc_id, case when rtrim(text, ' ') = '' and text <> '' then []::varchar[]
                                     else string_split(rtrim(text, ' '), ' ') end as toks
                 from documents),
      t as (select doc_id, unnest(toks) as tag, unnest(range(len(toks))) as pos from l),
      i as (select tag, row_number() over (order by doc_id, pos) - 1 as i from t)
      select cast(i // 201 as bigint) as chunk, string_agg(tag, ' ' order by i) || ' ' as text
      from i group by chunk""",
})

SQL["type_window_report"] = f"""
  with n as (select make_timestamp((epoch_us(ts) // {_DAY_US}) * {_DAY_US}) + interval 1 day as window_end,
                    event_type as tag, count(*) as cnt
             from events group by window_end, tag),
  r as (select *, row_number() over (partition by window_end order by cnt desc, tag) as rnk from n)
  select window_end,
         '---------------------' || chr(10) || ' 窗口结束时间： '
         || strftime(window_end, '%Y-%m-%d %H:%M:%S') || '.0' || chr(10)
         || string_agg('No. ' || rnk || ' tag: ' || tag || ' 出现数目：' || cnt || chr(10), '' order by rnk)
         || '------------------' || chr(10) as report
  from r where rnk <= 10 group by window_end"""

SQL.update({
    "supply_subgraph": f"""with se as {_SE}, sv as {_SV},
      keep as (select id from sv where not starts_with(label, 'blue'))
      select * from se where weight >= 4
        and src in (select id from keep) and dst in (select id from keep)""",
    "supply_lines_triplets": f"""with se as {_SE},
      vl as (select id, min(split_part(label, ' ', 1)) as label from (
               select p_partkey as id, p_name as label from part
               union all select s_suppkey + {_B}, s_name from supplier) group by id),
      sv as {_vertices_of("se", "vl")}
      select se.src, a.label as src_label, se.dst, b.label as dst_label, se.weight
      from se join sv a on a.id = se.src join sv b on b.id = se.dst""",
})

SQL["page_tag_chunks"] = f"""
  with p as (select page_id, tags from ({_PAGE_FIELDS})),
  t as (select page_id, unnest(tags) as tag, unnest(range(len(tags))) as pos from p),
  i as (select tag, row_number() over (order by page_id, pos) - 1 as i from t)
  select cast(i // 201 as bigint) as chunk, string_agg(tag, ' ' order by i) || ' ' as text
  from i group by chunk"""

_MAP_ROWS = f"""
  select *, (row_number() over (partition by window_start order by tag) - 1) // {MAP_KEYS} as part
  from ({_SLIDING_COUNT})"""
SQL["sliding_count_maps"] = f"""
  select window_start, window_end, part,
         '{{' || string_agg('"' || tag || '":' || cnt, ',' order by tag) || '}}' as json
  from ({_MAP_ROWS}) group by window_start, window_end, part"""
SQL["sliding_count_pairs"] = f"""
  select window_start, window_end, part,
         '[' || string_agg('{{"key":' || tag || ',"value":' || cnt || '}}', ',' order by tag) || ']' as json
  from ({_MAP_ROWS}) group by window_start, window_end, part"""
SQL["stream_sliding_batches"] = SQL["stream_sliding_count"]

# Customers and their blocks of 12 by order priority, merged by label.
_LOYALTY = f"""
  occ as (select o_orderpriority as f, o_custkey as src, o_custkey // 12 + {_B} as dst, count(*) as w
          from orders group by all having count(*) > 4),
  vl as (select c_custkey as id, c_name as label from customer
         where (c_custkey // 12) % 5 <> 0 or c_acctbal >= 2000
         union all
         select distinct c_custkey // 12 + {_B}, 'block ' || (c_custkey // 12) from customer
         where (c_custkey // 12) % 5 <> 0),
  lab as (select occ.w, coalesce(a.label, '') as sl, coalesce(b.label, '') as dl
          from occ left join vl a on a.id = occ.src left join vl b on b.id = occ.dst),
  lv as (select row_number() over (order by label) - 1 as id, label
         from (select sl as label from lab union select dl from lab)),
  le as (select va.id as src, vb.id as dst, cast(sum(w) as bigint) as weight
         from lab join lv va on va.label = lab.sl join lv vb on vb.label = lab.dl group by all),
  low as (select id from (select src as id from le union all select dst from le) group by id having count(*) <= 2)
"""
SQL.update({
    "loyalty_edges": f"with {_LOYALTY} select src, dst, weight from le",
    "loyalty_low_degree": f"with {_LOYALTY} select id from low",
    "loyalty_low_degree_edges": f"""with {_LOYALTY}
      select * from le where src in (select id from low) or dst in (select id from low)""",
    "loyalty_low_degree_induced": f"""with {_LOYALTY}
      select * from le where src in (select id from low) and dst in (select id from low)""",
    "loyalty_components": f"with {_LOYALTY} select * from {_components('le', 'lv')}",
    "loyalty_component_lines": f"with {_LOYALTY} {_component_lines(_components('le', 'lv'))}",
    "type_counts_sorted": """
      select event_type as tag, count(*) as cnt from events group by event_type order by cnt desc, tag""",
    "window_value_stats": f"""
      select make_timestamp((epoch_us(ts) // {_DAY_US}) * {_DAY_US}) as window_start,
             make_timestamp((epoch_us(ts) // {_DAY_US}) * {_DAY_US}) + interval 1 day as window_end,
             event_type, count(*) as n, max(value) as top, min(value) as low
      from events group by all""",
})

SQL.update(stateful_sql(SQL, _TOKEN_LIST))
SQL.update(listings_sql(SQL, _between("<footer>", "</footer>")))
