"""Oracle SQL: for each registered query, a text DuckDB runs on the driver's tables.

The common table expressions below are the bindings of FIXTURES.md section 2. Every
computed column is aliased to the name the Spark query produces, and every sum is
cast to ``bigint`` (DuckDB would give HUGEINT).
"""

from __future__ import annotations

FX_TABLE_INFO = """
fx_table_info as (
  select concat('table_', cast(c_custkey as varchar)) as table_id, c_name as table_name,
    case when k = 3 then 'ns_MOVED2' when k >= 1 and c_custkey % 21 = 0 then 'ns_MOVED'
      else concat('ns_', c_mktsegment) end as table_namespace,
    concat('domain_', cast(c_nationkey as varchar)) as domain,
    concat('user_', cast(c_custkey % 40 as varchar)) as creator,
    op as commit_op, c_custkey * 13 * (1 + k) + k as seq
  from (select *, 0 as k, 'create' as op from customer
        union all select *, 1 as k, 'update' as op from customer where c_custkey % 7 = 0
        union all select *, 2 as k, 'delete' as op from customer where c_custkey % 11 = 0
        union all select *, 3 as k, 'update' as op from customer where c_custkey % 35 = 0) c)"""

FX_PARTITION_INFO = """
fx_partition_info as (
  select concat('table_', cast(o_custkey as varchar)) as table_id,
    case when o_orderkey % 97 <> 0 then concat('year=', cast(year(o_orderdate) as varchar)) end as partition_desc,
    case when o_orderkey % 5 = 0 then 'delete' when o_orderkey % 3 = 0 then 'update' else 'create' end as commit_op,
    o_orderkey as seq
  from orders)"""

FX_FILE_OPS = """
fx_file_ops as (
  select l_orderkey,
    case when l_linenumber = 1 and l_orderkey % 101 = 0 then 'broken' else
    concat('(s3://b/', cast(l_orderkey as varchar), '/', cast(l_linenumber as varchar), '.parquet,',
      case when l_returnflag = 'R' then 'del' else 'add' end, ',',
      case when l_linenumber = 1 and l_orderkey % 107 = 0 then 'none'
        else cast(cast(floor(l_extendedprice) as bigint) as varchar) end, ',"c1,c2")') end as file_op
  from lineitem)"""

FX_FILE_STATS = """
fx_file_stats as (
  select l_orderkey,
    cast(sum(case when action = 'add' then 1 else 0 end) as bigint) as file_count,
    cast(sum(case when action = 'add' then coalesce(size, 0) else 0 end) as bigint) as file_bytes,
    case when bool_or(action = '') then 'unparsed_file_op'
      when bool_or(action = 'add' and size is null) then 'bad_file_size' end as problem
  from (
    select l_orderkey,
      regexp_extract(file_op, '[(]([^,]+),([^,]+),([^,]+),"([^"]+)"[)]', 2) as action,
      try_cast(regexp_extract(file_op, '[(]([^,]+),([^,]+),([^,]+),"([^"]+)"[)]', 3) as bigint) as size
    from fx_file_ops) p
  group by l_orderkey)"""

FX_COMMIT = """
fx_commit as (
  select concat('table_', cast(o_custkey as varchar)) as table_id,
    cast(o_orderkey as varchar) as commit_id, o_orderkey as seq,
    o_orderstatus <> 'P' as committed,
    case when o_orderkey % 13 = 0 then 'delete' else 'create' end as commit_op,
    case when o_orderkey % 103 = 0 then 0 else file_count end as file_count,
    case when o_orderkey % 103 = 0 then 0 else file_bytes end as file_bytes,
    case when o_orderkey % 103 = 0 then 'missing_file_ops' else problem end as problem
  from orders join fx_file_stats g on l_orderkey = o_orderkey)"""

TI = """
ti as (
  select table_id,
    max_by(table_name, seq) filter (where commit_op <> 'delete') as table_name,
    max_by(table_namespace, seq) filter (where commit_op <> 'delete') as namespace,
    max_by(domain, seq) filter (where commit_op <> 'delete') as domain,
    max_by(creator, seq) filter (where commit_op <> 'delete') as creator,
    max_by(commit_op, seq) as op
  from fx_table_info group by table_id)"""

PL = """
pl as (
  select table_id, partition_desc, max_by(commit_op, seq) as op
  from fx_partition_info where partition_desc is not null group by table_id, partition_desc)"""

PC = """
pc as (
  select table_id, cast(sum(case when op <> 'delete' then 1 else 0 end) as bigint) as partition_counts
  from pl group by table_id)"""

DC = """
dc as (
  select table_id,
    cast(sum(case when commit_op = 'delete' then -file_count else file_count end) as bigint) as file_counts,
    cast(sum(case when commit_op = 'delete' then -file_bytes else file_bytes end) as bigint) as file_total_size
  from fx_commit where problem is null and (commit_op = 'delete' or committed) group by table_id)"""

TA = """
fx_table_assets as (
  select ti.table_id, table_name, domain, creator, namespace, op, partition_counts, file_counts, file_total_size
  from ti join pc on ti.table_id = pc.table_id join dc on ti.table_id = dc.table_id)"""

ALL_CTES = [FX_TABLE_INFO, FX_PARTITION_INFO, FX_FILE_OPS, FX_FILE_STATS, FX_COMMIT,
            TI, PL, PC, DC, TA]


def with_ctes(body: str) -> str:
    return "with " + ",".join(ALL_CTES) + "\n" + body


GROUP_ASSETS = """
hist as (
  select distinct i.{src} as {key}
  from fx_table_info i join fx_table_assets a on i.table_id = a.table_id
  where i.commit_op <> 'delete' and i.{src} is not null),
live as (
  select {key}, count(*) as table_counts, cast(sum(partition_counts) as bigint) as partition_counts,
    cast(sum(file_counts) as bigint) as file_counts, cast(sum(file_total_size) as bigint) as file_total_size
  from fx_table_assets where op <> 'delete' group by {key})
select hist.{key}, {cast}(coalesce(table_counts, 0) as {it}) as table_counts,
  {cast}(coalesce(partition_counts, 0) as {it}) as partition_counts,
  {cast}(coalesce(file_counts, 0) as {it}) as file_counts,
  cast(coalesce(file_total_size, 0) as bigint) as file_total_size
from hist left join live on hist.{key} = live.{key}"""

USER_ASSETS = """
hist as (
  select i.creator, count(distinct i.domain) as domain_counts, count(distinct i.table_namespace) as namespace_counts
  from fx_table_info i join fx_table_assets a on i.table_id = a.table_id
  where i.commit_op <> 'delete' and i.creator is not null group by i.creator),
live as (
  select creator, count(*) as table_counts, cast(sum(partition_counts) as bigint) as partition_counts,
    cast(sum(file_counts) as bigint) as file_counts, cast(sum(file_total_size) as bigint) as file_total_size
  from fx_table_assets where op <> 'delete' group by creator)
select hist.creator, cast(domain_counts as {it}) as domain_counts,
  cast(namespace_counts as {it}) as namespace_counts,
  cast(coalesce(table_counts, 0) as {it}) as table_counts,
  cast(coalesce(partition_counts, 0) as {it}) as partition_counts,
  cast(coalesce(file_counts, 0) as {it}) as file_counts,
  cast(coalesce(file_total_size, 0) as bigint) as file_total_size
from hist left join live on hist.creator = live.creator"""


def group_assets_sql(key: str, int_counts: bool = False) -> str:
    src = "table_namespace" if key == "namespace" else key
    return with_ctes("," + GROUP_ASSETS.format(
        key=key, src=src, cast="cast", it="integer" if int_counts else "bigint"))


def user_assets_sql(int_counts: bool = False) -> str:
    return with_ctes("," + USER_ASSETS.format(it="integer" if int_counts else "bigint"))


def table_assets_sql(int_counts: bool = False, with_op: bool = True) -> str:
    it = "integer" if int_counts else "bigint"
    op = ", op" if with_op else ""
    return with_ctes(
        f"select table_id, table_name, domain, creator, namespace{op}, "
        f"cast(partition_counts as {it}) as partition_counts, cast(file_counts as {it}) as file_counts, "
        "file_total_size from fx_table_assets")


def _union_catalog(select_ti: str, select_pi: str, select_ci: str) -> str:
    return f"{select_ti} from fx_table_info union all {select_pi} from fx_partition_info " \
           f"union all {select_ci} from fx_commit"


PATTERN = """'[(]([^,]+),([^,]+),([^,]+),"([^"]+)"[)]'"""

CUT = "(select (min(o_orderkey) + max(o_orderkey)) // 2 from orders)"


REJECTS = """
select case c_custkey % 50 when 1 then 'bad_json' when 2 then 'no_position' when 3 then 'no_operation'
    else 'no_table_id' end as problem,
  case when c_custkey % 50 <> 1 then 'table_info' end as table_name,
  case c_custkey % 50 when 1 then null when 3 then 'truncate' else 'create' end as commit_op,
  case when c_custkey % 50 in (3, 4) then cast(c_custkey * 13 + 5 as bigint) end as seq,
  case when c_custkey % 50 in (2, 3) then concat('table_', cast(c_custkey as varchar)) end as table_id,
  case when c_custkey % 50 = 1 then concat('{"commitOp":"create","tableName":"table_info","after":{"table_id":"table_',
    cast(c_custkey as varchar)) end as raw
from customer where c_custkey % 50 between 1 and 4"""


def frozen_assets_sql() -> str:
    """Attributes as the first half of the log left them, where it had the table;
    measures of the whole log."""
    early = ["early_" + cte.strip().replace("from fx_table_info", f"from fx_table_info where seq <= {CUT}")
             .replace("from fx_partition_info where", f"from fx_partition_info where seq <= {CUT} and")
             .replace("from fx_commit where", f"from fx_commit where seq <= {CUT} and") for cte in (TI, PC, DC)]
    early.insert(1, "early_" + PL.strip().replace(
        "from fx_partition_info where", f"from fx_partition_info where seq <= {CUT} and"))
    early[2] = early[2].replace("from pl ", "from early_pl ")
    return with_ctes("," + ",".join(early) + """,
first as (select early_ti.* from early_ti join early_pc on early_ti.table_id = early_pc.table_id
  join early_dc on early_ti.table_id = early_dc.table_id)
select a.table_id, case when f.table_id is null then a.table_name else f.table_name end as table_name,
  case when f.table_id is null then a.domain else f.domain end as domain,
  case when f.table_id is null then a.creator else f.creator end as creator,
  case when f.table_id is null then a.namespace else f.namespace end as namespace,
  cast(a.partition_counts as integer) as partition_counts, cast(a.file_counts as integer) as file_counts,
  a.file_total_size
from fx_table_assets a left join first f on a.table_id = f.table_id""")


# Change history: one row per change, with what holds right after it.
VERSIONS = """
deltas as (
  select table_id, seq, case when commit_op = 'delete' then -file_count else file_count end as d_files,
    case when commit_op = 'delete' then -file_bytes else file_bytes end as d_bytes
  from fx_commit where problem is null and (commit_op = 'delete' or committed)),
steps as (
  select table_id, seq, case when commit_op <> 'delete' then 1 else 0 end
    - coalesce(lag(case when commit_op <> 'delete' then 1 else 0 end) over (partition by table_id, partition_desc order by seq), 0) as d
  from fx_partition_info where partition_desc is not null),
events as (
  select table_id, seq, 0 as side, case when commit_op <> 'delete' then
      {'n': table_name, 'ns': table_namespace, 'd': domain, 'c': creator} end as attrs, commit_op as op,
    0 as d, 0 as d_files, 0 as d_bytes from fx_table_info
  union all select table_id, seq, 1, null, null, d, 0, 0 from steps
  union all select table_id, seq, 2, null, null, 0, d_files, d_bytes from deltas),
known as (
  select table_id, seq, side, last_value(attrs ignore nulls) over w as attrs, last_value(op ignore nulls) over w as op,
    cast(sum(d) over w as bigint) as partition_counts, cast(sum(d_files) over w as bigint) as file_counts,
    cast(sum(d_bytes) over w as bigint) as file_total_size,
    count(*) filter (side = 0) over w as n0, count(*) filter (side = 1) over w as n1, count(*) filter (side = 2) over w as n2
  from events window w as (partition by table_id order by seq, side rows unbounded preceding)),
versions as (
  select table_id, seq, side, attrs.n as table_name, attrs.ns as namespace, attrs.d as domain, attrs.c as creator, op,
    partition_counts, file_counts, file_total_size
  from known where n0 > 0 and n1 > 0 and n2 > 0)"""

GROUP_VERSIONS = """
pairs as (
  select *, lag(op) over w as old_op, lag({key}) over w as old_key, lag(partition_counts) over w as old_p,
    lag(file_counts) over w as old_f, lag(file_total_size) over w as old_s
  from versions window w as (partition by table_id order by seq, side)),
firsts as (select table_id, min((seq, side)) as f from versions group by table_id),
seen as (
  select i.table_id, greatest((i.seq, 0), f) as p, i.table_namespace as namespace, i.domain, i.creator
  from fx_table_info i join firsts on i.table_id = firsts.table_id where i.commit_op <> 'delete'),
changes as (
  select {key} as key, seq, side, table_id, 1 as t, partition_counts as p, file_counts as f, file_total_size as s,
    0 as dom, 0 as ns from pairs where op <> 'delete'
  union all select old_key, seq, side, table_id, -1, -old_p, -old_f, -old_s, 0, 0 from pairs where old_op <> 'delete'
  union all select {key}, p[1], p[2], table_id, 0, 0, 0, 0, 0, 0 from seen
  union all select creator, p[1], p[2], p[3], 0, 0, 0, 0, 1, 0 from (
    select creator, domain, min((p[1], p[2], table_id)) as p from seen where domain is not null group by creator, domain)
    where '{key}' = 'creator'
  union all select creator, p[1], p[2], p[3], 0, 0, 0, 0, 0, 1 from (
    select creator, namespace, min((p[1], p[2], table_id)) as p from seen where namespace is not null group by creator, namespace)
    where '{key}' = 'creator'),
summed as (
  select key, seq, side, table_id, sum(t) as t, sum(p) as p, sum(f) as f, sum(s) as s, sum(dom) as dom, sum(ns) as ns
  from changes where key is not null group by all)
select key as {key}, seq, side, table_id, {seen} cast(sum(t) over w as bigint) as table_counts,
  cast(sum(p) over w as bigint) as partition_counts, cast(sum(f) over w as bigint) as file_counts,
  cast(sum(s) over w as bigint) as file_total_size
from summed window w as (partition by key order by seq, side, table_id rows unbounded preceding)"""


def versions_sql(body: str) -> str:
    return with_ctes("," + VERSIONS + body)


def group_versions_sql(key: str) -> str:
    seen = "cast(sum(dom) over w as bigint) as domain_counts, cast(sum(ns) over w as bigint) as namespace_counts," \
        if key == "creator" else ""
    return versions_sql("," + GROUP_VERSIONS.format(key=key, seen=seen))


def oracle_sql() -> dict[str, str]:
    sides = ("case when commit_op = 'delete' then table_id end as before_table_id, "
             "case when commit_op <> 'delete' then table_id end as after_table_id")
    img = "case when commit_op = 'delete' then 'before' else 'after' end as image_side, table_id"
    q = {
        "file_op_parse": with_ctes(
            "select cast(l_orderkey as varchar) as commit_id, "
            f"regexp_matches(file_op, {PATTERN}) as matched, "
            f"regexp_extract(file_op, {PATTERN}, 1) as path, "
            f"regexp_extract(file_op, {PATTERN}, 2) as action, "
            f"try_cast(regexp_extract(file_op, {PATTERN}, 3) as bigint) as size, "
            f"regexp_extract(file_op, {PATTERN}, 4) as columns "
            "from fx_file_ops where l_orderkey in (select o_orderkey from orders where o_orderkey % 103 <> 0)"),
        "commit_file_stats": with_ctes(
            "select table_id, commit_id, committed, commit_op, seq, file_count, file_bytes from fx_commit"),
        "commit_totals": with_ctes("select table_id, file_counts, file_total_size from dc"),
        "live_partition_counts": with_ctes("select table_id, partition_counts from pc"),
        "latest_table_info": with_ctes(
            "select table_id, table_name, namespace, domain, creator, op from ti"),
        "table_with_partitions": with_ctes(
            "select ti.table_id, table_name, namespace, domain, creator, op, partition_counts "
            "from ti join pc on ti.table_id = pc.table_id"),
        "table_level_assets": table_assets_sql(),
        "namespace_level_assets": group_assets_sql("namespace"),
        "domain_level_assets": group_assets_sql("domain"),
        "user_level_assets": user_assets_sql(),
        "envelope_decode": with_ctes(
            ", fx_line_counts as (select l_orderkey, count(*) as n from fx_file_ops group by l_orderkey)\n"
            f"select 'table_info' as table_name, commit_op, seq, {sides}, "
            "cast(null as bigint) as file_op_count from fx_table_info "
            f"union all select 'partition_info', commit_op, seq, {sides}, cast(null as bigint) from fx_partition_info "
            f"union all select 'data_commit_info', commit_op, seq, {sides}, case when seq % 103 <> 0 then n end "
            "from fx_commit join fx_line_counts on cast(l_orderkey as varchar) = commit_id "
            "union all select 'namespace', 'create', cast(-1 - n_nationkey as bigint), "
            "cast(null as varchar), cast(null as varchar), cast(null as bigint) from nation"),
        "row_image": with_ctes(_union_catalog(
            f"select 'table_info' as table_name, commit_op, seq, {img}",
            f"select 'partition_info', commit_op, seq, {img}",
            f"select 'data_commit_info', commit_op, seq, {img}")),
        "route_table_info": with_ctes(
            "select table_id, table_name, table_namespace, domain, creator, commit_op, seq from fx_table_info"),
        "route_partition_info": with_ctes(
            "select table_id, partition_desc, commit_op, seq from fx_partition_info"),
        "route_data_commit_info": with_ctes(
            "select table_id, commit_id, committed, commit_op, seq, file_count, file_bytes from fx_commit"),
        "cdc_scan": with_ctes(_union_catalog(
            "select 'table_info' as table_name, commit_op, seq, table_id",
            "select 'partition_info', commit_op, seq, table_id",
            "select 'data_commit_info', commit_op, seq, table_id")),
        "snapshot_bootstrap": with_ctes(
            f", cut as (select {CUT} as c), snap as ("
            "select table_id, partition_desc, max_by(commit_op, seq) as op from fx_partition_info, cut "
            "where seq <= c and partition_desc is not null group by table_id, partition_desc), "
            "tsnap as (select table_id, max_by(table_namespace, seq) filter (where commit_op <> 'delete') as ns, "
            "max_by(commit_op, seq) as op from fx_table_info, cut where seq <= c group by table_id), "
            "csnap as (select * from fx_commit, cut where seq <= c and commit_op <> 'delete')\n"
            "select 'partition_info' as table_name, table_id, partition_desc as detail, 'read' as commit_op, "
            "cast(c as bigint) as seq from snap, cut where op <> 'delete' "
            "union all select 'table_info', table_id, ns, 'read', cast(c as bigint) from tsnap, cut where op <> 'delete' "
            "union all select 'data_commit_info', table_id, commit_id, 'read', cast(c as bigint) from csnap "
            "union all select 'partition_info', table_id, partition_desc, commit_op, seq from fx_partition_info, cut where seq > c "
            "union all select 'table_info', table_id, table_namespace, commit_op, seq from fx_table_info, cut where seq > c "
            "union all select 'data_commit_info', table_id, commit_id, commit_op, seq from fx_commit, cut where seq > c"),
        "commit_total_versions": versions_sql(
            "select table_id, seq, cast(sum(d_files) over w as bigint) as file_counts, "
            "cast(sum(d_bytes) over w as bigint) as file_total_size from deltas "
            "window w as (partition by table_id order by seq rows unbounded preceding)"),
        "partition_count_versions": versions_sql(
            "select table_id, seq, cast(sum(d) over (partition by table_id order by seq rows unbounded preceding) "
            "as bigint) as partition_counts from steps"),
        "table_asset_versions": versions_sql("select * from versions"),
        "namespace_asset_versions": group_versions_sql("namespace"),
        "domain_asset_versions": group_versions_sql("domain"),
        "user_asset_versions": group_versions_sql("creator"),
        "snapshot_reconciled": with_ctes("""
, changes as (
  select 'table_info' as table_name, 0 as t, table_id, table_namespace as detail, table_id as key, commit_op, seq from fx_table_info
  union all select 'partition_info', 1, table_id, partition_desc, concat(table_id, chr(31), coalesce(partition_desc, '')), commit_op, seq
    from fx_partition_info
  union all select 'data_commit_info', 2, table_id, commit_id, concat(table_id, chr(31), commit_id), commit_op, seq from fx_commit),
placed as (
  select changes.*, (select max(o_orderkey) from orders) * (2 + ('0x' || md5(key)[:8])::bigint % 4) // 10 + 100 * t as high
  from changes),
at_high as (
  select table_name, table_id, arg_max({'d': detail, 'op': commit_op}, seq) as c, high from placed where seq <= high
  group by table_name, table_id, key, high)
select table_name, table_id, c.d as detail, 'read' as commit_op, cast(high as bigint) as seq from at_high where c.op <> 'delete'
union all select table_name, table_id, detail, commit_op, seq from placed where seq > high"""),
        "commit_quarantine": with_ctes(
            "select table_id, commit_id, commit_op, seq, problem from fx_commit where problem is not null"),
        "envelope_rejects": REJECTS,
        "upsert_frozen_table_assets": frozen_assets_sql(),
    }
    for name in ("table_level_assets", "namespace_level_assets", "domain_level_assets",
                 "user_level_assets"):
        q["feed_" + name] = q[name]
    sink = {
        "table_level_assets": table_assets_sql(int_counts=True, with_op=False),
        "namespace_level_assets": group_assets_sql("namespace", int_counts=True),
        "domain_level_assets": group_assets_sql("domain", int_counts=True),
        "user_level_assets": user_assets_sql(int_counts=True),
    }
    q["stream_table_asset_versions"] = q["table_asset_versions"]
    for name, text in sink.items():
        q["upsert_" + name.replace("_level", "")] = text
        q["stream_" + name] = text
    return q
