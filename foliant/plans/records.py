"""Queries over whole records: nested trees, snapshot changes, dangling references."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliant.operators import nested, orphans, snapshots
from foliant.session import table, written

#: How a tree's levels are named, and the keys under which a tree may be wrapped.
LEVELS, WRAPPERS = ("divisions", "children"), ("tree", "doc_tree", "document", "data", "payload")
#: Fields that are columns whether or not a tree has them. The texts among them stay texts
#: (of another value its JSON); the others have the type that is inferred.
P2_TEXTS = ("type", "id", "cite", "page_label", "kind", "number", "title", "text", "plain", "caption", "term", "definition", "key", "source", "abbreviation", "meaning")
P2_OTHERS = {
    "page": T.LongType(), "level": T.LongType(), "depth": T.LongType(), "grid": T.BooleanType(), "proponent": T.BooleanType(),
    "columns": T.ArrayType(T.StringType()), "rows": T.ArrayType(T.ArrayType(T.StringType())),
}


def p2_trees(spark: SparkSession, sf: str) -> tuple[DataFrame, nested.Shape]:
    """The trees, brought into one shape and written once, and their merged schema."""
    trees = written(nested.latest_readable(table(spark, sf, "doc_trees"), "pub_id", "received_at", "tree", LEVELS, WRAPPERS))
    return trees, nested.shape(trees, LEVELS[1])


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    trees, merged = p2_trees(spark, sf)
    n = nested.node_rows(trees, ["pub_id"], {"type": T.StringType()}, LEVELS[1], merged.levels, written)
    return n.select("pub_id", "ord", "parent_ord", F.col("type").alias("node_type"))


def p2_tables(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """The related tables of the trees: ``nodes``, and one per array in a node. Their
    fields are those of the schema merged over all nodes of all trees."""
    trees, merged = p2_trees(spark, sf)
    fields = dict.fromkeys(P2_TEXTS, T.StringType()) | P2_OTHERS
    fields |= {f: nested.held_type(t) for f, t in merged.fields.items() if f not in fields or f in P2_OTHERS and not isinstance(t, T.NullType)}
    n = nested.node_rows(trees, ["pub_id"], fields, LEVELS[1], merged.levels, written)
    path = F.array_join(F.col("path").cast("array<string>"), ".").alias("path")
    own = [F.col(f"`{c}`") for c in n.columns if c not in ("pub_id", "path", "ord", "parent_ord")]
    return nested.relate(n.select("pub_id", "ord", "parent_ord", path, *own), ["pub_id", "ord"], "nodes")


def p2_node_table(spark: SparkSession, sf: str) -> DataFrame:
    """The flat node rows with all their fields but arrays, and the parent's ordinal."""
    return p2_tables(spark, sf)["nodes"]


def p2_node_arrays(spark: SparkSession, sf: str) -> DataFrame:
    """The elements of the arrays in nodes, one child table under the other: ``_parent_id`` is
    the ``_id`` of the node, or of the outer element for an array in an array, which has no
    value of its own; an element with several fields has them as JSON."""
    out: DataFrame | None = None
    for path, t in p2_tables(spark, sf).items():
        if path == "nodes":
            continue
        own = [c for c in t.columns if c not in ("_id", "_parent_id", "_pos")]
        value = F.lit(None) if not own else F.col("value") if own == ["value"] else F.to_json(F.struct(*[F.col(f"`{c}`") for c in own]))
        got = t.select(F.lit(path).alias("array_path"), "_id", "_parent_id", "_pos", value.cast("string").alias("value"))
        out = got if out is None else out.unionByName(got)
    return out if out is not None else spark.createDataFrame([], "array_path string, _id string, _parent_id string, _pos int, value string")


P5 = {
    "publications": (["pub_id"], ["title", "pub_date", "supersedes", "page_count", "sha256", "proponent"], "fetched_at"),
    "para_snapshots": (["pub_id", "number"], ["plain"], None),
}


def p5_changes(spark: SparkSession, sf: str, values: bool = False) -> list[tuple[str, DataFrame]]:
    """Per table its changes, snapshot by snapshot through an index."""
    return [(name, snapshots.changes_over(table(spark, sf, name), "snapshot_on", key, compared, latest, values)) for name, (key, compared, latest) in P5.items()]


def p5_cols(name: str) -> list[Column]:
    # a null key part stays apart from an empty one and from a missing one
    key = F.concat_ws("/", *[F.coalesce(k, F.lit("\\N")) for k in P5[name][0]]) if len(P5[name][0]) > 1 else F.col(P5[name][0][0])
    return [F.lit(name).alias("src"), F.date_format("snapshot_on", "yyyy-MM-dd").alias("snapshot_on"), key.alias("record_key")]


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    return functools.reduce(DataFrame.unionByName, [got.select(*p5_cols(name), snapshots.KIND) for name, got in p5_changes(spark, sf)])


def p5_values(spark: SparkSession, sf: str) -> DataFrame:
    """Each compared value that differs, before and after, of the changed records."""
    out: list[DataFrame] = []
    for name, got in p5_changes(spark, sf, values=True):
        each = [F.struct(F.lit(c).alias("column_name"), F.col(f"old.{c}").cast("string").alias("old_value"), F.col(f"new.{c}").cast("string").alias("new_value")) for c in P5[name][1]]
        got = got.where(F.col(snapshots.KIND) == "changed").select(*p5_cols(name), F.inline(F.array(*each)))
        out.append(got.where(~snapshots.folded("old_value").eqNullSafe(snapshots.folded("new_value"))))
    return functools.reduce(DataFrame.unionByName, out)


def p6_refs(spark: SparkSession, sf: str) -> DataFrame:
    """All references in one table: ref_table, pub_id, ref_key, target, key, recorded_at. The
    key parts may be null: what that means is the operator's to say."""

    def refs(name: str, key: str, target: str) -> DataFrame:
        bare = F.regexp_replace(target, r"^[ \t]+|[ \t]+$", "").alias("key")
        return table(spark, sf, name).select(F.lit(name).alias("ref_table"), "pub_id", F.col(key).cast("string").alias("ref_key"), F.col(target).alias("target"), bare, "recorded_at")

    return refs("claim_cites", "claim_id", "node_id").unionAll(refs("slides", "slide_id", "source_table")).unionAll(refs("review_findings", "finding_no", "claim"))


def p6_targets(spark: SparkSession, sf: str) -> DataFrame:
    """What each table's references may name, and when it is there."""
    n = table(spark, sf, "nodes").select("pub_id", F.col("id").alias("key"), "type", F.col("loaded_at").alias("since"), F.col("dropped_at").alias("until"))
    # one scan: a table node is the target of two kinds of references
    named = F.explode(F.when(F.col("type") == "table", F.array(F.lit("claim_cites"), F.lit("slides"))).otherwise(F.array(F.lit("claim_cites"))))
    n = n.select(named.alias("ref_table"), "pub_id", "key", "since", "until")
    c = table(spark, sf, "claims").select(F.lit("review_findings").alias("ref_table"), "pub_id", F.col("claim_id").alias("key"), F.col("made_at").alias("since"), F.col("withdrawn_at").alias("until"))
    return n.unionByName(c)


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    key = ("ref_table", "pub_id", "key")
    got = orphans.orphans(p6_refs(spark, sf), p6_targets(spark, sf), dict(zip(key, key)), "recorded_at", "since", "until", "simple")
    return got.select("ref_table", F.date_format("recorded_at", "yyyy-MM").alias("ref_month"), "pub_id", "ref_key", "target", "reason").distinct()


def p6_report(spark: SparkSession, sf: str) -> DataFrame:
    """References and orphans per table and month."""
    refs = p6_refs(spark, sf).where("target is not null").distinct().select("ref_table", F.date_format("recorded_at", "yyyy-MM").alias("ref_month"))
    return orphans.rates(p6_found(spark, sf).drop("reason"), refs, ["ref_table", "ref_month"])


QUERIES = {f.__name__: f for f in (p2_found, p2_node_table, p2_node_arrays, p5_found, p5_values, p6_found, p6_report)}

_FOLD = "nullif(trim(regexp_replace(lower(cast({0} as varchar)), '\\s+', ' ', 'g')), '')"


def _p5_sql(name: str) -> str:
    key, compared, latest = P5[name]
    ks = ", ".join(key)
    rec = " || '/' || ".join(key)
    order = f"{latest} desc nulls last" if latest else "1"
    vals = ", ".join(f"{_FOLD.format(c)} as {c}" for c in compared)
    same = " and ".join(f"a.{c} is not distinct from b.{c}" for c in compared)
    on = " and ".join(f"a.{k} = b.{k}" for k in key)
    return f"""
    select '{name}' as src, snapshot_on, record_key, change_kind from (
      with s as (select snapshot_on, {ks}, {vals} from (select *, row_number() over (partition by snapshot_on, {ks} order by {order}) rn from {name}) where rn = 1),
      d as (select snapshot_on as b_on, lag(snapshot_on) over (order by snapshot_on) as a_on from (select distinct snapshot_on from {name})),
      a as (select d.b_on, s.* from s join d on s.snapshot_on = d.a_on),
      b as (select d.b_on, s.* from s join d on s.snapshot_on = d.b_on where d.a_on is not null)
      select strftime(coalesce(a.b_on, b.b_on), '%Y-%m-%d') as snapshot_on, {" || '/' || ".join(f"coalesce(a.{k}, b.{k})" for k in key)} as record_key,
        case when a.{key[0]} is null then 'added' when b.{key[0]} is null then 'removed' else 'changed' end as change_kind
      from a full join b on a.b_on = b.b_on and {on}
      where a.{key[0]} is null or b.{key[0]} is null or not ({same}))"""


def _p5_values_sql(name: str) -> str:
    key, compared, latest = P5[name]
    ks = ", ".join(key)
    hashed = " || chr(31) || ".join(f"coalesce('=' || {_FOLD.format(c)}, '-')" for c in compared)
    rows = f"(select *, row_number() over (partition by snapshot_on, {ks} order by {latest + ' desc nulls last, ' if latest else ''}md5({hashed}) desc) as rn from {name})"
    each = " union all ".join(
        f"select '{name}' as src, strftime(b.snapshot_on, '%Y-%m-%d') as snapshot_on, {' || chr(47) || '.join(f'b.{k}' for k in key)} as record_key, '{c}' as column_name, cast(a.{c} as varchar) as old_value, cast(b.{c} as varchar) as new_value "
        f"from s a join s b on {' and '.join(f'a.{k} = b.{k}' for k in key)} and a.snapshot_on = (select max(snapshot_on) from s x where x.snapshot_on < b.snapshot_on) where {_FOLD.format('a.' + c)} is distinct from {_FOLD.format('b.' + c)}"
        for c in compared
    )
    return f"select * from (with s as (select * from {rows} where rn = 1) {each})"


def _p6_sql(name: str, key: str, target: str, ttable: str, tid: str, since: str, until: str, cond: str = "true") -> str:
    return f"""
    select '{name}' as ref_table, strftime(r.recorded_at at time zone 'UTC', '%Y-%m') as ref_month, r.pub_id, r.ref_key, r.target,
      case when t.n is null then 'missing' when t.last_since > r.recorded_at then 'late' else 'deleted' end as reason
    from (select distinct pub_id, cast({key} as varchar) as ref_key, {target} as target, trim({target}, ' ' || chr(9)) as k, recorded_at from {name} where {target} is not null) r
    left join (select pub_id, {tid} as k, count(*) as n, max({since}) as last_since from {ttable} where {cond} group by all) t on t.pub_id = r.pub_id and t.k = r.k
    where not exists (select 1 from {ttable} x where x.pub_id = r.pub_id and x.{tid} = r.k and {cond} and x.{since} <= r.recorded_at and (x.{until} is null or r.recorded_at < x.{until}))"""


_P6 = " union ".join([
    _p6_sql("claim_cites", "claim_id", "node_id", "nodes", "id", "loaded_at", "dropped_at"),
    _p6_sql("slides", "slide_id", "source_table", "nodes", "id", "loaded_at", "dropped_at", "type = 'table'"),
    _p6_sql("review_findings", "finding_no", "claim", "claims", "claim_id", "made_at", "withdrawn_at"),
])

def _kids_sql(c: str) -> str:
    """The objects among the children as given, as JSON[]."""
    v = f"case when json_type({c}) = 'VARCHAR' then case when json_valid({c} ->> '$') then cast({c} ->> '$' as json) end else {c} end"
    return f"list_filter(case json_type({v}) when 'OBJECT' then [{v}] when 'ARRAY' then from_json({v}, '[\"JSON\"]') else [] end, lambda e: json_type(e) = 'OBJECT')"


# layer by layer out of its wrapping, then level by level down the tree
_P2 = """
with recursive u as (
    select pub_id, received_at, cast(tree as json) as j, 0 as step from doc_trees where json_valid(tree)
    union all
    select pub_id, received_at, case json_type(j) when 'VARCHAR' then cast(j ->> '$' as json) when 'ARRAY' then j -> 0 else coalesce(j -> 'tree', j -> 'doc_tree', j -> 'document', j -> 'data', j -> 'payload') end, step + 1 from u
    where json_type(j) = 'VARCHAR' and json_valid(j ->> '$') or json_type(j) = 'ARRAY' and json_array_length(j) = 1 and json_type(j -> 0) = 'OBJECT'
      or json_type(j) = 'OBJECT' and not json_exists(j, '$.divisions') and (json_exists(j, '$.tree') or json_exists(j, '$.doc_tree') or json_exists(j, '$.document') or json_exists(j, '$.data') or json_exists(j, '$.payload'))),
  d as (select pub_id, received_at, j -> 'divisions' as top from u where json_type(j) = 'OBJECT' and json_exists(j, '$.divisions')),
  r as (select pub_id, arg_max(top, received_at) as top from d where json_type(top) <> 'VARCHAR' or trim(top ->> '$') = '' or json_valid(top ->> '$') group by pub_id),
  n as (
    select pub_id, [i] as path, x from (select pub_id, unnest(xs) as x, generate_subscripts(xs, 1) as i from (select pub_id, __TOP__ as xs from r))
    union all
    select pub_id, list_append(path, i), y from (select pub_id, path, unnest(xs) as y, generate_subscripts(xs, 1) as i from (select pub_id, path, __KIDS__ as xs from n)))
  , o as (select pub_id, path, row_number() over (partition by pub_id order by path) as ord, x ->> 'type' as node_type from n)
select o.pub_id, cast(o.ord as int) as ord, cast(coalesce(p.ord, 0) as int) as parent_ord, o.node_type from o left join o p on p.pub_id = o.pub_id and p.path = o.path[:len(o.path) - 1]
""".replace("__TOP__", _kids_sql("top")).replace("__KIDS__", _kids_sql("(x -> 'children')"))

SQL = {
    "p2_found": _P2,
    "p5_found": _p5_sql("publications") + " union all " + _p5_sql("para_snapshots"),
    "p5_values": _p5_values_sql("publications") + " union all " + _p5_values_sql("para_snapshots"),
    "p6_found": _P6,
    "p6_report": f"""
    select r.ref_table, r.ref_month, r."references", coalesce(o.orphans, 0) as orphans from (
      select ref_table, strftime(recorded_at at time zone 'UTC', '%Y-%m') as ref_month, count(*) as "references" from (
        select distinct 'claim_cites' as ref_table, pub_id, claim_id as k, node_id as t, recorded_at from claim_cites where node_id is not null
        union all select distinct 'slides', pub_id, slide_id, source_table, recorded_at from slides where source_table is not null
        union all select distinct 'review_findings', pub_id, cast(finding_no as varchar), claim, recorded_at from review_findings where claim is not null)
      group by all) r
    left join (select ref_table, ref_month, count(*) as orphans from ({_P6}) group by all) o on o.ref_table = r.ref_table and o.ref_month = r.ref_month""",
}
