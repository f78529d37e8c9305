"""Nested records to related flat tables.

``relate`` turns a DataFrame with arrays of structs into one table per array level.
JSON documents whose levels repeat (a node holds nodes) are first brought into one shape,
then read once with the schema merged over all of them (``shape``, ``typed``), and each
array level is exploded into a child table of the one above (``child_tables``). Both
carry the parent's surrogate key and the ordinal in the array. Exploding runs inside one
row at a time, so a document's size, not a key's frequency, bounds a task's memory.
"""

from __future__ import annotations

import functools
import json
import re
from collections.abc import Callable
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


# --- merged schema -----------------------------------------------------------
def merged_schema(df: DataFrame, col: str) -> T.DataType:
    """The schema that covers every JSON string of ``col`` (unreadable ones are
    left out). Partial schemas are merged on the executors; one type comes back.
    A null-only or empty column gives ``VOID``."""
    return _merged(df, col)[0]


def _merged(df: DataFrame, col: str) -> tuple[T.DataType, int]:
    """``merged_schema`` and how many strings were left out."""
    p = df.where(F.col(col).isNotNull()).select(F.try_parse_json(F.col(col)).alias("p"))
    one, lost = p.agg(F.schema_of_variant_agg("p"), F.count_if(F.col("p").isNull())).first()
    ddl = (one or "VOID").replace("OBJECT<", "STRUCT<")
    return T._parse_datatype_string(ddl) if ddl not in ("VOID", "VARIANT") else T.NullType(), lost


def held_type(t: T.DataType) -> T.DataType:
    """``t`` as a column can hold it: what has several types, none or no fields is JSON text."""
    if isinstance(t, T.ArrayType):
        return T.ArrayType(held_type(t.elementType), True)
    if isinstance(t, T.StructType) and t.fields:
        return T.StructType([T.StructField(f.name, held_type(f.dataType), True) for f in t.fields])
    return T.StringType() if isinstance(t, (T.StructType, T.VariantType, T.NullType)) else t


def _free(base: str, taken: set[str]) -> str:
    """``base``, or with a number where that is taken in any letter case; taken from now on."""
    n, at = 1, base
    while at.lower() in taken:
        n += 1
        at = f"{base}_{n}"
    taken.add(at.lower())
    return at


# --- arrays of structs, statically typed -------------------------------------
def relate(df: DataFrame, key: list[str], name: str = "root") -> dict[str, DataFrame]:
    """Flat tables of a nested DataFrame: ``name`` plus one table per array level,
    named by its path (``root.orders.items``).

    Each table has ``_id`` (surrogate: the row's key and ordinals, joined by '/'),
    and each child ``_parent_id`` and ``_pos`` (ordinal from 0). Structs become
    columns ``a_b`` (``a_b_2`` where that name is taken, also by ``_id``,
    ``_parent_id`` or ``_pos``). An empty or null array gives no child rows, a null
    element a row of nulls. Arrays of scalars give a ``value`` column. Key columns
    may be null (rendered as \\N); rows that repeat give equal surrogates.
    """
    ident = F.concat_ws("/", *[F.coalesce(F.col(k).cast("string"), F.lit("\\N")) for k in key])
    out: dict[str, DataFrame] = {}

    def level(frame: DataFrame, value: Column, dtype: T.DataType, keep: list[Column], path: str) -> None:
        taken: set[str] = {"_id", "_parent_id", "_pos"}
        cols: list[Column] = []
        arrays: list[tuple[str, Column, T.ArrayType]] = []

        def walk(v: Column, t: T.DataType, label: str) -> None:
            if isinstance(t, T.StructType):
                for f in t.fields:
                    walk(v.getField(f.name), f.dataType, f"{label}_{f.name}" if label else f.name)
            elif isinstance(t, T.ArrayType):
                arrays.append((label, v, t))
            else:
                at = _free(label or "value", taken)
                cols.append(v.alias(at))

        walk(value, dtype, "")
        out[path] = frame.select(*keep, *cols)
        for label, v, t in arrays:
            kid = frame.select(F.col("_id").alias("_parent_id"), F.posexplode(v).alias("_pos", "_v"))
            kid = kid.withColumn("_id", F.concat_ws("/", "_parent_id", F.concat(F.lit(label + ":"), F.col("_pos"))))
            level(kid, F.col("_v"), t.elementType, [F.col("_id"), F.col("_parent_id"), F.col("_pos")], f"{path}.{label or 'items'}")

    top = df.select(ident.alias("_id"), F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_v"))
    level(top, F.col("_v"), df.schema, [F.col("_id")], name)
    return out


# --- documents that nest in themselves ----------------------------------------
#: Levels that one piece of a document holds; deeper nodes are pieces of their own, so no
#: plan and no schema is deeper than this, however deep a document is.
LEVELS = 8
#: Deepest value of a field; a deeper one comes out as null.
FIELD_DEPTH = 400
_TOKEN = re.compile(r'\s*([{}\[\],:]|"(?:[^"\\]|\\.)*"|[^\s{}\[\],:"]+)', re.S)


def loads(text: str):
    """``json.loads`` for values of any depth."""
    try:
        return json.loads(text)
    except RecursionError:
        pass
    top: list = []
    held, at, end = [top], 0, len(text.rstrip())
    name, after, comma = [None], False, False  # after: a value has just ended; comma: one must follow
    while at < end:
        m = _TOKEN.match(text, at)
        if m is None:
            raise ValueError(f"at {at}")
        at, tok, box = m.end(), m[1], held[-1]
        if tok in "]}":
            if len(held) == 1 or comma or isinstance(box, list) != (tok == "]") or name[-1] is not None:
                raise ValueError(tok)
            held.pop()
            name.pop()
            after = True
            continue
        if tok in ",:":
            if (tok == ",") != after or tok == "," and len(held) == 1 or tok == ":" and not (isinstance(box, dict) and comma is None):
                raise ValueError(tok)
            after, comma = False, tok == ","
            continue
        if after or comma is None:
            raise ValueError(tok)
        if isinstance(box, dict) and name[-1] is None:
            name[-1], comma = json.loads(tok), None
            if not isinstance(name[-1], str):
                raise ValueError(tok)
            continue
        value = {} if tok == "{" else [] if tok == "[" else json.loads(tok)
        if isinstance(box, dict):
            box[name[-1]], name[-1] = value, None
        else:
            box.append(value)
        after, comma = tok not in "{[", False
        if not after:
            held.append(value)
            name.append(None)
    if len(held) != 1 or len(top) != 1:
        raise ValueError("not ended")
    return top[0]


def _objects(held) -> list[dict]:
    """The node objects among the children as given: an array, one object in its place and a
    JSON string of either count; what is no object doesn't."""
    if isinstance(held, str):
        try:
            held = loads(held)
        except ValueError:
            return []
    return [x for x in ([held] if isinstance(held, dict) else held if isinstance(held, list) else []) if isinstance(x, dict)]


def _shallow(value) -> bool:
    level, n = [value], 0
    while level:
        n += 1
        level = [y for x in level for y in (x.values() if isinstance(x, dict) else x) if isinstance(y, (dict, list))]
        if n > FIELD_DEPTH:
            return False
    return True


def pieces(text: str | None, lists: tuple[str, str], wrappers: tuple[str, ...]) -> list[tuple[list[int], str]] | None:
    """A document's nodes in one shape: (ordinals of the parent, JSON array of node objects)
    for the first level and for each array of children below every ``LEVELS`` levels. Children
    are arrays of objects throughout. None if the text isn't such a document."""
    try:
        doc = loads(text) if text else None
        while True:  # every step goes one layer in
            if isinstance(doc, str):
                doc = loads(doc)
            elif isinstance(doc, list) and len(doc) == 1 and isinstance(doc[0], dict):
                doc = doc[0]
            elif isinstance(doc, dict) and lists[0] not in doc and (w := next((w for w in wrappers if w in doc), None)):
                doc = doc[w]
            else:
                break
        if not isinstance(doc, dict) or lists[0] not in doc:
            return None
        top = doc[lists[0]]
        if isinstance(top, str) and top.strip():
            loads(top)  # a first level that can't be read makes the document unreadable
    except ValueError:
        return None
    out: list[tuple[list[int], str]] = []
    roots: list[tuple[list[int], list[dict]]] = [([], _objects(top))]
    while roots:
        prefix, nodes = roots.pop()
        level = [(prefix, nodes)]
        for k in range(LEVELS):
            below = []
            for at, group in level:
                for i, x in enumerate(group, 1):
                    kids = _objects(x.pop(lists[1], None))
                    for f, v in x.items():
                        if isinstance(v, (dict, list)) and not _shallow(v):
                            x[f] = None
                    if kids:
                        below.append(([*at, i], kids))
                        if k + 1 < LEVELS:
                            x[lists[1]] = kids
            level = below
        roots += level
        out.append((prefix, json.dumps(nodes, ensure_ascii=False)))
    return out


def readable(df: DataFrame, col: str, lists: tuple[str, str], wrappers: tuple[str, ...] = ()) -> DataFrame:
    """``df`` with ``_pieces`` (null if unreadable): see ``pieces``. A document may be a JSON
    object, one in a list of one, under one of the keys ``wrappers``, or any of these encoded
    again as a JSON string."""

    @F.pandas_udf("array<struct<prefix:array<int>,body:string>>")
    def unpack(s: pd.Series) -> pd.Series:
        return s.map(lambda x: None if (got := pieces(x, lists, wrappers)) is None else [{"prefix": a, "body": b} for a, b in got])

    return df.select(*[F.col(f"`{c}`") for c in df.columns if c != "_pieces"], unpack(F.col(col).cast("string")).alias("_pieces"))


def latest_readable(df: DataFrame, key: str, order: str, col: str, lists: tuple[str, str], wrappers: tuple[str, ...]) -> DataFrame:
    """Of each ``key`` the readable document with the greatest ``order`` (ties: the
    greater pieces). Rows with a null key or order are kept (a null order is least)."""
    got = readable(df.select(key, order, col), col, lists, wrappers).where(F.col("_pieces").isNotNull())
    return got.groupBy(key).agg(F.max_by("_pieces", F.struct(order, "_pieces")).alias("_pieces"))


def _wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """A type for the values of both; JSON text where there is none."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(_wider(a.elementType, b.elementType))
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        got = {f.name: f.dataType for f in a.fields}
        for f in b.fields:
            got[f.name] = _wider(got[f.name], f.dataType) if f.name in got else f.dataType
        return T.StructType([T.StructField(n, t) for n, t in got.items()])
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        return T.DoubleType()
    return T.StringType()


@dataclass(frozen=True)
class Shape:
    """What ``merged_schema`` tells of self-nesting documents: the node fields of all levels
    (``kids`` apart), and how many levels a piece has."""

    fields: dict[str, T.DataType]
    levels: int


def shape(docs: DataFrame, kids: str) -> Shape:
    """The merged schema over all pieces of all documents, its levels laid over one another."""
    # levels and fields are inferred from every piece: one that can't be read must not be passed over
    at, lost = _merged(docs.select(F.explode("_pieces.body").alias("b")), "b")
    if lost:
        raise ValueError(f"{lost} pieces of documents are too large to be read")
    fields: T.DataType = T.NullType()
    n = 0
    while isinstance(at, T.ArrayType) and isinstance(at.elementType, T.StructType):
        n += 1
        own = {f.name: f.dataType for f in at.elementType.fields}
        at = own.pop(kids, T.NullType())
        fields = _wider(fields, T.StructType([T.StructField(f, t) for f, t in own.items()]))
    return Shape({f.name: f.dataType for f in fields.fields} if isinstance(fields, T.StructType) else {}, n)


def typed(docs: DataFrame, key: list[str], kids: str, fields: dict[str, T.DataType], levels: int) -> DataFrame:
    """``key``, ``prefix`` and ``v``: each piece as nested arrays of structs, read once with the
    merged schema. Fields go by place (f0, f1, ..), as names may differ by letter case only. A
    piece that is too large to be read (128 MB, or a single text of tens of millions of signs) is
    an error, never a loss."""
    named, placed = None, None
    for _ in range(levels):
        own = [T.StructField(f, t) for f, t in fields.items()] + ([T.StructField(kids, named)] if named else [])
        at = [T.StructField(f"f{i}", t) for i, t in enumerate(fields.values())] + ([T.StructField("kids", placed)] if placed else [])
        named, placed = T.ArrayType(T.StructType(own)), T.ArrayType(T.StructType(at))
    each = docs.select(*[F.col(f"`{k}`") for k in key], F.inline("_pieces"))
    lost = F.raise_error(F.lit("a piece of a document is too large to be read")).cast(placed)
    return each.select(*[F.col(f"`{k}`") for k in key], "prefix", F.coalesce(F.from_json("body", named).cast(placed), lost).alias("v"))


def child_tables(pieces_: DataFrame, key: list[str], n_fields: int, levels: int) -> list[DataFrame]:
    """One table per array level of ``typed`` pieces, each exploded from the one above: ``key``,
    ``_id`` (with the key a node's surrogate: the ordinals from 1 on the way to it),
    ``_parent_id``, carried from the parent (empty for the first level), ``_pos`` (ordinal in
    its array from 0) and the fields f0, f1, .."""
    keys = [F.col(f"`{k}`") for k in key]
    out: list[DataFrame] = []
    at = pieces_.select(*keys, F.col("prefix").alias("_parent_id"), F.posexplode("v").alias("_pos", "_v"))
    for k in range(levels):
        at = at.select("*", F.concat("_parent_id", F.array(F.col("_pos") + 1)).alias("_id"))
        out.append(at.select(*keys, "_id", "_parent_id", "_pos", *[F.col(f"_v.f{i}").alias(f"f{i}") for i in range(n_fields)]))
        if k + 1 < levels:
            at = at.select(*keys, F.col("_id").alias("_parent_id"), F.posexplode("_v.kids").alias("_pos", "_v"))
    return out


def node_rows(docs: DataFrame, key: list[str], fields: dict[str, T.DataType], kids: str, levels: int, keep: Callable[[DataFrame], DataFrame] = lambda d: d) -> DataFrame:
    """The child tables of all levels as one: ``key``, ``ord`` (depth-first from 1 in its
    document), ``parent_ord`` (0 at the first level), ``path`` (ordinals) and ``fields``; one whose
    name is taken becomes ``name_2``. ``keep`` materialises the typed pieces, which each level
    reads. The order stands over one document, no larger than a row of the input was; a node
    finds its parent's number by the key that it carries. Without nodes there are no rows."""
    taken = {k.lower() for k in key} | {"path", "ord", "parent_ord"}
    names = [_free(f, taken) for f in fields]
    if not levels:
        own = [T.StructField("path", T.ArrayType(T.IntegerType())), T.StructField("ord", T.IntegerType()), T.StructField("parent_ord", T.IntegerType())]
        return docs.sparkSession.createDataFrame([], T.StructType([docs.schema[k] for k in key] + own + [T.StructField(n, t) for n, t in zip(names, fields.values())]))
    tables = child_tables(keep(typed(docs, key, kids, fields, levels)), key, len(fields), levels)
    n = functools.reduce(DataFrame.unionByName, tables)
    n = n.withColumn("ord", F.row_number().over(Window.partitionBy(*key).orderBy("_id")))
    up = n.select(*[F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(key)], F.col("_id").alias("_up"), F.col("ord").alias("_o"))
    on = [F.col(f"`{k}`").eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(key)]
    n = n.join(up, [*on, F.col("_parent_id") == F.col("_up")], "left")
    return n.select(*[F.col(f"`{k}`") for k in key], F.col("_id").alias("path"), "ord", F.coalesce("_o", F.lit(0)).alias("parent_ord"), *[F.col(f"f{i}").alias(n_) for i, n_ in enumerate(names)])
