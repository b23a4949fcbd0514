"""Nested data: relationalize, unnest, unbox, DynamoDB-JSON flattening.

All of these are projections and ``posexplode``s — row-local work that
never groups. Schema discovery for text columns (``unbox``) is a distributed
aggregate returning one row: ``schema_of_variant_agg`` for JSON, the type
lattice of ``functions.lattice`` for CSV fields and DynamoDB numbers.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cairn.functions.lattice import csv_ddl, learnt
from cairn.session import cut_lineage


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def flatten_struct_columns(df: DataFrame, sep: str = ".") -> DataFrame:
    """``unnest``: every struct field becomes a top-level column named by its
    dotted path (``customer.name``); arrays and maps are left as they are."""
    cols: list[Column] = []

    def walk(c: Column, dtype: T.DataType, name: str):
        if isinstance(dtype, T.StructType):
            for f in dtype.fields:
                walk(c.getField(f.name), f.dataType, f"{name}{sep}{f.name}")
        else:
            cols.append(c.alias(name))

    for f in df.schema.fields:
        walk(F.col(_q(f.name)), f.dataType, f.name)
    return df.select(cols)


def with_dense_id(df: DataFrame, name: str = "id") -> DataFrame:
    """Dense ids 1..n without a single-partition window.

    The input is checkpointed into the shared checkpoint folder first, so the
    partitioning is fixed and both passes see the same rows; then a per-task
    row count (one small row per partition) gives each partition its offset,
    and ``monotonically_increasing_id`` supplies the position inside it.
    The offsets are a frame of one row per partition, joined by partition id
    (broadcast: its size is bounded by the partition count, not the data).
    """
    fixed = cut_lineage(df)
    pid = F.spark_partition_id()
    counts = (fixed.groupBy(pid.alias("pid")).agg(F.count(F.lit(1)).alias("n"))
              .orderBy("pid").collect())  # one row per partition
    rows, acc = [], 0
    for r in counts:
        rows.append((r.pid, acc))
        acc += r.n
    offsets = fixed.sparkSession.createDataFrame(rows, "__pid INT, __off BIGINT")
    local = F.monotonically_increasing_id() - (pid.cast("bigint") * F.lit(1 << 33))
    # pid and position are taken on the checkpointed scan, before the join
    tagged = fixed.withColumn("__pid", pid).withColumn("__pos", local)
    return (tagged.join(F.broadcast(offsets), "__pid")
            .withColumn(name, (F.col("__off") + F.col("__pos") + 1).cast("bigint"))
            .drop("__pid", "__off", "__pos"))


def relationalize(df: DataFrame, name: str, key: str | None = None,
                  sep: str = ".") -> dict[str, DataFrame]:
    """Nested frame → flat tables (``Relationalize``).

    Returns ``{name: root, f"{name}_{array}": child, …}``. In the root, structs
    are flattened to dotted columns and each array column is replaced by a join
    id: the value of ``key`` when given (else a dense generated id), NULL when
    the array is NULL or empty. A child table has ``id``, ``index`` (0-based)
    and the flattened element columns ``<array>.<field>`` (``<array>.val`` for
    scalar elements). Arrays nested inside elements recurse; their join id is
    the text ``"<id>_<index>"`` of the parent element.
    """
    if key is None:
        key = "__rid"
        df = with_dense_id(df, key)
    out: dict[str, DataFrame] = {}
    _relationalize(df, name, key, sep, out, drop_key=(key == "__rid"))
    return out


def _relationalize(df: DataFrame, name: str, key: str, sep: str,
                   out: dict[str, DataFrame], drop_key: bool):
    flat = flatten_struct_columns(df, sep)
    arrays = [f.name for f in flat.schema.fields
              if isinstance(f.dataType, T.ArrayType) and f.name != key]
    root_cols = []
    for f in flat.schema.fields:
        if f.name == key and drop_key:
            continue
        if f.name in arrays:
            c = F.col(_q(f.name))
            root_cols.append(F.when(F.size(c) > 0, F.col(_q(key))).alias(f.name))
        else:
            root_cols.append(F.col(_q(f.name)))
    out[name] = flat.select(root_cols)
    for a in arrays:
        child_name = f"{name}_{a.replace(sep, '_')}"
        if child_name in out:
            raise ValueError(f"two arrays map to the table {child_name}; rename one of them")
        el = flat.schema[a].dataType.elementType
        exploded = flat.select(F.col(_q(key)).alias("id"),
                               F.posexplode(F.col(_q(a))).alias("index", "_el"))
        if isinstance(el, T.StructType):
            body = exploded.select("id", "index",
                                   *[F.col("_el").getField(f.name).alias(f"{a}{sep}{f.name}")
                                     for f in el.fields])
        else:
            body = exploded.select("id", "index", F.col("_el").alias(f"{a}{sep}val"))
        nested = [f.name for f in body.schema.fields
                  if isinstance(f.dataType, (T.ArrayType, T.StructType))]
        if not nested:
            out[child_name] = body
            continue
        # recurse: the element's own join id is "<id>_<index>"
        ck = "__cid"
        body = body.withColumn(ck, F.concat_ws("_", F.col("id").cast("string"),
                                               F.col("index").cast("string")))
        sub: dict[str, DataFrame] = {}
        _relationalize(body, child_name, ck, sep, sub, drop_key=True)
        if clash := out.keys() & sub.keys():
            raise ValueError(f"two arrays map to the tables {sorted(clash)}; rename one of them")
        out.update(sub)


def unbox(df: DataFrame, col: str, fmt: str = "json", schema: str | None = None,
          sep: str = ",") -> DataFrame:
    """Parse a text column holding JSON or CSV into a struct column.

    Without a schema, one is learnt from all values: of JSON by the distributed
    ``schema_of_variant_agg`` aggregate, of CSV by a fold of every field through
    the type lattice (fields ``_c0``, ``_c1``, …). Malformed values → NULL fields.
    """
    c = F.col(_q(col))
    fmt = fmt.lower()
    if fmt == "json":
        if schema is None:
            schema = infer_json_schema(df, col)
        return df.withColumn(col, F.from_json(c, schema, {"mode": "PERMISSIVE"}))
    if fmt == "csv":
        if schema is None:
            schema = csv_ddl(df, col, sep)
        return df.withColumn(col, F.from_csv(c, schema, {"sep": sep, "mode": "PERMISSIVE"}))
    raise ValueError(f"unsupported unbox format {fmt}")


def infer_json_schema(df: DataFrame, col: str) -> str:
    """DDL schema of a JSON text column, merged over every value."""
    s = df.select(F.schema_of_variant_agg(F.try_parse_json(F.col(_q(col)))).alias("s")).first().s
    if not s:
        raise ValueError(f"column {col} holds no JSON values")
    return s.replace("OBJECT<", "STRUCT<")


# DynamoDB attribute-value type tags; a number's type is learnt.
DDB_SCALAR_TAGS = {"S": "string", "N": "double", "BOOL": "boolean", "B": "string"}
DDB_SET_TAGS = {"SS": "array<string>", "NS": "array<double>", "BS": "array<string>"}


def unnest_ddb_json(df: DataFrame, col: str, attributes: dict | None = None,
                    sep: str = ".", numbers: str = "exact") -> DataFrame:
    """Flatten a DynamoDB-JSON text column (``{"a": {"S": "x"}, "n": {"N": "1"}}``)
    into typed columns.

    ``M`` maps flatten to dotted names; ``L`` lists become arrays, of structs
    where the elements are maps, to any depth; sets become arrays; ``NULL`` →
    NULL. An attribute seen with several scalar tags becomes text, one seen
    with lists or maps beside other tags too (these as JSON).

    The layout is learnt from all values (``schema_of_variant_agg``) unless
    ``attributes`` is given as ``{name: tag, tags, or nested dict}``. Numbers
    are exact: each attribute's type is the least of INT, BIGINT, DECIMAL that
    holds all its numbers, and text where 38 digits are too few. That takes a
    second aggregate of one row; ``numbers="double"`` does without it and
    reads DOUBLE.
    """
    if numbers not in ("exact", "double"):
        raise ValueError("numbers must be exact or double")
    v = F.try_parse_json(F.col(_q(col)))
    if attributes is None:
        s = df.select(F.schema_of_variant_agg(v).alias("s")).first().s
        if not s or not s.startswith("OBJECT<"):
            raise ValueError(f"column {col} holds no DynamoDB items")
        parsed = T._parse_datatype_string(s.replace("OBJECT<", "STRUCT<"))  # noqa: SLF001
        layout = {f.name: _ddb_node(f.dataType) for f in parsed.fields}
    else:
        layout = {k: _ddb_given(x) for k, x in attributes.items()}
    base = df.withColumn("__v", v).drop(col)
    types = _ddb_number_types(base, layout) if numbers == "exact" else {}
    cols = [F.col(_q(c)) for c in df.columns if c != col]
    cols += _ddb_columns((F.col("__v"), "$"), layout, (), "", sep, types)
    return base.select(cols)


def _ddb_node(dtype: T.DataType) -> dict:
    """Tags of an attribute value, from its JSON type: {tag: what is inside}."""
    if not isinstance(dtype, T.StructType):
        return {}
    node: dict = {}
    for f in dtype.fields:
        if f.name == "M" and isinstance(f.dataType, T.StructType):
            node["M"] = {g.name: _ddb_node(g.dataType) for g in f.dataType.fields}
        elif f.name == "L" and isinstance(f.dataType, T.ArrayType):
            node["L"] = _ddb_node(f.dataType.elementType)
        elif f.name in DDB_SCALAR_TAGS or f.name in DDB_SET_TAGS:
            node[f.name] = None
    return node


def _ddb_given(spec) -> dict:
    if isinstance(spec, dict):
        return {"M": {k: _ddb_given(x) for k, x in spec.items()}}
    # the elements of a list given by tag alone: text or numbers
    return {t: {"S": None, "N": None} if t == "L" else None for t in ([spec] if isinstance(spec, str) else spec)}


def _ddb_at(v: tuple, *names: str) -> tuple:
    """Place of a value inside another: (variant column, JSON path). A path is
    followed in one step; a variant taken out on the way would be built anew."""
    return v[0], v[1] + "".join(f"['{name}']" for name in names)


def _ddb_get(v: tuple, name: str, kind: str = "variant") -> Column:
    return F.try_variant_get(v[0], _ddb_at(v, name)[1], kind)


def _ddb_paths(node: dict, at: tuple):
    """The path of every number in a node."""
    yield from ((*at, t) for t in ("N", "NS") if t in node)
    for name, child in (node.get("M") or {}).items():
        yield from _ddb_paths(child, (*at, "M", name))
    if node.get("L"):
        yield from _ddb_paths(node["L"], (*at, "L"))


def _ddb_numbers(v: tuple, node: dict, at: tuple, places: dict) -> list[Column]:
    """Arrays of (pos, text) of every number in a node; a list's elements are
    gone through once for all the numbers in them."""
    def pos(t: str) -> int:
        return places[(*at, t)]

    out = []
    if "N" in node:
        out.append(F.array(_numbered(pos("N"))(_ddb_get(v, "N", "string"))))
    if "NS" in node:
        out.append(F.coalesce(F.transform(_ddb_get(v, "NS", "array<string>"), _numbered(pos("NS"))), _no_numbers()))
    for name, child in (node.get("M") or {}).items():
        out += _ddb_numbers(_ddb_at(v, "M", name), child, (*at, "M", name), places)
    if node.get("L") and any(_ddb_paths(node["L"], ())):
        each = F.transform(_ddb_get(v, "L", "array<variant>"),
                           lambda e: F.concat(*_ddb_numbers((e, "$"), node["L"], (*at, "L"), places)))
        out.append(F.coalesce(F.flatten(each), _no_numbers()))
    return out


def _no_numbers() -> Column:
    return F.array().cast("array<struct<pos:int,text:string>>")


def _ddb_number_types(df: DataFrame, layout: dict) -> dict:
    """Type of the numbers at each path, folded over all items (a row per path)."""
    paths = [p for name, node in layout.items() for p in _ddb_paths(node, (name,))]
    if not paths:
        return {}
    places = {p: i for i, p in enumerate(paths)}
    found = [x for name, node in layout.items() for x in _ddb_numbers((F.col("__v"), f"$['{name}']"), node, (name,), places)]
    types = learnt(df.select(F.inline(F.concat(*found))), exact=True)
    return {p: types.get(i, "STRING") for p, i in places.items()}


def _numbered(i: int) -> Callable[[Column], Column]:
    return lambda t: F.struct(F.lit(i).alias("pos"), t.alias("text"))


def _ddb_value(v: tuple, node: dict, at: tuple, types: dict) -> Column:
    """An attribute value as a typed column."""
    tags = list(node)
    scalars = [_ddb_get(v, t, "string").try_cast(types[(*at, t)]) if (*at, t) in types
               else _ddb_get(v, t, DDB_SCALAR_TAGS[t]) for t in tags if t in DDB_SCALAR_TAGS]
    if not tags or tags == ["M"] and not node["M"]:
        return F.lit(None).cast("string")
    if len(tags) == 1 and scalars:
        return scalars[0]
    if len(scalars) == len(tags):
        return F.coalesce(*[_ddb_get(v, t, "string") for t in tags])
    if tags == ["M"]:
        fields = [_ddb_value(_ddb_at(v, "M", name), child, (*at, "M", name), types).alias(name) for name, child in node["M"].items()]
        return F.when(_ddb_get(v, "M").isNotNull(), F.struct(*fields))
    if tags == ["L"]:
        return F.transform(_ddb_get(v, "L", "array<variant>"), lambda e: _ddb_value((e, "$"), node["L"], (*at, "L"), types))
    if len(tags) == 1:
        if (*at, tags[0]) in types:
            kind = types[(*at, tags[0])]
            return F.transform(_ddb_get(v, tags[0], "array<string>"), lambda x: x.try_cast(kind))
        return _ddb_get(v, tags[0], DDB_SET_TAGS[tags[0]])
    text = [_ddb_get(v, t, "string") for t in tags if t in DDB_SCALAR_TAGS]
    own = F.try_variant_get(v[0], v[1], "variant")
    whole = F.when(own.isNotNull() & _ddb_get(v, "NULL").isNull(), F.to_json(own))
    return F.coalesce(*text, whole)


def _ddb_columns(v: tuple, layout: dict, at: tuple, prefix: str, sep: str, types: dict) -> list[Column]:
    """Columns of the attributes of a map; maps inside it flatten."""
    out = []
    for name, node in layout.items():
        own, path = _ddb_at(v, name), (*at, name)
        if list(node) == ["M"] and node["M"]:
            out += _ddb_columns(_ddb_at(own, "M"), node["M"], (*path, "M"), f"{prefix}{name}{sep}", sep, types)
        elif node:
            out.append(_ddb_value(own, node, path, types).alias(f"{prefix}{name}"))
    return out


def explode_array(df: DataFrame, col: str, alias: str | None = None,
                  keep: Sequence[str] | None = None, with_position: bool = False) -> DataFrame:
    """One row per array element (rows with NULL/empty arrays disappear)."""
    keep = list(keep) if keep is not None else [c for c in df.columns if c != col]
    gen = (F.posexplode(F.col(_q(col))).alias("pos", alias or col) if with_position
           else F.explode(F.col(_q(col))).alias(alias or col))
    return df.select(*[F.col(_q(c)) for c in keep], gen)


def explode_map(df: DataFrame, col: str, keep: Sequence[str] | None = None) -> DataFrame:
    """One row per map entry: (kept columns…, key, value)."""
    keep = list(keep) if keep is not None else [c for c in df.columns if c != col]
    return df.select(*[F.col(_q(c)) for c in keep], F.explode(F.col(_q(col))).alias("key", "value"))
