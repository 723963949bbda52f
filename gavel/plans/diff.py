"""Differences between two snapshots of nested documents.

Documents are compared from the top down.  Digests of whole documents find the ones that changed, so the
others are not moved; within a document, equal subtrees are left as soon as they are seen to be equal, and only
what is left is flattened, both sides together.  The expression follows the two schemas; it needs no maps of paths
and no rows for what did not change.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHANGE = "array<struct<path:string,change:string,old:string,new:string>>"


def _one(path: Column, change: str, old: Column, new: Column) -> Column:
    row = F.struct(path.alias("path"), F.lit(change).alias("change"), old.cast("string").alias("old"), new.cast("string").alias("new"))
    return F.array(row).cast(CHANGE)


def _none() -> Column:
    return F.array().cast(CHANGE)


def _null(dtype: T.DataType) -> Column:
    return F.lit(None).cast(dtype)


def _text(value: Column, dtype: T.DataType) -> Column:
    return F.to_json(value) if isinstance(dtype, (T.StructType, T.ArrayType)) else value.cast("string")


def _kind(dtype: T.DataType) -> str:
    return "number" if isinstance(dtype, T.NumericType) else dtype.typeName()


def _comparable(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.StructType):
        return all(_comparable(f.dataType) for f in dtype.fields)
    return _comparable(dtype.elementType) if isinstance(dtype, T.ArrayType) else not isinstance(dtype, (T.MapType, T.VariantType))


def changes_between(o: Column, n: Column, old: T.DataType, new: T.DataType, path: Column) -> Column:
    """Array of (path, change, old, new) of everything that differs below two values at one path."""
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        found = _fields(o, n, old, new, path)
    elif isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        found = _elements(o, n, old.elementType, new.elementType, path)
    elif any(isinstance(t, (T.StructType, T.ArrayType)) for t in (old, new)):  # another shape: all of one goes, all of the other comes
        found = F.concat(changes_between(o, _null(old), old, old, path), changes_between(_null(new), n, new, new, path))
    else:
        found = _scalar(o, n, old, new, path)
    return F.when(o.eqNullSafe(n), _none()).otherwise(found) if old.simpleString() == new.simpleString() and _comparable(old) else found


def _scalar(o: Column, n: Column, old: T.DataType, new: T.DataType, path: Column) -> Column:
    both = o.isNotNull() & n.isNotNull()
    change = "type_change" if _kind(old) != _kind(new) else "value_change"
    differs = both if change == "type_change" else both & (o.cast("string") != n.cast("string"))
    return (
        F.when(differs, _one(path, change, o, n))
        .when(o.isNull() & n.isNotNull(), _one(path, "field_added", o, n))
        .when(o.isNotNull() & n.isNull(), _one(path, "field_removed", o, n))
        .otherwise(_none())
    )


def _fields(o: Column, n: Column, old: T.StructType, new: T.StructType, path: Column) -> Column:
    was, now = ({f.name: f.dataType for f in t.fields} for t in (old, new))
    parts = []
    for name in [*was, *(f for f in now if f not in was)]:
        left = o[name] if name in was else _null(now[name])
        right = n[name] if name in now else _null(was[name])
        below = F.when(path == "", F.lit(name)).otherwise(F.concat(path, F.lit("." + name)))
        parts.append(changes_between(left, right, was.get(name, now.get(name)), now.get(name, was.get(name)), below))
    return F.concat(*parts) if parts else _none()


def _elements(o: Column, n: Column, old: T.DataType, new: T.DataType, path: Column) -> Column:
    """Length, items that came, and what differs in items that both sides have; items that went show in the length alone."""
    before, after = F.size(o), F.size(n)
    length = (
        F.when(o.isNull() & n.isNotNull(), _one(path, "field_added", F.lit(None), after))
        .when(o.isNotNull() & n.isNull(), _one(path, "field_removed", before, F.lit(None)))
        .when(before != after, _one(path, "array_length_change", before, after))
        .otherwise(_none())
    )
    had, has = (F.when(x.isNull(), F.lit(0)).otherwise(F.size(x)) for x in (o, n))

    def at(i: Column) -> Column:
        here = F.concat(path, F.lit("["), i.cast("string"), F.lit("]"))
        came = _one(here, "array_item_added", F.lit(None), _text(F.get(n, i), new))
        return F.when(i >= had, came).otherwise(changes_between(F.get(o, i), F.get(n, i), old, new, here))

    places = F.when(has > 0, F.sequence(F.lit(0), has - 1)).otherwise(F.array().cast("array<int>"))
    return F.concat(length, F.flatten(F.transform(places, at)))


def changed_documents(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Keys of the documents whose digests differ; only keys and digests are joined.

    Snapshots of different schemas differ as a whole."""
    same = old.select(*sorted(old.columns)).schema == new.select(*sorted(new.columns)).schema

    def digests(df: DataFrame, name: str) -> DataFrame:
        body = F.struct(*sorted(c for c in df.columns if c != key))
        return df.select(key, (F.sha2(F.to_json(body), 256) if same else F.lit(name)).alias(name))

    return digests(old, "o").join(digests(new, "n"), key).where(F.col("o") != F.col("n")).select(key)


def snapshot_diff(old: DataFrame, new: DataFrame, key: str, skip_fields: tuple[str, ...] = ("url",), by_digest: bool = False) -> DataFrame:
    """Rows (key, path, change, old, new) of the documents that both snapshots have.

    change: value_change, type_change, array_length_change, array_item_added,
    field_added, field_removed.  A removed array item shows as a length change only.
    Fields named in `skip_fields` are ignored where both sides have a value.  `by_digest` moves only the documents
    whose digests differ; it reads both snapshots twice, so it is for stored snapshots with few changes.
    """
    if by_digest:
        changed = changed_documents(old, new, key)
        old, new = (df.join(changed, key, "left_semi") for df in (old, new))

    def body(df: DataFrame, name: str) -> tuple[DataFrame, T.StructType]:
        fields = [f for f in df.schema.fields if f.name != key]
        return df.select(key, F.struct(*[f.name for f in fields]).alias(name)), T.StructType(fields)

    (left, was), (right, now) = body(old, "o"), body(new, "n")
    found = changes_between(F.col("o"), F.col("n"), was, now, F.lit(""))
    rows = left.join(right, key).select(key, F.explode(found).alias("c")).select(key, "c.*")
    leaf_name = F.regexp_extract("path", r"([^.\[\]]+)(?:\[\d+\])*$", 1)
    skipped = leaf_name.isin(*skip_fields) & (F.col("old") != "") & (F.col("new") != "")
    return rows.where(~F.coalesce(skipped, F.lit(False)))


def change_summary(changes: DataFrame, key: str, items: str = "agendaItems", documents: str = "supportingDocuments") -> DataFrame:
    """Per item index: new documents and the set of changed fields."""
    index = F.regexp_extract("path", rf"^{items}\[(\d+)\]", 1).try_cast("int")
    field = F.regexp_extract("path", r"([^.\[\]]+)(?:\[\d+\])*$", 1)
    is_new_doc = (F.col("change") == "array_item_added") & F.col("path").contains(documents)
    rows = changes.select(key, index.alias("item_index"), field.alias("field"), is_new_doc.alias("new_doc"))
    return rows.where(F.col("item_index").isNotNull()).groupBy(key, "item_index").agg(
        F.count(F.when(F.col("new_doc"), 1)).alias("new_documents"),
        F.array_sort(F.collect_set(F.when(~F.col("new_doc"), F.col("field")))).alias("changed_fields"),
    )
