"""Nested payload to flat columns, from a struct column or from JSON text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart.schemas import PAYLOAD_LEAVES


def _text_schema(paths: list[str]) -> T.StructType:
    """Schema holding every leaf as text, so that one bad leaf cannot spoil its siblings."""
    tree: dict = {}
    for path in paths:
        node = tree
        *parents, leaf = path.split(".")
        for name in parents:
            node = node.setdefault(name, {})
        node[leaf] = None

    def build(node: dict) -> T.StructType:
        return T.StructType(
            [T.StructField(k, T.StringType() if v is None else build(v)) for k, v in node.items()]
        )

    return build(tree)


def _has_path(dtype: T.DataType, path: str) -> bool:
    for name in path.split("."):
        if not isinstance(dtype, T.StructType) or name not in dtype.names:
            return False
        dtype = dtype[name].dataType
    return True


def _leaf(root: Column, path: str) -> Column:
    for name in path.split("."):
        root = root.getField(name)
    return root


def _texts(schema: T.StructType) -> T.StructType:
    return T.StructType(
        [T.StructField(f.name, _texts(f.dataType) if isinstance(f.dataType, T.StructType) else T.StringType()) for f in schema.fields]
    )


def struct_of_text(text: Column, schema: T.StructType) -> Column:
    """JSON text as a struct; a leaf that is missing or does not convert gives NULL and spoils no other."""

    def build(node: Column, want: T.StructType) -> Column:
        return F.struct(
            *[
                (build(node.getField(f.name), f.dataType) if isinstance(f.dataType, T.StructType) else node.getField(f.name).try_cast(f.dataType)).alias(f.name)
                for f in want.fields
            ]
        )

    return F.when(text.isNotNull(), build(F.from_json(text, _texts(schema)), schema))


def unpack_payload(
    df: DataFrame,
    col: str = "payload",
    leaves: dict[str, tuple[str, str]] = PAYLOAD_LEAVES,
) -> DataFrame:
    """Replace `col` by one column per leaf; a missing, null or malformed leaf gives NULL.

    A struct column is read leaf by leaf, so Parquet prunes the leaves nobody
    asks for. JSON text is parsed once per row.
    """
    dtype = df.schema[col].dataType
    rest = [c for c in df.columns if c != col]
    if isinstance(dtype, T.StructType):
        out = [
            (
                _leaf(F.col(col), path).try_cast(typ)
                if _has_path(dtype, path)
                else F.lit(None).cast(typ)
            ).alias(name)
            for path, (name, typ) in leaves.items()
        ]
        return df.select(*rest, *out)
    parsed = df.withColumn(col, F.from_json(F.col(col), _text_schema(list(leaves))))
    out = [_leaf(F.col(col), path).try_cast(typ).alias(name) for path, (name, typ) in leaves.items()]
    return parsed.select(*rest, *out)
