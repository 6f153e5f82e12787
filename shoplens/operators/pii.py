"""PII protection on nested paths (L0 layer).

A policy maps each collection to the dotted paths to protect. Each path
is rewritten in place with ``withField``; a missing path is a no-op, a
NULL value or NULL parent stays NULL. Names, addresses and loyalty card
numbers stay in clear, as in the original publisher.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shoplens.functions.pii import PiiHasher

# Protected paths per collection.
PII_POLICY: dict[str, tuple[str, ...]] = {
    "customers": ("email", "phone"),
    "stores": ("manager.email", "manager.phone"),
    "purchases": ("customer.email", "customer.phone"),
    "products": (),
}


def has_path(schema: StructType, path: str) -> bool:
    t = schema
    for part in path.split("."):
        if not isinstance(t, StructType) or part not in t.fieldNames():
            return False
        t = t[part].dataType
    return True


def _hash_for(leaf: str, hasher: PiiHasher):
    if leaf == "email":
        return hasher.email
    if leaf == "phone":
        return hasher.phone
    return hasher.hash


def rewrite_path(df: DataFrame, path: str, fn) -> DataFrame:
    """Apply ``fn`` to the value at ``path`` (dotted); keep NULLs NULL."""
    if not has_path(df.schema, path):
        return df
    parts = path.split(".")
    leaf: Column = F.col(parts[0])
    for p in parts[1:]:
        leaf = leaf.getField(p)
    new = F.when(leaf.isNotNull(), fn(leaf))
    if len(parts) == 1:
        return df.withColumn(parts[0], new)
    # A NULL parent struct stays NULL (withField on NULL yields NULL).
    return df.withColumn(parts[0], F.col(parts[0]).withField(".".join(parts[1:]), new))


def protect(df: DataFrame, collection: str, hasher: PiiHasher,
            policy: dict[str, tuple[str, ...]] = PII_POLICY) -> DataFrame:
    """Hash the policy paths of one collection; ``_id`` becomes text."""
    if collection not in policy:
        raise KeyError(f"no PII policy for collection {collection!r}")
    out = df
    if "_id" in df.columns:
        out = out.withColumn("_id", F.col("_id").cast("string"))
    for path in policy[collection]:
        out = rewrite_path(out, path, _hash_for(path.rsplit(".", 1)[-1], hasher))
    return out
