"""Change events, keyed upserts and deletes, and log reading."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from .ranking import latest_per_key

# Operation codes of change events: snapshot read, create, update, delete.
OPS = ("r", "c", "u", "d")


def _envelopes(df: DataFrame, value: str, row_schema: str, keys: list[str]) -> DataFrame:
    row = T.StructType.fromDDL(row_schema)
    missing = [k for k in keys if k not in row.fieldNames()]
    if missing:
        raise ValueError(f"key columns {missing} are not part of the row schema")
    envelope = T.StructType.fromDDL("op string, seq bigint").add("before", row).add("after", row)
    # explode() keeps filters from being pushed into the scan, where they would parse every document again.
    return df.select("*", F.explode(F.array(F.from_json(F.col(value), envelope))).alias("_change"))


def _readable(keys: list[str]) -> Column:
    row = F.coalesce("_change.after", "_change.before")
    good = F.col("_change.op").isin(*OPS) & row.isNotNull()
    for key in keys:
        good = good & row[key].isNotNull()
    return F.coalesce(good, F.lit(False))


def decode_changes(df: DataFrame, value: str, row_schema: str, keys: list[str], skip_rejected: bool = False) -> DataFrame:
    """Change envelopes ``{op, seq, before, after}`` to a flat log.

    The row of a delete comes from its full before-image, so every column of it can route or filter.
    Output: ``op``, ``seq``, the row's columns, and the ``before`` struct. An envelope that is broken, has an unknown
    operation or lacks a key stops the job; with ``skip_rejected`` it is left to :func:`rejected_changes`.
    """
    parsed = _envelopes(df, value, row_schema, keys)
    if skip_rejected:
        parsed = parsed.where(_readable(keys))
        op = F.col("_change.op")
    else:
        told = F.concat(F.lit("unreadable change: "), F.coalesce(F.substring(F.col(value), 1, 200), F.lit("null")))
        op = F.when(_readable(keys), F.col("_change.op")).otherwise(F.raise_error(told))
    return parsed.select(op.alias("op"), "_change.seq", F.coalesce("_change.after", "_change.before").alias("row"), "_change.before").select(
        "op", "seq", "row.*", "before"
    )


def rejected_changes(df: DataFrame, value: str, row_schema: str, keys: list[str]) -> DataFrame:
    """The rows of ``df`` whose envelope :func:`decode_changes` cannot read, as they came."""
    return _envelopes(df, value, row_schema, keys).where(~_readable(keys)).drop("_change")


def encode_changes(df: DataFrame, op: Column, seq: Column, before: Column, after: Column) -> DataFrame:
    """Rows to change envelopes in one text column ``value``."""
    body = F.struct(op.alias("op"), seq.alias("seq"), before.alias("before"), after.alias("after"))
    return df.select(F.to_json(body).alias("value"))


def snapshot_then_changes(base: DataFrame, changes: DataFrame) -> DataFrame:
    """One ordered log: the snapshot as reads at position 0, then the changes."""
    snapshot = base.withColumns({"op": F.lit("r"), "seq": F.lit(0).cast("bigint")})
    return snapshot.unionByName(changes, allowMissingColumns=True)


def latest_changes(changes: DataFrame, keys: list[str]) -> DataFrame:
    """The last change of each key. Order is ``seq``, never arrival."""
    return latest_per_key(changes, keys, F.desc("seq"), F.desc("op"))


def apply_upserts(base: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """The table after the changes: untouched rows, plus the last image of each key that was not deleted.

    The anti join needs the changes' keys only, each once: a key with many changes collapses inside each task. A small batch is broadcast by Catalyst's own size check and the
    base is then not shuffled at all; a large batch becomes a shuffled join.
    """
    survivors = latest_changes(changes, keys).where(F.col("op") != "d").select(*base.columns)
    return base.join(changes.select(*keys).distinct(), keys, "left_anti").unionByName(survivors)


def fold_changes(base: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """The last change of each key of two logs, deletes included, so that a later fold still knows their ``seq``.

    ``base`` holds one row per key. Only its rows that the changes touch meet them; the others stay where they are.
    """
    changed = changes.select(*keys).distinct()
    touched = base.join(changed, keys, "left_semi").unionByName(changes.select(*base.columns))
    return base.join(changed, keys, "left_anti").unionByName(latest_changes(touched, keys))


def read_latest(log: DataFrame, keys: list[str], *newest_first: Column) -> DataFrame:
    """A unique-key table kept as an append log: repeats are resolved when it is read."""
    return latest_per_key(log, keys, *newest_first)


def routed(df: DataFrame, topic: str, targets: dict[str, str]) -> DataFrame:
    """Add ``target_table``; a topic without a target stops the job instead of vanishing."""
    choice = F.raise_error(F.concat(F.lit("no target table for topic "), F.coalesce(F.col(topic), F.lit("null"))))
    for name, table in targets.items():
        choice = F.when(F.col(topic) == name, F.lit(table)).otherwise(choice)
    return df.withColumn("target_table", choice)


def insert_ignore(base: DataFrame, new: DataFrame, keys: list[str], *first: Column) -> DataFrame:
    """``base`` plus the new rows whose key is not there yet; of new rows with one key the first is taken."""
    fresh = latest_per_key(new, keys, *first).join(base.select(*keys).distinct(), keys, "left_anti")
    return base.unionByName(fresh.select(*base.columns))


def with_defaults(df: DataFrame, document: str, row_schema: str, defaults: dict[str, object]) -> DataFrame:
    """Parse JSON rows; a column gets its default only when the document lacks it, so a written null stays."""
    fields = T.StructType.fromDDL(row_schema).fields
    parsed = df.select(
        F.from_json(F.col(document), row_schema).alias("row"), F.json_object_keys(document).alias("given")
    )
    columns = []
    for field in fields:
        value = F.col("row").getField(field.name)
        if field.name in defaults:
            default = defaults[field.name]
            default = default if isinstance(default, Column) else F.lit(default)
            value = F.when(F.array_contains("given", field.name), value).otherwise(default.cast(field.dataType))
        columns.append(value.alias(field.name))
    return parsed.select(*columns)
