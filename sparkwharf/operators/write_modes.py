"""Write modes as pure functions: the table to be and a batch give the new table.

Parquet tables have no MERGE; a sink computes the new table (or the new
partitions) with these and swaps it in. Batches carry ``_seq``, their arrival order, so that
"the last of a batch" is defined after any shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEQ = "_seq"


def _all(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def keep_last(batch: DataFrame, key: list[str], seq: str = SEQ) -> DataFrame:
    """The last row of each key by arrival; rows with a null key go."""
    w = Window.partitionBy(*key).orderBy(F.col(seq).desc())
    return batch.filter(_all([F.col(k).isNotNull() for k in key])).withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def keep_first(batch: DataFrame, key: list[str], seq: str = SEQ) -> DataFrame:
    w = Window.partitionBy(*key).orderBy(F.col(seq))
    return batch.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def upsert(table: DataFrame, batch: DataFrame, key: list[str], seq: str = SEQ) -> DataFrame:
    """Rows of the batch replace those with equal keys; one grouped pass over both sides."""
    both = table.withColumn(seq, F.lit(None).cast("long")).unionByName(batch.withColumn(seq, F.col(seq).cast("long")).select(*table.columns, seq))
    w = Window.partitionBy(*key).orderBy(F.col(seq).desc_nulls_last())
    return both.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn", seq)


def insert_new(table: DataFrame, batch: DataFrame, *keys: list[str], seq: str = SEQ) -> DataFrame:
    """Append rows that clash with no unique key of the table; inside the batch the first by arrival stays, key by key."""
    fresh = batch
    for key in keys:
        fresh = fresh.join(table.select(*key).distinct(), key, "left_anti")
    for key in keys:
        fresh = keep_first(fresh, key, seq)
    return table.unionByName(fresh.select(table.columns))


def prune_stale(current: DataFrame, seen_at: str, batch_time: Column) -> DataFrame:
    """Without rows last seen before this batch."""
    return current.filter(F.col(seen_at) >= batch_time)


def expire(current: DataFrame, until: str, as_of: Column) -> DataFrame:
    return current.filter(F.col(until).isNull() | (F.col(until) >= as_of))


def changed_only(current: DataFrame, batch: DataFrame, key: list[str], content: list[str]) -> DataFrame:
    """Rows of the batch that are new or differ from the current row in any content column, nulls being equal."""
    old = current.select(*[F.col(k).alias(f"_k_{k}") for k in key], *[F.col(c).alias(f"_o_{c}") for c in content], F.lit(True).alias("_known"))
    joined = batch.join(old, _all([F.col(k) == F.col(f"_k_{k}") for k in key]), "left")
    same = _all([F.col(c).eqNullSafe(F.col(f"_o_{c}")) for c in content])
    return joined.filter(F.col("_known").isNull() | ~same).select(batch.columns)


def merge_preserving(table: DataFrame, batch: DataFrame, key: list[str], rules: dict[str, str]) -> DataFrame:
    """Full outer merge by column rules.

    ``keep``: the table's value unless null; ``new``: the batch's unless null; ``least``, ``greatest``,
    ``union`` (sorted set of arrays), ``sum``; ``human``: the table's, whatever the batch says.
    """
    b = batch.select(*key, *[F.col(c).alias(f"_b_{c}") for c in rules], F.lit(True).alias("_in"))
    a = table.select(*key, *rules, F.lit(True).alias("_had"))
    j = a.join(b, key, "full")
    empty = lambda c: F.coalesce(F.col(c), F.array().cast(dict(table.dtypes)[c.removeprefix("_b_")]))
    how = {
        "keep": lambda c: F.coalesce(c, f"_b_{c}"),
        "new": lambda c: F.coalesce(f"_b_{c}", c),
        "least": lambda c: F.least(c, f"_b_{c}"),
        "greatest": lambda c: F.greatest(c, f"_b_{c}"),
        "union": lambda c: F.array_sort(F.array_union(empty(c), empty(f"_b_{c}"))),
        "sum": lambda c: F.coalesce(F.col(c), F.lit(0)) + F.coalesce(F.col(f"_b_{c}"), F.lit(0)),
        "human": lambda c: F.when(F.col("_had"), F.col(c)).otherwise(F.col(f"_b_{c}")),
    }
    return j.select(*key, *[how[r](c).alias(c) for c, r in rules.items()])


def update_from(table: DataFrame, dim: DataFrame, key: list[str], cols: list[str], locked: Column | None = None) -> DataFrame:
    """Columns taken from a dimension where it has the key and differs, unless the row is locked by hand."""
    d = dim.select(*key, *[F.col(c).alias(f"_d_{c}") for c in cols], F.lit(True).alias("_hit"))
    j = table.join(d, key, "left")
    free = F.col("_hit").isNotNull() & (~F.coalesce(locked, F.lit(False)) if locked is not None else F.lit(True))
    return j.select([F.when(free, F.col(f"_d_{c}")).otherwise(F.col(c)).alias(c) if c in cols else F.col(c) for c in table.columns])


def not_found(batch: DataFrame, table: DataFrame, key: list[str]) -> DataFrame:
    """Keys of an update that the table doesn't have."""
    return batch.join(table, key, "left_anti").select(*key)


def fail_counts(ledger: DataFrame, outcomes: DataFrame, key: list[str]) -> DataFrame:
    """Consecutive failures by key: up on failure, zero on success, unchanged if not run."""
    o = outcomes.select(*key, "ok")
    j = ledger.join(o, key, "full")
    n = F.coalesce("fails", F.lit(0))
    return j.select(*key, F.when(F.col("ok").isNull(), n).when(F.col("ok"), 0).otherwise(n + 1).alias("fails"))


def fan_out(batch: DataFrame, tag: str, tables: list[str]) -> dict[str, DataFrame]:
    """One frame for each table by the rows' tag."""
    return {t: batch.filter(F.col(tag) == t).drop(tag) for t in tables}


def completeness(rows: DataFrame, run_key: str, expected: DataFrame, grain: list[str]) -> DataFrame:
    """Per run: row count, duplicate grains, and whether the run may be published."""
    per = rows.groupBy(run_key, *grain).agg(F.count(F.lit(1)).alias("_n")).groupBy(run_key).agg(F.sum("_n").alias("n_rows"), F.sum((F.col("_n") > 1).cast("int")).alias("dup_grains"))
    j = expected.join(per, run_key, "left").withColumns({"n_rows": F.coalesce("n_rows", F.lit(0)), "dup_grains": F.coalesce("dup_grains", F.lit(0))})
    return j.withColumn("complete", (F.col("n_rows") == F.col("expected")) & (F.col("dup_grains") == 0))


def replace_days(table: DataFrame, batch: DataFrame, day: str) -> DataFrame:
    """All rows of the batch's days give way to the batch."""
    return table.join(batch.select(day).distinct(), day, "left_anti").unionByName(batch.select(table.columns))


def retain(table: DataFrame, day: str, as_of: Column, days: int) -> DataFrame:
    return table.filter(F.col(day) >= F.date_sub(as_of, days))


def to_archive(days: DataFrame, archived: DataFrame) -> DataFrame:
    """Days not yet archived; only archived ones may be deleted."""
    return days.join(archived, days.columns, "left_anti")


def buffered(files: DataFrame, as_of: Column, most: int = 500, days: int = 3) -> DataFrame:
    """Failed batches still worth replaying: younger than the limit, the newest ``most``, oldest first."""
    young = files.filter(F.col("failed_at") >= as_of - F.make_dt_interval(F.lit(days)))
    return young.orderBy(F.col("failed_at").desc(), "name").limit(most).orderBy("failed_at", "name")


def not_archived(live: DataFrame, archive: DataFrame, day: str) -> DataFrame:
    """Rows of the days that the archive hasn't at all."""
    return live.join(archive.select(day).distinct(), day, "left_anti")


def without_archived(live: DataFrame, archive: DataFrame, day: str, oldest: Column) -> DataFrame:
    """``live`` without the days before ``oldest`` of which the archive holds as many rows; others stay, however old."""
    n = lambda rows, name: rows.groupBy(day).agg(F.count(F.lit(1)).alias(name))
    safe = n(live.filter(F.col(day) < oldest), "_live").join(n(archive, "_kept"), day).filter("_live = _kept").select(day)
    return live.join(safe, day, "left_anti")
