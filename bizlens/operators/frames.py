"""Generic DataFrame operators (column names are parameters, nothing is tied to one report)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bizlens.functions.common import col_of


def asc_last(c) -> Column:
    """Ascending with nulls last (the SQL warehouse default; Spark's own default puts nulls first)."""
    return col_of(c).asc_nulls_last()


def desc_last(c) -> Column:
    return col_of(c).desc_nulls_last()


def first_per_key(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """First row per key by ``order`` (ascending, nulls last), i.e. ``row_number() = 1``.

    Spark plans this filter as a WindowGroupLimit below the shuffle: each input partition forwards at most one
    row per key, so even a key that owns a third of the rows costs one row per map task downstream.
    """
    w = Window.partitionBy(*keys).orderBy(*[o if isinstance(o, Column) else asc_last(o) for o in order])
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def best_record(df: DataFrame, keys: list[str], score: Column, seq: list[str]) -> DataFrame:
    """Richest row per key: highest ``score``, ties -> the latest ``seq`` (last seen wins)."""
    return first_per_key(df.withColumn("_score", score), keys, [desc_last("_score")] + [desc_last(s) for s in seq]) \
        .drop("_score")


def keep_first(df: DataFrame, keys: list[str], seq: list[str]) -> DataFrame:
    """``drop_duplicates(keep='first')`` with an explicit arrival order."""
    return first_per_key(df, keys, seq)


#: A filter over the hashes of a table's keys: 2^17 rows of 16 words of 64 bits, 16 MB at most however large the table is.
MARK_ROWS, MARK_WORDS = 1 << 17, 16


def hashable(c: Column, kind: str) -> Column:
    """Values that compare as equal hash alike (the two zeros of floating point do not)."""
    return c + F.lit(0).cast(kind) if kind in ("float", "double") else c


def _mark(key: list[Column]) -> tuple[Column, Column, Column]:
    h = F.xxhash64(*key)
    word = F.shiftrightunsigned(h, MARK_ROWS.bit_length() - 1).bitwiseAND(F.lit(MARK_WORDS - 1).cast("bigint"))
    bit = F.shiftrightunsigned(h, 40).bitwiseAND(F.lit(63).cast("bigint"))
    return h.bitwiseAND(F.lit(MARK_ROWS - 1).cast("bigint")), word.cast("int"), bit.cast("int")


def marks(df: DataFrame, key: list[Column]) -> DataFrame:
    """The filter of a table's keys: one bit set for each. Too many keys make it pass more rows, never fewer."""
    row, word, bit = _mark(key)
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("_bit"))
    words = [F.coalesce(F.bit_or(F.when(F.col("_word") == w, one)), F.lit(0).cast("bigint")) for w in range(MARK_WORDS)]
    return df.select(row.alias("_row"), word.alias("_word"), bit.alias("_bit")).groupBy("_row").agg(F.array(*words).alias("_words"))


def with_marks(df: DataFrame, key: list[Column], filter_: DataFrame, name: str) -> DataFrame:
    """The rows with a flag that is true if their key may be among those of :func:`marks`, and false only if it is not. The
    filter is small and broadcast, no row moves."""
    row, word, bit = _mark(key)
    met = df.join(F.broadcast(filter_), row == F.col("_row"), "left")
    found = F.call_function("shiftright", F.get("_words", word), bit).bitwiseAND(F.lit(1).cast("bigint")) == 1
    return met.select(*df.columns, F.coalesce(found, F.lit(False)).alias(name))


def ensure_columns(df: DataFrame, defaults: dict[str, tuple[object, str]]) -> DataFrame:
    """Add each missing column as a typed literal: ``{name: (default, spark_type)}``."""
    missing = {name: F.lit(v).cast(t) for name, (v, t) in defaults.items() if name not in df.columns}
    return df.withColumns(missing) if missing else df


def stack(frames: list[DataFrame]) -> DataFrame:
    """Concatenate by column name; columns missing on one side become null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def append_member(df: DataFrame, row: dict, first: bool = False) -> DataFrame:
    """Append (or prepend) one fixed member row, typed like ``df``; columns not given are null."""
    spark = df.sparkSession
    member = spark.createDataFrame([tuple(row.get(f.name) for f in df.schema.fields)], df.schema)
    return member.unionByName(df) if first else df.unionByName(member)


def share_of_total(df: DataFrame, value: str, out: str = "percentual") -> DataFrame:
    """``value / total * 100`` when the total is positive, else 0 (sum exact when ``value`` is decimal).

    The total is a scalar subquery (one value computed once), so there is no global window and no
    single-partition exchange.
    """
    total = df.select(F.sum(F.col(value)).cast("double").alias("t")).scalar()
    v = F.col(value).cast("double")
    return df.withColumn(out, F.when(total > 0, v / total * F.lit(100.0)).otherwise(F.lit(0.0)))


def signed_split(df: DataFrame, keys: list, value: str) -> DataFrame:
    """Per key: revenue (sum of v>0), expense (|sum of v<0|), net (sum of v), each 0 when empty."""
    v = F.col(value)
    return df.groupBy(*keys).agg(
        F.coalesce(F.sum(F.when(v > 0, v)), F.lit(0)).alias("receitas"),
        F.coalesce(F.abs(F.sum(F.when(v < 0, v))), F.lit(0)).alias("despesas"),
        F.coalesce(F.sum(v), F.lit(0)).alias("lucro_liquido"))


def gap_fill(agg: DataFrame, bucket_col: str, step: Column, zero_cols: list[str],
             keep_if: Column | None = None) -> DataFrame:
    """Every bucket between the first and last one present, missing buckets filled with 0.

    ``agg`` is already one row per bucket; the spine is built from its min/max with ``sequence`` + ``explode``
    and left-joined back, so both sides are bounded by the number of buckets. ``keep_if`` is an aggregate
    condition over ``agg`` evaluated in the same one-row bounds aggregate; when false the spine (and so the
    result) is empty, without a second pass over the input.
    """
    bounds = agg.agg(F.min(bucket_col).alias("lo"), F.max(bucket_col).alias("hi"),
                     *([keep_if.alias("_keep")] if keep_if is not None else []))
    if keep_if is not None:
        bounds = bounds.where(F.coalesce(F.col("_keep"), F.lit(False)))
    spine = bounds.select(F.explode(F.sequence("lo", "hi", step)).alias(bucket_col))
    filled = spine.join(agg, bucket_col, "left")
    return filled.withColumns({c: F.coalesce(F.col(c), F.lit(0).cast(agg.schema[c].dataType)) for c in zero_cols})


def top_k(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    """Top-k by a total order (planned as TakeOrderedAndProject: per-partition top-k, then merge)."""
    return df.orderBy(*order).limit(k)
