"""SCD Type 2 history by check columns, with hard-delete closing.

History rows carry ``valid_from`` / ``valid_to`` (half-open, NULL = open).
Applying a new full extract at ``as_of``:

* key in both, all check columns equal (NULL-safe)  -> current row kept
* key in both, any check column differs              -> current closed at as_of,
                                                        new version opened at as_of
* key only in history (hard delete)                  -> current closed at as_of
* key only in the extract (new or re-appearing)      -> new version opened at as_of

One full-outer join of the whole history with the extract produces every case: only open
versions can match (the condition is part of the join), closed ones pass through unmatched.  The
history is read once per apply, so n versions cost n - 1 joins.  A NULL key, a key that occurs twice and an
``as_of`` before the start of an open version are errors.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class DuplicateKeyError(ValueError):
    pass


def _stamp(as_of) -> F.Column:
    return F.lit(str(as_of)).cast("timestamp_ntz")


class NullKeyError(ValueError):
    pass


def assert_unique_keys(incoming: DataFrame, key: str) -> None:
    """Raise when the extract holds a key twice or a NULL key (one distributed check, one row back)."""
    bad = (incoming.groupBy(key).count().where((F.col("count") > 1) | F.col(key).isNull())
           .agg(F.count_if(F.col(key).isNull()).alias("nulls"),
                F.count_if(F.col(key).isNotNull()).alias("twice")).first())
    if bad.nulls:
        raise NullKeyError(f"incoming extract has NULL values of {key!r}")
    if bad.twice:
        raise DuplicateKeyError(f"incoming extract has duplicate values of {key!r}")


def initial_history(incoming: DataFrame, key: str, check_cols: list[str], as_of) -> DataFrame:
    return incoming.select(key, *check_cols, _stamp(as_of).alias("valid_from"),
                           F.lit(None).cast("timestamp_ntz").alias("valid_to"))


def unique_in_plan(incoming: DataFrame, key: str, check_cols: list[str]) -> DataFrame:
    """One row per key, failing the job when a key occurs twice or is NULL.

    The grouping is the shuffle by key that the comparison join needs anyway
    (the join reuses its partitioning), so the check costs no extra job and
    no extra shuffle; the error surfaces when the history is computed.
    """
    grouped = incoming.groupBy(key).agg(F.count(F.lit(1)).alias("_n"),
                                        *[F.first(c).alias(c) for c in check_cols])
    ok = (F.when(F.col(key).isNull(),
                 F.raise_error(F.lit(f"incoming extract has NULL values of {key!r}")))
          .when(F.col("_n") > 1, F.raise_error(F.concat(
              F.lit(f"incoming extract has duplicate values of {key!r}: "),
              F.col(key).cast("string")))).otherwise(F.lit(True)))
    return grouped.where(ok).select(key, *check_cols)


def scd2_apply(history: DataFrame | None, incoming: DataFrame, key: str,
               check_cols: list[str], as_of, check_unique: bool | str = True) -> DataFrame:
    """Return the full history after applying ``incoming`` at ``as_of``.

    ``check_unique``: ``True`` checks the extract's keys now (one small job,
    raises :class:`DuplicateKeyError`); ``"in_plan"`` folds the check into
    the comparison's shuffle (the job computing the history fails instead);
    ``False`` trusts the extract.
    """
    if check_unique == "in_plan":
        incoming = unique_in_plan(incoming, key, check_cols)
    elif check_unique:
        assert_unique_keys(incoming, key)
    if history is None:
        return initial_history(incoming, key, check_cols, as_of)
    stamp = _stamp(as_of)
    inc = incoming.select(key, *check_cols).alias("i")
    is_open = F.col("c.valid_to").isNull()
    j = history.alias("c").join(
        inc, (F.col(f"c.{key}") == F.col(f"i.{key}")) & is_open, "full_outer")

    in_c = F.col("c.valid_from").isNotNull()
    in_i = F.col(f"i.{key}").isNotNull()
    same = reduce(lambda a, b: a & b,
                  [F.col(f"c.{c}").eqNullSafe(F.col(f"i.{c}")) for c in check_cols])
    changed = in_c & in_i & ~same
    backward = F.raise_error(F.lit(f"as_of {as_of} is before the start of an open version"))

    def version(side: str, valid_from, valid_to):
        return F.struct(F.col(f"{side}.{key}").alias(key),
                        *[F.col(f"{side}.{c}").alias(c) for c in check_cols],
                        valid_from.alias("valid_from"), valid_to.alias("valid_to"))

    null_ts = F.lit(None).cast("timestamp_ntz")
    end = (F.when(~is_open, F.col("c.valid_to"))
           .when(F.col("c.valid_from") > stamp, backward.cast("timestamp_ntz"))
           .when(~in_i | changed, stamp).otherwise(null_ts))
    old = F.when(in_c, version("c", F.col("c.valid_from"), end))
    new = F.when(in_i & (~in_c | changed), version("i", stamp, null_ts))
    emitted = j.select(F.explode(F.filter(F.array(old, new), lambda v: v.isNotNull())).alias("v"))
    return emitted.select("v.*")
