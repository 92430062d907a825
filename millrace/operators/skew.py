"""Hot groups: find them, split them in order, salt them in joins.

A key is hot when it holds more than `max_rows` rows, so at most count/max_rows keys can be hot. A table of
hot keys therefore shrinks with the limit and never grows with the number of keys, which is the bound
behind every broadcast in this module.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from millrace.session import materialize

MAX_GROUP_ROWS = 4_000_000


def _match(left_alias: str, right_alias: str, keys: Sequence[str]) -> Column:
    condition = F.lit(True)
    for k in keys:
        condition = condition & F.col(f"{left_alias}.{k}").eqNullSafe(F.col(f"{right_alias}.{k}"))
    return condition


def order_number(df: DataFrame, column: str) -> Column:
    """A BIGINT that orders like the column: the split points of a hot group are cut on it."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column)
    if isinstance(kind, T.TimestampNTZType):
        epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        return F.timestamp_diff("MICROSECOND", epoch, F.col(column))
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("bigint")
    if isinstance(kind, T.IntegralType):
        return F.col(column).cast("bigint")
    raise TypeError(f"cannot cut groups on {column} of type {kind.simpleString()}")


def hot_keys(df: DataFrame, keys: Sequence[str], max_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """(keys..., _rows) for keys above the limit. One partial aggregate over the key columns only."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
            .filter(F.col("_rows") > max_rows))


def salted_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left",
                hot: DataFrame | None = None, max_rows: int = MAX_GROUP_ROWS,
                spread_by: Sequence[str] | None = None) -> DataFrame:
    """Equi-join whose left side may hold a hot (or NULL) key.

    Rows of a hot key spread over rows/max_rows salts chosen by a hash of `spread_by` (default: the whole
    row, so a retried task picks the same salt), and only the matching right rows are copied per salt.
    Without `hot` the left side is read twice, which suits a stored table. Where it is the result of other
    joins, pass `hot` from the table it derives from: the profile then reads one column of one scan.
    """
    if how not in ("left", "inner", "left_semi", "left_anti"):
        raise ValueError(f"the left side must be the preserved side, not {how}")
    on = list(on)
    hot = hot_keys(left, on, max_rows) if hot is None else hot
    salts = hot.select(*on, F.ceil(F.col("_rows") / F.lit(max_rows)).cast("int").alias("_salts"))
    spread = list(spread_by or left.columns)
    salted_left = (left.alias("l").join(F.broadcast(salts).alias("h"), _match("l", "h", on), "left")
                   .select("l.*", F.when(F.col("h._salts").isNull(), F.lit(0)).otherwise(
                       F.pmod(F.xxhash64(*[F.col(f"l.{c}") for c in spread]), F.col("h._salts")))
                       .cast("int").alias("_salt")))
    copied_right = (right.alias("r").join(F.broadcast(salts).alias("h"), _match("r", "h", on), "left")
                    .select("r.*", F.explode(F.sequence(
                        F.lit(0), F.coalesce(F.col("h._salts"), F.lit(1)) - 1)).alias("_salt")))
    return salted_left.join(copied_right, [*on, "_salt"], how).drop("_salt")


class OrderedGroups:
    """Order-dependent columns (previous, next, running values) per key, safe for hot keys.

    Ordinary keys use one window per key. A hot key is cut into consecutive stretches of its order column;
    each stretch is a window of its own and what the stretch needs from its neighbours comes from a summary
    with one row per stretch. The result equals the plain window, row by row.

    `order` must be a total order within the key; its first column must be numeric, a date or a timestamp.
    One job profiles the key and order columns; without hot keys the plan is exactly the plain window.
    """

    def __init__(self, df: DataFrame, keys: Sequence[str], order: Sequence[str],
                 max_rows: int = MAX_GROUP_ROWS, profile: bool = True):
        self.keys, self.order, self.max_rows = list(keys), list(order), max_rows
        self.split = False
        self.df = df.withColumn("_cut", F.lit(0).cast("bigint"))
        if not profile:
            return
        number = order_number(df, self.order[0])
        found = materialize(
            df.select(*self.keys, number.alias("_n")).groupBy(*self.keys)
            .agg(F.count(F.lit(1)).alias("_rows"))
            .filter(F.col("_rows") > max_rows))
        if found.isEmpty():
            return
        self.split = True
        # Stretches end at quantiles of the key's own order values, so gaps and far values do not matter. All hot
        # keys get the quantiles that the largest needs; a smaller one uses every so-many-th of them.
        most = int(found.agg(F.max(F.ceil(F.col("_rows") * 4 / F.lit(max_rows)))).first()[0])
        numbered = df.withColumn("_n", number)
        hot = (numbered.alias("d").join(F.broadcast(found).alias("h"), _match("d", "h", self.keys), "left_semi")
               .groupBy(*self.keys).agg(F.percentile_approx(
                   "_n", [i / most for i in range(1, most)] or [0.5], max(10_000, 20 * most)).alias("_q")))
        pieces = F.ceil(F.col("h._rows") * 4 / F.lit(max_rows)).cast("int")
        ends = F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(pieces - 1, F.lit(1))), lambda i: F.get(
            F.col("q._q"), F.least(F.floor(i * most / pieces).cast("int") - 1, F.lit(max(most - 2, 0))))))
        borders = materialize(found.alias("h").join(hot.alias("q"), _match("h", "q", self.keys))
                              .select("h.*", ends.alias("_ends")))
        # NULL order values come first, as they do in the window.
        place = F.when(F.col("d._n").isNull(), F.lit(0)).otherwise(
            F.size(F.filter(F.col("h._ends"), lambda e: e < F.col("d._n"))) + 1)
        cut = (numbered.alias("d").join(F.broadcast(borders).alias("h"), _match("d", "h", self.keys), "left")
               .select("d.*", F.when(F.col("h._rows").isNull(), F.lit(-1)).otherwise(place)
                       .cast("bigint").alias("_cut"))
               .drop("_n"))
        self.df = materialize(cut)

    # -- helpers -------------------------------------------------------------------------------------
    def _window(self, descending: bool = False):
        order = [F.desc(c) if descending else F.asc(c) for c in self.order]
        return W.partitionBy(*self.keys, "_cut").orderBy(*order)

    def _carry(self, summary: Column, combine, descending: bool = False) -> DataFrame:
        """One row per stretch of a hot key with what precedes it: combine(column, window)."""
        order = F.desc("_cut") if descending else F.asc("_cut")
        over_cuts = W.partitionBy(*self.keys).orderBy(order)
        return (self.df.filter(F.col("_cut") >= 0).groupBy(*self.keys, "_cut")
                .agg(summary.alias("_piece"))
                .select(*self.keys, "_cut", combine(F.col("_piece"), over_cuts).alias("_carry")))

    def _with_carry(self, base: DataFrame, carry: DataFrame) -> DataFrame:
        # At most 4 x rows / max_rows stretches exist over all hot keys.
        return (base.alias("b").join(F.broadcast(carry).alias("c"), _match("b", "c", [*self.keys, "_cut"]), "left")
                .select("b.*", F.col("c._carry").alias("_carry")))

    def _finish(self, df: DataFrame) -> "OrderedGroups":
        # Each step refers to its input twice, so a split frame is written out before the next step.
        self.df = materialize(df) if self.split else df
        return self

    def _total_order(self) -> Column:
        return F.struct(*self.order)

    # -- operators -----------------------------------------------------------------------------------
    def previous(self, out: str, *columns: str, following: bool = False) -> "OrderedGroups":
        """`out` = struct of `columns` from the previous (or following) row of the key, NULL at its edge."""
        value = F.struct(*columns)
        window = self._window(descending=following)
        base = self.df.withColumn(out, F.lag(value).over(window))
        if not self.split:
            return self._finish(base)
        edge = F.min_by(value, self._total_order()) if following else F.max_by(value, self._total_order())
        carry = self._carry(edge, lambda c, w: F.lag(c).over(w), descending=following)
        joined = self._with_carry(base, carry)
        return self._finish(joined.withColumn(out, F.coalesce(out, "_carry")).drop("_carry"))

    def running_sum(self, out: str, value: Column) -> "OrderedGroups":
        """Sum from the first row of the key up to the current row."""
        frame = (W.unboundedPreceding, W.currentRow)
        base = self.df.withColumn("_v", value)
        self.df = base
        result = base.withColumn(out, F.sum("_v").over(self._window().rowsBetween(*frame)))
        if self.split:
            carry = self._carry(F.sum("_v"), lambda c, w: F.sum(c).over(w.rowsBetween(W.unboundedPreceding, -1)))
            result = (self._with_carry(result, carry)
                      .withColumn(out, F.coalesce(F.col(out) + F.col("_carry"), F.col("_carry"), F.col(out)))
                      .drop("_carry"))
        return self._finish(result.drop("_v"))

    def running_extreme(self, out: str, value: Column, largest: bool = True,
                        backwards: bool = False) -> "OrderedGroups":
        """Max (or min) over all earlier (or, backwards, all later) rows of the key, current row excluded."""
        pick = F.max if largest else F.min
        frame = (W.unboundedPreceding, -1)
        self.df = self.df.withColumn("_v", value)
        result = self.df.withColumn(out, pick("_v").over(self._window(descending=backwards).rowsBetween(*frame)))
        if self.split:
            carry = self._carry(pick("_v"), lambda c, w: pick(c).over(w.rowsBetween(*frame)), descending=backwards)
            both = F.greatest if largest else F.least
            result = (self._with_carry(result, carry)
                      .withColumn(out, both(F.col(out), F.col("_carry"))).drop("_carry"))
        return self._finish(result.drop("_v"))

    def last_known(self, out: str, value: Column, include_current: bool = True) -> "OrderedGroups":
        """Latest non-NULL value at or before the current row of the key."""
        end = W.currentRow if include_current else -1
        self.df = self.df.withColumn("_v", value)
        result = self.df.withColumn(out, F.last("_v", ignorenulls=True).over(
            self._window().rowsBetween(W.unboundedPreceding, end)))
        if self.split:
            latest = F.max_by("_v", F.when(F.col("_v").isNotNull(), self._total_order()))
            carry = self._carry(latest, lambda c, w: F.last(c, ignorenulls=True).over(
                w.rowsBetween(W.unboundedPreceding, -1)))
            result = (self._with_carry(result, carry)
                      .withColumn(out, F.coalesce(out, "_carry")).drop("_carry"))
        return self._finish(result.drop("_v"))

    def where(self, condition: Column) -> "OrderedGroups":
        self.df = self.df.filter(condition)
        return self

    def result(self) -> DataFrame:
        return self.df.drop("_cut")
