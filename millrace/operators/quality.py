"""Named rules, quarantine, key and reference checks, drift."""
from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from millrace.functions import dates, money
from millrace.operators.skew import MAX_GROUP_ROWS, OrderedGroups, salted_join

STAGES = ("structure", "keys", "types", "business")


@dataclass(frozen=True)
class Rule:
    """`fails` is TRUE for a bad row; NULL counts as passing."""
    name: str
    stage: str
    fails: Column


def ordered(rules: Sequence[Rule]) -> list[Rule]:
    return sorted(rules, key=lambda r: STAGES.index(r.stage))


def first_reason(rules: Sequence[Rule]) -> Column:
    """Name of the first failing rule, in the order structure, keys, types, business."""
    return F.coalesce(*[F.when(r.fails, F.lit(r.name)) for r in ordered(rules)])


def apply_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    return df.withColumn("reason", first_reason(rules))


def split_quarantine(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """(good, quarantined with `reason`); together they are the input, row for row."""
    judged = apply_rules(df, rules)
    return judged.filter(F.col("reason").isNull()).drop("reason"), judged.filter(F.col("reason").isNotNull())


def rule_results(df: DataFrame, rules: Sequence[Rule], by: Sequence[str] = ()) -> DataFrame:
    """(by, rule, rows_checked, rows_failed) from one pass over the data, whatever the number of rules.

    rows_checked says whether there was anything to check: no failures among no rows prove nothing.
    """
    counted = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows_checked"),
        *[F.count_if(r.fails).alias(f"_f{i}") for i, r in enumerate(rules)])
    pairs = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.col(f"_f{i}").alias("rows_failed"))
                      for i, r in enumerate(rules)])
    return (counted.select(*by, "rows_checked", F.explode(pairs).alias("p"))
            .select(*by, "p.rule", "rows_checked", "p.rows_failed"))


def source_texts(columns: dict[str, str]) -> list[str]:
    """Names under which a typed projection keeps what the source sent."""
    return [name if kind == "string" else f"{name}_text" for name, kind in columns.items()]


def malformed(columns: dict[str, str]) -> Rule:
    """A record none of whose source columns has a value."""
    return Rule("malformed_record", "structure", F.coalesce(*[F.col(c) for c in source_texts(columns)]).isNull())


def transaction_rules(currencies: Sequence[str], columns: dict[str, str]) -> list[Rule]:
    """The payment feed's rules over a typed projection of `columns`."""
    c = F.col
    return [
        malformed(columns),
        Rule("missing_transaction_id", "keys", c("transaction_id").isNull()),
        Rule("invalid_amount", "types", c("amount").isNull() & c("amount_text").isNotNull()),
        Rule("invalid_event_ts", "types", c("event_ts").isNull() & c("event_ts_text").isNotNull()),
        Rule("invalid_due_date", "types", c("due_date").isNull() & c("due_date_text").isNotNull()),
        Rule("invalid_currency", "business", ~c("currency").isin(list(currencies))),
        Rule("negative_amount", "business", c("amount") <= 0),
        Rule("future_event_ts", "business", dates.local_date("event_ts") > c("_batch_date")),
        Rule("bill_without_biller", "business",
             (c("transaction_type") == "bill_payment") & c("biller_id").isNull()),
    ]


def domain_rules(domains: dict[str, Sequence[str]]) -> list[Rule]:
    return [Rule(f"{column}_domain", "business", ~F.col(column).isin(list(values)))
            for column, values in domains.items()]


def contract_rules(columns: dict[str, str], keys: Sequence[str] = (), domains: dict[str, Sequence[str]] | None = None) -> list[Rule]:
    """What a contract alone says of a typed projection: whole records, keys, values that fit their types, code values."""
    typed = [c for c, kind in columns.items() if kind != "string"]
    return [malformed(columns), *[Rule(f"missing_{k}", "keys", F.col(k).isNull()) for k in keys],
            *[Rule(f"invalid_{c}", "types", F.col(c).isNull() & F.col(f"{c}_text").isNotNull()) for c in typed],
            *domain_rules({c: values for c, values in (domains or {}).items() if c in columns})]


# Which kinds of transaction use which field.
USERS = {
    "merchant_id": ["purchase", "refund"], "biller_id": ["bill_payment"],
    "bill_reference": ["bill_payment"], "due_date": ["bill_payment"],
    "counterparty_iban": ["transfer_out"], "original_transaction_id": ["refund"],
}


def cross_field_rules(kind: str = "transaction_type", users: dict[str, Sequence[str]] | None = None) -> list[Rule]:
    """Fields that must be empty unless the kind of row uses them."""
    return [Rule(f"{field}_not_applicable", "business", F.col(field).isNotNull() & ~F.col(kind).isin(list(kinds)))
            for field, kinds in (users or USERS).items()]


def id_prefix_fails(identifier: str, kind: str, business_date: str,
                    letters: dict[str, str] = money.STREAM_BY_ID_LETTER) -> Column:
    """The id's letter names the stream and its digits the business date."""
    pattern = r"^T(\d{8})([PRBXS])"
    stream = money.lookup(F.regexp_extract(identifier, pattern, 2), letters)
    day = F.regexp_extract(identifier, pattern, 1)
    return ~(stream.eqNullSafe(F.col(kind)) & (day == F.date_format(business_date, "yyyyMMdd")))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys used more than once; NULL keys belong to another rule."""
    return (df.dropna(subset=list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
            .filter(F.col("copies") > 1))


def missing_parents(child: DataFrame, parent: DataFrame, on: dict[str, str],
                    max_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """Child rows whose (non-NULL) reference has no parent. The parent side is reduced to distinct keys."""
    keys = list(on)
    known = parent.select(*[F.col(p).alias(c) for c, p in on.items()]).distinct()
    return salted_join(child.dropna(subset=keys), known, keys, "left_anti", max_rows=max_rows)


def orphans_as_of(facts: DataFrame, master: DataFrame, key: str, as_of: str, first_seen: str,
                  max_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """Adds orphan_now (unknown today) and orphan_as_of (unknown on the row's own date); keeps every fact."""
    known = master.groupBy(key).agg(F.min(first_seen).alias("_first_seen"))
    joined = salted_join(facts, known, [key], "left", max_rows=max_rows)
    present = F.col("_first_seen").isNotNull()
    return (joined.withColumn("orphan_now", F.col(key).isNotNull() & ~present)
            .withColumn("orphan_as_of", F.col(key).isNotNull()
                        & F.coalesce(F.col("_first_seen") > F.col(as_of), F.lit(True)))
            .drop("_first_seen"))


def sequence_findings(changes: DataFrame, scope: Sequence[str], seq: str, batch_date: str) -> DataFrame:
    """Change sequences that repeat within a scope or whose leading date is not the batch date."""
    counted = changes.groupBy(*scope, seq, batch_date).agg(F.count(F.lit(1)).alias("uses"))
    per_seq = counted.groupBy(*scope, seq).agg(F.sum("uses").alias("uses"), F.min(batch_date).alias(batch_date),
                                               F.max(batch_date).alias("_last"))
    wrong_day = ~dates.sequence_day(seq).eqNullSafe(F.col(batch_date)) | (F.col("_last") != F.col(batch_date))
    finding = F.when(F.col("uses") > 1, "repeated").when(wrong_day, "wrong_day")
    return per_seq.withColumn("finding", finding).filter(F.col("finding").isNotNull()).drop("_last")


def out_of_order(rows: DataFrame, keys: Sequence[str], arrival: Sequence[str], seq: str,
                 max_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """Rows whose sequence is not above every earlier arrival of the same key."""
    groups = OrderedGroups(rows, keys, arrival, max_rows).running_extreme("_highest", F.col(seq))
    return groups.result().filter(F.col(seq) <= F.col("_highest")).drop("_highest")


def lifecycle_findings(rows: DataFrame, keys: Sequence[str], order: Sequence[str], status: str,
                       allowed: dict[str | None, Sequence[str]], max_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """Rows whose status may not follow the previous one; `allowed[None]` lists the first states."""
    groups = OrderedGroups(rows, keys, order, max_rows).previous("_before", status)
    previous = F.col(f"_before.{status}")
    follows = F.lit(False)
    for before, after in allowed.items():
        state = F.col("_before").isNull() if before is None else previous == before
        follows = follows | (state & F.col(status).isin(list(after)))
    return (groups.result().withColumn("previous_status", previous)
            .filter(~F.coalesce(follows, F.lit(False))).drop("_before"))


def running_delete_findings(changes: DataFrame, keys: Sequence[str], order: Sequence[str], op: str = "op",
                            max_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """Deletes of a row that is not live, and inserts of one that is."""
    delta = F.when(F.col(op) == "I", 1).when(F.col(op) == "D", -1).otherwise(0)
    rows = (OrderedGroups(changes, keys, order, max_rows).running_sum("_live", delta).result())
    bad = ((F.col(op) == "D") & (F.col("_live") != 0)) | ((F.col(op) == "I") & (F.col("_live") != 1))
    return rows.withColumn("live_after", F.col("_live").cast("bigint")).filter(bad).drop("_live")


def null_rates(df: DataFrame, batch: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """(batch, column_name, rows, null_rows) from one aggregate over all columns."""
    counted = df.groupBy(*batch).agg(F.count(F.lit(1)).alias("rows"),
                                     *[F.count_if(F.col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(columns)])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"_n{i}").alias("null_rows"))
                      for i, c in enumerate(columns)])
    return (counted.select(*batch, "rows", F.explode(pairs).alias("p"))
            .select(*batch, "p.column_name", "rows", "p.null_rows"))


def null_rate_alerts(rates: DataFrame, batch_date: str, window_batches: int = 7,
                     min_increase_pct: int = 20) -> DataFrame:
    """Batches whose null share exceeds the trailing share by so many percentage points.

    Works on one row per batch and column. Shares are compared as integer percentages of row counts.
    """
    trailing = W.partitionBy("column_name").orderBy(batch_date).rowsBetween(-window_batches, -1)
    share = (F.col("null_rows") * 100 / F.col("rows"))
    before = F.sum("null_rows").over(trailing) * 100 / F.sum("rows").over(trailing)
    return (rates.withColumn("null_pct", F.floor(share).cast("bigint"))
            .withColumn("baseline_pct", F.floor(before).cast("bigint"))
            .filter(F.col("null_pct") - F.col("baseline_pct") >= min_increase_pct))


def schema_drift(keys_seen: DataFrame, contract: Sequence[str], batch: Sequence[str]) -> DataFrame:
    """keys_seen (batch, field) against the contract's fields: 'unexpected' and 'missing' per batch."""
    seen = keys_seen.select(*batch, "field").distinct()
    expected = (seen.select(*batch).distinct()
                .select(*batch, F.explode(F.array(*[F.lit(f) for f in contract])).alias("field")))
    return (seen.withColumn("_s", F.lit(1))
            .join(expected.withColumn("_e", F.lit(1)), [*batch, "field"], "full_outer")
            .filter(F.col("_s").isNull() | F.col("_e").isNull())
            .select(*batch, "field", F.when(F.col("_e").isNull(), "unexpected").otherwise("missing").alias("finding")))
