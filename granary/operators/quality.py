"""Data-quality checks in few passes over the data.

Every check is one row of a frame with the columns of :data:`CHECK_COLUMNS`.
All rules that look at single rows share one aggregate; uniqueness and
referential integrity aggregate by key before anything else, so a key held by
many rows is one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary import schemas
from granary.functions.clean import Mapping, convert
from granary.session import stage

CRITICAL, WARNING, INFO = "CRITICAL", "WARNING", "INFO"

# Tolerated shares of unresolved keys, row and amount differences.
MAX_UNRESOLVED = 0.005
MAX_ROW_VARIANCE = 0.005
MAX_AMOUNT_VARIANCE = 0.001

CHECK_COLUMNS = [
    "name",
    "severity",
    "passed",
    "message",
    "failed_rows",
    "total_rows",
    "pass_rate",
]


class DataQualityError(ValueError):
    """A critical check failed."""


@dataclass(frozen=True)
class Rule:
    """A rule on single rows: ``failed`` is true for a row that breaks it."""

    name: str
    failed: Column
    severity: str = CRITICAL
    max_rate: float = 0.0


def not_null(column: str, severity: str = CRITICAL, max_null_rate: float = 0.0) -> Rule:
    return Rule(f"not_null:{column}", F.col(column).isNull(), severity, max_null_rate)


def accepted_values(column: str, accepted: Sequence[str], severity: str = WARNING) -> Rule:
    return Rule(f"accepted_values:{column}", ~F.col(column).isin(list(accepted)), severity)


def not_negative(column: str, severity: str = CRITICAL) -> Rule:
    return Rule(f"not_negative:{column}", F.col(column) < 0, severity)


def business_rule(name: str, failed: Column, severity: str = CRITICAL) -> Rule:
    return Rule(f"business_rule:{name}", failed, severity)


def gross_gte_net() -> Rule:
    return business_rule("gross_gte_net", F.col("gross_amount") < F.col("net_amount"))


def fits_length(column: str, longest: int, severity: str = CRITICAL) -> Rule:
    return Rule(f"max_length:{column}", F.length(column) > longest, severity)


def convertible(source: str, kind: str, severity: str = CRITICAL) -> Rule:
    """The value of a source column is absent or fits the model type."""
    bad = F.col(source).isNotNull() & convert(F.col(source), kind).isNull()
    return Rule(f"type:{source}", bad, severity)


def _result(
    name: Column, severity: Column, failed: Column, total: Column, max_rate: Column
) -> list[Column]:
    rate = F.when(total > 0, failed / total).otherwise(F.lit(0.0))
    return [
        name.alias("name"),
        severity.alias("severity"),
        (rate <= max_rate).alias("passed"),
        F.format_string(
            "%d of %d rows fail (rate %.6f, allowed %.6f)", failed, total, rate, max_rate
        ).alias("message"),
        failed.alias("failed_rows"),
        total.alias("total_rows"),
        F.when(total > 0, (total - failed) / total).alias("pass_rate"),
    ]


def _rule_struct(rule: Rule, failed: Column, total: Column) -> Column:
    return F.struct(
        *_result(F.lit(rule.name), F.lit(rule.severity), failed, total, F.lit(rule.max_rate))
    )


def _rows_of(one_row: DataFrame, checks: Sequence[Column]) -> DataFrame:
    return one_row.select(F.inline(F.array(*checks))).select(*CHECK_COLUMNS)


def _counts(rules: Sequence[Rule], among: Column | None = None) -> list[Column]:
    """Aggregates for ``rules``: rows looked at and failures of each, ``among`` some rows."""
    if among is None:
        return [
            F.count("*").alias("_total"),
            *[F.count_if(r.failed).alias(f"_f{i}") for i, r in enumerate(rules)],
        ]
    return [
        F.count_if(among).alias("_total"),
        *[F.count_if(among & r.failed).alias(f"_f{i}") for i, r in enumerate(rules)],
    ]


def _counted(rules: Sequence[Rule]) -> list[Column]:
    total = F.col("_total")
    return [_rule_struct(r, F.col(f"_f{i}"), total) for i, r in enumerate(rules)]


def row_checks(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """All ``rules`` in one aggregate over ``df``."""
    return _rows_of(df.agg(*_counts(rules)), _counted(rules))


def unique_check(df: DataFrame, columns: Sequence[str], severity: str = CRITICAL) -> DataFrame:
    """Rows beyond the first of each key; nulls are one key."""
    sizes = df.groupBy(*columns).agg(F.count("*").alias("_n"))
    totals = sizes.agg(
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("_failed"),
        F.coalesce(F.sum("_n"), F.lit(0)).alias("_total"),
    )
    rule = Rule(f"unique:{'+'.join(columns)}", F.lit(False), severity)
    return _rows_of(totals, [_rule_struct(rule, F.col("_failed"), F.col("_total"))])


@dataclass(frozen=True)
class Reference:
    """A foreign key of the checked frame and the column it points at."""

    fk: str
    dim: DataFrame
    pk: str
    severity: str = CRITICAL
    max_rate: float = MAX_UNRESOLVED

    @property
    def name(self) -> str:
        return f"referential_integrity:{self.fk}→{self.pk}"


def integrity_checks(df: DataFrame, references: Sequence[Reference]) -> DataFrame:
    """Rows whose foreign key the dimension lacks.

    Each key column is read by itself and counted per value, in its own type and
    map side first, before it meets the dimension, which is broadcast where its
    size allows. A null key counts as unresolved.
    """
    def check(r: Reference) -> DataFrame:
        used = df.groupBy(F.col(r.fk).alias("_fk")).agg(F.count("*").alias("_n"))
        known = r.dim.select(F.col(r.pk).alias("_pk")).distinct().withColumn("_known", F.lit(True))
        one = used.join(known, F.col("_fk") == F.col("_pk"), "left").agg(
            F.coalesce(F.sum("_n"), F.lit(0)).alias("_total"),
            F.coalesce(F.sum(F.when(F.col("_known").isNull(), F.col("_n"))), F.lit(0)).alias("_failed"),
        )
        rule = Rule(r.name, F.lit(False), r.severity, float(r.max_rate))
        return _rows_of(one, [_rule_struct(rule, F.col("_failed"), F.col("_total"))])

    return reduce(DataFrame.unionByName, [check(r) for r in references])


def _variance(source: Column, target: Column) -> Column:
    """Difference as a share of the source; an empty source only matches an empty target."""
    gap = F.abs(source.cast("double") - target.cast("double"))
    return F.when(source == 0, F.when(target == 0, 0.0).otherwise(1.0)).otherwise(
        gap / F.abs(source.cast("double"))
    )


def _reconciliation(name: str, source: Column, target: Column, allowed: float) -> Column:
    variance = _variance(source, target)
    return F.struct(
        F.lit(f"reconciliation:{name}").alias("name"),
        F.lit(CRITICAL).alias("severity"),
        (variance <= allowed).alias("passed"),
        F.format_string(
            "source %s, target %s (variance %.6f, allowed %.6f)",
            source.cast("string"),
            target.cast("string"),
            variance,
            F.lit(allowed),
        ).alias("message"),
        F.lit(0).cast("long").alias("failed_rows"),
        F.lit(0).cast("long").alias("total_rows"),
        F.lit(None).cast("double").alias("pass_rate"),
    )


def _reconciliations(
    table: str, column: str, counts: tuple[Column, Column], sums: tuple[Column, Column]
) -> list[Column]:
    return [
        _reconciliation(f"row_count:{table}", *counts, MAX_ROW_VARIANCE),
        _reconciliation(f"amount:{column}:{table}", *sums, MAX_AMOUNT_VARIANCE),
    ]


def totals(df: DataFrame, amount: str) -> DataFrame:
    """One row: ``row_count`` and ``amount_total``."""
    return df.agg(
        F.count("*").alias("row_count"),
        F.coalesce(F.sum(amount), F.lit(0)).cast("decimal(38,4)").alias("amount_total"),
    )


def reconcile_totals(source: DataFrame, target: DataFrame, table: str, column: str) -> DataFrame:
    """Row count and amount of two one-row frames as :func:`totals` gives them."""
    sides = source.withColumn("side", F.lit("s")).unionByName(target.withColumn("side", F.lit("t")))
    one = sides.agg(
        *[
            F.max(F.when(F.col("side") == side, F.col(c))).alias(f"{side}_{c}")
            for side in ("s", "t")
            for c in ("row_count", "amount_total")
        ]
    )
    return _rows_of(
        one,
        _reconciliations(
            table,
            column,
            (F.col("s_row_count"), F.col("t_row_count")),
            (F.col("s_amount_total"), F.col("t_amount_total")),
        ),
    )


def reconcile(
    source: DataFrame, target: DataFrame, table: str, source_amount: str, target_amount: str
) -> DataFrame:
    """Compare row count and amount of any two frames."""
    return reconcile_totals(
        totals(source, source_amount), totals(target, target_amount), table, target_amount
    )


def fingerprints(df: DataFrame, keys: Sequence[str], columns: Sequence[str], day: str, buckets: int) -> DataFrame:
    """Count, sum and xor of the hashes of rows by day and key bucket: equal for equal rows in whatever order.

    The sum tells repeated rows, which a xor alone would cancel. Tasks add up
    their own rows first, so a hot day or key travels as one row a task.
    """
    values = [*keys, day, *columns]
    # A hash passes over nulls: flags tell which columns they stand in.
    own = F.xxhash64(*values, *[F.col(c).isNull() for c in values])
    rows = df.select(F.col(day).alias("day"), _bucket(keys, buckets).alias("bucket"), own.alias("h"))
    return rows.groupBy("day", "bucket").agg(
        F.count("*").alias("n"), F.sum(F.col("h").cast("decimal(20,0)")).alias("total"), F.bit_xor("h").alias("xor")
    )


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets))


def differing_rows(
    source: DataFrame, target: DataFrame, keys: Sequence[str], columns: Sequence[str], day: str, buckets: int = 1024
) -> DataFrame:
    """Rows that one frame has more often than the other: keys, day, columns, ``in_source`` and ``in_target``.

    Found also where counts and totals agree, as when two amounts are swapped.
    Fingerprints are compared by day first and then by bucket; only rows of
    buckets that differ are laid side by side, summed by all their columns, so
    nothing is joined row by row and repeated rows and nulls count like others.
    Values are compared in the types of ``source``.
    """
    values = [*keys, day, *columns]
    kinds = {f.name: f.dataType for f in source.select(values).schema.fields}
    sides = [source.select(values), target.select(*[F.col(c).cast(kinds[c]).alias(c) for c in values])]
    marked = [
        fingerprints(df, keys, columns, day, buckets).select("day", "bucket", (F.lit(sign) * F.col("n")).alias("n"), (F.lit(sign) * F.col("total")).alias("total"), "xor")
        for df, sign in zip(sides, (1, -1), strict=True)
    ]
    gap = [F.sum("n").alias("n"), F.sum("total").alias("total"), F.bit_xor("xor").alias("xor")]
    unequal = (F.col("n") != 0) | (F.col("total") != 0) | (F.col("xor") != 0)
    cells = stage(marked[0].unionAll(marked[1]).groupBy("day", "bucket").agg(*gap).filter(unequal), "unequal")
    both = []
    for df, side in zip(sides, ("in_source", "in_target"), strict=True):
        cell = (F.col(day).eqNullSafe(F.col("day_"))) & (_bucket(keys, buckets) == F.col("bucket_"))
        rows = df.join(cells.select(F.col("day").alias("day_"), F.col("bucket").alias("bucket_")), cell, "left_semi")
        both.append(rows.withColumn("side", F.lit(side)))
    counts = [F.count_if(F.col("side") == side).alias(side) for side in ("in_source", "in_target")]
    return both[0].unionByName(both[1]).groupBy(*values).agg(*counts).filter("in_source != in_target")


def schema_checks(df: DataFrame, expected: T.StructType) -> DataFrame:
    """Presence and type of every expected column, from the schema alone."""
    have = {f.name: f.dataType for f in df.schema.fields}
    rows = []
    for f in expected.fields:
        got = have.get(f.name)
        rows.append((f"column_present:{f.name}", got is not None, "missing" if got is None else "ok"))
        if got is not None:
            same = got == f.dataType
            text = "ok" if same else f"is {got.simpleString()}, not {f.dataType.simpleString()}"
            rows.append((f"column_type:{f.name}", same, text))
    frame = df.sparkSession.createDataFrame(rows, "name string, passed boolean, message string")
    return frame.select(
        "name",
        F.lit(CRITICAL).alias("severity"),
        "passed",
        "message",
        F.lit(0).cast("long").alias("failed_rows"),
        F.lit(0).cast("long").alias("total_rows"),
        F.lit(None).cast("double").alias("pass_rate"),
    )


def missing_columns(df: DataFrame, expected: T.StructType) -> list[str]:
    """Names of ``expected`` that ``df`` lacks; letter case does not count."""
    have = {c.lower() for c in df.columns}
    return [n for n in expected.names if n.lower() not in have]


def source_checks(
    df: DataFrame, mapping: Mapping, table: str, severity: str = CRITICAL
) -> DataFrame:
    """Conversion and length of a source table's columns, in one aggregate."""
    longest = schemas.MAX_LENGTH.get(table, {})
    rules = [
        convertible(s, kind, severity) for s, _, kind in mapping if kind not in ("string", "title")
    ]
    rules += [fits_length(s, longest[t], severity) for s, t, _ in mapping if t in longest]
    return row_checks(df, rules)


def fact_rules() -> list[Rule]:
    """The rules on single fact rows."""
    required = ["transaction_bk", "time_sk", "customer_sk", "product_sk", "gross_amount", "net_amount"]
    return [
        *[not_null(c) for c in required],
        accepted_values("transaction_type", schemas.TRANSACTION_TYPES),
        accepted_values("transaction_status", schemas.TRANSACTION_STATUSES),
        not_negative("fee_amount", WARNING),
        not_negative("net_amount"),
        gross_gte_net(),
    ]


#: Columns of a flagged fact that :func:`fact_suite` reads, so that others need not be written for it.
SUITE_COLUMNS = [
    "transaction_bk", "time_sk", "customer_sk", "product_sk", "gross_amount", "net_amount",
    "fee_amount", "transaction_type", "transaction_status", "reasons",
]


def fact_suite(
    flagged: DataFrame,
    valid: Column,
    dim_customer: DataFrame,
    dim_product: DataFrame,
    dim_time: DataFrame,
    source_totals: DataFrame,
    max_unresolved: float = MAX_UNRESOLVED,
    referring: Column | None = None,
) -> DataFrame:
    """Fifteen checks and two reconciliations of a fact batch, in three passes.

    Rules on single rows and uniqueness look at the ``valid`` rows, which are to
    be loaded. The share of unresolved keys and the totals look at all rows,
    with the rejected ones. ``source_totals`` is one row as :func:`totals` gives
    it. Single-row rules and totals share one aggregate. The share of unresolved
    keys is that among the ``referring`` rows, by default all.
    """
    rules = fact_rules()
    one = flagged.agg(
        *_counts(rules, valid),
        F.count("*").alias("_rows"),
        F.coalesce(F.sum("net_amount"), F.lit(0)).cast("decimal(38,4)").alias("_amount"),
    )
    sides = _reconciliations(
        "fact_transactions",
        "net_amount",
        (source_totals.select("row_count").scalar(), F.col("_rows")),
        (source_totals.select("amount_total").scalar(), F.col("_amount")),
    )
    rows = _rows_of(one, [*_counted(rules), *sides])
    unique = unique_check(flagged.filter(valid), ["transaction_bk"])
    keys = integrity_checks(
        flagged if referring is None else flagged.filter(referring),
        [
            Reference("customer_sk", dim_customer, "customer_sk", max_rate=max_unresolved),
            Reference("product_sk", dim_product, "product_sk", max_rate=max_unresolved),
            Reference("time_sk", dim_time, "time_sk", max_rate=max_unresolved),
        ],
    )
    return rows.unionByName(unique).unionByName(keys)


@dataclass
class Report:
    """The collected checks of one table: a handful of rows."""

    table: str
    batch_id: str
    checks: list[dict] = field(default_factory=list)

    @classmethod
    def collect(cls, table: str, batch_id: str, checks: DataFrame) -> Report:
        return cls(table, batch_id, [r.asDict() for r in checks.collect()])

    @property
    def critical_failures(self) -> list[dict]:
        return [c for c in self.checks if c["severity"] == CRITICAL and not c["passed"]]

    @property
    def passed(self) -> bool:
        return not self.critical_failures

    def summary(self) -> str:
        good = sum(c["passed"] for c in self.checks)
        verdict = "passed" if self.passed else "failed"
        return f"{self.table} {self.batch_id}: {good} of {len(self.checks)} checks hold, {verdict}"

    def raise_for_failures(self) -> Report:
        if not self.passed:
            names = ", ".join(c["name"] for c in self.critical_failures)
            raise DataQualityError(f"{self.summary()}: {names}")
        return self


def report_frame(checks: DataFrame) -> DataFrame:
    """The verdict over a frame of checks, one row."""
    critical_failed = (F.col("severity") == CRITICAL) & ~F.col("passed")
    return checks.agg(
        F.count("*").alias("checks"),
        F.count_if("passed").alias("checks_passed"),
        F.count_if(critical_failed).alias("critical_failures"),
        (F.count_if(critical_failed) == 0).alias("passed"),
    )
