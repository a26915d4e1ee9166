"""Data-quality checks and reject trails. A check returns its failing rows."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from rivulet.functions.clean import clean_text
from rivulet.operators.joins import drop_known, fill_months, flag_known, monthly_counts
from rivulet.operators.reshape import month_series
from rivulet.operators.summaries import median_nonzero


def require_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    missing = sorted(set(cols) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns {missing}; available: {sorted(df.columns)}")
    return df


def require_nonempty(df: DataFrame, what: str = "input") -> DataFrame:
    if df.isEmpty():
        raise ValueError(f"{what} has no rows")
    return df


def require_parent(df: DataFrame, parent: DataFrame, what: str) -> DataFrame:
    """The rows, but reading any of them fails while the referential is empty.

    An existence filter over an empty referential would drop every row silently. The
    referential is looked at when the plan runs, and only for a first row.
    """
    filled = parent.limit(1).agg(F.count(F.lit(1)).alias("n")).scalar() > 0
    return df.where(F.when(filled, F.lit(True)).otherwise(
        F.raise_error(F.lit(f"{what}: the referential has no rows")).cast("boolean")))


def require_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(cols))


def require_any(df: DataFrame, cols: Sequence[str | Column]) -> DataFrame:
    """Keep rows with at least one of the measures."""
    return df.where(F.coalesce(*cols).isNotNull())


def not_null(df: DataFrame, col: str, where: str | None = None) -> DataFrame:
    return _scope(df, where).where(F.col(col).isNull())


def unique(df: DataFrame, cols: Sequence[str], where: str | None = None) -> DataFrame:
    """Key values that occur more than once, with their count."""
    return (_scope(df, where).groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).where("n > 1"))


def accepted_values(df: DataFrame, col: str, values: Sequence, where: str | None = None
                    ) -> DataFrame:
    return _scope(df, where).where(~F.col(col).isin(*values))


def relationships(df: DataFrame, col: str, ref: DataFrame, ref_col: str | None = None,
                  where: str | None = None, spread: Sequence[str] = ()) -> DataFrame:
    """Rows whose non-NULL key has no parent; ``spread`` as in ``salted_join``."""
    parents = ref.select(F.col(ref_col or col).alias(col))
    return drop_known(_scope(df, where).where(F.col(col).isNotNull()), parents, col,
                      spread)


def accepted_range(df: DataFrame, col: str, lo=None, hi=None, where: str | None = None
                   ) -> DataFrame:
    bad = F.lit(False)
    if lo is not None:
        bad = bad | (F.col(col) < lo)
    if hi is not None:
        bad = bad | (F.col(col) > hi)
    return _scope(df, where).where(bad)


def expression_is_true(df: DataFrame, expr: str, where: str | None = None) -> DataFrame:
    """Rows where the expression is false; NULL counts as false."""
    return _scope(df, where).where(~F.coalesce(F.expr(expr), F.lit(False)))


def _scope(df: DataFrame, where: str | None) -> DataFrame:
    return df.where(where) if where else df


@dataclass(frozen=True)
class Check:
    """``failing`` gives the failing rows. A check of single rows may give a condition
    (true where a row fails) instead; all such checks are counted in one pass."""

    name: str
    failing: Callable[[DataFrame], DataFrame] | None = None
    severity: str = "error"
    bad: Column | None = None

    def rows(self, df: DataFrame) -> DataFrame:
        return self.failing(df) if self.bad is None else df.where(self.bad)


class CheckFailed(Exception):
    pass


def run_checks(df: DataFrame, checks: Sequence[Check], audit: str | None = None) -> list[dict]:
    """Count failing rows per check; error checks raise together at the end.

    With ``audit`` the failing rows of each check are kept under that folder.
    """
    report = []
    by_row = {f"_{k}": F.count_if(c.bad) for k, c in enumerate(checks) if c.bad is not None}
    counted = df.agg(*[v.alias(k) for k, v in by_row.items()]).first() if by_row else {}
    for k, check in enumerate(checks):
        failing = counted[f"_{k}"] if check.bad is not None else None
        if audit and failing != 0:
            store_failures(check.rows(df), check.name, audit)
            failing = df.sparkSession.read.parquet(f"{audit}/{check.name}").count()
        elif failing is None:
            failing = check.rows(df).count()
        status = "pass" if failing == 0 else check.severity
        report.append({"check": check.name, "failing": failing, "status": status})
    broken = [r for r in report if r["status"] == "error"]
    if broken:
        raise CheckFailed(f"{broken}")
    return report


def store_failures(failing: DataFrame, name: str, audit: str) -> None:
    failing.write.mode("overwrite").parquet(f"{audit}/{name}")


def freshness(df: DataFrame, moment: str | Column, as_of: str, warn: int, error: int
              ) -> DataFrame:
    """Age in days of the newest row and its class; an empty source is an error."""
    moment = F.col(moment) if isinstance(moment, str) else moment
    age = F.datediff(F.lit(as_of).cast("date"), F.max(moment).cast("date"))
    return df.agg(F.max(moment).alias("latest"), age.alias("age_days")).withColumn(
        "status", F.when(F.col("age_days").isNull() | (F.col("age_days") > error), F.lit("error"))
        .when(F.col("age_days") > warn, F.lit("warn")).otherwise(F.lit("pass")))


def completeness(df: DataFrame, day: str, as_of: str, months: int = 13, min_pct: float = 50.0
                 ) -> DataFrame:
    """Rows per complete month: MISSING at 0, PARTIAL below a share of the median."""
    this_month = F.trunc(F.lit(as_of).cast("date"), "month")
    recent = df.where((F.col(day) >= F.add_months(this_month, -months))
                      & (F.col(day) < this_month))
    calendar = month_series(df, as_of, months)
    filled = fill_months(monthly_counts(recent, day), calendar, "m", "n")
    # thirteen rows; an all-empty window has a NULL median and only MISSING months
    median = median_nonzero(filled, "n")
    scored = filled.withColumn("median", median.scalar())
    return scored.withColumn("status", F.when(F.col("n") == 0, F.lit("MISSING"))
                             .when(F.col("n") < F.col("median") * min_pct / 100, F.lit("PARTIAL"))
                             .otherwise(F.lit("OK")))


def completeness_failures(sources: Mapping[str, tuple[DataFrame, str]], as_of: str,
                          months: int = 13, min_pct: float = 50.0) -> list[str]:
    """The monitor: raise when any source misses a month."""
    found = []
    for label, (df, day) in sources.items():
        bad = completeness(df, day, as_of, months, min_pct).where("status <> 'OK'")
        found += [f"[{label}] {r['m']:%Y-%m}: {r['status']} ({r['n']} rows)"
                  for r in bad.orderBy("m").collect()]
    if found:
        raise CheckFailed("; ".join(found))
    return found


def label_rejects(df: DataFrame, rules: Sequence[tuple[str, Column]],
                  name: str = "rejection_reason") -> DataFrame:
    """First matching rule wins; NULL means accepted. A NULL condition does not match."""
    chain = F
    for label, condition in rules:
        chain = chain.when(F.coalesce(condition, F.lit(False)), F.lit(label))
    return df.withColumn(name, chain.otherwise(F.lit(None).cast("string")))


def labelled_rejects(df: DataFrame, rules: Sequence[tuple[str, Column]],
                     ref: DataFrame | None = None, key: str | None = None,
                     ref_key: str | None = None, known: str = "_known", row_id: str = "_dlt_id"
                     ) -> DataFrame:
    """All rows with ``rejection_reason``, NULL for accepted ones.

    With ``ref`` the rules may use the boolean column ``known``: the key exists
    in the referential. The key is joined in its cleaned text form, spread by ``row_id``.
    """
    source = df
    if ref is not None:
        keyed = df.withColumn("_ref_key", clean_text(key))
        parents = ref.select(F.col(ref_key or key).alias("_ref_key"))
        source = flag_known(keyed, parents, "_ref_key", known,
                            spread=[row_id] if row_id in df.columns else ())
    return label_rejects(source, rules).select(*df.columns, "rejection_reason")


def split_labelled(labelled: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected with a reason); see ``tables.store_split`` to scan the rows once."""
    accepted = labelled.where("rejection_reason is null").drop("rejection_reason")
    return accepted, labelled.where("rejection_reason is not null")


def split_rejects(df: DataFrame, rules: Sequence[tuple[str, Column]], ref: DataFrame | None = None,
                  key: str | None = None, ref_key: str | None = None,
                  known: str = "_known", row_id: str = "_dlt_id"
                  ) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected with a reason), each planned from the rows."""
    return split_labelled(labelled_rejects(df, rules, ref, key, ref_key, known, row_id))


def append_rejects(old: DataFrame, new: DataFrame, row_id: str = "_dlt_id") -> DataFrame:
    """New rejects that are not logged yet; the log itself is append-only."""
    return drop_known(new, old, row_id)
