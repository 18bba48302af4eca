"""Rules and what can be done with them: scan, compose, split, report.

A rule turns a text column into a risk between 0 and 1 and, where it knows how,
into a repaired text. Rules are plain Column expressions, so scanning is one
projection over the table: no shuffle, no Python in the executors.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textguard.session import new_path

Expression = Callable[[Column], Column]


@dataclass(frozen=True)
class Rule:
    """``risk`` scores a text, ``fix`` repairs it (None: there is no repair).

    A text is valid while its risk stays below ``limit``; at limit 0 only a risk
    of 0 is valid. With ``measure`` the text is measured once, and the risk and
    the ``details`` to keep, such as found terms, are taken from the measure;
    ``repair`` is a fix that looks at the measure too.
    """

    name: str
    risk: Expression
    fix: Expression | None = None
    limit: float = 1.0
    on_fail: str = "fix"
    measure: Expression | None = None
    details: Mapping[str, Expression] = field(default_factory=dict)
    repair: Callable[[Column, Column], Column] | None = None


def flag(violated: Column) -> Column:
    """Risk of a yes/no rule."""
    return F.when(violated, 1.0).otherwise(0.0)


def itself(measure: Column) -> Column:
    return measure


def _risk(rule: Rule, text: Column, measure: Column) -> Column:
    return F.when(text.isNotNull(), F.round(rule.risk(measure).cast("double"), 6))


def _verdict(rule: Rule, text: Column, measure: Column, risk: Column) -> Column:
    is_valid = risk < rule.limit if rule.limit > 0 else risk <= 0
    sanitized = text
    if rule.on_fail == "fix":
        if rule.repair:
            fixed = rule.repair(text, measure)
        else:
            fixed = rule.fix(text) if rule.fix else F.lit(None).cast("string")
        sanitized = F.when(is_valid, text).otherwise(fixed)
    return F.struct(
        sanitized.alias("sanitized"),
        is_valid.alias("is_valid"),
        risk.alias("risk_score"),
        *[make(measure).alias(name) for name, make in rule.details.items()],
    )


def scan(df: DataFrame, text: str, *rules: Rule, out: Sequence[str] | None = None) -> DataFrame:
    """Add one verdict struct per rule, each seeing the text as it is.

    Measures, risks and verdicts are three projections, because each of them is
    used more than once by the next.
    """
    named = dict(zip(out or [rule.name for rule in rules], rules))
    measures = {f"__measure_{n}": r.measure(F.col(text)) for n, r in named.items() if r.measure}

    def measured(name: str) -> Column:
        return F.col(f"__measure_{name}" if named[name].measure else text)

    risks = {f"__risk_{n}": _risk(r, F.col(text), measured(n)) for n, r in named.items()}
    verdicts = {
        n: _verdict(r, F.col(text), measured(n), F.col(f"__risk_{n}")) for n, r in named.items()
    }
    scanned = df.withColumns(measures) if measures else df
    return scanned.withColumns(risks).withColumns(verdicts).drop(*measures, *risks)


def compose(df: DataFrame, text: str, rules: Sequence[Rule], out: str = "scan") -> DataFrame:
    """Run the rules in order, each on the text that the rule before left.

    The result is valid if all rules are, has the greatest risk and names the
    rules that failed. A text that a rule could not repair stays NULL, and the
    rules after it have nothing to say.
    """
    current, steps = text, []
    for position, rule in enumerate(rules):
        step = f"__step_{position}"
        df = scan(df, current, rule, out=[step])
        current = f"{step}.sanitized"
        steps.append(step)
    failed = F.array_compact(
        F.array(*[F.when(~F.col(f"{s}.is_valid"), r.name) for s, r in zip(steps, rules)])
    )
    known = F.col(text).isNotNull()
    verdict = F.struct(
        F.col(current).alias("sanitized"),
        F.when(known, F.size(failed) == 0).alias("is_valid"),
        F.when(known, F.greatest(F.lit(0.0), *[F.col(f"{s}.risk_score") for s in steps])).alias(
            "risk_score"
        ),
        F.when(known, failed).alias("failed"),
    )
    return df.withColumn(out, verdict).drop(*steps)


def write_split(df: DataFrame, scan_column: str, path: str) -> None:
    """Write valid and quarantined rows in one pass, as partitions ``passed=...``.

    A row without a verdict is quarantined.
    """
    passed = F.coalesce(F.col(f"{scan_column}.is_valid"), F.lit(False))
    df.withColumn("passed", passed).write.partitionBy("passed").parquet(path)


def split_valid(df: DataFrame, scan_column: str) -> tuple[DataFrame, DataFrame]:
    """Valid rows and quarantined rows, from one scan that is written in two parts.

    Filtering the scanned rows directly would move the condition, and with it the
    whole chain of rules, below the projections and run it a second time.
    """
    path = new_path(df.sparkSession, "split")
    write_split(df, scan_column, path)
    schema = T.StructType([*df.schema.fields, T.StructField("passed", T.BooleanType())])
    both = df.sparkSession.read.schema(schema).parquet(path)
    return both.filter("passed").drop("passed"), both.filter("NOT passed").drop("passed")


def require_valid(df: DataFrame, scan_column: str) -> DataFrame:
    """Strict mode: the job fails at the first row that is not valid."""
    passed = F.coalesce(F.col(f"{scan_column}.is_valid"), F.lit(False))
    failure = F.raise_error(F.concat(F.lit(f"{scan_column} failed for: "), F.to_json(F.struct("*"))))
    checked = F.when(passed, F.col(scan_column)).otherwise(
        failure.cast(df.schema[scan_column].dataType)
    )
    return df.withColumn(scan_column, checked)


def _counts(scan_column: str) -> list[Column]:
    violated = ~F.col(f"{scan_column}.is_valid")
    risk = F.col(f"{scan_column}.risk_score")
    return [
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(violated).alias("n_violations"),
        F.sum(risk).alias("sum_risk"),
        F.count(risk).alias("n_scored"),
        F.max(risk).alias("max_risk"),
    ]


def _report(counted: DataFrame, by: Sequence[str]) -> DataFrame:
    mean = F.round(F.try_divide(F.col("sum_risk"), F.col("n_scored")), 6)
    return counted.select(*by, "n_rows", "n_violations", mean.alias("avg_risk"), "max_risk")


def violation_report(df: DataFrame, by: Sequence[str], scan_column: str = "scan") -> DataFrame:
    """Rows, violations and risks per group."""
    return _report(df.groupBy(*by).agg(*_counts(scan_column)), by)


def violation_rollup(df: DataFrame, by: Sequence[str], scan_column: str = "scan") -> DataFrame:
    """The report with subtotals, rolled up from the grouped counts, so that the
    rows themselves are read and grouped only once."""
    counted = df.groupBy(*by).agg(*_counts(scan_column))
    sums = [F.sum(name).alias(name) for name in ("n_rows", "n_violations", "sum_risk", "n_scored")]
    return _report(counted.rollup(*by).agg(*sums, F.max("max_risk").alias("max_risk")), by)
