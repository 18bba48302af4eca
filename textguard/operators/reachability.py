"""URLs in texts against a table of probes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textguard.functions import text as tx
from textguard.plans.asof import asof_join
from textguard.plans.skew import spread_join
from textguard.session import stage

URL = r'https?://[^ \t\n\r\f<>"]+'


def extract_urls(df: DataFrame, key: str, text: str) -> DataFrame:
    """One row per text and URL in it."""
    found = F.array_distinct(tx.extract(F.col(text), URL))
    return df.select(key, F.explode(found).alias("url"))


def url_status(
    probes: DataFrame,
    success_status_codes: Sequence[int] = (200, 201, 202, 301, 302),
    timeout: float = 1.0,
) -> DataFrame:
    """Whether each URL answered in time at its newest probe.

    Of probes at the same time the one with the greatest status code counts.
    """
    newest = probes.groupBy("url").agg(
        F.max(F.struct("checked_at", "status_code", "elapsed_s")).alias("newest")
    )
    in_time = F.col("newest.elapsed_s") <= timeout
    answered = F.col("newest.status_code").isin(list(success_status_codes))
    return newest.select("url", (answered & in_time).alias("reachable"))


def url_reachability(
    df: DataFrame,
    key: str,
    text: str,
    probes: DataFrame,
    success_status_codes: Sequence[int] = (200, 201, 202, 301, 302),
    timeout: float = 1.0,
) -> DataFrame:
    """A text is valid if every URL in it is reachable; a URL never probed is not.

    A popular URL may be in a large part of the texts, so its rows are spread over
    several tasks for the join with its status.
    """
    uses = extract_urls(df, key, text)
    status = stage(url_status(probes, success_status_codes, timeout), "status")
    judged = spread_join(
        uses,
        status,
        "url",
        lambda: (uses.groupBy("url").agg(F.count(F.lit(1)).alias("n")), "n"),
        [key],
        "left",
    )
    broken = judged.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_urls"),
        F.count_if(~F.coalesce(F.col("reachable"), F.lit(False))).alias("n_unreachable"),
    )
    return _verdicts(df, key, text, broken)


def _verdicts(df: DataFrame, key: str, text: str, broken: DataFrame) -> DataFrame:
    """What the counts of broken URLs say of each text; only keys are joined."""
    risk = F.when(F.col("known"), F.when(F.col("n_unreachable") > 0, 1.0).otherwise(0.0))
    known = df.select(key, F.col(text).isNotNull().alias("known"))
    return known.join(broken, key, "left").select(
        key,
        F.coalesce("n_urls", F.lit(0)).alias("n_urls"),
        F.coalesce("n_unreachable", F.lit(0)).alias("n_unreachable"),
        (risk < 1).alias("is_valid"),
        risk.alias("risk_score"),
    )


def url_reachability_at(
    df: DataFrame,
    key: str,
    text: str,
    fetched_at: str,
    probes: DataFrame,
    success_status_codes: Sequence[int] = (200, 201, 202, 301, 302),
    timeout: float = 1.0,
) -> DataFrame:
    """The same as of the time at which each text was fetched: of every URL the latest probe up to then
    counts, and a URL not probed by then is not reachable. Texts stay where they are."""
    found = F.array_distinct(tx.extract(F.col(text), URL))
    uses = df.select(key, F.col(fetched_at).alias("__fetched"), F.explode(found).alias("url"))
    seen = asof_join(uses, probes, "url", "__fetched", "checked_at", ["status_code", "elapsed_s"])
    reachable = F.col("status_code").isin(list(success_status_codes)) & (F.col("elapsed_s") <= timeout)
    broken = seen.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_urls"),
        F.count_if(~F.coalesce(reachable, F.lit(False))).alias("n_unreachable"),
    )
    return _verdicts(df, key, text, broken)
