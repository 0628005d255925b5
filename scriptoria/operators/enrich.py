"""Enrichment of metadata by an outside provider: candidates, gate, budget, calls, merge and change report.

A provider is a function from an iterator of pandas frames (key, candidate JSON) to frames (key, record JSON, status, error); the
default one looks records up in a table, so nothing here needs a network.
"""

from __future__ import annotations

import re
import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scriptoria.functions import fixed
from scriptoria.scratch import materialise

from .normalize import SNAPSHOT, analysis_lines, changed, is_analysis_noise, looks_weak, merge_enrichment, normalise, with_needs_enrichment

_PERSON = "struct<name:string,raw:string,confidence:string>"
_MADE = "struct<date:string,year:int,raw:string,confidence:string>"
_LINE = "struct<volume:int,issue:string,date:string,rawDate:string,raw:string,confidence:string>"
RECORD = f"documentTitle string, documentType string, author {_PERSON}, creation {_MADE}, publication {_LINE}, notes string"
CONFIDENCE = ["high", "medium", "low"]
# Error texts of a provider that cannot be reached from here.
UNAVAILABLE = r"(?i)unsupported_country|country, region, or territory|region not supported|403 forbidden|access denied"


def candidates(docs: DataFrame) -> DataFrame:
    """slug, position, candidate (JSON) from rows with header, body, footer lines, label, rawLabel and the metadata."""
    label, raw = F.col("label"), F.col("rawLabel")
    preview = F.filter(analysis_lines(F.slice("bodyLines", 1, 3), label, raw), lambda x: ~looks_weak(x))
    clean = lambda c: F.when(~is_analysis_noise(c), c)
    now = F.struct(
        F.when(~looks_weak(F.col("documentTitle")), F.col("documentTitle")).alias("documentTitle"), "documentType",
        F.struct(clean(F.col("author.name")).alias("name"), F.col("author.slug").alias("slug"), clean(F.col("author.raw")).alias("raw")).alias("author"), "creation", "publication",
    )
    parts = F.struct(F.col("position").alias("documentIndex"), now.alias("current"), analysis_lines(F.col("header"), label, raw).alias("header"), F.col("footerLines").alias("footer"), preview.alias("bodyPreview"))
    return docs.select("slug", "position", F.to_json(parts).alias("candidate"))


def budgeted(rows: DataFrame, flag: str, order: list, limit: int, block: str | None = None) -> DataFrame:
    """Add ``inBudget``: the first ``limit`` flagged rows in order are in, rows without the flag are free.

    Counts are made per ``block`` first (a column that agrees with the order, such as a year), so only one number a
    block is summed in a single task; without a block the order itself is split into ranges.
    """
    if block is None:
        # the place of the limit-th flagged row bounds all others: a distributed top-k, no global window
        last = rows.where(F.col(flag)).select(F.struct(*order).alias("_o")).orderBy("_o").limit(limit).agg(F.max("_o").alias("_last"), F.count(F.lit(1)).alias("_n"))
        return rows.crossJoin(F.broadcast(last)).withColumn("inBudget", ~F.col(flag) | (F.coalesce("_n", F.lit(0)) < limit) | (F.struct(*order) <= F.col("_last"))).drop("_last", "_n")
    sums = rows.groupBy(block).agg(F.count_if(F.col(flag)).alias("_k"))
    sums = sums.withColumn("_before", F.coalesce(F.sum("_k").over(Window.orderBy(block).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_k")
    own = F.sum(F.col(flag).cast("long")).over(Window.partitionBy(block).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return rows.join(sums, block).withColumn("inBudget", ~F.col(flag) | (F.col("_before") + own <= limit)).drop("_before")


def table_provider(records: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """Provider that looks records (slug, position, record JSON) up in a table."""

    def call(asked: DataFrame) -> DataFrame:
        out = asked.join(records.select("slug", "position", "record"), ["slug", "position"], "left")
        return out.select("slug", "position", "record", F.when(F.col("record").isNull(), 404).otherwise(200).alias("status"), F.when(F.col("record").isNull(), "no record").alias("error"))

    return call


def null_provider(asked: DataFrame) -> DataFrame:
    """Provider that knows nothing."""
    nothing = F.lit(None).cast("string")
    return asked.select("slug", "position", nothing.alias("record"), F.lit(404).alias("status"), F.lit("no record").alias("error"))


class ProviderError(Exception):
    """A call's failure with its status."""

    def __init__(self, status: int, message: str):
        super().__init__(message)
        self.status = status


class Unavailable(RuntimeError):
    """The provider refuses every call: the run ends."""


def partition_provider(call: Callable[[list[str]], list[str | None]], size: int = 20, retries: int = 2, pause: float = 0.5, characters: int | None = None, width: int | None = None) -> Callable[[DataFrame], DataFrame]:
    """Provider that calls ``call(candidates) -> records`` with up to ``size`` candidates of a partition at a time.

    A call that fails with 429 or 5xx is repeated up to ``retries`` times, after a pause that doubles; another failure, or the last, is the error of that
    call's rows, and the next call is made.  ``characters`` bounds the text that one partition sends: rows beyond it get status 402 without a call.  A refusal
    (``is_refusal``) raises, so that Spark stops the job's other tasks; no later call of the partition is made.  ``width`` is the number of partitions, that is of calls at one time.
    Rows stay in order within a partition, and each row gets one answer."""

    def answers(frames):
        sent = 0
        for frame in frames:
            for lo in range(0, len(frame), size):
                part = frame.iloc[lo : lo + size]
                keys = part[["slug", "position"]]
                asked = part["candidate"].tolist()
                sent += sum(map(len, asked))
                if characters is not None and sent > characters:
                    sent = characters + 1  # the budget is spent: nothing smaller slips through later
                    yield keys.assign(record=None, status=402, error="the partition's budget is spent")
                    continue
                records, status, error = _called(call, asked, retries, pause)
                yield keys.assign(record=records, status=status, error=error)

    def ask(candidates: DataFrame) -> DataFrame:
        types = dict(candidates.dtypes)
        dealt = candidates if width is None else candidates.repartitionByRange(width, "slug", "position")
        return dealt.sortWithinPartitions("slug", "position").mapInPandas(answers, f"slug {types['slug']}, position {types['position']}, record string, status int, error string")

    return ask


def is_refusal(status: int, message: str) -> bool:
    return status == 403 or re.search(UNAVAILABLE, message) is not None


def _called(call, asked: list[str], retries: int, pause: float) -> tuple[list[str | None], list[int], list[str | None]]:
    for attempt in range(retries + 1):
        try:
            records = call(asked)
            if len(records) != len(asked):
                raise ProviderError(502, f"{len(records)} records for {len(asked)} candidates")
            return records, [404 if r is None else 200 for r in records], ["no record" if r is None else None for r in records]
        except ProviderError as e:
            if is_refusal(e.status, str(e)):
                raise Unavailable(f"the provider is not available: {e}") from e
            if attempt == retries or e.status != 429 and e.status < 500:
                n = len(asked)
                return [None] * n, [e.status] * n, [str(e)] * n
            time.sleep(pause * 2**attempt)
    raise AssertionError("unreachable")


def is_unavailable(status: Column, error: Column) -> Column:
    """Errors that stop a run; others are reported and passed over."""
    return (status == 403) | F.coalesce(F.rlike(error, F.lit(UNAVAILABLE)), F.lit(False))


def valid_record(record: Column) -> Column:
    """The parsed record, null if it has an unknown type or confidence."""
    r = F.from_json(record, RECORD)
    known = F.coalesce(r["documentType"].isin(*fixed.TYPE_LABELS), F.lit(True))
    sure = [F.coalesce(r[k]["confidence"].isin(*CONFIDENCE), F.lit(True)) for k in ("author", "creation", "publication")]
    return F.when(known & sure[0] & sure[1] & sure[2], r)


def enrich(docs: DataFrame, provider: Callable[[DataFrame], DataFrame], limit: int | None = None, force: bool = False) -> DataFrame:
    """All rows with their new metadata, and ``outcome``: changed, same, normalised, ready, failed or unasked.

    Rows with a usable title are only normalised; the split comes before the provider, so it never sees them.
    """
    gated = with_needs_enrichment(docs)
    gated = gated.withColumn("needsEnrichment", F.lit(True)) if force else gated
    if limit is not None:
        gated = budgeted(gated, "needsEnrichment", ["slug", "position"], limit)
    else:
        gated = gated.withColumn("inBudget", F.lit(True))
    # a written table: predicates on the gate would otherwise be expanded into all title rules, branch by branch
    gated = materialise(gated, "gated")
    base = docs.columns
    ready = normalise(gated.where("not needsEnrichment").withColumn("_old", F.struct(*SNAPSHOT))).withColumn("_new", F.struct(*SNAPSHOT))
    ready = ready.select(*base, F.when(changed("_old", "_new"), "normalised").otherwise("ready").alias("outcome"))
    asked = gated.where("needsEnrichment and inBudget")
    answers = provider(candidates(asked)).withColumn("ai", valid_record(F.col("record"))).drop("record")
    joined = asked.join(answers, ["slug", "position"], "left").withColumn("_old", F.struct(*SNAPSHOT))
    joined = materialise(joined, "answered").withColumn("evidence", F.array_join(F.concat("header", "footerLines", F.slice("bodyLines", 1, 3)), "\n"))
    got = merge_enrichment(joined.where("ai is not null"), "evidence").withColumn("_new", F.struct(*SNAPSHOT))
    got = got.select(*base, F.when(changed("_old", "_new"), "changed").otherwise("same").alias("outcome"))
    stop = F.when(F.coalesce(is_unavailable(F.col("status"), F.col("error")), F.lit(False)), F.raise_error(F.lit("the provider is not available"))).otherwise(F.lit("failed"))
    lost = joined.where("ai is null").select(*base, stop.cast("string").alias("outcome"))
    left = gated.where("needsEnrichment and not inBudget").select(*base, F.lit("unasked").alias("outcome"))
    return ready.unionByName(got).unionByName(lost).unionByName(left)


def run_report(outcomes: DataFrame) -> DataFrame:
    """One row of counts: asked, ready, changed documents and changed issues."""
    moved = F.col("outcome").isin("changed", "normalised")
    return outcomes.agg(
        F.count_if(F.col("outcome").isin("changed", "same", "failed")).alias("asked"), F.count_if(F.col("outcome") == "ready").alias("ready"),
        F.count_if(moved).alias("changed"), F.count_distinct(F.when(moved, F.col("slug"))).alias("changed_issues"),
    )
