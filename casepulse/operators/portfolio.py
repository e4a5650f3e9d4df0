"""State of the open portfolio at a month end, from the latest milestones of each case."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casepulse.functions import first_of_month, on_or_before, shift_months
from casepulse.operators.series import EXCLUDE_AGREED


@dataclass(frozen=True)
class Vocabulary:
    """Milestone names by their meaning."""

    # Milestone names as the log writes them.
    paused: tuple[str, ...] = (
        "Behov for tilleggsdokumentasjon",
        "Anmodning om tilleggsdokumentasjon",
    )
    resume: tuple[str, ...] = ("Komplett søknad", "Mottatt tilleggsdokumentasjon")
    workable: tuple[str, ...] = ("Søknad mottatt", "Komplett søknad", "Mottatt tilleggsdokumentasjon")
    mini_hearing: str = "Begrenset høring"
    early: str = "Tidligbehandling"

    def states(self) -> list[str]:
        """The names that decide a state as the latest milestone, in string order."""
        return sorted({*self.workable, self.mini_hearing})


def snapshot_month_end(as_of: date) -> date:
    """The last day of the month before ``as_of``."""
    return first_of_month(as_of) - timedelta(days=1)


def open_at(cases: DataFrame, day: date) -> DataFrame:
    """The open cases as (case_id, indicator).

    Spelled as plain comparisons so that both reach the scan.
    """
    started = on_or_before(F.col("start_date"), day)
    running = F.col("end_date").isNull() | ~on_or_before(F.col("end_date"), day)
    return cases.where(F.col("indicator").isNotNull() & started & running).select("case_id", "indicator")


def latest_milestone(milestones: DataFrame, day: date) -> DataFrame:
    """The newest milestone of each case up to ``day``; equal times go to the greater name.

    The log is hashed to the newest time of each case and name, task by task, before it is
    shuffled; only those few rows are ranked.
    """
    newest_first = Window.partitionBy("case_id").orderBy(
        F.col("milestone_ts").desc(), F.col("milestone").desc_nulls_last()
    )
    return (
        milestones.where(on_or_before(F.col("milestone_ts"), day))
        .groupBy("case_id", "milestone")
        .agg(F.max("milestone_ts").alias("milestone_ts"))
        .withColumn("place", F.row_number().over(newest_first))
        .where("place = 1")
        .select("case_id", "milestone", "milestone_ts")
    )


def _moment(milestones: DataFrame) -> Column:
    """The milestone time as a BIGINT that sorts like it."""
    kind = milestones.schema["milestone_ts"].dataType
    ts = F.col("milestone_ts")
    days = F.unix_date(ts.cast("date")).cast("bigint")
    if isinstance(kind, T.DateType):
        return days
    if isinstance(kind, T.TimestampNTZType):  # from its fields, so that no time zone shifts it
        minutes = (days * 24 + F.hour(ts)) * 60 + F.minute(ts)
        return minutes * 60_000_000 + (F.extract(F.lit("SECOND"), ts) * 1_000_000).cast("bigint")
    return F.unix_micros(ts)


def _milestone_state(milestones: DataFrame, day: date, vocabulary: Vocabulary) -> DataFrame:
    """One row per case: the three state flags at ``day``.

    The latest milestone is kept as one BIGINT, its time times a base plus a code that
    orders names as strings do but merges the names that mean nothing here. So every
    buffer has a fixed width, the aggregate hashes instead of sorting, and a case with very
    many milestones is folded to one row per task before the shuffle.
    """
    rolled = milestones.where(on_or_before(F.col("milestone_ts"), day)).groupBy("case_id").agg(*_newest(milestones, vocabulary))
    return rolled.select("case_id", *_flags(vocabulary))


def _newest(milestones: DataFrame, vocabulary: Vocabulary) -> list[Column]:
    """Aggregates that the flags of a case follow from: maxima, so they can be taken of one another."""
    name, ts = F.col("milestone"), F.col("milestone_ts")
    states = vocabulary.states()
    code = F.lit(0)
    for state in states:
        code = code + F.when(name > state, 2).when(name == state, 1).otherwise(0)
    return [
        F.max(_moment(milestones) * (2 * len(states) + 1) + code).alias("latest"),
        F.max(F.when(name.isin(*vocabulary.paused), ts)).alias("paused_ts"),
        F.max(F.when(name.isin(*vocabulary.resume), ts)).alias("resumed_ts"),
    ]


def _flags(vocabulary: Vocabulary) -> list[Column]:
    code_of = {state: 2 * place + 1 for place, state in enumerate(vocabulary.states())}
    state = F.pmod("latest", F.lit(2 * len(code_of) + 1))
    paused = F.col("paused_ts").isNotNull() & (
        F.col("resumed_ts").isNull() | (F.col("paused_ts") > F.col("resumed_ts"))
    )
    return [
        paused.alias("is_paused"),
        (~paused & state.isin([code_of[w] for w in vocabulary.workable])).alias("is_workable"),
        (state == code_of[vocabulary.mini_hearing]).alias("is_mini_hearing"),
    ]


def _flag(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(False))


def classify(
    open_cases: DataFrame, milestones: DataFrame, day: date, vocabulary: Vocabulary = Vocabulary()
) -> DataFrame:
    """State flags of each open case at ``day``.

    Paused means the last pause is later than the last resumption; workable, not paused and
    the latest milestone is a working one; mini hearing looks at the latest milestone alone,
    so it can coincide with paused. A case without milestones has no flag set.
    """
    state = _milestone_state(milestones, day, vocabulary)
    return open_cases.join(state, "case_id", "left").select(
        "case_id",
        "indicator",
        *[_flag(name).alias(name) for name in ("is_paused", "is_workable", "is_mini_hearing")],
    )


def early_processing(
    cases: DataFrame,
    milestones: DataFrame,
    day: date,
    *,
    vocabulary: Vocabulary = Vocabulary(),
    exclude_like: str | None = EXCLUDE_AGREED,
) -> DataFrame:
    """Distinct cases per indicator with an early-processing milestone in the month of ``day``."""
    ts = F.col("milestone_ts")
    in_month = (ts >= F.lit(first_of_month(day))) & (ts < F.lit(shift_months(day, 1)))
    early = milestones.where((F.col("milestone") == vocabulary.early) & in_month).select("case_id").distinct()
    return (
        cases.where(_counted(exclude_like))
        .select("case_id", "indicator")
        .join(early, "case_id", "left_semi")
        .distinct()  # on rows dealt by case already
        .groupBy("indicator")
        .agg(F.count("case_id").cast("int").alias("tidligbehandling_count"))
    )


def _counted(exclude_like: str | None) -> Column:
    named = F.col("indicator").isNotNull()
    return named & ~F.col("indicator").like(exclude_like) if exclude_like else named


def portfolio_snapshot(
    cases: DataFrame,
    milestones: DataFrame,
    day: date,
    *,
    vocabulary: Vocabulary = Vocabulary(),
    exclude_like: str | None = EXCLUDE_AGREED,
) -> DataFrame:
    """The rows of ``portefolje_snapshot`` for one month end.

    One row per indicator with an open case. The open states and the early processing are
    two branches joined on the indicator: the date tests of the first reach the scan of the
    cases, so only open cases are shuffled, and the month and name of the second reach that
    of the milestones. Where the session lets Spark filter the milestones by the open case
    keys at run time, closed cases' milestones are dropped before the shuffle as well.
    """
    state = classify(open_at(cases, day), milestones, day, vocabulary)
    counts = state.groupBy("indicator").agg(
        F.count("*").cast("int").alias("open_total"),
        F.count_if("is_workable").cast("int").alias("open_workable"),
        F.count_if("is_paused").cast("int").alias("open_paused"),
        F.count_if("is_mini_hearing").cast("int").alias("open_mini_hearing"),
    )
    early = early_processing(cases, milestones, day, vocabulary=vocabulary, exclude_like=exclude_like)
    return counts.join(early, "indicator", "left").select(
        F.lit(day).alias("snapshot_month"),
        F.col("indicator").alias("indikator"),
        "open_total",
        "open_workable",
        "open_paused",
        "open_mini_hearing",
        F.coalesce("tidligbehandling_count", F.lit(0)).alias("tidligbehandling_count"),
    )


def _place(moment: Column, days: Sequence[date]) -> Column:
    """The place of the first of the sorted ``days`` that is not before the moment's day; their number if none is."""
    first, last = days[0].toordinal(), days[-1].toordinal()
    listed = ",".join(str(bisect_left(days, date.fromordinal(n))) for n in range(first, last + 1))
    places = F.split(F.lit(listed), ",").cast("array<int>")  # one literal, folded to a constant
    since = F.datediff(moment.cast("date"), F.lit(days[0]))
    return F.when(since <= 0, 0).when(since > last - first, len(days)).otherwise(F.get(places, since))


def portfolio_snapshots(
    cases: DataFrame,
    milestones: DataFrame,
    days: Sequence[date],
    *,
    vocabulary: Vocabulary = Vocabulary(),
    exclude_like: str | None = EXCLUDE_AGREED,
) -> DataFrame:
    """The rows of ``portefolje_snapshot`` for many month ends, with one scan of each table.

    A case is open from one place in the list of days up to another, so it adds one to a counter
    there and takes one away at the other; running sums of those counters are the open cases of
    each day. Milestones are folded to the maxima of each case and stretch between two days,
    whose running maxima are the state as of each day; a state counts from its day to the next
    change, cut to the days its case is open. So no row is multiplied by the number of days:
    what is shuffled grows with the changes of state, and counters are added up in each task.
    All cases are read, as early processing counts closed ones too.
    """
    days = sorted(set(days))
    if not days:
        return portfolio_snapshot(cases, milestones, date(1970, 1, 1), vocabulary=vocabulary).where("false")
    flags = ["is_workable", "is_paused", "is_mini_hearing"]
    until_last = on_or_before(F.col("milestone_ts"), days[-1])
    month = F.year("milestone_ts") * 12 + F.month("milestone_ts")
    early = (F.col("milestone") == vocabulary.early) & month.isin(sorted({d.year * 12 + d.month for d in days}))
    # An early-processing milestone counts for the whole of the last month, a state up to the day.
    folded = (
        milestones.where(F.col("milestone_ts") < F.lit(shift_months(days[-1], 1)))
        .groupBy(
            "case_id",
            F.when(until_last, _place(F.col("milestone_ts"), days)).otherwise(len(days)).alias("since"),
            F.when(early, month).alias("early_month"),
        )
        .agg(*_newest(milestones, vocabulary))
    )
    in_order = Window.partitionBy("case_id").orderBy("since", F.col("early_month").asc_nulls_first())
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    running = folded.select(
        "case_id",
        "since",
        F.coalesce(F.lead("since").over(in_order), F.lit(len(days))).alias("until"),
        F.row_number().over(in_order).alias("row"),
        *[F.max(name).over(so_far).alias(name) for name in ("latest", "paused_ts", "resumed_ts")],
        # Months rise with the places, so one that is no higher than before has been counted.
        F.when(F.col("early_month") > F.coalesce(F.max("early_month").over(before), F.lit(0)), F.col("early_month")).alias("early_month"),
    )
    states = running.select("case_id", "since", "until", "row", "early_month", *_flags(vocabulary))
    known = cases.where(F.col("indicator").isNotNull()).select(
        "case_id",
        "indicator",
        F.coalesce(_place(F.col("start_date"), days), F.lit(len(days))).alias("begun"),
        F.coalesce(_place(F.col("end_date"), days), F.lit(len(days))).alias("ended"),
    )
    joined = known.join(states, "case_id", "left")

    def step(when: Column, kind: int, key: Column, **by: Column | int) -> Column:
        counted = [F.lit(by.get(name, 0)).cast("int").alias(name) for name in ("is_open", *flags, "early")]
        return F.when(when, F.struct(F.lit(kind).alias("kind"), key.alias("key"), *counted))

    once = (F.coalesce("row", F.lit(1)) == 1) & (F.col("begun") < F.col("ended"))
    since, until = F.greatest("since", "begun"), F.least("until", "ended")
    holds = (since < until) & reduce(Column.__or__, (_flag(f) for f in flags))
    steps = F.array(
        step(once, 0, F.col("begun"), is_open=1),
        step(once, 0, F.col("ended"), is_open=-1),
        step(holds, 0, since, **{f: _flag(f).cast("int") for f in flags}),
        step(holds, 0, until, **{f: -_flag(f).cast("int") for f in flags}),
        step(F.col("early_month").isNotNull() & _counted(exclude_like), 1, F.col("early_month"), early=1),
    )
    counters = ["is_open", *flags, "early"]
    added = (
        joined.select("indicator", F.explode(F.array_compact(steps)).alias("step"))
        .groupBy("indicator", "step.kind", "step.key")
        .agg(*[F.sum(f"step.{name}").alias(name) for name in counters])
    )
    # From here on all is bounded by indicators and days.
    of_indicator = added.groupBy("indicator").agg(F.collect_list(F.struct("kind", "key", *counters)).alias("steps"))
    listed = F.array(*[F.lit(day) for day in days])
    rows = of_indicator.select("indicator", "steps", F.posexplode(listed).alias("place", "day"))
    own_month = F.year("day") * 12 + F.month("day")

    def total(name: str, kind: int, counts) -> Column:
        chosen = F.filter("steps", lambda s: (s["kind"] == kind) & counts(s["key"]))
        return F.aggregate(chosen, F.lit(0).cast("bigint"), lambda t, s: t + s[name]).cast("int")

    up_to = {name: total(name, 0, lambda key: key <= F.col("place")) for name in ("is_open", *flags)}
    return rows.select(
        F.col("day").alias("snapshot_month"),
        F.col("indicator").alias("indikator"),
        up_to["is_open"].alias("open_total"),
        up_to["is_workable"].alias("open_workable"),
        up_to["is_paused"].alias("open_paused"),
        up_to["is_mini_hearing"].alias("open_mini_hearing"),
        total("early", 1, lambda key: key == own_month).alias("tidligbehandling_count"),
    ).where("open_total > 0")
