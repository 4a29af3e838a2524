"""Service-level reports: violations per day, tickets close to violation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitepulse.functions import as_of, first_match, minutes_between, minutes_between_exact, not_text
from sitepulse.operators import dedupe
from sitepulse.sources.readers import look_back

# Messages that never count as service tickets.
OFFLINE_MESSAGES = ["NC-30", "NC-30 (Mains Power Failure)"]
LOBBY_MOVEMENT = "Movement in Lobby for more than 3 Mins"

CLASSES = ["SOS", "Critical"]
MEASURES = ["total_tickets", "total_sos", "total_critical", "sos_ack", "sos_close",
            "critical_ack", "critical_close"]


@dataclass(frozen=True)
class Limits:
    """Minutes allowed per ticket class, and the bands that count as close to the limit."""

    ack: Mapping[str, float] = field(default_factory=lambda: {"SOS": 5, "Critical": 10})
    close: Mapping[str, float] = field(default_factory=lambda: {"SOS": 30, "Critical": 60})
    near_ack: Mapping[str, tuple[float, float]] = field(
        default_factory=lambda: {"SOS": (4, 5), "Critical": (8, 10)})
    near_close: Mapping[str, tuple[float, float]] = field(
        default_factory=lambda: {"SOS": (24, 30), "Critical": (48, 60)})


def _at_least(age: str, limits: Mapping[str, float]) -> Column:
    """``age`` has reached the limit of the row's class."""
    return first_match([(F.col("event_type") == c, F.col(age) >= limit)
                        for c, limit in limits.items()])


def _within(age: str, bands: Mapping[str, tuple[float, float]]) -> Column:
    return first_match([
        (F.col("event_type") == c, (F.col(age) >= low) & (F.col(age) < high))
        for c, (low, high) in bands.items()])


def first_acknowledgement(remarks: DataFrame) -> DataFrame:
    """Earliest acknowledging remark per ticket."""
    return (remarks.filter("tkt_status = 1").groupBy("event_id")
            .agg(F.min("updated_on").alias("ack_on")))


def rated_tickets(tickets: DataFrame, remarks: DataFrame, asof, limits: Limits = Limits(), *,
                  excluded: Sequence[str] = (*OFFLINE_MESSAGES, LOBBY_MOVEMENT)) -> DataFrame:
    """Service tickets with ages and penalty labels; NULL label means no violation.

    Tickets whose closer is unknown are left out, as an SQL ``!=`` does.
    """
    kept = tickets.filter(
        F.col("event_type").isin(CLASSES) & ~F.col("msg").isin(list(excluded))
        & not_text(F.col("closed_by"), "system", keep_null=False))
    single = dedupe(kept, ["site_id", "msg", "at_time"], ["event_id"])
    aged = single.join(first_acknowledgement(remarks), "event_id", "left").withColumns({
        "date": F.to_date("opened_on"),
        "age": minutes_between("opened_on", F.coalesce(F.col("closed_on"), as_of(asof))),
        "ack_age": minutes_between("opened_on", "ack_on"),
    })
    late_open = F.col("ack_on").isNull() & _at_least("age", limits.ack)
    late_ack = F.col("ack_on").isNotNull() & _at_least("ack_age", limits.ack)
    ticket_class = F.col("event_type")
    return aged.withColumns({
        "ack_penalty": F.when(late_open, F.concat(ticket_class, F.lit("NoAckVio")))
                        .when(late_ack, F.concat(ticket_class, F.lit("AckViolations"))),
        "close_penalty": F.when(_at_least("age", limits.close),
                                F.concat(ticket_class, F.lit("CloseViolations"))),
    })


def violated_tickets(rated: DataFrame, sites: DataFrame) -> DataFrame:
    """Ticket list; ``'0'`` marks the label that does not apply."""
    late = rated.filter("ack_penalty is not null or close_penalty is not null")
    zero = F.lit("0")
    return late.join(sites.select("site_id", "site_name", "bank"), "site_id").select(
        "date", "bank", "site_name", "site_id", "event_id", "event_type", "at_time", "opened_on",
        "ack_on", "closed_on", F.coalesce("ack_penalty", zero).alias("ack_penalty"),
        F.coalesce("close_penalty", zero).alias("close_penalty"))


def _measures(rated: DataFrame) -> DataFrame:
    """Counts per day and site, before any dimension is joined."""
    def of(name: str, test: Column = F.lit(True)) -> Column:
        return F.count_if((F.col("event_type") == name) & test)

    late_ack, late_close = F.col("ack_penalty").isNotNull(), F.col("close_penalty").isNotNull()
    return rated.groupBy("date", "site_id").agg(
        F.count(F.lit(1)).alias("total_tickets"), of("SOS").alias("total_sos"),
        of("Critical").alias("total_critical"), of("SOS", late_ack).alias("sos_ack"),
        of("SOS", late_close).alias("sos_close"),
        of("Critical", late_ack).alias("critical_ack"),
        of("Critical", late_close).alias("critical_close"))


def site_violations(rated: DataFrame, sites: DataFrame, first_day: str,
                    last_day: str) -> DataFrame:
    """Every site on every day of the range, zeros where nothing happened."""
    days = F.sequence(F.lit(first_day).cast("date"), F.lit(last_day).cast("date"))
    calendar = sites.select("site_id", "site_name", "bank", F.explode(days).alias("date"))
    joined = calendar.join(_measures(rated), ["date", "site_id"], "left")
    return joined.fillna(0, MEASURES).select("date", "bank", "site_name", "site_id", *MEASURES)


def bank_violations(rated: DataFrame, sites: DataFrame) -> DataFrame:
    """Per day and customer, for customers with at least one ticket."""
    counted = _measures(rated).join(sites.select("site_id", "bank"), "site_id")
    return counted.groupBy("date", "bank").agg(*[F.sum(m).alias(m) for m in MEASURES])


def open_tickets(tickets: DataFrame, remarks: DataFrame | None, sites: DataFrame, asof,
                 limits: Limits = Limits(), *, days: int = 1,
                 excluded: Sequence[str] = OFFLINE_MESSAGES) -> DataFrame:
    """Open service tickets with their age and the action that is due.

    Acknowledgements matter to ``class_summary`` only; without ``remarks`` they are left out.
    """
    kept = look_back(tickets, "at_time", asof, days=days).filter(
        F.col("closed_on").isNull() & F.col("event_type").isin(CLASSES)
        & ~F.col("msg").isin(list(excluded)))
    single = dedupe(kept, ["site_id", "event_type", "at_time"], ["event_id"])
    if remarks is None:
        noted = single.withColumn("ack_on", F.lit(None).cast("timestamp_ntz"))
    else:
        acks = (look_back(remarks, "updated_on", asof, days=days).groupBy("event_id")
                .agg(F.min("updated_on").alias("ack_on")))
        noted = single.join(acks, "event_id", "left")
    aged = (noted
            .join(sites.select("site_id", "site_name", "bank"), "site_id").withColumns({
                "age_minutes": minutes_between_exact("opened_on", as_of(asof)),
                "ack_minutes": minutes_between_exact("opened_on", "ack_on")}))
    return aged.withColumns({
        "to_ack": F.coalesce(_within("age_minutes", limits.near_ack), F.lit(False)),
        "to_close": F.coalesce(_within("age_minutes", limits.near_close), F.lit(False)),
        "late_ack": F.coalesce(first_match([
            (F.col("event_type") == c, F.col("ack_minutes") > limit)
            for c, limit in limits.ack.items()]), F.lit(False)),
    })


def near_violation(open_: DataFrame) -> DataFrame:
    """Tickets that need action now; acknowledging comes before closing."""
    action = F.when(F.col("to_ack"), "TicketToAck").when(F.col("to_close"), "TicketToClose")
    return open_.withColumn("required_action", action).filter(
        "required_action is not null").select(
        "bank", "site_name", "site_id", "event_id", "event_type", "msg", "opened_on",
        "age_minutes", "required_action")


def class_summary(open_: DataFrame, sites: DataFrame) -> DataFrame:
    """Per customer and ticket class; both classes always present."""
    counted = open_.groupBy("bank", "event_type").agg(
        F.count(F.lit(1)).alias("total_tickets"),
        F.count_if(F.col("ack_on").isNotNull()).alias("acknowledged"),
        F.count_if(F.col("ack_on").isNull()).alias("not_acknowledged"),
        F.count_if("late_ack").alias("violated_ack"), F.count_if("to_ack").alias("near_ack"),
        F.count_if("to_close").alias("near_close"))
    measures = [c for c in counted.columns if c not in ("bank", "event_type")]
    classes = F.explode(F.array(*[F.lit(c) for c in sorted(CLASSES)])).alias("event_type")
    members = sites.select("bank").distinct().select("bank", classes)
    return members.join(counted, ["bank", "event_type"], "left").fillna(0, measures)
