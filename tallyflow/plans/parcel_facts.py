"""Parcel event facts. One builder serves every waybill event; the events differ in status rule and time column."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyflow.functions.clean import hash_sensitive, mask_name
from tallyflow.functions.times import OPEN_END, day, days_before, from_epoch_ms, iso_text
from tallyflow.operators.dims import dictionary_roles, enrich
from tallyflow.operators.history import event_from_open

# Waybill states.
CREATED, PAID, COLLECTED, FINISHED, CANCELLED, VOID = "60010", "60020", "60030", "60040", "60050", "60999"


@dataclass(frozen=True)
class Event:
    """States an order may (``only``) or may not (``never``) be in, and the column of the event time."""

    time: str
    only: tuple[str, ...] = ()
    never: tuple[str, ...] = ()
    source: str = "update_time"

    def rows(self, orders: DataFrame) -> DataFrame:
        out = orders.where(F.col("is_deleted") == "0")
        if self.only:
            out = out.where(F.col("status").isin(*self.only))
        return out.where(~F.col("status").isin(*self.never)) if self.never else out


EVENTS = {
    "order": Event("order_time", source="create_time"),
    "cancel": Event("cancel_time", only=(CANCELLED,)),
    "pay": Event("payment_time", never=(CREATED, VOID)),
    "receive": Event("receive_time", never=(CREATED, PAID, VOID)),
    "dispatch": Event("dispatch_time", never=(CREATED, PAID, COLLECTED, FINISHED, VOID)),
    "bound_finish": Event("bound_finish_time", never=(COLLECTED, PAID)),
    "deliver": Event("deliver_suc_time", never=(COLLECTED, PAID)),
    "sign": Event("sign_time", never=(COLLECTED, PAID)),
}

ROLES = {
    "cargo_type": "cargo_type_name",
    "status": "status_name",
    "collect_type": "collect_type_name",
    "payment_type": "payment_type_name",
}


def _names(orders: DataFrame) -> DataFrame:
    return orders.withColumns(
        {
            "receiver_name": mask_name("receiver_name"),
            "sender_name": mask_name("sender_name"),
            "estimate_arrive_time": from_epoch_ms("estimate_arrive_time"),
        }
    )


def waybill_event(cargo: DataFrame, orders: DataFrame, dictionary: DataFrame, event: Event) -> DataFrame:
    """Cargo lines of the orders in the event's states, with masked names and four dictionary names."""
    picked = _names(event.rows(orders)).withColumnRenamed("id", "order_id").withColumn(event.time, iso_text(event.source))
    lines = cargo.join(picked.drop("create_time", "update_time", "is_deleted", "ds"), "order_id")
    return dictionary_roles(lines, dictionary, ROLES).withColumn("dt", F.to_date(event.time))


#: Days from the load of a waybill to its last change, at most.
LIFE_DAYS = 5


def loaded_for(orders: DataFrame, as_of: str, days: int) -> DataFrame:
    """Waybills that can have an event in the ``days`` days up to ``as_of``, by their load day, which prunes the scan."""
    return orders.where(F.col("ds").between(days_before(as_of, days - 1 + LIFE_DAYS), day(as_of)))


def event_orders(cargo: DataFrame, orders: DataFrame, event: Event) -> DataFrame:
    """One row per order with cargo: what the summaries count."""
    picked = event.rows(orders).select(
        F.col("id").alias("order_id"), "amount", "sender_district_id", "sender_city_id", F.to_date(iso_text(event.source)).alias("dt")
    )
    return picked.join(cargo.select("order_id"), "order_id", "left_semi")


def order_process(cargo: DataFrame, orders: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Open-order life cycle: closed on the update day when cancelled or finished, else open-ended."""
    live = _names(orders.where(F.col("is_deleted") == "0")).withColumnRenamed("id", "order_id")
    closed = F.col("status").isin(CANCELLED, FINISHED)
    dated = live.withColumn("start_date", F.to_date(iso_text("create_time"))).withColumn(
        "end_date", F.when(closed, F.to_date(iso_text("update_time"))).otherwise(day(OPEN_END))
    )
    lines = cargo.join(dated.drop("create_time", "update_time", "is_deleted", "ds"), "order_id")
    return dictionary_roles(lines, dictionary, ROLES).withColumn("dt", F.col("end_date"))


def waybill_event_daily(orders: DataFrame, as_of: str, event: Event, open_states: tuple[str, ...] = (CREATED,)) -> DataFrame:
    """Daily load: today's changes into the event's states, met with the open and the new orders."""
    made, changed = F.to_date(iso_text("create_time")), F.to_date(iso_text("update_time"))
    live = orders.where(F.col("is_deleted") == "0").withColumnRenamed("id", "order_id")
    attributes = ["order_id", "order_no", "user_id", "amount", "sender_city_id", "receiver_city_id"]
    before = live.where((made < day(as_of)) & (changed >= day(as_of)))
    open_orders = before.select(*attributes, F.lit(open_states[0]).alias("status"))
    new_orders = live.where(made == day(as_of)).select(*attributes, F.lit(CREATED).alias("status"))
    changes = event.rows(orders).where(changed == day(as_of)).select(F.col("id").alias("order_id"), "status", iso_text("update_time").alias("update_time"))
    states = event.only or tuple(s for s in ALL_STATES if s not in event.never)
    return event_from_open(open_orders, new_orders, changes, open_states, states)


ALL_STATES = (CREATED, PAID, COLLECTED, FINISHED, CANCELLED, "60060", "60070", "60080", VOID)


def bound(rows: DataFrame, kind: str) -> DataFrame:
    """Depot events (inbound, sort, outbound) that have happened."""
    emp = {"inbound": "inbound_emp_id", "sort": "sorter_emp_id", "outbound": "outbound_emp_id"}[kind]
    at = f"{kind}_time"
    return rows.where(F.col(at).isNotNull()).select("id", "order_id", "org_id", at, emp, F.to_date(at).alias("dt"))


def newly_bound(before: DataFrame, now: DataFrame, kind: str) -> DataFrame:
    """Rows whose event time was empty in the earlier snapshot and is set in the later one."""
    at = f"{kind}_time"
    unset = before.where(F.col(at).isNull()).select("id")
    return bound(now.join(unset, "id", "left_semi"), kind)


def trans_finish(tasks: DataFrame, shifts: DataFrame, organs: DataFrame) -> DataFrame:
    """Finished trips: duration, planned end (start + planned minutes of the shift) and lateness."""
    done = tasks.where(F.col("actual_end_time").isNotNull())
    out = enrich(done, organs, "start_org_id", "id", {"org_name": "start_org_name"})
    out = enrich(out, shifts, "shift_id", "id", ["estimated_time"])
    planned = F.col("actual_start_time") + F.col("estimated_time") * 60000
    return (
        out.withColumn("finish_dur_sec", F.expr("(actual_end_time - actual_start_time) div 1000"))
        .withColumn("is_late", F.coalesce(F.col("actual_end_time") > planned, F.lit(False)).cast("int"))
        .withColumn("estimate_end_time", planned)
        .withColumns({"driver1_name": mask_name("driver1_name"), "driver2_name": mask_name("driver2_name"), "truck_no": hash_sensitive("truck_no")})
        .drop("estimated_time")
        .withColumn("dt", F.to_date(from_epoch_ms("actual_end_time")))
    )
