"""Parcel plans over the given tables."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyflow.plans import parcel_dims as dims
from tallyflow.plans import parcel_facts as facts
from tallyflow.plans import parcel_reports as reports
from tallyflow.plans import parcel_summaries as sums
from tallyflow.operators.align import align_join
from tallyflow.session import materialise
from tallyflow.sources.parcel_standins import Parcel
from tallyflow.sources.standins import ORDERS_AS_OF as AS_OF

DAY_BEFORE = "2001-07-30"
CARGO_KEYS = ["org_id", "org_name", "city_id", "city_name", "cargo_type", "cargo_type_name"]


class ParcelWarehouse(Parcel):
    """Layers over the source tables. Region and depot dimensions are stored once: every report looks them up several times.

    So is the code dictionary: stored, its size is known, and facts are not dealt to the few tasks that its codes would make.
    """

    @cached_property
    def dictionary(self) -> DataFrame:
        return materialise(Parcel.dictionary.func(self), "codes")

    @cached_property
    def region_info(self) -> DataFrame:
        return materialise(Parcel.region_info.func(self), "regions")

    @cached_property
    def organs(self) -> DataFrame:
        return materialise(dims.organs(self.organ_base, self.region_info), "organs")

    @cached_property
    def shifts(self) -> DataFrame:
        return dims.shifts(self.shift_base, self.line_info, self.dictionary)

    @cached_property
    def trucks(self) -> DataFrame:
        return dims.trucks(self.truck_info, self.truck_team, self.truck_model, self.organs, self.dictionary)

    def event(self, name: str) -> DataFrame:
        return facts.waybill_event(self.cargo, self.waybill, self.dictionary, facts.EVENTS[name])

    def orders(self, name: str, recent: bool = False) -> DataFrame:
        """Orders of an event; ``recent`` reads only what the last 30 days can need."""
        made = facts.loaded_for(self.waybill, AS_OF, 30) if recent else self.waybill
        return facts.event_orders(self.cargo, made, facts.EVENTS[name])

    @cached_property
    def trips(self) -> DataFrame:
        return facts.trans_finish(self.transport_task, self.shifts, self.organs)

    @cached_property
    def sorts(self) -> DataFrame:
        return facts.bound(self.org_bound, "sort")

    @cached_property
    def cargo_1d(self) -> DataFrame:
        return sums.org_cargo_type_order_1d(self.event("order"), self.organs, self.region_info)

    @cached_property
    def cargo_nd(self) -> DataFrame:
        return sums.recent(self.cargo_1d, AS_OF, CARGO_KEYS, ["order_count", "order_amount"])

    @cached_property
    def dispatch_1d(self) -> DataFrame:
        return sums.order_count_amount(self.orders("dispatch"))

    @cached_property
    def dispatch_nd(self) -> DataFrame:
        return sums.recent(self.dispatch_recent, AS_OF, [], ["order_count", "order_amount"])

    @cached_property
    def dispatch_recent(self) -> DataFrame:
        return sums.order_count_amount(self.orders("dispatch", True))

    @cached_property
    def finish_1d(self) -> DataFrame:
        return sums.order_count_amount(self.orders("bound_finish"))

    @cached_property
    def receive(self) -> tuple[DataFrame, DataFrame]:
        daily = sums.station_orders_1d(self.orders("receive"), self.organs, self.region_info, True)
        return daily, sums.recent(self.receive_recent, AS_OF, sums.DEPOT, ["order_count", "order_amount"])

    @cached_property
    def receive_recent(self) -> DataFrame:
        return sums.station_orders_1d(self.orders("receive", True), self.organs, self.region_info, True)

    @cached_property
    def deliver_recent(self) -> DataFrame:
        return sums.station_orders_1d(self.orders("deliver", True), self.organs, self.region_info, False)

    @cached_property
    def deliver(self) -> tuple[DataFrame, DataFrame]:
        daily = sums.station_orders_1d(self.orders("deliver"), self.organs, self.region_info, False)
        return daily, sums.recent(self.deliver_recent, AS_OF, sums.DEPOT, ["order_count"])

    @cached_property
    def sort(self) -> tuple[DataFrame, DataFrame]:
        daily = sums.org_sort_1d(self.sorts, self.organs, self.region_info)
        return daily, sums.recent(self.sort_recent, AS_OF, sums.DEPOT, ["sort_count"])

    @cached_property
    def sort_recent(self) -> DataFrame:
        return sums.org_sort_1d(facts.bound(facts.loaded_for(self.org_bound, AS_OF, 30), "sort"), self.organs, self.region_info)

    @cached_property
    def trip_1d(self) -> DataFrame:
        return sums.truck_model_trips_1d(self.trips, self.trucks)

    @cached_property
    def shift_nd(self) -> DataFrame:
        return sums.shift_trips_nd(self.trips, self.organs, self.region_info, self.shifts, self.trucks, AS_OF)

    def express(self, keys: list[str], how: str = "union") -> DataFrame:
        return reports.express(self.receive_recent, self.deliver_recent, self.sort_recent, keys, AS_OF, how)


def _placed(w: ParcelWarehouse) -> tuple[DataFrame, DataFrame]:
    city_1d = reports.place_of_trips(w.trip_1d, w.organs, w.region_info)
    return city_1d, w.shift_nd


def _bound_snapshots(w: ParcelWarehouse, kind: str) -> DataFrame:
    """Two snapshots a day apart: times after the earlier day were not known in it."""
    at = f"{kind}_time"
    before = w.org_bound.withColumn(at, F.when(F.to_date(at) <= F.lit(DAY_BEFORE).cast("date"), F.col(at)))
    now = w.org_bound.withColumn(at, F.when(F.to_date(at) <= F.lit(AS_OF).cast("date"), F.col(at)))
    return facts.newly_bound(before, now, kind)


QUERIES = {
    "parcel_complex_dim": lambda w: dims.complexes(w.complex_info, w.region_info, w.courier_complex),
    "parcel_courier_dim": lambda w: dims.couriers(w.courier, w.organs, w.dictionary),
    "parcel_organ_dim": lambda w: w.organs,
    "parcel_region_dim": lambda w: w.region_info,
    "parcel_shift_dim": lambda w: w.shifts,
    "parcel_driver_dim": lambda w: dims.drivers(w.truck_driver, w.organs, w.truck_team),
    "parcel_truck_dim": lambda w: w.trucks,
    "parcel_address_history": lambda w: dims.address_history(w.user_address),
    "parcel_user_history": lambda w: dims.user_history(w.user_info),
    "parcel_inbound_fact": lambda w: facts.bound(w.org_bound, "inbound"),
    "parcel_outbound_fact": lambda w: facts.bound(w.org_bound, "outbound"),
    "parcel_sort_fact": lambda w: w.sorts,
    "parcel_sort_fact_daily": lambda w: _bound_snapshots(w, "sort"),
    "parcel_outbound_fact_daily": lambda w: _bound_snapshots(w, "outbound"),
    "parcel_order_fact": lambda w: w.event("order"),
    "parcel_cancel_fact": lambda w: w.event("cancel"),
    "parcel_pay_fact": lambda w: w.event("pay"),
    "parcel_receive_fact": lambda w: w.event("receive"),
    "parcel_dispatch_fact": lambda w: w.event("dispatch"),
    "parcel_bound_finish_fact": lambda w: w.event("bound_finish"),
    "parcel_deliver_fact": lambda w: w.event("deliver"),
    "parcel_sign_fact": lambda w: w.event("sign"),
    "parcel_order_process": lambda w: facts.order_process(w.cargo, w.waybill, w.dictionary),
    "parcel_cancel_daily": lambda w: facts.waybill_event_daily(w.waybill, AS_OF, facts.EVENTS["cancel"]),
    "parcel_receive_daily": lambda w: facts.waybill_event_daily(w.waybill, AS_OF, facts.EVENTS["receive"]),
    "parcel_trip_fact": lambda w: w.trips,
    "parcel_cargo_type_1d": lambda w: w.cargo_1d,
    "parcel_cargo_type_nd": lambda w: w.cargo_nd,
    "parcel_bound_finish_td": lambda w: sums.to_date(w.finish_1d, AS_OF),
    "parcel_dispatch_1d": lambda w: w.dispatch_1d,
    "parcel_dispatch_nd": lambda w: w.dispatch_nd,
    "parcel_dispatch_td": lambda w: sums.to_date_carry(
        sums.to_date(w.dispatch_1d, DAY_BEFORE), w.dispatch_1d.where(F.col("dt") == F.lit(AS_OF).cast("date"))),
    "parcel_deliver_1d": lambda w: w.deliver[0],
    "parcel_deliver_nd": lambda w: w.deliver[1],
    "parcel_receive_1d": lambda w: w.receive[0],
    "parcel_receive_nd": lambda w: w.receive[1],
    "parcel_sort_1d": lambda w: w.sort[0],
    "parcel_sort_nd": lambda w: w.sort[1],
    "parcel_truck_model_trips_1d": lambda w: w.trip_1d,
    "parcel_shift_trips_nd": lambda w: w.shift_nd,
    "parcel_city_stats": lambda w: reports.orders_and_trips(w.cargo_1d, w.cargo_nd, *_placed(w), ["city_id", "city_name"], AS_OF),
    "parcel_org_stats": lambda w: reports.orders_and_trips(w.cargo_1d, w.cargo_nd, w.trip_1d, w.shift_nd, ["org_id", "org_name"], AS_OF, align_join),
    "parcel_driver_stats": lambda w: reports.drivers(w.shift_nd, AS_OF),
    "parcel_express_city_stats": lambda w: w.express(["city_id", "city_name"]),
    "parcel_express_org_stats": lambda w: w.express(["org_id", "org_name"]),
    "parcel_express_province_stats": lambda w: w.express(["province_id", "province_name"]),
    "parcel_express_province_full_join": lambda w: w.express(["province_id", "province_name"], "join"),
    "parcel_express_stats": lambda w: w.express([]),
    "parcel_line_stats": lambda w: reports.by_keys(w.shift_nd.withColumnRenamed("line_name", "name"), ["line_id", "name"], AS_OF),
    "parcel_shift_stats": lambda w: reports.by_keys(w.shift_nd, ["shift_id"], AS_OF),
    "parcel_truck_stats": lambda w: reports.by_keys(w.shift_nd, ["truck_model_type", "truck_model_type_name"], AS_OF, sums.TRIP, True),
    "parcel_order_stats": lambda w: reports.cargo_orders(w.cargo_1d, w.cargo_nd, [], AS_OF),
    "parcel_order_cargo_type_stats": lambda w: reports.cargo_orders(w.cargo_1d, w.cargo_nd, ["cargo_type", "cargo_type_name"], AS_OF),
    "parcel_trip_stats": lambda w: reports.trips_overall(w.trip_1d, w.shift_nd, AS_OF),
    "parcel_receive_dispatch_stats": lambda w: reports.receive_and_dispatch(w.receive_recent, w.dispatch_recent, AS_OF),
    "parcel_open_balance_td": lambda w: reports.open_balance(sums.to_date(w.dispatch_1d, AS_OF), sums.to_date(w.finish_1d, AS_OF), AS_OF),
}
