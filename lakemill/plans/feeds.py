"""The source feeds: columns, keys and load rules of every table, as data."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import StructType

from lakemill.operators.incremental import Watermark
from lakemill.sources.relational import Split


@dataclass(frozen=True)
class Kept:
    """Which version of a fact is kept beside its history: per ``keys`` the greatest by ``order`` of those that meet ``only``."""

    name: str
    keys: tuple[str, ...]
    order: tuple[str, ...]
    only: str | None = None


@dataclass(frozen=True)
class TableSpec:
    """Everything the generic jobs need to know about one table.

    ``order`` sorts the versions of a key (dimensions) and decides upserts (``precombine``).
    ``rules`` are SQL conditions that cleaned fact rows must meet. ``kept`` names versions of a fact that are kept at write time
    besides the last one of each key. ``inclusive`` takes rows whose mark equals the stored high-water again, less those
    already stored. ``keys_move=False`` promises that a key stays in its partition. ``split`` cuts the source scan.
    """

    source: str
    target: str
    keys: tuple[str, ...]
    order: tuple[str, ...]
    columns: str
    watermark: Watermark | None = None
    dimension: bool = False
    time_columns: tuple[str, ...] = ()
    event_time: str = "create_time"
    load_time: str | None = None
    fills: tuple[tuple[str, str], ...] = ()
    drops: tuple[str, ...] = ()
    rules: tuple[str, ...] = ()
    partition: str = "etl_date"
    kept: tuple[Kept, ...] = ()
    inclusive: bool = False
    keys_move: bool = True
    split: Split | None = None

    def versions(self) -> tuple[Kept, ...]:
        """All versions kept of a fact; a dimension is one itself."""
        if self.dimension or not self.keys:
            return ()
        held = {*StructType.fromDDL(self.columns).names, "dwd_modify_time"}
        ties = [c for c in ("dwd_modify_time", "create_time") if c in held and c not in self.order]
        return (Kept("last", self.keys, (*self.order, *ties)), *self.kept)


def _ts(column: str) -> Watermark:
    return Watermark("ts", (column,))


_BOTH_TIMES = Watermark("greatest", ("create_time", "operate_time"))
_ID = Watermark("id", ("id",))
_FILL_OPERATE = (("operate_time", "create_time"),)

# Tables, columns, keys and times of the first retail feed.
RETAIL_A = (
    TableSpec(
        "user_info", "dim_user_info", ("id",), ("operate_time",),
        "id bigint, login_name string, nick_name string, passwd string, name string, phone_num string, "
        "email string, head_img string, user_level string, birthday date, gender string, "
        "create_time timestamp_ntz, operate_time timestamp_ntz",
        _BOTH_TIMES, dimension=True, time_columns=("create_time", "operate_time"), fills=_FILL_OPERATE,
    ),
    TableSpec(
        "sku_info", "dim_sku_info", ("id",), ("create_time",),
        "id bigint, spu_id bigint, price decimal(10,0), sku_name string, sku_desc string, "
        "weight decimal(10,2), tm_id bigint, category3_id bigint, sku_default_img string, "
        "create_time timestamp_ntz",
        _ts("create_time"), dimension=True, time_columns=("create_time",),
    ),
    TableSpec(
        "base_province", "dim_province", ("id",), ("create_time",),
        "id bigint, name string, region_id string, area_code string, iso_code string, "
        "create_time timestamp_ntz",
        _ID, dimension=True, load_time="create_time",
    ),
    TableSpec(
        "base_region", "dim_region", ("id",), ("create_time",),
        "id string, region_name string, create_time timestamp_ntz",
        _ID, dimension=True, load_time="create_time",
    ),
    TableSpec(
        "order_info", "fact_order_info", ("id",), ("operate_time",),
        "id bigint, consignee string, consignee_tel string, final_total_amount decimal(16,2), "
        "order_status string, user_id bigint, delivery_address string, order_comment string, "
        "out_trade_no string, trade_body string, create_time timestamp_ntz, operate_time timestamp_ntz, "
        "expire_time timestamp_ntz, tracking_no string, parent_order_id bigint, img_url string, "
        "province_id int, benefit_reduce_amount decimal(16,2), original_total_amount decimal(16,2), "
        "feight_fee decimal(16,2)",
        _BOTH_TIMES, time_columns=("operate_time", "expire_time"), fills=_FILL_OPERATE,
    ),
    TableSpec(
        "order_detail", "fact_order_detail", ("id",), ("create_time",),
        "id bigint, order_id bigint, sku_id bigint, sku_name string, img_url string, "
        "order_price decimal(10,2), sku_num string, create_time timestamp_ntz, source_type string, "
        "source_id bigint",
        _ts("create_time"),
    ),
)

# Tables, columns, keys and times of the second retail feed.
RETAIL_B = (
    TableSpec(
        "customer_inf", "dim_customer_inf", ("customer_id",), ("modified_time",),
        "customer_inf_id int, customer_id int, customer_name string, identity_card_type tinyint, "
        "identity_card_no string, mobile_phone string, customer_email string, gender string, "
        "customer_point int, register_time timestamp_ntz, birthday timestamp_ntz, customer_level tinyint, "
        "customer_money decimal(8,2), modified_time timestamp_ntz",
        _ts("modified_time"), dimension=True, time_columns=("register_time", "modified_time"),
    ),
    TableSpec(
        "product_info", "dim_product_info", ("product_id",), ("modified_time",),
        "product_id int, product_core string, product_name string, bar_code string, brand_id int, "
        "one_category_id tinyint, two_category_id tinyint, three_category_id tinyint, supplier_id int, "
        "price decimal(8,2), average_cost decimal(18,2), publish_status tinyint, audit_status tinyint, "
        "weight float, length float, height float, width float, color_type string, "
        "production_date timestamp_ntz, shelf_life int, descript string, indate timestamp_ntz, "
        "modified_time timestamp_ntz",
        _ts("modified_time"), dimension=True, time_columns=("production_date", "indate", "modified_time"),
    ),
    TableSpec(
        "order_master", "fact_order_master", ("order_id",), ("modified_time",),
        "order_id int, order_sn string, customer_id int, shipping_user string, province string, "
        "city string, address string, order_source tinyint, payment_method tinyint, "
        "order_money decimal(8,2), district_money decimal(8,2), shipping_money decimal(8,2), "
        "payment_money decimal(8,2), shipping_comp_name string, shipping_sn string, create_time string, "
        "shipping_time string, pay_time string, receive_time string, order_status string, "
        "order_point int, invoice_title string, modified_time timestamp_ntz",
        _ts("modified_time"),
        time_columns=("modified_time", "shipping_time", "pay_time", "receive_time"),
        rules=("length(city) <= 8",),
        # A refunded version is no valid order and does not hide an earlier one that was.
        kept=(Kept("valid", ("order_sn",), ("create_time", "modified_time", "order_id"), "order_status not in ('已退款')"),),
    ),
    TableSpec(
        "order_detail", "fact_order_detail", ("order_detail_id",), ("modified_time",),
        "order_detail_id int, order_sn string, product_id int, product_name string, product_cnt int, "
        "product_price decimal(8,2), average_cost decimal(8,2), weight float, fee_money decimal(8,2), "
        "w_id int, create_time string, modified_time timestamp_ntz",
        _ts("modified_time"), time_columns=("modified_time",),
    ),
)

# Tables, keys and times of the manufacturing feed, extracted whole.
MANUFACTURING = (
    TableSpec(
        "ChangeRecord", "changerecord", ("ChangeID", "ChangeMachineID"), ("ChangeEndTime",),
        "ChangeID int, ChangeMachineID int, ChangeMachineRecordID int, ChangeRecordState string, "
        "ChangeStartTime timestamp_ntz, ChangeEndTime timestamp_ntz, ChangeRecordData string, "
        "ChangeHandleState int",
        partition="etldate",
    ),
    TableSpec(
        "BaseMachine", "basemachine", ("BaseMachineID",), ("MachineAddDate",),
        "BaseMachineID int, MachineFactory int, MachineNo string, MachineName string, MachineIP string, "
        "MachinePort int, MachineAddDate date, MachineRemarks string, MachineAddEmpID int, "
        "MachineResponsEmpID int, MachineLedgerXml string, ISWS int",
        partition="etldate",
    ),
    TableSpec(
        "MachineData", "machinedata", ("MachineRecordID",), ("MachineRecordDate",),
        "MachineRecordID int, MachineID int, MachineRecordState string, MachineRecordData string, "
        "MachineRecordDate timestamp_ntz",
        partition="etldate",
    ),
    TableSpec(
        "ProduceRecord", "producerecord", ("ProduceRecordID", "ProduceMachineID"), ("ProduceCodeEndTime",),
        "ProduceRecordID int, ProduceMachineID int, ProduceCodeNumber string, "
        "ProduceStartWaitTime timestamp_ntz, ProduceCodeStartTime timestamp_ntz, "
        "ProduceCodeEndTime timestamp_ntz, ProduceCodeCycleTime int, ProduceEndTime timestamp_ntz, "
        "ProduceTotalOut int, ProduceInspect int",
        drops=("ProducePrgCode",), partition="etldate",
    ),
)

# Result tables and their columns, without partition columns where those are named apart.
RESULTS = {
    "user_consumption_day_aggr": (
        "customer_id bigint, customer_name string, total_amount double, total_count bigint, "
        "year int, month int, day int", ["year", "month", "day"]),
    "city_consumption_day_aggr": (
        "city_name string, province_name string, total_amount double, total_count bigint, "
        "sequence bigint, year int, month int", ["year", "month"]),
    "province_consumption_day_aggr": (
        "province_id int, province_name string, region_id int, region_name string, total_amount double, "
        "total_count bigint, sequence bigint, year int, month int", ["year", "month"]),
}
