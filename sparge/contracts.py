"""Table contracts: columns, keys, references and partitions of every layer."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import types as T

LAYERS = ("raw", "bronze", "silver", "gold")
OPERATIONS = ("insert", "update", "delete")
STATUSES = ("pending", "running", "success", "error")


@dataclass(frozen=True)
class Contract:
    """Columns of one entity, its key, and the columns that point at other entities."""

    name: str
    columns: T.StructType
    key: str
    references: dict[str, str] = field(default_factory=dict)

    @property
    def bronze(self) -> T.StructType:
        return T.StructType([*self.columns.fields, T.StructField("operation", T.StringType(), False)])

    @property
    def silver(self) -> T.StructType:
        return T.StructType([*self.columns.fields, *AUDIT.fields, T.StructField("partitioned_at", T.StringType())])


_TYPES: dict[str, T.DataType] = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "timestamp": T.TimestampType(),
    "map<string,string>": T.MapType(T.StringType(), T.StringType()),
}


def columns(text: str) -> T.StructType:
    """Schema from `name type [not null], ...`; unlike `fromDDL` it needs no running session."""
    fields = []
    for entry in re.split(r",\s+", text.strip()):
        name, kind, *rest = entry.split()
        fields.append(T.StructField(name, _TYPES[kind], not rest))
    return T.StructType(fields)


AUDIT = columns("created_at timestamp, updated_at timestamp, deleted_at timestamp")

BREWERY = Contract(
    "brewery",
    columns("brewery_id bigint not null, brewery_name string not null"),
    "brewery_id",
)
BEER = Contract(
    "beer",
    columns(
        "beer_id bigint not null, brewery_id bigint not null, beer_name string not null,"
        " beer_style string not null, beer_abv double"
    ),
    "beer_id",
    {"brewery_id": "brewery"},
)
PROFILE = Contract(
    "profile",
    columns("profile_id bigint not null, profile_name string not null, email string not null, state string not null"),
    "profile_id",
)
REVIEW = Contract(
    "review",
    columns(
        "review_id bigint not null, brewery_id bigint not null, beer_id bigint not null,"
        " profile_id bigint not null, review_overall double, review_aroma double,"
        " review_appearance double, review_palate double, review_taste double, review_time bigint"
    ),
    "review_id",
    {"brewery_id": "brewery", "beer_id": "beer", "profile_id": "profile"},
)
ENTITIES = {c.name: c for c in (BREWERY, BEER, PROFILE, REVIEW)}

REVIEW_FLAT = columns(
    "review_id bigint, brewery_id bigint, beer_id bigint, profile_id bigint,"
    " brewery_name string, beer_name string, beer_style string, beer_abv double,"
    " profile_name string, email string, state string,"
    " review_overall double, review_aroma double, review_appearance double,"
    " review_palate double, review_taste double, review_time bigint,"
    " created_at timestamp, updated_at timestamp, deleted_at timestamp, partitioned_at string"
)

# When a bronze row's change was made, and where the row comes from: its raw file and its place there. In this order
# they say which change is newer. The time is the envelope's where it has one, else that of the file.
RAW_ORDER = columns(
    "_event_time timestamp, _raw_time timestamp, _raw_key string, _raw_block bigint, _raw_row bigint"
)
# Name of the envelope's time in raw JSON.
EVENT_TIME = "_event_time"

LEDGER = columns(
    "control_id string, object_key string, schema_name string, table_name string,"
    " record_count bigint, file_format string, file_size bigint, checksum string,"
    " status string, attempt_count int, compute_target string,"
    " started_at timestamp, finished_at timestamp, created_at timestamp, updated_at timestamp,"
    " duration bigint, error_message string"
)

# Source database type -> Spark type. 64-bit integers stay 64-bit.
SOURCE_TYPES: dict[str, T.DataType] = {
    "bytea": T.BinaryType(),
    "bool": T.BooleanType(),
    "bpchar": T.StringType(),
    "char": T.StringType(),
    "name": T.StringType(),
    "text": T.StringType(),
    "varchar": T.StringType(),
    "inet": T.StringType(),
    "int2": T.ShortType(),
    "int4": T.IntegerType(),
    "int8": T.LongType(),
    "float4": T.DoubleType(),
    "float8": T.DoubleType(),
    "numeric": T.DoubleType(),
    "date": T.TimestampType(),
    "time": T.TimestampType(),
    "timestamp": T.TimestampType(),
    "timestamptz": T.TimestampType(),
    "interval": T.StringType(),
    "uuid": T.StringType(),
    "json": T.MapType(T.StringType(), T.StringType()),
    "jsonb": T.MapType(T.StringType(), T.StringType()),
}

# Fallback by type category (composite, date/time, enum, user-defined, string).
SOURCE_CATEGORIES: dict[str, T.DataType] = {
    "C": T.StringType(),
    "D": T.TimestampType(),
    "E": T.StringType(),
    "U": T.MapType(T.StringType(), T.StringType()),
    "S": T.StringType(),
}


def source_type(name: str, category: str | None = None, element: str | None = None) -> T.DataType:
    """Spark type of a source column; arrays (category "A") map their element type."""
    if category == "A":
        if element is None:
            raise ValueError(f"array type {name} needs its element type")
        return T.ArrayType(source_type(element))
    if name in SOURCE_TYPES:
        return SOURCE_TYPES[name]
    if category in SOURCE_CATEGORIES:
        return SOURCE_CATEGORIES[category]
    raise ValueError(f"type could not be mapped: {name}")


def layer_of(schema: str) -> str:
    """Lake layer of a source schema; `schema_of` is the inverse."""
    return {"core": "bronze", "view": "silver", "mart": "gold"}[schema.removeprefix("dm_")]


def schema_of(layer: str) -> str:
    return {"bronze": "dm_core", "silver": "dm_view", "gold": "dm_mart"}[layer]


# The published cost-and-usage columns, in their order.
COSTS = columns(
    """
    bill_bill_type string, bill_billing_entity string, bill_billing_period_end_date timestamp,
    bill_billing_period_start_date timestamp, bill_invoice_id string, bill_invoicing_entity string,
    bill_payer_account_id string, bill_payer_account_name string,
    cost_category map<string,string>, discount map<string,string>,
    discount_bundled_discount double, discount_total_discount double,
    identity_line_item_id string, identity_time_interval string,
    line_item_availability_zone string, line_item_blended_cost double, line_item_blended_rate string,
    line_item_currency_code string, line_item_legal_entity string, line_item_line_item_description string,
    line_item_line_item_type string, line_item_net_unblended_cost double, line_item_net_unblended_rate string,
    line_item_normalization_factor double, line_item_normalized_usage_amount double, line_item_operation string,
    line_item_product_code string, line_item_resource_id string, line_item_tax_type string,
    line_item_unblended_cost double, line_item_unblended_rate string, line_item_usage_account_id string,
    line_item_usage_account_name string, line_item_usage_amount double, line_item_usage_end_date timestamp,
    line_item_usage_start_date timestamp, line_item_usage_type string,
    pricing_currency string, pricing_lease_contract_length string, pricing_offering_class string,
    pricing_public_on_demand_cost double, pricing_public_on_demand_rate string, pricing_purchase_option string,
    pricing_rate_code string, pricing_rate_id string, pricing_term string, pricing_unit string,
    product map<string,string>, product_comment string, product_fee_code string, product_fee_description string,
    product_from_location string, product_from_location_type string, product_from_region_code string,
    product_instance_family string, product_instance_type string, product_instancesku string,
    product_location string, product_location_type string, product_operation string, product_pricing_unit string,
    product_product_family string, product_region_code string, product_servicecode string, product_sku string,
    product_to_location string, product_to_location_type string, product_to_region_code string,
    product_usagetype string,
    reservation_amortized_upfront_cost_for_usage double, reservation_amortized_upfront_fee_for_billing_period double,
    reservation_availability_zone string, reservation_effective_cost double, reservation_end_time string,
    reservation_modification_status string, reservation_net_amortized_upfront_cost_for_usage double,
    reservation_net_amortized_upfront_fee_for_billing_period double, reservation_net_effective_cost double,
    reservation_net_recurring_fee_for_usage double,
    reservation_net_unused_amortized_upfront_fee_for_billing_period double,
    reservation_net_unused_recurring_fee double, reservation_net_upfront_value double,
    reservation_normalized_units_per_reservation string, reservation_number_of_reservations string,
    reservation_recurring_fee_for_usage double, reservation_reservation_a_r_n string,
    reservation_start_time string, reservation_subscription_id string,
    reservation_total_reserved_normalized_units string, reservation_total_reserved_units string,
    reservation_units_per_reservation string, reservation_unused_amortized_upfront_fee_for_billing_period double,
    reservation_unused_normalized_unit_quantity double, reservation_unused_quantity double,
    reservation_unused_recurring_fee double, reservation_upfront_value double,
    resource_tags map<string,string>,
    savings_plan_amortized_upfront_commitment_for_billing_period double, savings_plan_end_time string,
    savings_plan_instance_type_family string,
    savings_plan_net_amortized_upfront_commitment_for_billing_period double,
    savings_plan_net_recurring_commitment_for_billing_period double,
    savings_plan_net_savings_plan_effective_cost double, savings_plan_offering_type string,
    savings_plan_payment_option string, savings_plan_purchase_term string,
    savings_plan_recurring_commitment_for_billing_period double, savings_plan_region string,
    savings_plan_savings_plan_a_r_n string, savings_plan_savings_plan_effective_cost double,
    savings_plan_savings_plan_rate double, savings_plan_start_time string,
    savings_plan_total_commitment_to_date double, savings_plan_used_commitment double,
    billing_period string
    """
)
