"""Schemas of the tables this package reads and writes.  Nothing is inferred."""

from __future__ import annotations

from treadmark.functions.lists import SLOTS


Fields = tuple[tuple[str, str], ...]


def _schema(*fields: tuple[str, str]) -> Fields:
    return fields


def ddl(fields: Fields) -> str:
    """The schema as text, as readers and ``createDataFrame`` take it."""
    return ", ".join(f"`{name}` {kind}" for name, kind in fields)


def names(fields: Fields) -> list[str]:
    return [name for name, _ in fields]


PRODUCTS = _schema(
    ("ProductId", "bigint"), ("Grade", "string"), ("Size", "string"), ("Manufacturer", "string"), ("Model", "string"),
    ("WetGrip", "string"), ("Fuel", "string"), ("Noise", "string"), ("Price", "double"), ("PrevPrice7", "double"),
    ("PrevPrice28", "double"), ("Season", "string"), ("Offer", "string"), ("OE", "string"), ("AwardScore", "string"),
)
SALES = _schema(
    *[(c, "string") for c in ("ProductId", "CarMake", "CarModel", "Width", "Profile", "Rim", "Orders", "Units", "AvgPrice")]
)
RESULTS = _schema(("Vehicle", "string"), ("Size", "string"), *[(c, "string") for c in SLOTS])
STAGING = _schema(*RESULTS, ("last_modified", "timestamp"))
VEHICLE_MAPPING = _schema(
    *[(c, "string") for c in ("vehicle", "CarMake", "CarModel", "Pod", "Category", "Segment")]
)
SEGMENT_LIST = _schema(*[(c, "string") for c in ("Vehicle", "Size", "Pod", "Segment")])
RUNLIST = _schema(("Vehicle", "string"), ("Size", "string"), ("PriorityRank", "string"))
BENCH_RUNS = _schema(
    ("Model", "string"), ("Search_Enabled", "boolean"), ("Thinking_Budget", "int"), ("Vehicle", "string"),
    ("Size", "string"), ("Run_ID", "bigint"), ("Success", "boolean"), ("Model_Latency_ms", "bigint"),
    ("E2E_Latency_ms", "bigint"), ("Input_Tokens", "bigint"), ("Output_Tokens", "bigint"), ("Total_Tokens", "bigint"),
    ("Cost_USD", "double"), ("Error_Type", "string"), ("Generated_SKUs", "string"), ("Raw_Output", "string"),
)
LOG_ENTRIES = _schema(("run_id", "string"), ("timestamp", "timestamp"), ("textPayload", "string"))

_PARAMS = "array<struct<key: string, value: struct<string_value: string>>>"
EVENTS = _schema(
    ("event_date", "string"), ("event_timestamp", "bigint"), ("user_pseudo_id", "string"), ("user_id", "string"),
    ("event_name", "string"), ("geo", "struct<country: string>"), ("event_params", _PARAMS),
    (
        "items",
        "array<struct<item_id: string, item_list_id: string, item_list_index: string, item_category: string, "
        "item_category5: string, item_brand: string, item_variant: string, price: double, quantity: bigint, "
        f"item_params: {_PARAMS}>>",
    ),
)
