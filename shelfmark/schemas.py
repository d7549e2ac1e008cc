"""Row types: the stored tables' and the wire item's."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType, BooleanType, DataType, DecimalType, IntegerType, LongType, MapType, StringType, StructType,
    TimestampType,
)

MONEY = DecimalType(12, 4)
STRINGS = ArrayType(StringType())
FACETS = MapType(StringType(), STRINGS)


def row(**fields: DataType) -> StructType:
    """A struct with the fields in the order given."""
    result = StructType()
    for name, kind in fields.items():
        result.add(name, kind)
    return result


VARIANT = row(id=LongType(), sku=StringType(), price=LongType(), in_stock=BooleanType(), attributes=FACETS)

DOCUMENT = row(
    id=LongType(), name=StringType(), sku=StringType(), visible=BooleanType(), in_stock=BooleanType(),
    price=LongType(), currency=StringType(), price_exponent=IntegerType(), on_sale=BooleanType(),
    permalink=StringType(), image=StringType(), description=StringType(), brand=StringType(), categories=STRINGS,
    popularity_score=LongType(), attributes=FACETS, variants=ArrayType(VARIANT),
)

ITEM = row(op=StringType(), data=DOCUMENT, version=LongType())

QUEUE = row(
    object_type=StringType(), object_id=LongType(), store_id=LongType(), op=StringType(), version=LongType(),
    status=StringType(), attempts=LongType(), first_seq=LongType(),
)

# A document as it is held: its wire JSON under its id.
HELD = row(id=LongType(), op=StringType(), version=LongType(), json=StringType())

# Ids a refresh reads rows of.
WANTED = row(entity_id=LongType())

MARKER = row(ids=ArrayType(LongType()), q=StringType(), at=LongType())

ATTRIBUTED_LINE = row(
    session_id=LongType(), order_id=LongType(), item_id=LongType(), product_id=LongType(), currency=StringType(),
    value_cents=LongType(), q=StringType(), ts=TimestampType(),
)

ORDER_REPORT = row(
    id=LongType(), order_id=LongType(), value_cents=LongType(), currency=StringType(), item_ids=StringType(),
    q=StringType(), occurred_at=TimestampType(),
)

# The source tables, by the names a catalogue bundle uses.
_SCOPED = {"entity_id": LongType(), "attribute_id": IntegerType(), "store_id": IntegerType()}
SOURCES = {
    "entity": row(entity_id=LongType(), sku=StringType(), type_id=StringType()),
    "website": row(product_id=LongType(), website_id=IntegerType()),
    "eav_int": row(**_SCOPED, value=IntegerType()),
    "eav_varchar": row(**_SCOPED, value=StringType()),
    "eav_text": row(**_SCOPED, value=StringType()),
    "attribute": row(
        attribute_id=IntegerType(), entity_type_code=StringType(), attribute_code=StringType(),
        backend_type=StringType(), frontend_input=StringType(), frontend_label=StringType(),
        is_filterable=IntegerType(), is_filterable_in_search=IntegerType(),
    ),
    "attribute_label": row(attribute_id=IntegerType(), store_id=IntegerType(), value=StringType()),
    "option": row(option_id=IntegerType(), attribute_id=IntegerType()),
    "option_value": row(option_id=IntegerType(), store_id=IntegerType(), value=StringType()),
    "price": row(
        entity_id=LongType(), customer_group_id=IntegerType(), website_id=IntegerType(), price=MONEY,
        final_price=MONEY, min_price=MONEY,
    ),
    "stock_status": row(product_id=LongType(), website_id=IntegerType(), stock_status=IntegerType()),
    "stock_channel": row(type=StringType(), code=StringType(), stock_id=IntegerType()),
    "bestsellers": row(product_id=LongType(), store_id=IntegerType(), period=IntegerType(), qty_ordered=MONEY),
    "super_link": row(parent_id=LongType(), product_id=LongType()),
    "super_attribute": row(product_id=LongType(), attribute_id=IntegerType()),
    "bundle_selection": row(parent_product_id=LongType(), product_id=LongType()),
    "product_link": row(product_id=LongType(), linked_product_id=LongType(), link_type_id=IntegerType()),
    "category_product": row(product_id=LongType(), category_id=LongType(), position=IntegerType()),
    "category_varchar": row(**_SCOPED, value=StringType()),
}
STOCK_TABLE = row(sku=StringType(), is_salable=IntegerType())
