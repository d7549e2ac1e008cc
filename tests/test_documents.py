"""The document job on a small catalogue built to hold every special case."""

import json
from dataclasses import replace
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shelfmark.operators import categories, facets, indexing, popularity, quality, stock, variants
from shelfmark.operators.ids import normalise_ids
from shelfmark.plans.search_items import quarantine, search_items, with_json
from shelfmark.schemas import ITEM, SOURCES, STOCK_TABLE
from shelfmark.sources.catalogue import Catalogue, StoreView, from_files, narrowed, url_suffix

STORE = StoreView(currency="USD")
NAME, URL, SMALL, IMAGE, SHORT, LONG, STATUS, VISIBLE, BRAND, COLOUR, PROMO, STUFF, SHADE, CAT = range(1, 15)

ATTRIBUTES = [
    (NAME, "catalog_product", "name", "varchar", "text", "Name", 0, 0),
    (URL, "catalog_product", "url_key", "varchar", "text", "Url", 0, 0),
    (SMALL, "catalog_product", "small_image", "varchar", "media_image", "Small", 0, 0),
    (IMAGE, "catalog_product", "image", "varchar", "media_image", "Image", 0, 0),
    (SHORT, "catalog_product", "short_description", "text", "textarea", "Short", 0, 0),
    (LONG, "catalog_product", "description", "text", "textarea", "Long", 0, 0),
    (STATUS, "catalog_product", "status", "int", "select", "Status", 1, 1),
    (VISIBLE, "catalog_product", "visibility", "int", "select", "Visibility", 1, 1),
    (BRAND, "catalog_product", "manufacturer", "int", "select", "Maker", 0, 0),
    (COLOUR, "catalog_product", "colour", "int", "select", "Colour", 2, 0),
    (PROMO, "catalog_product", "promo", "int", "boolean", "Promo", 1, 0),
    (STUFF, "catalog_product", "stuff", "text", "multiselect", "", 0, 1),
    (SHADE, "catalog_product", "shade", "varchar", "select", "Colour", 1, 0),
    (CAT, "catalog_category", "name", "varchar", "text", "Name", 0, 0),
]
D = Decimal
TABLES = {
    "entity": [
        (1, "A", "simple"), (2, "B", "simple"), (3, "C", "bundle"), (4, "D", "configurable"), (5, "E", "simple"),
        (6, "F", "simple"), (7, "G", "simple"), (8, "H", "simple"), (9, "I", "grouped"),
    ],
    "website": [(i, 1) for i in (1, 2, 3, 4, 5, 7, 8, 9)] + [(6, 2)],
    "eav_int": [(i, STATUS, 0, 1) for i in range(1, 8)] + [(9, STATUS, 1, 1)]
    + [(i, VISIBLE, 0, 4) for i in (1, 3, 4, 6, 7, 8)] + [(9, VISIBLE, 0, 3), (2, VISIBLE, 0, 2), (5, VISIBLE, 0, 4)]
    + [(7, STATUS, 1, 2), (5, VISIBLE, 1, 1)]
    + [(1, BRAND, 0, 201), (3, BRAND, 0, 202), (4, BRAND, 1, 201)]
    + [(1, COLOUR, 0, 101), (1, COLOUR, 1, 102), (3, COLOUR, 0, 999), (5, COLOUR, 0, 101), (2, COLOUR, 0, 102)]
    + [(1, PROMO, 0, 1), (3, PROMO, 0, 0)],
    "eav_varchar": [
        (1, NAME, 0, "Mat"), (1, NAME, 1, "Tapis"), (3, NAME, 1, "Kit"), (9, NAME, 0, ""),
        (1, URL, 0, "mat"), (3, URL, 1, "kit"), (4, URL, 0, ""),
        (1, SMALL, 0, "no_selection"), (1, IMAGE, 0, "//m/1.jpg"), (3, SMALL, 0, "/s/3.jpg"), (4, SMALL, 0, ""),
        (4, SHADE, 0, "103"), (1, SHADE, 0, "103"),
    ],
    "eav_text": [
        (1, SHORT, 0, "<p>default</p>"), (1, SHORT, 1, "  "), (1, LONG, 0, "<li>Cotton</li><li>Machine wash</li>"),
        (3, SHORT, 0, "x" * 2000), (4, SHORT, 1, "store only"),
        (1, STUFF, 0, "301, 302,,301"), (3, STUFF, 0, "0301"), (4, STUFF, 0, "1"),
    ],
    "attribute": ATTRIBUTES,
    "attribute_label": [(COLOUR, 1, "Couleur"), (SHADE, 1, "Couleur"), (STUFF, 1, "")],
    "option": [(101, COLOUR), (102, COLOUR), (103, SHADE), (201, BRAND), (202, BRAND), (301, STUFF), (302, STUFF), (1, COLOUR)],
    "option_value": [
        (101, 0, "Red"), (101, 1, "Rouge"), (102, 0, "Blue &amp; <b>white</b>"), (103, 0, "Dark"), (201, 0, "A&amp;B"),
        (202, 0, ""), (301, 0, "CoolTech&trade;"), (302, 1, "store only"), (1, 0, "one"),
    ],
    "price": [
        (1, 0, 1, D(32), D(24), D(24)), (3, 0, 1, D(0), D(0), D(61)), (4, 0, 1, D(35), D(28), D(21)),
        (9, 0, 1, None, None, D(14)), (2, 0, 1, D(10), D(9), D(9)), (1, 1, 1, D(1), D(1), D(1)), (8, 0, 2, D(5), D(5), D(5)),
    ],
    "stock_status": [(1, 1, 0), (1, 2, 1), (3, 1, 0), (2, 1, 0)],
    "stock_channel": [("website", "base", 1), ("website", "depot", 2), ("website", "gone", 7)],
    "bestsellers": [(1, 0, 2024, D(6)), (1, 1, 2024, D(1)), (1, 1, 2025, D("2.5")), (3, 0, 2024, D("2.4")), (3, 2, 2024, D(9))],
    "super_link": [(4, 2), (4, 5), (4, 6)],
    "super_attribute": [(4, COLOUR)],
    "bundle_selection": [(3, 1)],
    "product_link": [(9, 1, 3), (1, 2, 1)],
    "category_product": [(1, 1, 0), (1, 2, 0), (1, 12, 1), (1, 11, 1), (1, 10, 5), (1, 13, 0), (3, 13, 0)],
    "category_varchar": [
        (10, CAT, 0, "Sale"), (11, CAT, 0, " Yoga "), (12, CAT, 0, "Old"), (12, CAT, 1, "Sale"), (13, CAT, 0, "Gone"),
        (13, CAT, 1, " "), (2, CAT, 0, "Root"),
    ],
}


@pytest.fixture(scope="module")
def catalogue(spark):
    frames = {name: spark.createDataFrame(rows, SOURCES[name]) for name, rows in TABLES.items()}
    return Catalogue(**frames, inventory_stock={2: spark.createDataFrame([("A", 0), ("C", 1), ("b", 1)], STOCK_TABLE)})


@pytest.fixture(scope="module")
def items(spark, catalogue):
    ids = catalogue.entity.select("entity_id").union(spark.createDataFrame([(77,)], "entity_id bigint"))
    found = with_json(search_items(ids, catalogue, STORE, F.lit(5))).collect()
    return {r.id: r for r in found}


def test_one_item_per_requested_id(items):
    assert {i: r.op for i, r in items.items()} == {
        1: "upsert", 2: "delete", 3: "upsert", 4: "upsert", 5: "delete", 6: "delete", 7: "delete", 8: "delete",
        9: "upsert", 77: "delete",
    }
    assert json.loads(items[77].json) == {"op": "delete", "data": {"id": 77, "visible": False}, "version": 5}


def test_full_document(items):
    assert json.loads(items[1].json) == {
        "op": "upsert",
        "version": 5,
        "data": {
            "id": 1, "name": "Tapis", "sku": "A", "visible": True, "in_stock": True, "price": 2400, "currency": "USD",
            "price_exponent": 2, "on_sale": True, "permalink": "https://shop.example/mat.html",
            "image": "https://shop.example/media/catalog/product/m/1.jpg", "description": "Cotton Machine wash",
            "brand": "A&amp;B", "categories": ["Yoga", "Sale"], "popularity_score": 4,
            "attributes": {"Couleur": ["Dark"], "Promo": ["Yes"], "stuff": ["CoolTech™"]},
        },
    }


def test_absent_fields_stay_absent(items):
    nine = json.loads(items[9].json)["data"]
    assert nine == {
        "id": 9, "name": "", "sku": "I", "visible": True, "in_stock": True, "price": 1400, "currency": "USD", "price_exponent": 2,
    }
    three = items[3]
    assert three.name == "Kit" and three.permalink is None and three.brand is None and three.categories is None
    assert three.in_stock is False and three.price == 6100 and three.on_sale is None and three.popularity_score == 2
    assert len(three.description) == 1000 and three.attributes is None
    assert items[4].name == "D" and items[4].description is None and items[4].permalink is None


def test_variants_are_priced_children_with_their_options(items):
    assert json.loads(items[4].json)["data"]["variants"] == [
        {"id": 2, "sku": "B", "price": 900, "in_stock": False, "attributes": {"Couleur": ["Blue &amp; <b>white</b>"]}}
    ]
    assert json.loads(items[4].json)["data"]["attributes"] == {"Couleur": ["Dark"]}


def test_a_hot_parent_is_one_row_with_every_variant(spark, catalogue):
    n = 25_000
    many = replace(
        catalogue,
        entity=spark.createDataFrame([(i, f"S{i}", "simple") for i in range(1, n)], SOURCES["entity"]),
        super_link=spark.createDataFrame([(4, i) for i in range(100, n)] + [(1, 50)], SOURCES["super_link"]),
        price=spark.createDataFrame([(i, 0, 1, D(i), D(i), D(i)) for i in range(1, n)], SOURCES["price"]),
    )
    rows = {r.entity_id: r.variants for r in variants.nested_variants(many, STORE).collect()}
    assert sorted(rows) == [1, 4] and [v["id"] for v in rows[1]] == [50]
    assert [v["id"] for v in rows[4]] == list(range(100, n))


def test_json_reads_back_as_the_wire_type(spark, items):
    rows = spark.createDataFrame([(r.json,) for r in items.values()], "json string")
    read = rows.select(F.from_json("json", ITEM).alias("i")).select("i.op", "i.data.*")
    assert read.where(F.col("id").isNull() | F.col("visible").isNull()).count() == 0


def test_stock_sources(spark, catalogue):
    def answers(code):
        found = stock.stock_of(catalogue, StoreView(website_code=code), catalogue.entity)
        return {r.entity_id: r.in_stock for r in found.collect()}

    legacy = {1: True, 2: False, 3: False}
    assert answers("base") == legacy and answers("unknown") == legacy and answers("gone") == legacy
    assert answers("depot") == {1: False, 3: True}  # SKU b is not SKU B


def test_missing_tables_and_attributes(spark, catalogue):
    bare = replace(
        catalogue, bestsellers=None, super_link=None, super_attribute=None, category_product=None, category_varchar=None,
        attribute_label=None, stock_channel=None,
        attribute=catalogue.attribute.where("attribute_code NOT IN ('manufacturer', 'url_key')"),
    )
    got = {r.id: r for r in search_items(catalogue.entity.select("entity_id"), bare, STORE, F.lit(1)).collect()}
    assert got[1].brand is None and got[1].permalink is None and got[4].variants is None
    assert got[1].popularity_score is None and got[1].attributes["Colour"] == ["Dark"]


def test_popularity_never_adds_the_rollup(catalogue):
    got = {r.entity_id: r.popularity_score for r in popularity.popularity(catalogue.bestsellers, 1).collect()}
    assert got == {1: 4, 3: 2}


def test_billable_count(catalogue):
    row = indexing.billable_count(catalogue, STORE).collect()[0]
    assert (row.catalogue_rows, row.billable, row.not_indexed) == (9, 4, 5)


def test_option_one_is_not_a_promo(catalogue):
    got = {(r.entity_id, r.label): r["values"] for r in facets.facet_lists(catalogue, STORE).collect()}
    assert got[(1, "Promo")] == ["Yes"] and (3, "Promo") not in got
    assert (4, "stuff") not in got, "option 1 belongs to another attribute"
    assert (3, "stuff") not in got, "0301 is not option 301"


def test_category_order(catalogue):
    got = {r.entity_id: r.categories for r in categories.category_names(catalogue, STORE).collect()}
    assert got == {1: ["Yoga", "Sale"]}


def test_rejected_prices_are_quarantined(spark, catalogue):
    wrong = replace(catalogue, price=spark.createDataFrame([(1, 0, 1, D(5), D(-5), D(-7))], SOURCES["price"]))
    found = search_items(catalogue.entity.select("entity_id"), wrong, STORE, F.lit(1))
    assert [(r.id, r.reason) for r in quarantine(found).collect()] == [(1, "negative price")]
    assert {r.reason for r in quality.item_violations(found).collect() if r.id == 1} == {"rejected price"}


def test_shuffled_input_gives_the_same_items(spark, catalogue, items):
    mixed = replace(
        catalogue,
        **{
            name: getattr(catalogue, name).orderBy(F.rand(3)).repartition(3)
            for name in ("entity", "eav_int", "eav_varchar", "eav_text", "category_product", "option_value", "price")
        },
    )
    ids = spark.createDataFrame([(i,) for i in items], "entity_id bigint")
    again = {r.id: r.json for r in with_json(search_items(ids, mixed, STORE, F.lit(5))).collect()}
    assert again == {i: r.json for i, r in items.items()}


def test_items_keep_the_requested_order(spark, catalogue):
    asked = spark.createDataFrame([("4", 0), ("x", 1), ("1", 2), ("4", 3), ("77", 4), ("0", 5)], "id string, place int")
    found = search_items(normalise_ids(asked, "id", "place"), catalogue, STORE, F.lit(1)).orderBy("ordinal")
    assert [(r.id, r.op) for r in found.collect()] == [(4, "upsert"), (1, "upsert"), (77, "delete")]


def test_narrowed_catalogue_gives_the_same_items(spark, catalogue, items):
    ids = spark.createDataFrame([(1,), (4,), (6,)], "entity_id bigint")
    found = with_json(search_items(ids, narrowed(catalogue, ids), STORE, F.lit(5))).collect()
    assert {r.id: r.json for r in found} == {i: items[i].json for i in (1, 4, 6)}


def test_suffix_setting(spark):
    def suffix(rows):
        config = spark.createDataFrame(rows, "path string, scope_id int, value string")
        return spark.range(1).select(url_suffix(config).alias("s")).collect()[0].s

    path = "catalog/seo/product_url_suffix"
    assert suffix([(path, 0, ".htm"), (path, 1, ".x"), ("other", 0, ".y")]) == ".htm"
    assert suffix([(path, 0, "")]) == ".html" and suffix([("other", 0, ".y")]) == ".html"


def test_catalogue_from_files(spark, catalogue, folder):
    for name in TABLES:
        getattr(catalogue, name).write.parquet(f"{folder}/{name}")
    catalogue.inventory_stock[2].write.parquet(f"{folder}/inventory_stock_2")
    stored = from_files(spark, folder, stock_ids=(2,))
    assert indexing.billable_count(stored, STORE).collect()[0].billable == 4
    assert stored.inventory_stock[2].count() == 3
