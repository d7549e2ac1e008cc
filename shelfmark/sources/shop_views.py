"""Shop-shaped views over the given tables.

The given tables are an order-processing star schema. These views read them as a shop's
catalogue, change log, orders and sessions. The SQL runs unchanged on Spark and on DuckDB,
so a query and its oracle start from the same rows. Every view covers its whole base table.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

VIEWS = {
    "shop_entity": """
SELECT p_partkey + 1 AS entity_id, concat('SKU-', CAST(p_partkey + 1 AS STRING)) AS sku,
 CASE WHEN (p_partkey + 1) % 20 = 0 THEN 'configurable' WHEN (p_partkey + 1) % 97 = 0 THEN 'bundle'
      WHEN (p_partkey + 1) % 89 = 0 THEN 'grouped' ELSE 'simple' END AS type_id,
 p_name, p_brand, p_type, p_size, p_retailprice FROM part""",
    "shop_website": """
SELECT entity_id AS product_id, 1 AS website_id FROM shop_entity WHERE entity_id % 11 <> 0
 UNION ALL SELECT entity_id, 2 FROM shop_entity WHERE entity_id % 5 = 0""",
    "shop_attribute": """
SELECT * FROM (VALUES
 (73,'catalog_product','name','varchar','text','Name',0,0),
 (75,'catalog_product','description','text','textarea','Description',0,0),
 (83,'catalog_product','manufacturer','int','select','Manufacturer',1,1),
 (85,'catalog_product','short_description','text','textarea','Short',0,0),
 (87,'catalog_product','image','varchar','media_image','Base',0,0),
 (88,'catalog_product','small_image','varchar','media_image','Small',0,0),
 (93,'catalog_product','color','int','select','Color',1,1),
 (97,'catalog_product','status','int','select','Enable',0,0),
 (99,'catalog_product','visibility','int','select','Visibility',0,0),
 (119,'catalog_product','url_key','varchar','text','URL Key',0,0),
 (150,'catalog_product','is_promo','int','boolean','Promo',1,0),
 (160,'catalog_product','material','text','multiselect','',0,1),
 (45,'catalog_category','name','varchar','text','Name',0,0))
 AS t(attribute_id, entity_type_code, attribute_code, backend_type, frontend_input, frontend_label,
      is_filterable, is_filterable_in_search)""",
    "shop_attribute_label": """
SELECT * FROM (VALUES (93, 1, 'Couleur'), (83, 1, ''), (150, 2, 'Aktion')) AS t(attribute_id, store_id, value)""",
    "shop_eav_int": """
SELECT entity_id, 97 AS attribute_id, 0 AS store_id, CASE WHEN entity_id % 13 = 0 THEN 2 ELSE 1 END AS value FROM shop_entity
 UNION ALL SELECT entity_id, 97, 1, CASE WHEN entity_id % 2 = 0 THEN 1 ELSE 2 END FROM shop_entity WHERE entity_id % 17 = 0 OR entity_id % 26 = 0
 UNION ALL SELECT entity_id, 99, 0, CASE WHEN type_id <> 'simple' THEN 4 WHEN entity_id % 10 < 4 THEN 1 WHEN entity_id % 10 < 6 THEN 2 WHEN entity_id % 10 < 8 THEN 3 ELSE 4 END FROM shop_entity
 UNION ALL SELECT entity_id, 99, 1, 1 FROM shop_entity WHERE entity_id % 19 = 0
 UNION ALL SELECT entity_id, 93, 0, 100 + p_size % 7 FROM shop_entity WHERE entity_id % 3 <> 0
 UNION ALL SELECT entity_id, 83, 0, 200 + CAST(substr(p_brand, 7) AS INT) FROM shop_entity WHERE entity_id % 2 = 0
 UNION ALL SELECT entity_id, 150, 0, CAST(entity_id % 2 AS INT) FROM shop_entity""",
    "shop_eav_varchar": """
SELECT entity_id, 73 AS attribute_id, 0 AS store_id, p_name AS value FROM shop_entity WHERE entity_id % 29 <> 0
 UNION ALL SELECT entity_id, 73, 1, concat(p_name, ' FR') FROM shop_entity WHERE entity_id % 7 = 0
 UNION ALL SELECT entity_id, 119, 0, concat(replace(p_name, ' ', '-'), '-', CAST(entity_id AS STRING)) FROM shop_entity
 UNION ALL SELECT entity_id, 88, 0, CASE WHEN entity_id % 6 = 0 THEN 'no_selection' ELSE concat('/s/', CAST(entity_id AS STRING), '.jpg') END FROM shop_entity
 UNION ALL SELECT entity_id, 87, 0, CASE WHEN entity_id % 12 = 0 THEN 'no_selection' ELSE concat('/i/', CAST(entity_id AS STRING), '.jpg') END FROM shop_entity""",
    "shop_eav_text": """
SELECT doc_id + 1 AS entity_id, 85 AS attribute_id, 0 AS store_id, concat('<ul><li>', source, ' ', lang, '</li><li>A&amp;B</li></ul>') AS value FROM documents WHERE doc_id % 3 = 0
 UNION ALL SELECT doc_id + 1, 75, 0, concat('<p>', text, '</p>') FROM documents
 UNION ALL SELECT doc_id + 1, 85, 1, '' FROM documents WHERE doc_id % 12 = 0
 UNION ALL SELECT entity_id, 160, 0, CASE WHEN entity_id % 4 = 0 THEN '301' WHEN entity_id % 4 = 1 THEN '301, 302' WHEN entity_id % 4 = 2 THEN '303,,301' ELSE '' END FROM shop_entity""",
    "shop_option": """
SELECT 100 + p_size % 7 AS option_id, 93 AS attribute_id FROM part GROUP BY 100 + p_size % 7
 UNION ALL SELECT 200 + CAST(substr(p_brand, 7) AS INT), 83 FROM part GROUP BY 200 + CAST(substr(p_brand, 7) AS INT)
 UNION ALL SELECT * FROM (VALUES (301,160),(302,160),(303,160),(1,170)) AS t(a,b)""",
    "shop_option_value": """
SELECT option_id, 0 AS store_id, CASE WHEN option_id = 303 THEN 'CoolTech&trade;' ELSE concat('Opt ', CAST(option_id AS STRING)) END AS value FROM shop_option
 UNION ALL SELECT option_id, 1, concat('Choix ', CAST(option_id AS STRING)) FROM shop_option WHERE option_id % 5 = 0""",
    "shop_price": """
SELECT entity_id, 0 AS customer_group_id, 1 AS website_id,
 CASE WHEN type_id = 'grouped' THEN NULL WHEN type_id = 'bundle' THEN CAST(0 AS DECIMAL(12,4)) ELSE CAST(p_retailprice AS DECIMAL(12,4)) END AS price,
 CASE WHEN type_id = 'grouped' THEN NULL WHEN type_id = 'bundle' THEN CAST(0 AS DECIMAL(12,4)) WHEN entity_id % 5 = 0 THEN CAST(p_retailprice - 100 AS DECIMAL(12,4)) ELSE CAST(p_retailprice AS DECIMAL(12,4)) END AS final_price,
 CAST(p_retailprice - 150 AS DECIMAL(12,4)) AS min_price FROM shop_entity WHERE entity_id % 23 <> 0""",
    "shop_stock_status": """
SELECT entity_id AS product_id, 1 AS website_id, CASE WHEN entity_id % 8 = 0 THEN 0 ELSE 1 END AS stock_status FROM shop_entity WHERE entity_id % 31 <> 0
 UNION ALL SELECT entity_id, 2, CASE WHEN entity_id % 16 = 0 THEN 1 ELSE 0 END FROM shop_entity WHERE entity_id % 4 = 0""",
    "shop_stock_channel": """
SELECT * FROM (VALUES ('website', 'base', 1), ('website', 'depot', 2), ('other', 'base', 3)) AS t(type, code, stock_id)""",
    "shop_inventory_stock_2": """
SELECT sku, CASE WHEN entity_id % 9 = 0 THEN 0 ELSE 1 END AS is_salable FROM shop_entity WHERE entity_id % 37 <> 0""",
    "shop_bestsellers": """
SELECT l_partkey + 1 AS product_id, 1 AS store_id, CAST(year(l_shipdate) AS INT) AS period, SUM(CAST(l_quantity AS DECIMAL(12,4))) AS qty_ordered FROM lineitem WHERE l_partkey % 3 <> 0 AND l_linenumber <= 4 GROUP BY l_partkey, year(l_shipdate)
 UNION ALL SELECT l_partkey + 1, 0, CAST(year(l_shipdate) AS INT), SUM(CAST(l_quantity AS DECIMAL(12,4))) FROM lineitem GROUP BY l_partkey, year(l_shipdate)""",
    "shop_super_link": """
SELECT entity_id - entity_id % 20 AS parent_id, entity_id AS product_id FROM shop_entity WHERE entity_id % 20 BETWEEN 1 AND 4 AND entity_id > 20""",
    "shop_super_attribute": """
SELECT entity_id AS product_id, 93 AS attribute_id FROM shop_entity WHERE type_id = 'configurable'""",
    "shop_bundle_selection": """
SELECT entity_id - entity_id % 97 AS parent_product_id, entity_id AS product_id FROM shop_entity WHERE entity_id % 97 BETWEEN 1 AND 3 AND entity_id > 97""",
    "shop_product_link": """
SELECT entity_id - entity_id % 89 AS product_id, entity_id AS linked_product_id, 3 AS link_type_id FROM shop_entity WHERE entity_id % 89 BETWEEN 1 AND 3 AND entity_id > 89
 UNION ALL SELECT entity_id, entity_id + 1, 1 FROM shop_entity WHERE entity_id % 4 = 0""",
    "shop_category_product": """
SELECT entity_id AS product_id, 1 AS category_id, 0 AS position FROM shop_entity UNION ALL SELECT entity_id, 2, 0 FROM shop_entity
 UNION ALL SELECT entity_id, 10 + length(p_type), CAST(entity_id % 3 AS INT) FROM shop_entity UNION ALL SELECT entity_id, 30 + p_size % 9, 1 FROM shop_entity""",
    "shop_category_varchar": """
SELECT category_id AS entity_id, 45 AS attribute_id, 0 AS store_id, concat(' Cat ', CAST(category_id AS STRING)) AS value FROM shop_category_product GROUP BY category_id
 UNION ALL SELECT category_id, 45, 1, CASE WHEN category_id % 8 = 0 THEN '  ' ELSE concat('Rayon ', CAST(category_id % 6 AS STRING)) END FROM shop_category_product WHERE category_id % 4 < 2 GROUP BY category_id""",
    "shop_changelog": """
SELECT event_id + 1 AS version_id, (user_id * 13 + event_id) % 200 + 1 AS entity_id, ts, event_type FROM events""",
    "shop_order_item": """
SELECT l_orderkey AS order_id, l_linenumber AS item_id, CASE WHEN l_linenumber % 4 = 0 THEN l_linenumber - 1 ELSE NULL END AS parent_item_id, l_partkey + 1 AS product_id,
 CAST(l_extendedprice AS DECIMAL(12,4)) AS row_total, CAST(l_extendedprice * (1 + l_tax) AS DECIMAL(12,4)) AS row_total_incl_tax, CAST(l_extendedprice * l_discount AS DECIMAL(12,4)) AS discount_amount FROM lineitem""",
    "shop_order": """
SELECT o_orderkey AS order_id, o_custkey % 150 AS session_id, o_orderdate AS created_at,
 CASE o_orderkey % 4 WHEN 0 THEN ' usd' WHEN 1 THEN 'JPY' WHEN 2 THEN 'KWD' ELSE '' END AS order_currency, 'EUR' AS base_currency FROM orders""",
    "shop_session_event": """
SELECT event_id, ts, user_id AS session_id, CASE event_type WHEN 'click' THEN 'mark' ELSE 'order' END AS kind, event_id + 1 AS order_id,
 CAST(get_k AS BIGINT) % 20 + 1 AS product_id, CASE WHEN event_id % 5 = 0 THEN '' ELSE concat('term ', CAST(event_id % 17 AS STRING)) END AS q, value
 FROM (SELECT *, regexp_extract(props, '([0-9]+)', 1) AS get_k FROM events) x WHERE event_type IN ('click','purchase')""",
    "shop_delivery": """
SELECT event_id + 1 AS id, user_id AS store_id, ts, CASE CAST(event_id % 10 AS INT) WHEN 0 THEN 429 WHEN 1 THEN 422 WHEN 2 THEN 503 WHEN 3 THEN 0 WHEN 4 THEN 409 ELSE 202 END AS status FROM events WHERE event_type = 'purchase'""",
    "shop_queue_log": """
SELECT event_id + 1 AS seq, (user_id * 13 + event_id) % 200 + 1 AS object_id, ts,
 CASE event_type WHEN 'purchase' THEN CASE WHEN event_id % 10 >= 5 THEN 'complete' ELSE 'release' END WHEN 'view' THEN 'claim' ELSE 'enqueue' END AS kind,
 CASE WHEN event_type IN ('purchase', 'view') THEN (event_id + 1 - (event_id % 7) * 150) * 1000 ELSE (event_id + 1) * 1000 END AS version FROM events""",
    # The queue's log by type, object and store; there are as many objects as the tables give.
    "shop_drain_log": """
SELECT event_id + 1 AS seq, CASE WHEN event_id % 5 = 0 THEN 'page' ELSE 'product' END AS object_type,
 (user_id * 31 + event_id) % (SELECT CAST(count(*) AS BIGINT) + 1 FROM part) + 1 AS object_id, CAST(event_id % 2 AS BIGINT) AS store_id, ts,
 CASE event_type WHEN 'purchase' THEN CASE WHEN event_id % 10 >= 5 THEN 'complete' ELSE 'release' END WHEN 'view' THEN 'claim' ELSE 'enqueue' END AS kind,
 CASE WHEN event_type IN ('purchase', 'view') THEN (event_id + 1 - (event_id % 3) * 200) * 1000 ELSE (event_id + 1) * 1000 END AS version FROM events""",
    "shop_watched_change": """
SELECT CAST(event_id % 14 AS INT) AS table_no, (user_id * 13 + event_id) % 200 + 1 AS changed_id, ts FROM events""",
    "shop_config": """
SELECT * FROM (VALUES ('catalog/seo/product_url_suffix', 0, '.htm'), ('catalog/seo/product_url_suffix', 1, ''), ('web/secure/base_url', 0, 'x')) AS t(path, scope_id, value)""",
    "shop_store_settings": """
SELECT n_nationkey AS store_id, n_nationkey % 3 <> 0 AS connected, n_nationkey % 5 <> 0 AS share_search_data FROM nation""",
    "shop_settings_change": """
SELECT user_id % 25 AS store_id, ts, event_id AS seq, event_id % 4 <> 0 AS connected, event_id % 3 <> 0 AS share_search_data FROM events WHERE event_type IN ('error', 'signup')""",
    "shop_report": """
SELECT user_id % 25 AS store_id, event_id + 1 AS id, event_id + 1 AS order_id, ts AS occurred_at, event_id % 9 = 0 AS spoilt,
 CASE WHEN event_id % 23 = 1 THEN 429 WHEN event_id % 7 = 1 THEN 422 ELSE 202 END AS status FROM events WHERE event_type = 'purchase'""",
    "shop_store": """
SELECT n_nationkey AS store_id, n_regionkey AS website_id, concat('site', CAST(n_regionkey AS STRING)) AS website_code, n_nationkey % 3 + 2 AS root_category_id FROM nation""",
    "shop_scoped_config": """
SELECT 'default' AS scope, CAST(0 AS BIGINT) AS scope_id, path, value FROM (VALUES ('web/secure/base_url', 'https://shop.example'), ('currency/options/default', 'usd'),
 ('catalog/seo/product_url_suffix', '.html')) AS t(path, value)
 UNION ALL SELECT 'websites', r_regionkey, 'web/secure/base_url', concat('https://', lower(replace(r_name, ' ', '-')), '.example/') FROM region WHERE r_regionkey % 2 = 0
 UNION ALL SELECT 'websites', r_regionkey, 'currency/options/default', CASE WHEN r_regionkey = 3 THEN 'EUR' ELSE 'JPY' END FROM region WHERE r_regionkey > 1
 UNION ALL SELECT 'stores', n_nationkey, 'catalog/seo/product_url_suffix', CASE WHEN n_nationkey % 4 = 0 THEN '' ELSE '.htm' END FROM nation WHERE n_nationkey % 2 = 0
 UNION ALL SELECT 'stores', n_nationkey, 'currency/options/default', CASE WHEN n_nationkey % 5 = 0 THEN NULL ELSE 'KWD' END FROM nation WHERE n_nationkey % 3 = 0
 UNION ALL SELECT 'stores', n_nationkey, 'web/secure/base_media_url', concat('https://cdn', CAST(n_nationkey AS STRING), '.example/') FROM nation WHERE n_nationkey % 7 = 0""",
    "shop_document_write": """
SELECT event_id + 1 AS arrival, (user_id * 13 + event_id) % 200 + 1 AS object_id, (event_id * 7919) % 1009 AS version, event_type AS body FROM events""",
    "shop_resync_poll": """
SELECT event_id + 1 AS seq, user_id % 7 AS install_id, ts, event_type <> 'error' AS required,
 CASE WHEN event_type = 'signup' THEN '' ELSE concat('tok-', CAST(CAST(floor(event_id / 40) AS BIGINT) AS STRING)) END AS token, event_id % 3 AS pending FROM events""",
}


def _reads(sql: str, known: dict[str, str]) -> list[str]:
    """The base tables and known views that a text names."""
    words = dict.fromkeys(re.findall(r"\b[a-z_0-9]+\b", sql))
    return [word for word in words if word in known or word in BASE_TABLES]


def with_views(sql: str, extra: dict[str, str] | None = None, recursive: bool = False) -> str:
    """``sql`` behind a WITH list of the views it reads, directly or through others."""
    known = VIEWS | (extra or {})
    wanted: set[str] = set()
    pending = _reads(sql, known)
    while pending:
        name = pending.pop()
        if name in known and name not in wanted:
            wanted.add(name)
            pending += _reads(known[name], known)
    views = ",\n".join(f"{name} AS ({text.strip()})" for name, text in known.items() if name in wanted)
    keyword = "WITH RECURSIVE" if recursive else "WITH"
    return f"{keyword} {views}\n{sql}" if views else sql


class Shop:
    """The views of one data folder as DataFrames, built when first asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._frames: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._frames:
            if name in VIEWS:
                for source in _reads(VIEWS[name], VIEWS):
                    self.table(source).createOrReplaceTempView(source)
                self._frames[name] = self.spark.sql(VIEWS[name])
            else:
                self._frames[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._frames[name]

    def __getitem__(self, name: str) -> DataFrame:
        return self.table(name if name in BASE_TABLES else f"shop_{name}")
