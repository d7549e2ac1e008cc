"""The same questions in plain SQL, written from the rules and not from the Spark plans:
self joins where the plans aggregate, windows where they take minimums, a recursive query
where they fold. DuckDB runs them over the same tables."""

from __future__ import annotations

from shelfmark.functions.money import EXPONENTS
from shelfmark.functions.text import TAGS_PORTABLE, WHITESPACE_PORTABLE
from shelfmark.functions.wire import RETRY_CODES
from shelfmark.operators.locales import CATALOGUES, LOCALE
from shelfmark.plans.queries import CURRENCIES, INSTALL, LOCALE_SUFFIXES, STORE, WALK_VERSION
from shelfmark.sources.changelog import WATCHED
from shelfmark.sources.shop_views import with_views


def _quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _words(markup: str) -> str:
    """Plain text. The given texts hold only these references, ``&amp;`` decoded last."""
    bare = f"regexp_replace(replace(replace({markup}, '<', ' <'), '>', '> '), {_quote(TAGS_PORTABLE)}, '', 'g')"
    known = {"&trade;": "™", "&middot;": "·", "&copy;": "©", "&quot;": '"', "&lt;": "<", "&gt;": ">", "&amp;": "&"}
    for reference, chars in known.items():
        bare = f"replace({bare}, '{reference}', '{chars}')"
    return f"trim(regexp_replace({bare}, {_quote(WHITESPACE_PORTABLE)}, ' ', 'g'))"


def _scoped(table: str, attribute: int) -> str:
    return f"""SELECT d.entity_id, coalesce(s.value, d.value) AS value FROM {table} d
 LEFT JOIN {table} s ON s.entity_id = d.entity_id AND s.attribute_id = d.attribute_id AND s.store_id = 1
 WHERE d.attribute_id = {attribute} AND d.store_id = 0"""


def _exponent(code: str) -> str:
    cases = " ".join(
        f"WHEN {code} IN ({', '.join(_quote(c) for c, e in EXPONENTS.items() if e == n)}) THEN {n}" for n in (0, 3, 4)
    )
    return f"(CASE {cases} ELSE 2 END)"


def _minor(amount: str, code: str) -> str:
    scale = " ".join(f"WHEN {n} THEN {10**n}" for n in (0, 2, 3, 4))
    return f"CAST(round({amount} * (CASE {_exponent(code)} {scale} END), 0) AS BIGINT)"


CURRENCY_LIST = "(VALUES " + ", ".join(f"('{c}')" for c in CURRENCIES) + ")"

# Steps that several oracles share.
SHARED = {
    "o_indexable": """
SELECT e.entity_id, e.sku, e.type_id, coalesce(ns.value, nd.value) AS name FROM shop_entity e
 JOIN shop_website w ON w.product_id = e.entity_id AND w.website_id = 1
 LEFT JOIN shop_eav_int sd ON sd.entity_id = e.entity_id AND sd.attribute_id = 97 AND sd.store_id = 0
 LEFT JOIN shop_eav_int ss ON ss.entity_id = e.entity_id AND ss.attribute_id = 97 AND ss.store_id = 1
 LEFT JOIN shop_eav_int vd ON vd.entity_id = e.entity_id AND vd.attribute_id = 99 AND vd.store_id = 0
 LEFT JOIN shop_eav_int vs ON vs.entity_id = e.entity_id AND vs.attribute_id = 99 AND vs.store_id = 1
 LEFT JOIN shop_eav_varchar nd ON nd.entity_id = e.entity_id AND nd.attribute_id = 73 AND nd.store_id = 0
 LEFT JOIN shop_eav_varchar ns ON ns.entity_id = e.entity_id AND ns.attribute_id = 73 AND ns.store_id = 1
 WHERE coalesce(ss.value, sd.value) = 1 AND coalesce(vs.value, vd.value) IN (3, 4)""",
    "o_amount": """
SELECT p.entity_id, e.type_id, p.price AS full_price, p.final_price, p.min_price,
 CASE WHEN e.type_id = 'bundle' OR coalesce(p.final_price, p.min_price) <= 0 THEN p.min_price ELSE coalesce(p.final_price, p.min_price) END AS amount,
 CASE WHEN p.price IS NULL OR p.final_price IS NULL THEN FALSE ELSE p.final_price < p.price - 0.001 END AS on_sale
 FROM shop_price p JOIN shop_entity e ON e.entity_id = p.entity_id WHERE p.customer_group_id = 0 AND p.website_id = 1""",
    "o_url": _scoped("shop_eav_varchar", 119),
    "o_image": f"""
SELECT entity_id, 'https://shop.example/media/catalog/product/' || ltrim(path, '/') AS image FROM (
 SELECT coalesce(s.entity_id, f.entity_id) AS entity_id,
  CASE WHEN coalesce(s.value, '') NOT IN ('', 'no_selection') THEN s.value WHEN coalesce(f.value, '') NOT IN ('', 'no_selection') THEN f.value END AS path
 FROM ({_scoped("shop_eav_varchar", 88)}) s FULL JOIN ({_scoped("shop_eav_varchar", 87)}) f ON s.entity_id = f.entity_id) x
 WHERE path IS NOT NULL""",
    "o_description": f"""
SELECT entity_id, substr(words, 1, 1000) AS description FROM (
 SELECT coalesce(s.entity_id, l.entity_id) AS entity_id, coalesce(nullif({_words("s.value")}, ''), nullif({_words("l.value")}, '')) AS words
 FROM ({_scoped("shop_eav_text", 85)}) s FULL JOIN ({_scoped("shop_eav_text", 75)}) l ON s.entity_id = l.entity_id) x
 WHERE words IS NOT NULL""",
    "o_option_text": """
SELECT o.option_id, o.attribute_id, d.value AS admin_label, s.value AS store_label, coalesce(s.value, d.value) AS text
 FROM shop_option o LEFT JOIN shop_option_value d ON d.option_id = o.option_id AND d.store_id = 0
 LEFT JOIN shop_option_value s ON s.option_id = o.option_id AND s.store_id = 1""",
    "o_option_label": f"""
SELECT attribute_id, option_id, {_words("text")} AS label FROM o_option_text WHERE admin_label IS NOT NULL""",
    "o_brand": f"""
SELECT m.entity_id, t.text AS brand FROM ({_scoped("shop_eav_int", 83)}) m
 JOIN o_option_text t ON t.option_id = m.value AND t.attribute_id = 83 WHERE t.text NOT IN ('', '0')""",
    "o_attribute_label": f"""
SELECT a.attribute_id, a.frontend_input, a.backend_type, {_words("coalesce(nullif(l.value, ''), nullif(a.frontend_label, ''), a.attribute_code)")} AS label
 FROM shop_attribute a LEFT JOIN shop_attribute_label l ON l.attribute_id = a.attribute_id AND l.store_id = 1
 WHERE a.entity_type_code = 'catalog_product' AND (a.is_filterable > 0 OR a.is_filterable_in_search = 1)
  AND a.frontend_input IN ('select', 'multiselect', 'boolean') AND a.attribute_code NOT IN ('price', 'status', 'visibility', 'tax_class_id')
  AND a.backend_type IN ('int', 'varchar', 'text')""",
    "o_facet_stored": "SELECT entity_id, attribute_id, store_id, CAST(value AS VARCHAR) AS value FROM shop_eav_int"
    " UNION ALL SELECT entity_id, attribute_id, store_id, value FROM shop_eav_text"
    " UNION ALL SELECT entity_id, attribute_id, store_id, value FROM shop_eav_varchar",
    "o_facet_part": """
SELECT d.entity_id, d.attribute_id, a.label, a.frontend_input, string_split(coalesce(s.value, d.value), ',') AS parts
 FROM o_facet_stored d JOIN o_attribute_label a ON a.attribute_id = d.attribute_id
 LEFT JOIN o_facet_stored s ON s.entity_id = d.entity_id AND s.attribute_id = d.attribute_id AND s.store_id = 1 WHERE d.store_id = 0""",
    "o_facet_value": """
SELECT entity_id, label, value, min(place) AS place FROM (
 SELECT p.entity_id, p.label, p.place, CASE WHEN p.frontend_input = 'boolean' THEN CASE WHEN p.place = 1 AND p.part = '1' THEN 'Yes' END ELSE o.label END AS value
 FROM (SELECT entity_id, attribute_id, label, frontend_input, trim(unnest(parts)) AS part, generate_subscripts(parts, 1) AS place FROM o_facet_part) p
 LEFT JOIN o_option_label o ON o.attribute_id = p.attribute_id AND CAST(o.option_id AS VARCHAR) = p.part) x
 WHERE value IS NOT NULL AND value <> '' GROUP BY entity_id, label, value""",
    "o_facet_map": """
SELECT entity_id, string_agg(label || '=' || vals, ';' ORDER BY label) AS attributes FROM (
 SELECT entity_id, label, string_agg(value, '|' ORDER BY place) AS vals FROM o_facet_value GROUP BY entity_id, label) x GROUP BY entity_id""",
    "o_category": """
SELECT product_id AS entity_id, string_agg(name, '|' ORDER BY position, category_id) AS categories FROM (
 SELECT *, row_number() OVER (PARTITION BY product_id, name ORDER BY position, category_id) AS nth FROM (
  SELECT cp.product_id, cp.category_id, cp.position, trim(coalesce(s.value, d.value)) AS name FROM shop_category_product cp
  LEFT JOIN shop_category_varchar d ON d.entity_id = cp.category_id AND d.attribute_id = 45 AND d.store_id = 0
  LEFT JOIN shop_category_varchar s ON s.entity_id = cp.category_id AND s.attribute_id = 45 AND s.store_id = 1
  WHERE cp.category_id NOT IN (1, 2)) y WHERE name <> '') x WHERE nth = 1 GROUP BY product_id""",
    "o_stock": "SELECT product_id AS entity_id, max(stock_status) <> 0 AS in_stock FROM shop_stock_status GROUP BY product_id",
    "o_popularity": """
WITH sold AS (SELECT product_id, store_id, CAST(round(SUM(qty_ordered), 0) AS BIGINT) AS n FROM shop_bestsellers WHERE store_id IN (0, 1) GROUP BY product_id, store_id)
SELECT product_id AS entity_id, n AS popularity_score FROM sold WHERE store_id = 1
UNION ALL SELECT product_id, n FROM sold r WHERE store_id = 0 AND NOT EXISTS (SELECT 1 FROM sold s WHERE s.product_id = r.product_id AND s.store_id = 1)""",
    "o_variant": f"""
SELECT l.parent_id, l.product_id AS id, e.sku, {_minor("CASE WHEN coalesce(p.final_price, p.min_price) <= 0 THEN p.min_price ELSE coalesce(p.final_price, p.min_price) END", "'USD'")} AS price,
 coalesce(s.in_stock, TRUE) AS in_stock FROM shop_super_link l JOIN shop_entity e ON e.entity_id = l.product_id
 JOIN shop_price p ON p.entity_id = l.product_id AND p.customer_group_id = 0 AND p.website_id = 1
 LEFT JOIN o_stock s ON s.entity_id = l.product_id""",
    "o_variant_option": """
SELECT l.parent_id, l.product_id AS id, v.attribute_id, coalesce(nullif(al.value, ''), nullif(a.frontend_label, ''), a.attribute_code) AS label, trim(t.text) AS value
 FROM shop_super_attribute sa JOIN shop_super_link l ON l.parent_id = sa.product_id JOIN shop_attribute a ON a.attribute_id = sa.attribute_id
 JOIN shop_eav_int v ON v.entity_id = l.product_id AND v.attribute_id = sa.attribute_id AND v.store_id = 0
 LEFT JOIN shop_attribute_label al ON al.attribute_id = sa.attribute_id AND al.store_id = 1
 JOIN o_option_text t ON t.option_id = v.value WHERE trim(t.text) <> ''""",
    "o_variant_list": """
SELECT v.parent_id AS entity_id, string_agg(v.id || ':' || v.sku || ':' || v.price || ':' || v.in_stock || ':' || coalesce(o.attributes, ''), ',' ORDER BY v.id) AS variants
 FROM o_variant v LEFT JOIN (SELECT parent_id, id, string_agg(label || '=' || value, ';' ORDER BY label) AS attributes FROM o_variant_option GROUP BY parent_id, id) o
 ON o.parent_id = v.parent_id AND o.id = v.id GROUP BY v.parent_id""",
    "o_item": f"""
SELECT e.entity_id AS id, CASE WHEN i.entity_id IS NULL THEN 'delete' ELSE 'upsert' END AS op, CAST({WALK_VERSION} AS BIGINT) AS version, i.entity_id IS NOT NULL AS visible,
 CASE WHEN i.entity_id IS NOT NULL THEN coalesce(i.name, i.sku) END AS name, i.sku,
 CASE WHEN i.entity_id IS NOT NULL THEN coalesce(st.in_stock, TRUE) END AS in_stock,
 CASE WHEN i.entity_id IS NOT NULL THEN {_minor("a.amount", "'USD'")} END AS price,
 CASE WHEN i.entity_id IS NOT NULL AND a.amount IS NOT NULL THEN 'USD' END AS currency,
 CASE WHEN i.entity_id IS NOT NULL AND a.amount IS NOT NULL THEN 2 END AS price_exponent,
 CASE WHEN i.entity_id IS NOT NULL AND a.on_sale THEN TRUE END AS on_sale,
 CASE WHEN i.entity_id IS NOT NULL THEN 'https://shop.example/' || u.value || '.html' END AS permalink,
 CASE WHEN i.entity_id IS NOT NULL THEN im.image END AS image, CASE WHEN i.entity_id IS NOT NULL THEN d.description END AS description,
 CASE WHEN i.entity_id IS NOT NULL THEN b.brand END AS brand, CASE WHEN i.entity_id IS NOT NULL THEN c.categories END AS categories,
 CASE WHEN i.entity_id IS NOT NULL THEN pop.popularity_score END AS popularity_score,
 CASE WHEN i.entity_id IS NOT NULL THEN f.attributes END AS attributes, CASE WHEN i.entity_id IS NOT NULL THEN v.variants END AS variants
 FROM shop_entity e LEFT JOIN o_indexable i ON i.entity_id = e.entity_id LEFT JOIN o_amount a ON a.entity_id = e.entity_id
 LEFT JOIN o_stock st ON st.entity_id = e.entity_id LEFT JOIN o_url u ON u.entity_id = e.entity_id LEFT JOIN o_image im ON im.entity_id = e.entity_id
 LEFT JOIN o_description d ON d.entity_id = e.entity_id LEFT JOIN o_brand b ON b.entity_id = e.entity_id LEFT JOIN o_category c ON c.entity_id = e.entity_id
 LEFT JOIN o_popularity pop ON pop.entity_id = e.entity_id LEFT JOIN o_facet_map f ON f.entity_id = e.entity_id LEFT JOIN o_variant_list v ON v.entity_id = e.entity_id""",
    "o_parent": """
SELECT product_id AS entity_id, parent_id FROM shop_super_link UNION ALL SELECT product_id, parent_product_id FROM shop_bundle_selection
 UNION ALL SELECT linked_product_id, product_id FROM shop_product_link WHERE link_type_id = 3""",
    "o_queue": """
SELECT 'product' AS object_type, entity_id AS object_id, CAST(0 AS BIGINT) AS store_id, 'upsert' AS op, max(version) AS version, 'pending' AS status, CAST(0 AS BIGINT) AS attempts, min(seq) AS first_seq FROM (
 SELECT entity_id, epoch_us(ts) // 1000 AS version, version_id AS seq FROM shop_changelog
 UNION ALL SELECT p.parent_id, epoch_us(c.ts) // 1000, c.version_id FROM shop_changelog c JOIN o_parent p ON p.entity_id = c.entity_id) x GROUP BY entity_id""",
    "o_walk": f"""
SELECT 'product' AS object_type, entity_id AS object_id, CAST(0 AS BIGINT) AS store_id, 'upsert' AS op, CAST({WALK_VERSION} AS BIGINT) AS version, 'pending' AS status, CAST(0 AS BIGINT) AS attempts, entity_id AS first_seq FROM shop_entity""",
    "o_slot": "SELECT *, (row_number() OVER (ORDER BY id) - 1) // 100 AS batch_no FROM o_item",
    # The queue log, row by row: what is queued before each row, which completes retire.
    "o_log": """
SELECT *, max(CASE WHEN kind = 'enqueue' THEN version END) OVER (PARTITION BY object_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS queued FROM shop_queue_log""",
    "o_life": """
SELECT *, coalesce(sum(CASE WHEN kind = 'complete' AND queued <= version THEN 1 ELSE 0 END) OVER (PARTITION BY object_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS life FROM o_log""",
    "o_last_life": """
SELECT l.* FROM o_life l JOIN (SELECT object_id, sum(CASE WHEN kind = 'complete' AND queued <= version THEN 1 ELSE 0 END) AS life FROM o_log GROUP BY object_id) m
 ON m.object_id = l.object_id AND m.life = l.life""",
    "o_row": "SELECT object_id, min(seq) AS created_seq, min(version) AS first_version, max(version) AS version FROM o_last_life WHERE kind = 'enqueue' GROUP BY object_id",
    "o_state": """
SELECT r.object_id, r.created_seq, r.version, CASE WHEN last_kind = 'claim' THEN 'sending' ELSE 'pending' END AS status, attempts, CASE WHEN last_kind = 'claim' THEN last_ts END AS claimed_at
 FROM o_row r JOIN (SELECT l.object_id, count(*) FILTER (l.kind = 'release') AS attempts, arg_max(l.kind, l.seq) AS last_kind, arg_max(l.ts, l.seq) AS last_ts FROM o_last_life l JOIN o_row r ON r.object_id = l.object_id
  WHERE l.kind <> 'complete' AND (l.kind = 'enqueue' OR (l.seq > r.created_seq AND l.version >= r.first_version)) GROUP BY l.object_id) m ON m.object_id = r.object_id""",
    # The same by type, object and store.
    "o_d_log": """
SELECT *, max(CASE WHEN kind = 'enqueue' THEN version END) OVER (PARTITION BY object_type, object_id, store_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS queued FROM shop_drain_log""",
    "o_d_life": """
SELECT *, coalesce(sum(CASE WHEN kind = 'complete' AND queued <= version THEN 1 ELSE 0 END) OVER (PARTITION BY object_type, object_id, store_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS life FROM o_d_log""",
    "o_d_last": """
SELECT * FROM (SELECT *, max(CASE WHEN kind = 'complete' AND queued <= version THEN life + 1 ELSE life END) OVER (PARTITION BY object_type, object_id, store_id) AS lives FROM o_d_life) x WHERE life = lives""",
    "o_d_row": "SELECT object_type, object_id, store_id, min(seq) AS created_seq, min(version) AS first_version, max(version) AS version FROM o_d_last WHERE kind = 'enqueue' GROUP BY object_type, object_id, store_id",
    "o_d_state": """
SELECT r.object_type, r.object_id, r.store_id, r.created_seq, r.version, attempts,
 CASE WHEN last_kind = 'claim' AND last_ts >= TIMESTAMP '2024-01-30 11:45:00' THEN 'sending' ELSE 'pending' END AS status,
 CASE WHEN last_kind = 'claim' AND last_ts >= TIMESTAMP '2024-01-30 11:45:00' THEN last_ts END AS claimed_at
 FROM o_d_row r JOIN (SELECT l.object_type, l.object_id, l.store_id, count(*) FILTER (l.kind = 'release') AS attempts, arg_max(l.kind, l.seq) AS last_kind, arg_max(l.ts, l.seq) AS last_ts
  FROM o_d_last l JOIN o_d_row r USING (object_type, object_id, store_id)
  WHERE l.kind <> 'complete' AND (l.kind = 'enqueue' OR (l.seq > r.created_seq AND l.version >= r.first_version)) GROUP BY l.object_type, l.object_id, l.store_id) m
 USING (object_type, object_id, store_id)""",
    "o_d_placed": """
SELECT *, (place - 1) // 20 AS batch_no, (place - 1) % 20 AS slot FROM (
 SELECT *, CASE WHEN status = 'pending' THEN row_number() OVER (PARTITION BY status ORDER BY created_seq) END AS place FROM o_d_state) x""",
    "o_drained": """
SELECT p.*, CASE WHEN batch_no IS NULL THEN 'held' WHEN batch_no > f.stop THEN 'waiting' WHEN batch_no = f.stop THEN 'released' ELSE 'completed' END AS outcome
 FROM o_d_placed p, (SELECT min(batch_no) AS stop FROM o_d_placed WHERE object_id % 13 <> 0 AND batch_no % 4 = 2) f""",
    "o_resync": """
SELECT *, bool_or(acted) OVER (PARTITION BY install_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS earlier FROM (
 SELECT *, token IS DISTINCT FROM lag(token) OVER (PARTITION BY install_id ORDER BY seq) AS acted FROM shop_resync_poll WHERE required AND token <> '') y""",
    "o_line": f"""
SELECT l.order_id, l.item_id, l.product_id, o.session_id, o.currency, l.row_total, l.row_total_incl_tax, l.discount_amount,
 greatest(0, {_minor("l.row_total_incl_tax", "o.currency")} - {_minor("l.discount_amount", "o.currency")}) AS with_tax,
 greatest(0, {_minor("l.row_total", "o.currency")} - {_minor("l.discount_amount", "o.currency")}) AS without_tax
 FROM shop_order_item l JOIN (SELECT order_id, session_id, upper(trim(CASE WHEN trim(order_currency) = '' THEN base_currency ELSE order_currency END)) AS currency FROM shop_order) o
 ON o.order_id = l.order_id WHERE l.parent_item_id IS NULL AND l.order_id > 0""",
    # One row per session event, walked in order by the recursive step.
    "o_step": "SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY ts, event_id) AS nth FROM shop_session_event",
    "o_walked": """
SELECT session_id, CAST(0 AS BIGINT) AS nth, CAST([] AS BIGINT[]) AS ids, '' AS q, CAST(NULL AS TIMESTAMP) AS marked, CAST(NULL AS BIGINT) AS event_id, FALSE AS hit, '' AS used FROM o_step GROUP BY session_id
 UNION ALL SELECT session_id, nth,
  CASE WHEN kind = 'mark' THEN CASE WHEN list_contains(live, product_id) THEN live ELSE list_append(live, product_id)[-25:] END WHEN list_contains(live, product_id) THEN [] ELSE live END,
  CASE WHEN kind = 'mark' THEN CASE WHEN term <> '' THEN term ELSE new_q END WHEN list_contains(live, product_id) THEN '' ELSE term END,
  CASE WHEN kind = 'mark' THEN ts WHEN list_contains(live, product_id) THEN NULL ELSE marked END, event_id, kind = 'order' AND list_contains(live, product_id), term
 FROM (SELECT s.session_id, s.nth, s.kind, s.product_id, s.ts, s.event_id, s.q AS new_q, w.marked,
   CASE WHEN epoch_us(s.ts) - epoch_us(w.marked) > 604800000000 THEN CAST([] AS BIGINT[]) ELSE w.ids END AS live,
   CASE WHEN epoch_us(s.ts) - epoch_us(w.marked) > 604800000000 THEN '' ELSE w.q END AS term
   FROM o_walked w JOIN o_step s ON s.session_id = w.session_id AND s.nth = w.nth + 1) n""",
    "o_attributed": f"""
SELECT w.session_id, s.order_id, 1 AS item_id, s.product_id, 'USD' AS currency, {_minor("CAST(s.value AS DECIMAL(12,4))", "'USD'")} AS value_cents, w.used AS q, s.ts
 FROM o_walked w JOIN o_step s ON s.session_id = w.session_id AND s.nth = w.nth WHERE w.hit""",
}

_retry = f"(status = 0 OR status >= 500 OR status IN ({', '.join(map(str, RETRY_CODES))}))"
_amount = """CASE WHEN order_id % 7 = 0 THEN '-' || plain WHEN order_id % 7 = 1 THEN plain || ' EUR' WHEN order_id % 7 = 2 THEN string_split(plain, '.')[1] ELSE ' ' || plain END"""
_code = "CASE WHEN item_id = 7 THEN 'dollar' WHEN item_id % 2 = 0 THEN ' kwd' ELSE 'usd' END"
_watched = " ".join(f"WHEN {number} THEN '{table}'" for number, table in enumerate(WATCHED))
_order_ref = f"sha256('{INSTALL}|order|' || CAST(order_id AS VARCHAR))"
_coverage = ["id", "name", "sku", "visible", "in_stock", "price", "currency", "price_exponent", "on_sale", "permalink",
             "image", "description", "brand", "popularity_score"]
_faults = {
    "no id": "entity_id % 31 = 0",
    "no visible": "entity_id % 17 = 0",
    "no in_stock": "found AND entity_id % 5 = 0",
    "price without currency or exponent": "found AND price IS NOT NULL AND entity_id % 7 = 0",
    "rejected price": "found AND entity_id % 13 = 0",
    "no name": "found AND entity_id % 3 = 0",
}
_locale = LOCALE

ORACLES: dict[str, str] = {
    "indexable_products": "SELECT entity_id, sku, type_id, name FROM o_indexable",
    "tombstones": "SELECT DISTINCT entity_id FROM shop_changelog WHERE entity_id NOT IN (SELECT entity_id FROM o_indexable)",
    "billable_count": """SELECT count(*) AS catalogue_rows, count(i.entity_id) AS billable, count(*) - count(i.entity_id) AS not_indexed
 FROM shop_entity e LEFT JOIN o_indexable i ON i.entity_id = e.entity_id""",
    "normalised_ids": """SELECT entity_id, min(event_id) AS ordinal FROM (
 SELECT event_id, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS entity_id FROM events) x WHERE entity_id <> 0 GROUP BY entity_id""",
    "attr_scoped_url_key": "SELECT entity_id, value FROM o_url",
    "attr_scoped_short_desc": _scoped("shop_eav_text", 85),
    "headline_price": f"""SELECT entity_id, c AS asked, {_minor("amount", "c")} AS price, CASE WHEN amount IS NOT NULL THEN c END AS currency,
 CASE WHEN amount IS NOT NULL THEN {_exponent("c")} END AS price_exponent, CAST(NULL AS VARCHAR) AS price_reject FROM o_amount, {CURRENCY_LIST} AS l(c)""",
    "on_sale": f"""SELECT entity_id, {_minor("amount", "'USD'")} AS price, on_sale FROM o_amount""",
    "minor_units": f"""SELECT order_id, item_id, c AS currency, {_exponent("c")} AS exponent, {_minor("row_total_incl_tax", "c")} AS total_minor,
 -{_minor("discount_amount", "c")} AS discount_minor, greatest(0, {_minor("row_total_incl_tax", "c")} - {_minor("discount_amount", "c")}) AS value_minor
 FROM shop_order_item, {CURRENCY_LIST} AS l(c)""",
    "minor_unit_rejects": f"""SELECT order_id, item_id, amount, code, upper(trim(code)) AS currency,
 CASE WHEN reject IS NULL THEN {_minor("CAST(trim(amount) AS DECIMAL(16,4))", "upper(trim(code))")} END AS minor, reject,
 CASE WHEN NOT regexp_matches(amount, '^-?[0-9]+$') THEN 'not a whole number' WHEN code = 'dollar' THEN 'bad currency' END AS minor_reject
 FROM (SELECT *, CASE WHEN NOT regexp_matches(trim(amount), '^[0-9]+([.][0-9]+)?$') THEN 'malformed amount' WHEN code = 'dollar' THEN 'bad currency'
  WHEN contains(amount, '.') AND rtrim(substr(string_split(amount, '.')[2], {_exponent("upper(trim(code))")} + 1), '0') <> '' THEN 'too many decimals' END AS reject
  FROM (SELECT order_id, item_id, {_amount} AS amount, {_code} AS code FROM (SELECT *, CAST(row_total AS VARCHAR) AS plain FROM shop_order_item) p) a) r""",
    "images": "SELECT entity_id, image FROM o_image",
    "permalinks": "SELECT entity_id, 'https://shop.example/' || value || '.htm' AS permalink FROM o_url",
    "descriptions": "SELECT entity_id, description FROM o_description",
    "pages_plain_text": f"SELECT page_id, {_words('html')} AS words FROM pages",
    "brands": "SELECT entity_id, brand FROM o_brand",
    "option_labels": "SELECT attribute_id, option_id, label FROM o_option_label",
    "facets_exploded": """SELECT entity_id, label, row_number() OVER (PARTITION BY entity_id, label ORDER BY place) - 1 AS position, value FROM o_facet_value""",
    "category_names": "SELECT entity_id, categories FROM o_category",
    "stock_legacy": "SELECT entity_id, in_stock FROM o_stock",
    "stock_by_sku": """SELECT e.entity_id, coalesce(s.is_salable <> 0, TRUE) AS in_stock, s.sku IS NOT NULL AS known
 FROM shop_entity e LEFT JOIN shop_inventory_stock_2 s ON s.sku = e.sku""",
    "popularity_scores": "SELECT entity_id, popularity_score FROM o_popularity",
    "variants_exploded": "SELECT parent_id, id, sku, price, in_stock FROM o_variant",
    "variant_options": "SELECT parent_id, id, attribute_id, label, value FROM o_variant_option",
    "price_range": f"""SELECT entity_id, min(price) AS price_min, max(price) AS price_max FROM (
 SELECT entity_id, {_minor("amount", "'USD'")} AS price FROM o_amount WHERE amount IS NOT NULL
 UNION ALL SELECT v.parent_id, v.price FROM o_variant v JOIN o_amount a ON a.entity_id = v.parent_id AND a.amount IS NOT NULL) x GROUP BY entity_id""",
    "search_items": "SELECT * FROM o_item",
    "sample_items": "SELECT id, op, name, price, categories, variants FROM o_item ORDER BY id LIMIT 25",
    "item_violations": "SELECT reason, id, count(*) AS n FROM ("
    + " UNION ALL ".join(
        f"SELECT '{reason}' AS reason, CASE WHEN entity_id % 31 <> 0 THEN entity_id ELSE -1 END AS id FROM f WHERE {rule}"
        for reason, rule in _faults.items()
    ).replace("FROM f", "FROM (SELECT e.entity_id, i.entity_id IS NOT NULL AS found, a.amount AS price FROM shop_entity e"
              " LEFT JOIN o_indexable i ON i.entity_id = e.entity_id LEFT JOIN o_amount a ON a.entity_id = e.entity_id) f")
    + ") x GROUP BY reason, id",
    "stray_variants": """SELECT DISTINCT id FROM o_variant WHERE id NOT IN (SELECT entity_id FROM o_indexable)""",
    "field_coverage": " UNION ALL ".join(
        f"SELECT '{name}' AS field, count({name}) AS filled, count(*) AS upserts FROM o_item WHERE op = 'upsert'" for name in _coverage
    ),
    "changelog_union": f"SELECT changed_id AS entity_id, CASE table_no {_watched} END AS source_table, epoch_us(ts) // 1000 AS ts FROM shop_watched_change",
    "parent_fanout": """SELECT entity_id FROM shop_changelog UNION SELECT p.parent_id FROM o_parent p WHERE p.entity_id IN (SELECT entity_id FROM shop_changelog)""",
    "coalesced_queue": "SELECT * FROM o_queue",
    "full_walk": "SELECT * FROM o_walk",
    "merged_queue": """SELECT 'product' AS object_type, object_id, CAST(0 AS BIGINT) AS store_id, 'upsert' AS op, max(version) AS version, 'pending' AS status, CAST(0 AS BIGINT) AS attempts, min(first_seq) AS first_seq
 FROM (SELECT * FROM o_queue UNION ALL SELECT * FROM o_walk) x GROUP BY object_id""",
    "queue_head": "SELECT * FROM o_queue ORDER BY first_seq, object_id LIMIT 100",
    "queue_peek": "SELECT * FROM o_walk WHERE object_id > 150 ORDER BY object_id LIMIT 100",
    "queue_claim": """SELECT status, count(*) AS n, min(object_id) AS least, max(first_seq) AS last_seq, count(*) FILTER (status = 'sending') AS claimed FROM (
 SELECT object_id, first_seq, CASE WHEN row_number() OVER (ORDER BY first_seq, object_id) <= 100 THEN 'sending' ELSE 'pending' END AS status FROM o_queue) x GROUP BY status""",
    "item_batches": """SELECT batch_no, count(*) AS n_items, string_agg(CAST(id AS VARCHAR), ',' ORDER BY id) AS ids, string_agg(op, ',' ORDER BY id) AS ops,
 coalesce(string_agg(name, ',' ORDER BY id), '') AS names, coalesce(string_agg(CAST(price AS VARCHAR), ',' ORDER BY id), '') AS prices FROM o_slot GROUP BY batch_no""",
    "batch_summary": """SELECT count(DISTINCT batch_no) AS batches, count(*) AS items, count(*) FILTER (found) AS upserts, count(*) FILTER (NOT found) AS deletes FROM (
 SELECT (row_number() OVER (ORDER BY e.entity_id) - 1) // 100 AS batch_no, i.entity_id IS NOT NULL AS found FROM shop_entity e LEFT JOIN o_indexable i ON i.entity_id = e.entity_id) x""",
    "batch_violations": """SELECT *, CASE WHEN items > 60 THEN 'too many items' ELSE 'item without id' END AS reason FROM (
 SELECT (entity_id * (entity_id % 3 + 1)) // 130 AS batch_no, count(*) AS items, count(*) FILTER (entity_id % 41 = 0) AS without_id FROM shop_entity GROUP BY 1) x
 WHERE items > 60 OR without_id > 0""",
    "outcome_log": f"""SELECT b AS seq, entity_id AS object_id, CASE WHEN b % 3 = 0 THEN 'release' ELSE 'complete' END AS kind, CAST({WALK_VERSION} AS BIGINT) AS version
 FROM (SELECT entity_id, (row_number() OVER (ORDER BY entity_id) - 1) // 100 AS b FROM shop_entity) x""",
    "content_items": f"""SELECT name, reject, CASE WHEN ok THEN 'upsert' END AS op, CASE WHEN ok THEN CAST({WALK_VERSION} AS BIGINT) END AS version, CASE WHEN ok THEN page_id END AS id,
 CASE WHEN ok THEN kind END AS object_type, CASE WHEN ok THEN page_id % 2 = 0 END AS visible, CASE WHEN ok THEN url END AS permalink,
 CASE WHEN ok AND page_id % 3 = 0 THEN array_to_string(string_split(url, '/')[1:3], '/') END AS excerpt, CASE WHEN ok THEN page_id * 86400 END AS published_at
 FROM (SELECT *, reject IS NULL AS ok FROM (SELECT *, CASE WHEN page_id % 50 = 0 THEN 'no id' WHEN kind = '' THEN 'no object_type' WHEN length(kind) > 20 THEN 'object_type too long' END AS reject
  FROM (SELECT page_id, url, 'Page ' || page_id AS name, CASE WHEN page_id % 7 = 0 THEN '' WHEN page_id % 11 = 0 THEN url ELSE 'page' END AS kind FROM pages) a) b) c""",
    "resync_walk": """SELECT 'product' AS object_type, e.entity_id AS object_id, CAST(0 AS BIGINT) AS store_id, 'upsert' AS op, s.seq AS version, 'pending' AS status, CAST(0 AS BIGINT) AS attempts, e.entity_id AS first_seq
 FROM shop_entity e, (SELECT max(seq) AS seq FROM o_resync WHERE acted AND (pending = 0 OR NOT coalesce(earlier, FALSE))) s""",
    "queue_state": "SELECT object_id, created_seq, version, status, attempts, epoch_us(claimed_at) // 1000 AS claimed_at FROM o_state",
    "requeue_stalled": """SELECT object_id, CASE WHEN claimed_at < TIMESTAMP '2024-01-30 11:45:00' THEN 'pending' ELSE status END AS status, attempts,
 CASE WHEN claimed_at >= TIMESTAMP '2024-01-30 11:45:00' THEN epoch_us(claimed_at) // 1000 END AS claimed_at FROM o_state""",
    "queue_health": """SELECT count(*) FILTER (status = 'pending') AS pending, count(*) FILTER (status = 'sending') AS sending,
 min(CASE WHEN status = 'pending' THEN created_seq END) AS oldest_seq, max(attempts) AS max_attempts, (SELECT count(*) FROM shop_changelog) AS changelog_rows FROM o_state""",
    "queue_depth": "SELECT status, count(*) AS depth FROM o_state GROUP BY status",
    "drain_round": """SELECT object_type, object_id, store_id, created_seq, version, status, attempts, epoch_us(claimed_at) // 1000 AS claimed_at, batch_no, CAST(slot AS INT) AS slot, outcome FROM o_drained""",
    "drain_summary": """SELECT count(DISTINCT CASE WHEN outcome = 'completed' AND object_id % 13 <> 0 THEN batch_no END) AS batches, count(*) FILTER (outcome = 'completed' AND object_id % 13 <> 0) AS items,
 bool_or(outcome = 'released') AS failed, count(*) FILTER (outcome = 'released') AS released, count(*) FILTER (outcome = 'waiting') AS waiting FROM o_drained""",
    "drain_after": """SELECT object_type, object_id, store_id, created_seq, version, status, attempts + CASE WHEN outcome = 'released' THEN 1 ELSE 0 END AS attempts FROM o_drained WHERE outcome <> 'completed'""",
    "current_documents": """SELECT object_id, version, arrival, body, writes FROM (SELECT *, row_number() OVER (PARTITION BY object_id ORDER BY version DESC, arrival) AS nth,
 count(*) OVER (PARTITION BY object_id) AS writes FROM shop_document_write) x WHERE nth = 1""",
    "resync_tokens": """SELECT install_id, seq, token, pending, acted, acted AND (pending = 0 OR NOT coalesce(earlier, FALSE)) AS walk_started FROM o_resync""",
    "attributed_order_value": """SELECT order_id, currency, CAST(sum(with_tax) AS BIGINT) AS value_cents, string_agg(CAST(product_id AS VARCHAR), ',' ORDER BY item_id, product_id) AS item_ids
 FROM o_line l WHERE EXISTS (SELECT 1 FROM shop_session_event m WHERE m.kind = 'mark' AND m.session_id = l.session_id AND m.product_id = l.product_id) GROUP BY order_id, currency""",
    "order_line_values": "SELECT order_id, currency, count(*) AS lines, CAST(sum(without_tax) AS BIGINT) AS value_cents FROM o_line GROUP BY order_id, currency",
    "consent_gate": """SELECT event_id, session_id % 25 AS store_id, kind FROM shop_session_event
 WHERE session_id % 25 IN (SELECT store_id FROM shop_store_settings WHERE connected AND share_search_data)""",
    "consent_as_of": """SELECT event_id, store_id, kind FROM (SELECT *, session_id % 25 AS store_id FROM shop_session_event) e
 WHERE (SELECT connected AND share_search_data FROM shop_settings_change c WHERE c.store_id = e.store_id AND c.ts <= e.ts ORDER BY c.ts DESC, c.seq DESC LIMIT 1)""",
    "store_views": """SELECT store_id, website_id, website_code, root_category_id, rtrim(base, '/') || '/' AS base_url, coalesce(nullif(media, ''), rtrim(base, '/') || '/media/') AS media_url,
 upper(currency) AS currency, coalesce(nullif(suffix, ''), '.html') AS url_suffix FROM (SELECT s.*, """
    + ", ".join(
        f"coalesce((SELECT value FROM shop_scoped_config c WHERE c.scope = 'stores' AND c.scope_id = s.store_id AND c.path = '{path}'), "
        f"(SELECT value FROM shop_scoped_config c WHERE c.scope = 'websites' AND c.scope_id = s.website_id AND c.path = '{path}'), "
        f"(SELECT value FROM shop_scoped_config c WHERE c.scope = 'default' AND c.path = '{path}')) AS {name}"
        for name, path in (("base", "web/secure/base_url"), ("media", "web/secure/base_media_url"),
                           ("currency", "currency/options/default"), ("suffix", "catalog/seo/product_url_suffix"))
    )
    + " FROM shop_store s) x",
    "report_flush": f"""SELECT store_id, id, CASE WHEN NOT willing THEN 'gated' WHEN old THEN 'abandoned' WHEN nth > 10 OR stops > 1 OR (stops = 1 AND NOT again) THEN 'waiting'
 WHEN spoilt THEN 'unreadable' WHEN again THEN 'retry' WHEN status BETWEEN 200 AND 299 THEN 'sent' ELSE 'dropped' END AS outcome
 FROM (SELECT *, sum(CASE WHEN again AND takes AND nth <= 10 THEN 1 ELSE 0 END) OVER (PARTITION BY store_id, takes ORDER BY id) AS stops
  FROM (SELECT *, willing AND NOT old AS takes, row_number() OVER (PARTITION BY store_id, willing AND NOT old ORDER BY id) AS nth, NOT spoilt AND {_retry} AS again
   FROM (SELECT r.*, r.occurred_at < TIMESTAMP '2024-01-18 00:00:00' AS old, r.store_id IN (SELECT store_id FROM shop_store_settings WHERE connected AND share_search_data) AS willing FROM shop_report r) a) b) c""",
    "session_attribution": "SELECT session_id, order_id, item_id, product_id, currency, value_cents, q, epoch_us(ts) // 1000 AS ts FROM o_attributed",
    "order_reports": f"""SELECT *, {_order_ref} AS order_ref FROM (SELECT CAST(floor(order_id / 500) AS BIGINT) AS order_id, epoch_us(arg_min(ts, order_id)) // 1000 AS occurred_at, arg_min(currency, order_id) AS currency,
 arg_max(value_cents, order_id) AS value_cents, arg_max(CAST(product_id AS VARCHAR), order_id) AS item_ids, arg_max(q, order_id) AS q, count(*) AS writes FROM o_attributed GROUP BY 1) x""",
    "report_payloads": f"""SELECT order_id, {_order_ref} AS order_ref, value_cents, currency, CASE WHEN order_id % 10 <> 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END AS occurred_at,
 CAST(product_id AS VARCHAR) AS item_ids, q, order_id % 10 = 0 AS unreadable FROM o_attributed WHERE order_id > 0""",
    "report_expiry": """SELECT created_at < TIMESTAMP '2001-07-25 00:00:00' AS abandoned, count(*) AS n, epoch_us(min(created_at)) // 1000 AS first_ms FROM shop_order GROUP BY 1""",
    "received_reports": f"SELECT DISTINCT order_id % 3 AS store_id, {_order_ref} AS order_ref, parent_item_id IS NULL AS occurred_at FROM shop_order_item",
    "report_checks": """SELECT 'order id not positive' AS "check", count(*) FILTER (order_id <= 3) AS violations FROM shop_order_item
 UNION ALL SELECT 'repeated order', count(*) FROM (SELECT order_id FROM shop_order_item GROUP BY order_id HAVING count(*) > 1) a
 UNION ALL SELECT 'no timestamp', count(*) FILTER (parent_item_id IS NULL) FROM shop_order_item
 UNION ALL SELECT 'shared reference', count(*) FROM (SELECT order_id // 2 FROM shop_order_item GROUP BY 1 HAVING count(DISTINCT order_id) > 1) b""",
    "delivery_classified": f"SELECT id, status, CASE WHEN status BETWEEN 200 AND 299 THEN 'done' WHEN {_retry} THEN 'retry' ELSE 'dropped' END AS outcome FROM shop_delivery",
    "delivered_prefix": f"""SELECT store_id, id, status FROM (SELECT *, max(CASE WHEN {_retry} THEN 1 ELSE 0 END) OVER (PARTITION BY store_id ORDER BY id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS stopped
 FROM shop_delivery) x WHERE stopped = 0""",
    "report_head": "SELECT id, status FROM shop_delivery ORDER BY id LIMIT 10",
    "locale_catalogue": f"""SELECT r.doc_id, r.locale, coalesce(e.c, CASE WHEN r.script = '' AND r.lang <> 'en' THEN o.c END) AS catalogue FROM (
 SELECT doc_id, locale, lower(regexp_extract(t, {_quote(_locale)}, 1)) AS lang, regexp_extract(t, {_quote(_locale)}, 2) AS script, upper(regexp_extract(t, {_quote(_locale)}, 3)) AS region FROM (
  SELECT doc_id, locale, replace(trim(locale), '-', '_') AS t FROM (SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN 'zh' ELSE lang END || s AS locale
   FROM documents, (VALUES {", ".join(f"('{s}')" for s in LOCALE_SUFFIXES)}) AS suffixes(s)) a) b) r
 LEFT JOIN (VALUES {", ".join(f"('{c}')" for c in CATALOGUES)}) AS e(c) ON lower(e.c) = lower(r.lang || CASE WHEN r.region <> '' THEN '_' || r.region ELSE '' END)
 LEFT JOIN (SELECT lower(string_split(c, '_')[1]) AS lang, min(c) AS c FROM (VALUES {", ".join(f"('{c}')" for c in CATALOGUES)}) AS k(c) GROUP BY 1 HAVING count(*) = 1) o ON o.lang = r.lang""",
}

_RECURSIVE = ("session_attribution", "order_reports", "report_payloads")


def oracle_sql() -> dict[str, str]:
    return {name: with_views(sql, SHARED, recursive=name in _RECURSIVE) for name, sql in ORACLES.items()}
