"""The registered queries: each operator over the shop views, flattened for comparison."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.functions import money, text, wire
from shelfmark.operators import (
    attribution, batches, categories, changes, content, delivery, drain, facets, indexing, locales, parents,
    popularity, pricing, quality, queue, settings, stock, variants,
)
from shelfmark.operators.ids import normalise_ids
from shelfmark.operators.scope import scoped_attribute
from shelfmark.plans import delivery_run
from shelfmark.plans import search_items as plan
from shelfmark.session import prepare
from shelfmark.sources.catalogue import StoreView, from_shop, narrowed, sample_ids, url_suffix
from shelfmark.sources.changelog import WATCHED, union_changes
from shelfmark.sources.shop_views import Shop

STORE = StoreView()
DEPOT = StoreView(website_code="depot")
INSTALL = "install-1"
# The latest moments in the given data, in place of the clock.
EVENTS_NOW = "2024-01-31 00:00:00"
# When the drain runs, and how many rows it takes at a time.
DRAIN_NOW = "2024-01-30 12:00:00"
DRAIN_SIZE = 20
# When reports are flushed.
FLUSH_NOW = "2024-01-25 00:00:00"
CURRENCIES = ("USD", "JPY", "KWD")
WALK_VERSION = 1_700_000_000_000
LOCALE_SUFFIXES = ("", "_DE", "-gb", "_US", "_Latn_CH", "_FR", "_419", "_x")

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def shop_of(spark: SparkSession, folder: str) -> Shop:
    """The views of a folder, kept with the session. Only plans are kept, never rows."""
    shops = spark.__dict__.setdefault("_shelfmark_shops", {})
    if folder not in shops:
        shops[folder] = Shop(spark, folder)
    return shops[folder]


def query(build: Callable[[Shop], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(build)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return build(shop_of(prepare(spark), folder))

    REGISTRY[build.__name__] = run
    return run


def catalogue_of(shop: Shop):
    if not hasattr(shop, "catalogue"):
        shop.catalogue = from_shop(shop)
    return shop.catalogue


def each_currency() -> Column:
    return F.explode(F.array(*map(F.lit, CURRENCIES)))


def joined(values: Column) -> Column:
    return F.array_join(values, "|")


def flat_map(attributes: Column) -> Column:
    """A facet map as text: ``label=a|b;label=c``, by label."""
    entries = F.array_sort(F.map_entries(attributes))
    return F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), joined(e["value"]))), ";")


# ---------------------------------------------------------------- which products


@query
def indexable_products(shop):
    return indexing.indexable_products(catalogue_of(shop), STORE)


@query
def tombstones(shop):
    return indexing.tombstones(shop["changelog"].select("entity_id"), catalogue_of(shop), STORE)


@query
def billable_count(shop):
    return indexing.billable_count(catalogue_of(shop), STORE)


@query
def normalised_ids(shop):
    asked = shop["events"].select(
        F.get_json_object("props", "$.k").alias("entity_id"), F.col("event_id").alias("place")
    )
    return normalise_ids(asked, ordinal="place")


# ---------------------------------------------------------------- fields


@query
def attr_scoped_url_key(shop):
    catalogue = catalogue_of(shop)
    return scoped_attribute(catalogue.eav_varchar, catalogue.ids("url_key")["url_key"], STORE.store_id)


@query
def attr_scoped_short_desc(shop):
    catalogue = catalogue_of(shop)
    return scoped_attribute(
        catalogue.eav_text, catalogue.ids("short_description")["short_description"], STORE.store_id
    )


@query
def headline_price(shop):
    catalogue = catalogue_of(shop)
    rows = pricing.price_rows(catalogue.price, STORE).join(catalogue.entity.select("entity_id", "type_id"), "entity_id")
    asked = rows.withColumn("asked", each_currency())
    return pricing.with_headline_price(asked, F.col("asked"), F.col("type_id")).select(
        "entity_id", "asked", "price", "currency", "price_exponent", "price_reject"
    )


@query
def on_sale(shop):
    return pricing.headline_prices(catalogue_of(shop).price, catalogue_of(shop).entity, STORE).select(
        "entity_id", "price", "on_sale"
    )


@query
def minor_units(shop):
    """Every line's amounts in several currencies: a text amount is read once for a line, an exponent once for a currency."""
    discount = F.concat(F.lit(" -"), F.col("discount_amount").cast("string"))
    lines = shop["order_item"].select(
        "order_id", "item_id", "row_total_incl_tax", "discount_amount", money.amount_parts(discount).alias("parts")
    )
    code, places = F.col("currency"), F.col("exponent")
    exponents = F.array(*(F.struct(F.lit(c).alias("currency"), money.exponent_of(F.lit(c)).alias("exponent")) for c in CURRENCIES))
    return lines.select("*", F.inline(exponents)).select(
        "order_id",
        "item_id",
        "currency",
        "exponent",
        money.round_minor(F.col("row_total_incl_tax"), code, places).alias("total_minor"),
        money.minor_of(F.col("parts"), places).alias("discount_minor"),
        money.line_value(F.col("row_total_incl_tax"), F.col("discount_amount"), code, places).alias("value_minor"),
    )


@query
def minor_unit_rejects(shop):
    """Strict conversion of amounts as text, some of them written the ways shops write them."""
    plain = F.col("row_total").cast("string")
    written = (
        F.when(F.col("order_id") % 7 == 0, F.concat(F.lit("-"), plain))
        .when(F.col("order_id") % 7 == 1, F.concat(plain, F.lit(" EUR")))
        .when(F.col("order_id") % 7 == 2, F.substring_index(plain, ".", 1))
        .otherwise(F.concat(F.lit(" "), plain))
    )
    code = F.when(F.col("item_id") == 7, "dollar").otherwise(F.when(F.col("item_id") % 2 == 0, " kwd").otherwise("usd"))
    rows = shop["order_item"].select("order_id", "item_id", written.alias("amount"), code.alias("code"))
    return rows.select(
        "order_id",
        "item_id",
        "amount",
        "code",
        money.currency_code(F.col("code")).alias("currency"),
        money.strict_minor(F.col("amount"), F.col("code")).alias("minor"),
        money.strict_minor_reject(F.col("amount"), F.col("code")).alias("reject"),
        money.minor_input_reject(F.col("amount"), F.col("code")).alias("minor_reject"),
    )


@query
def images(shop):
    return content.images(catalogue_of(shop), STORE)


@query
def permalinks(shop):
    catalogue = catalogue_of(shop)
    keys = scoped_attribute(catalogue.eav_varchar, catalogue.ids("url_key")["url_key"], STORE.store_id)
    address = content.permalink(F.col("value"), STORE.base_url, url_suffix(shop["config"]))
    return keys.select("entity_id", address.alias("permalink"))


@query
def descriptions(shop):
    return content.descriptions(catalogue_of(shop), STORE)


@query
def pages_plain_text(shop):
    return shop["pages"].select("page_id", text.plain_text("html").alias("words"))


@query
def brands(shop):
    return facets.brands(catalogue_of(shop), STORE)


@query
def option_labels(shop):
    return facets.option_labels(catalogue_of(shop), STORE)


@query
def facets_exploded(shop):
    rows = facets.facet_lists(catalogue_of(shop), STORE)
    return rows.select("entity_id", "label", F.posexplode("values").alias("position", "value"))


@query
def category_names(shop):
    rows = categories.category_names(catalogue_of(shop), STORE)
    return rows.select("entity_id", joined(F.col("categories")).alias("categories"))


@query
def stock_legacy(shop):
    return stock.stock_of(catalogue_of(shop), STORE, catalogue_of(shop).entity)


@query
def stock_by_sku(shop):
    """The custom stock, with the default for products it does not know."""
    catalogue = catalogue_of(shop)
    known = stock.stock_of(catalogue, DEPOT, catalogue.entity)
    return catalogue.entity.select("entity_id").join(known, "entity_id", "left").select(
        "entity_id", F.coalesce("in_stock", F.lit(True)).alias("in_stock"), F.col("in_stock").isNotNull().alias("known")
    )


@query
def popularity_scores(shop):
    return popularity.popularity(shop["bestsellers"], STORE.store_id)


@query
def variants_exploded(shop):
    return variants.variant_rows(catalogue_of(shop), STORE)


@query
def variant_options(shop):
    return variants.variant_options(catalogue_of(shop), STORE)


@query
def price_range(shop):
    catalogue = catalogue_of(shop)
    own = pricing.headline_prices(catalogue.price, catalogue.entity, STORE).where(F.col("price").isNotNull())
    return pricing.price_range(own, variants.variant_rows(catalogue, STORE))


# ---------------------------------------------------------------- documents


def walk_items(shop) -> DataFrame:
    requested = shop["entity"].select("entity_id")
    return plan.search_items(requested, catalogue_of(shop), STORE, F.lit(WALK_VERSION))


def flat_items(items: DataFrame) -> DataFrame:
    variant = F.transform(
        "variants",
        lambda v: F.concat_ws(
            ":", v["id"].cast("string"), v["sku"], v["price"].cast("string"), v["in_stock"].cast("string"),
            F.coalesce(flat_map(v["attributes"]), F.lit("")),
        ),
    )
    return (
        items.withColumn("categories", joined(F.col("categories")))
        .withColumn("attributes", flat_map(F.col("attributes")))
        .withColumn("variants", F.array_join(variant, ","))
        .drop("price_reject")
    )


@query
def search_items(shop):
    return flat_items(walk_items(shop))


@query
def sample_items(shop):
    """The dry run's sample: the documents of the first ids."""
    ids = sample_ids(shop["entity"], limit=25)
    items = plan.search_items(ids, narrowed(catalogue_of(shop), ids), STORE, F.lit(WALK_VERSION))
    return flat_items(items).select("id", "op", "name", "price", "categories", "variants")


@query
def item_violations(shop):
    """The contract check over documents with faults put in by rule."""
    catalogue = catalogue_of(shop)
    prices = pricing.headline_prices(catalogue.price, catalogue.entity, STORE)
    searchable = indexing.indexable_products(catalogue, STORE).withColumn("_found", F.lit(True))
    at = F.col("entity_id")
    items = (
        catalogue.entity.select("entity_id")
        .join(searchable, "entity_id", "left")
        .join(prices.drop("type_id"), "entity_id", "left")
        .select(
            F.when(at % 31 != 0, at).alias("id"),
            F.when(F.col("_found"), "upsert").otherwise("delete").alias("op"),
            F.when(at % 17 != 0, F.coalesce("_found", F.lit(False))).alias("visible"),
            F.when(at % 5 != 0, True).alias("in_stock"),
            "price",
            F.when(at % 7 != 0, F.col("currency")).alias("currency"),
            "price_exponent",
            F.when(at % 13 == 0, F.lit("negative price")).alias("price_reject"),
            F.when(at % 3 != 0, F.coalesce("name", "sku")).alias("name"),
        )
    )
    return quality.item_violations(items).groupBy("reason", F.coalesce("id", F.lit(-1)).alias("id")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query
def stray_variants(shop):
    """Variants that a producer which forgets the visibility rule also sends as products."""
    catalogue = catalogue_of(shop)
    sent = catalogue.entity.select(F.col("entity_id").alias("id"), F.lit("upsert").alias("op"))
    return quality.stray_variants(variants.variant_rows(catalogue, STORE), sent, indexing.indexable(catalogue, STORE))


@query
def field_coverage(shop):
    names = [name for name in plan.FIELDS if name not in ("attributes", "variants", "categories")]
    return quality.field_coverage(walk_items(shop), names)


# ---------------------------------------------------------------- queue and batches


def stamped_changes(shop) -> DataFrame:
    return shop["changelog"].select(
        "entity_id", wire.version_ms(F.col("ts")).alias("version"), F.col("version_id").alias("seq")
    )


def change_queue(shop) -> DataFrame:
    return changes.coalesced_queue(stamped_changes(shop), catalogue_of(shop))


def walk_queue(shop) -> DataFrame:
    return changes.full_walk(shop["entity"], F.lit(WALK_VERSION))


@query
def changelog_union(shop):
    order = list(WATCHED)
    rows = shop["watched_change"]

    def read(table: str) -> DataFrame:
        return rows.where(F.col("table_no") == order.index(table)).withColumnRenamed("changed_id", WATCHED[table])

    return union_changes(read).withColumn("ts", wire.version_ms(F.col("ts")))


@query
def parent_fanout(shop):
    return parents.with_parents(normalise_ids(shop["changelog"].select("entity_id")), catalogue_of(shop))


@query
def coalesced_queue(shop):
    return change_queue(shop)


@query
def full_walk(shop):
    return walk_queue(shop)


@query
def merged_queue(shop):
    """A full walk with the change queue arriving on top of it."""
    return changes.merge_queue(walk_queue(shop), change_queue(shop))


@query
def queue_head(shop):
    return queue.queue_head(change_queue(shop), limit=100)


@query
def queue_peek(shop):
    return queue.queue_peek(walk_queue(shop), after=150, limit=100)


@query
def queue_claim(shop):
    taken = queue.claim(change_queue(shop), limit=100, now=F.lit(EVENTS_NOW).cast("timestamp"))
    return taken.groupBy("status").agg(
        F.count(F.lit(1)).alias("n"), F.min("object_id").alias("least"), F.max("first_seq").alias("last_seq"),
        F.count("claimed_at").alias("claimed"),
    )


@query
def item_batches(shop):
    """The bodies of a full walk, read back: what each batch carries, in order."""
    bodies = delivery_run.bodies(delivery_run.numbered_queue(walk_queue(shop)), catalogue_of(shop), STORE)
    read = F.from_json("body", "items array<struct<op:string,version:bigint,data:struct<id:bigint,name:string,price:bigint>>>")
    return bodies.select("batch_no", "items", read.alias("read")).select(
        "batch_no",
        F.col("items").alias("n_items"),
        F.array_join(F.transform("read.items", lambda i: i["data"]["id"].cast("string")), ",").alias("ids"),
        F.array_join(F.transform("read.items", lambda i: i["op"]), ",").alias("ops"),
        F.array_join(F.transform("read.items", lambda i: i["data"]["name"]), ",").alias("names"),
        F.array_join(F.transform("read.items", lambda i: i["data"]["price"].cast("string")), ",").alias("prices"),
    )


def batched_ops(shop) -> DataFrame:
    numbered = batches.assign_batches(walk_queue(shop)).select(F.col("object_id").alias("entity_id"), "batch_no", "slot")
    return indexing.split_requested(numbered, indexing.indexable(catalogue_of(shop), STORE))


@query
def batch_summary(shop):
    return batches.batch_summary(batched_ops(shop))


@query
def batch_violations(shop):
    """The batch contract over batches cut too wide, with some ids missing."""
    at = F.col("entity_id")
    wide = shop["entity"].select(
        F.floor(at * (at % 3 + 1) / 130).cast("bigint").alias("batch_no"), F.when(at % 41 != 0, at).alias("id")
    )
    return batches.batch_violations(wide, size=60)


@query
def outcome_log(shop):
    """The answers to a full walk's batches, one answer per batch, back as log rows."""
    numbered = delivery_run.numbered_queue(walk_queue(shop))
    answers = numbered.where(F.col("slot") == 0).select(
        "batch_no", F.col("batch_no").alias("seq"), F.timestamp_seconds("batch_no").alias("ts"),
        F.when(F.col("batch_no") % 3 == 0, 503).otherwise(202).alias("status"),
    )
    log = delivery_run.outcome_log(numbered, answers)
    return log.select("seq", "object_id", "kind", "version")


@query
def content_items(shop):
    """The web pages as content of the index, read back from their JSON."""
    at = F.col("page_id")
    rows = shop["pages"].select(
        F.when(at % 50 != 0, at).alias("id"),
        F.when(at % 7 == 0, "").when(at % 11 == 0, F.col("url")).otherwise("page").alias("object_type"),
        F.concat(F.lit("Page "), at.cast("string")).alias("name"),
        (at % 2 == 0).alias("visible"),
        F.col("url").alias("permalink"),
        F.lit(None).cast("string").alias("image"),
        F.when(at % 3 == 0, F.substring_index("url", "/", 3)).alias("excerpt"),
        (at * 86400).alias("published_at"),
        F.lit(WALK_VERSION).alias("version"),
    )
    done = batches.content_items(rows)
    sent = "op string, version bigint, data struct<id:bigint,object_type:string,visible:boolean,permalink:string,excerpt:string,published_at:bigint>"
    read = F.from_json("json", sent)
    return done.select("name", "reject", read.alias("r")).select("name", "reject", "r.op", "r.version", "r.data.*")


@query
def resync_walk(shop):
    """The walk that the last started request of any install asks for."""
    return changes.resync_walk(changes.resync_requests(shop["resync_poll"]), shop["entity"])


@query
def queue_state(shop):
    return queue.queue_state(shop["queue_log"]).withColumn("claimed_at", wire.version_ms(F.col("claimed_at")))


@query
def requeue_stalled(shop):
    state = queue.queue_state(shop["queue_log"]).withColumn("claimed_at", F.col("claimed_at").cast("timestamp"))
    done = queue.requeue_stalled(state, F.lit("2024-01-30 12:00:00").cast("timestamp"))
    return done.select("object_id", "status", "attempts", F.unix_millis("claimed_at").alias("claimed_at"))


@query
def queue_health(shop):
    return queue.queue_health(queue.queue_state(shop["queue_log"]), shop["changelog"])


@query
def queue_depth(shop):
    return queue.queue_depth(queue.queue_state(shop["queue_log"]))


def drained(shop) -> DataFrame:
    """A run over the queue by type, object and store, at the end of its log. Every 13th object makes no item; the third batch fails."""
    state = queue.queue_state(shop["drain_log"].withColumn("ts", F.col("ts").cast("timestamp")), drain.QUEUE_KEYS)
    in_line = delivery_run.claimed_round(state, F.lit(DRAIN_NOW).cast("timestamp"), (F.col("object_id") % 13 != 0).cast("int"), DRAIN_SIZE)
    numbers = in_line.where(F.col("slot") == 0).select("batch_no")
    return drain.drain_round(in_line, numbers.withColumn("status", F.when(F.col("batch_no") % 4 == 2, 503).otherwise(202)))


@query
def drain_round(shop):
    return drained(shop).select(
        *drain.QUEUE_KEYS, "created_seq", "version", "status", "attempts", F.unix_millis("claimed_at").alias("claimed_at"), "batch_no", "slot", "outcome"
    )


@query
def drain_summary(shop):
    return drain.round_summary(drained(shop))


@query
def drain_after(shop):
    """The queue after the run, folded from its log with the run's own entries behind it."""
    log = shop["drain_log"].withColumn("ts", F.col("ts").cast("timestamp"))
    last = log.agg(F.max("seq")).scalar()
    added = drain.round_log(drained(shop), last, F.lit(DRAIN_NOW).cast("timestamp"))
    state = queue.queue_state(log.select(*added.columns).unionByName(added), drain.QUEUE_KEYS)
    again = queue.requeue_stalled(state, F.lit(DRAIN_NOW).cast("timestamp"))
    return again.select(*drain.QUEUE_KEYS, "created_seq", "version", "status", "attempts")


@query
def current_documents(shop):
    return changes.current_documents(shop["document_write"], "object_id", "version", "arrival", ["arrival", "body"])


@query
def resync_tokens(shop):
    return changes.resync_requests(shop["resync_poll"])


# ---------------------------------------------------------------- search to order


def session_lines(shop) -> DataFrame:
    events = shop["session_event"]
    marks = events.where(F.col("kind") == "mark")
    bought = events.where(F.col("kind") == "order").select(
        "session_id", "event_id", "ts", "order_id", F.lit(1).alias("item_id"), "product_id",
        F.lit("USD").alias("currency"),
        money.line_value(F.col("value").cast("decimal(12,4)"), F.lit(None).cast("decimal(12,4)"), F.lit("USD")).alias("value_cents"),
    )
    return attribution.attributed_lines(attribution.session_events(marks, bought))


@query
def attributed_order_value(shop):
    marks = shop["session_event"].where(F.col("kind") == "mark")
    return attribution.attributed_order_value(shop["order_item"], shop["order"], marks)


@query
def order_line_values(shop):
    """Every parent line's value, without tax."""
    lines = attribution.paid_lines(shop["order_item"], shop["order"], tax="excl")
    return lines.groupBy("order_id", "currency").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("value_cents").alias("value_cents")
    )


@query
def consent_gate(shop):
    rows = shop["session_event"].withColumn("store_id", F.col("session_id") % 25)
    return attribution.sharing_stores(rows, shop["store_settings"]).select("event_id", "store_id", "kind")


@query
def consent_as_of(shop):
    """Session events of stores whose settings allowed it at that moment."""
    at = {"ts": F.col("ts").cast("timestamp")}
    rows = shop["session_event"].withColumns(at | {"store_id": F.col("session_id") % 25})
    return attribution.consenting(rows, shop["settings_change"].withColumns(at)).select("event_id", "store_id", "kind")


@query
def store_views(shop):
    return settings.store_views(shop["store"], shop["scoped_config"])


def flushed(shop) -> DataFrame:
    written = F.date_format("occurred_at", "yyyy-MM-dd HH:mm:ss")
    reports = shop["report"].select(
        "store_id", "id", "order_id", F.col("occurred_at").cast("timestamp").alias("occurred_at"),
        F.when(F.col("spoilt"), F.replace(written, F.lit("-"), F.lit("/"))).otherwise(written).alias("stored"),
    )
    return delivery.report_flush(reports, shop["store_settings"], shop["report"], F.lit(FLUSH_NOW).cast("timestamp"))


@query
def report_flush(shop):
    return flushed(shop).select("store_id", "id", "outcome")


@query
def session_attribution(shop):
    return session_lines(shop).withColumn("ts", wire.version_ms(F.col("ts")))


def reports_of(shop) -> DataFrame:
    return attribution.order_reports(session_lines(shop))


@query
def order_reports(shop):
    """One report per order where orders are saved twice: an order and the next one of
    every pair share an id."""
    written = reports_of(shop).select(
        F.floor(F.col("order_id") / 500).cast("bigint").alias("order_id"), F.col("order_id").alias("arrival"),
        "value_cents", "currency", "item_ids", "q", "occurred_at",
    )
    once = attribution.one_report_per_order(written)
    return once.withColumn("order_ref", wire.order_ref(F.lit(INSTALL), F.col("order_id"))).withColumn(
        "occurred_at", wire.version_ms(F.col("occurred_at"))
    )


@query
def report_payloads(shop):
    """What is sent for each report; a stored timestamp that is no timestamp is marked."""
    reports = reports_of(shop).where(F.col("order_id") > 0)
    written = F.date_format("occurred_at", "yyyy-MM-dd HH:mm:ss")
    stored = F.when(F.col("order_id") % 10 == 0, F.replace(written, F.lit("-"), F.lit("/"))).otherwise(written)
    payloads = delivery.report_payloads(reports, F.lit(INSTALL), stored)
    return payloads.withColumn("item_ids", wire.join_ids(F.col("item_ids")))


@query
def report_expiry(shop):
    orders = shop["order"].select("order_id", F.col("created_at").cast("timestamp").alias("occurred_at"))
    now = F.lit("2001-08-01 00:00:00").cast("timestamp")
    return delivery.with_expiry(orders, now).groupBy("abandoned").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.unix_millis("occurred_at")).alias("first_ms")
    )


@query
def received_reports(shop):
    """Deliveries repeated by retries, kept once."""
    sent = shop["order_item"].select(
        (F.col("order_id") % 3).alias("store_id"),
        wire.order_ref(F.lit(INSTALL), F.col("order_id")).alias("order_ref"),
        F.col("parent_item_id").isNull().alias("occurred_at"),
    )
    return attribution.received_once(sent)


@query
def report_checks(shop):
    """The report check over one row per order line, whose references collide by rule."""
    rows = shop["order_item"].select(
        (F.col("order_id") - 3).alias("order_id"),
        wire.order_ref(F.lit(INSTALL), F.floor(F.col("order_id") / 2).cast("bigint")).alias("order_ref"),
        F.col("parent_item_id").alias("occurred_at"),
    )
    return quality.report_checks(rows)


@query
def delivery_classified(shop):
    rows = delivery.delivery_classified(shop["delivery"])
    return rows.select("id", "status", "outcome")


@query
def delivered_prefix(shop):
    return delivery.delivered_prefix(shop["delivery"].select("store_id", "id", "status"), per="store_id")


@query
def report_head(shop):
    return delivery.report_head(shop["delivery"].select("id", "status"))


@query
def locale_catalogue(shop):
    suffixes = F.array(*map(F.lit, LOCALE_SUFFIXES))
    rows = shop["documents"].select(
        "doc_id",
        F.explode(F.transform(suffixes, lambda s: F.concat(F.when(F.col("doc_id") % 4 == 0, "zh").otherwise(F.col("lang")), s))).alias("locale"),
    )
    return locales.resolve_locales(rows, locales.catalogue_frame(shop.spark))
