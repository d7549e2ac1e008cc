"""I-Match fingerprints: hashes of the sorted mid-frequency terms in randomised lexicons.

The lexicon holds the terms within a band of inverse document frequency, counted over all documents. A
document's terms of it are sorted and hashed, once all of them and once those of a subset from each of the
``FIELDS`` parts into which the terms' own hashes split the lexicon. A part has subsets at random, each half of the one
before; a document shows the smallest that still holds one of its terms. Two documents agree in a part about as often
as they share terms, whatever their length; equal texts agree in all.

The band is a share of the documents, so the lexicon has at most 1 / ``MIN_SHARE`` times as many terms as a
document has on average, at any size of the corpus. It goes to the tasks as a bit set of ``BITS`` bits,
and a text is fingerprinted where it is read: no term is shuffled but for the counts. A rarer term that
falls on a set bit is taken for one of the lexicon, in all documents alike; that is one term in
hundreds. Everything is DataFrame and SQL functions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import stored, whole_text

FIELDS = 32
#: The band: in at least so many documents and this share of all, and in at most that share.
MIN_DOCS = 2
MIN_SHARE = 0.0005
MAX_SHARE = 0.125
#: Bits of a set of terms: 2 MB.
BITS = 1 << 24
#: Bits of an id within a bucket, and groups of buckets; rows that one window orders at a time.
BUCKET_BITS = 10
ORDERED = 4096


def next_lower(ids: DataFrame) -> DataFrame:
    """``id, lower`` for distinct longs ``id``: the next lower one, null for the lowest.

    Above ``ORDERED`` ids they are ordered within groups of their upper bits, and the groups
    among themselves in the same way, so that no window holds more than ``ORDERED`` rows.
    """
    ids = stored(ids, "ids")
    down = F.col("id").desc()
    if ids.count() <= ORDERED:
        return ids.withColumn("lower", F.lead("id").over(Window.partitionBy(F.lit(0)).orderBy(down)))
    grouped = ids.withColumn("up", F.expr("shiftright(id, 12)"))
    inside = grouped.withColumn("lower", F.lead("id").over(Window.partitionBy("up").orderBy(down)))
    tops = grouped.groupBy("up").agg(F.max("id").alias("top"))
    below = next_lower(tops.select(F.col("up").alias("id"))).select(F.col("id").alias("up"), F.col("lower").alias("below"))
    below = below.join(tops.select(F.col("up").alias("below"), "top"), "below", "left").select("up", "top")
    return inside.join(below, "up", "left").select("id", F.coalesce("lower", "top").alias("lower"))


def _terms(text: str) -> str:
    """Distinct hashes of the words of a text, A to Z lower-cased."""
    spaced = f"translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' || '\\t\\n' || char(11) || '\\f\\r', 'abcdefghijklmnopqrstuvwxyz     ')"
    return f"array_distinct(transform(array_remove(split({spaced}, ' '), ''), w -> xxhash64(w)))"


def document_counts(docs: DataFrame) -> DataFrame:
    """``term, df``: in how many documents each term is, of those in ``MIN_DOCS`` or more."""
    terms = docs.select(F.explode(F.expr(_terms("text"))).alias("term"))
    return terms.groupBy("term").agg(F.count(F.lit(1)).alias("df")).where(F.col("df") >= MIN_DOCS)


def bit_set(terms: DataFrame) -> DataFrame:
    """One row with an array of ``BITS / 64`` longs: the bits of the longs ``term``."""
    at = f"pmod(term, {BITS})"
    words = terms.selectExpr(f"{at} div 64 word", f"cast({at} % 64 as int) bit").groupBy("word").agg(F.expr("bit_or(shiftleft(1L, bit))").alias("mask"))
    every = terms.sparkSession.range(BITS // 64).withColumnRenamed("id", "word").join(words, "word", "left").selectExpr("word", "coalesce(mask, 0L) mask")
    return every.agg(F.expr("transform(sort_array(collect_list(struct(word, mask))), x -> x.mask)").alias("bits"))


def _is_set(term: str, bits: str) -> str:
    return f"getbit(element_at({bits}, cast(pmod({term}, {BITS}) div 64 as int) + 1), cast(pmod({term}, 64) as int)) = 1"


def _keyed(docs: DataFrame) -> DataFrame:
    """Rows with ``bucket, key``: descending, they give the order of documents. Null ids are spread by text below all others."""
    spread = F.expr(f"xxhash64(text) & {(1 << 52) - 1}")
    bucket = f"CASE WHEN doc_id IS NULL THEN {-(1 << 62)} + shiftright(key, {BUCKET_BITS}) ELSE shiftright(key, {BUCKET_BITS}) END"
    return docs.withColumn("key", F.coalesce("doc_id", spread)).withColumns({"bucket": F.expr(bucket), "ghost": F.lit(False)})


def _placed(docs: DataFrame) -> tuple[DataFrame, Window]:
    """Rows by bucket and the window that orders those of one; where that window ends a ``ghost`` row repeats the first of the next bucket."""
    keyed = _keyed(docs)
    tops = stored(keyed.groupBy("bucket").agg(F.max("key").alias("top")), "tops")
    buckets = next_lower(tops.select(F.col("bucket").alias("id")))
    highest = tops.agg(F.max("bucket")).first()[0]
    steps = stored(buckets.select(F.col("id").alias("bucket"), F.coalesce("lower", F.lit(highest).cast("long")).alias("next_bucket")), "steps")
    firsts = keyed.join(tops, "bucket").where("key = top").groupBy("bucket").agg(F.min("text").alias("text"))
    ghosts = steps.join(firsts.withColumnRenamed("bucket", "next_bucket"), "next_bucket")
    ghosts = stored(ghosts.selectExpr("cast(null as bigint) doc_id", "text", "cast(null as bigint) key", "bucket", "true ghost"), "ghosts")
    order = Window.partitionBy("bucket").orderBy("ghost", F.col("key").desc(), "text")
    return keyed.select(*ghosts.columns).union(ghosts), order


def _edited(text: str, following: str) -> str:
    half = f"cast(floor(char_length({text}) / 2) as int)"
    return f"concat(left({text}, char_length({text}) - {half}), left({following}, {half}))"


def _bound(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` standing for ``value``, which is computed once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def chosen_terms(text: str, lexicon: str, common: str) -> str:
    """Sorted terms of a text: those of the lexicon; where there is none its rarer terms, and else its common ones."""
    inside, rare = f"filter(terms, t -> {_is_set('t', 'lexicon_set')})", f"filter(terms, t -> NOT {_is_set('t', 'common_set')})"
    rest = _bound(rare, "rare", "CASE WHEN size(rare) > 0 THEN rare ELSE terms END")
    chosen = _bound(inside, "inside", f"CASE WHEN size(inside) > 0 THEN inside ELSE {rest} END")
    chosen = _bound(lexicon, "lexicon_set", _bound(common, "common_set", chosen))
    return f"sort_array({_bound(_terms(text), 'terms', chosen)})"


def fingerprint_hashes(terms: str) -> str:
    """The hash of all ``terms`` (sorted hashes), then that of those in the smallest subset of each part that holds one.

    A part is a range of hashes, and its subset of level l the first 1 / 2**l of that range: both are
    runs of the sorted terms, found between marks that are sorted among them. A value is 0 where there is no term, else the level in
    the upper byte and 24 bits of hash.
    """
    left = 64 - (FIELDS - 1).bit_length()
    marks = ", ".join(f"shiftleft({f - FIELDS // 2}L, {left})" for f in range(FIELDS))
    value = "cast(1 + pmod(xxhash64({0}), 16777215) as int)"
    mark = f"shiftleft(cast(f - {FIELDS // 2} as bigint), {left})"
    end = f"CASE WHEN f = {FIELDS - 1} THEN size(marked) + 1L ELSE array_position(marked, shiftleft(cast(f + 1 - {FIELDS // 2} as bigint), {left})) END"
    first = _bound(f"array_position(marked, {mark})", "at", f"slice(marked, cast(at + 1 as int), cast(({end}) - at - 1 as int))")
    width = f"CASE WHEN part[0] = {mark} THEN 0 ELSE length(bin(part[0] - {mark})) END"
    held = f"filter(part, x -> x - {mark} < shiftleft(1L, width))"
    level = _bound(width, "width", f"shiftleft({left} - width, 24) + {value.format(held)}")
    part = _bound(first, "part", f"CASE WHEN size(part) = 0 THEN 0 ELSE {level} END")
    parts = _bound(f"sort_array(concat(terms, array({marks})))", "marked", f"transform(sequence(0, {FIELDS - 1}), f -> {part})")
    none = f"array_repeat(0, {FIELDS + 1})"
    return _bound(terms, "terms", f"CASE WHEN size(terms) = 0 THEN {none} ELSE concat(array({value.format('terms')}), {parts}) END")


def likeness(left: str, right: str) -> str:
    """Share of parts with equal hashes, of those that hold a term of either; 1 only if all terms are the same."""
    pairs = f"slice(zip_with({left}, {right}, (a, b) -> named_struct('a', a, 'b', b)), 2, {FIELDS})"
    share = _bound(f"filter({pairs}, x -> x.a <> 0 OR x.b <> 0)", "held", "least(size(filter(held, x -> x.a = x.b)) / size(held), size(held) / (size(held) + 1D))")
    return f"CASE WHEN {left}[0] = {right}[0] THEN 1D ELSE {share} END"


def fingerprinted(docs: DataFrame) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next`` for every row.

    ``docs`` has ``doc_id, text``; a null text counts as empty. The next document is that of the next
    lower doc_id, after the lowest the highest; rows that repeat an id follow each other by text, and
    null ids come last, in the order of a hash of their text. An empty text, or one without words, has the fingerprint of no
    terms, that of zeros; two of those are alike by 1. Other columns are not read, and an empty table gives
    an empty result.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    total = docs.count()
    counts = stored(document_counts(docs), "counts")
    most = max(MIN_DOCS, MAX_SHARE * total)
    lexicon = stored(bit_set(counts.where(F.col("df").between(MIN_SHARE * total, most))), "lexicon")
    common = stored(bit_set(counts.where(F.col("df") > most)), "common")
    sets = {"lexicon": lexicon.scalar(), "common": common.scalar()}

    def hashed(rows: DataFrame, text: str, name: str) -> DataFrame:
        """``rows`` and the hashes of a text. A set is named once in them, so that it becomes part of the expression and not of rows."""
        return rows.withColumns(sets).withColumn(name, F.expr(fingerprint_hashes(chosen_terms(text, "lexicon", "common")))).drop(*sets)

    rows, order = _placed(docs)
    rows = hashed(rows.withColumn("following", F.lead("text").over(order)), "text", "own")
    rows = rows.withColumn("ahead", F.lead("own").over(order)).where("NOT ghost").withColumn("edited", F.expr(_edited("text", "following")))
    done = hashed(rows, "edited", "changed").selectExpr(
        "doc_id", "cast(char_length(text) as bigint) n_chars", "sha2(edited, 256) edited_sha256", "own", "ahead", "changed"
    )
    # Stored, as each use of a column of expressions would compute it again.
    done = stored(done, "hashes")
    text = lambda c: f"concat_ws('', transform({c}, h -> lower(lpad(hex(h), 8, '0'))))"
    return done.selectExpr(
        "doc_id",
        "n_chars",
        "edited_sha256",
        f"{text('own')} fingerprint",
        f"{text('changed')} edited_fingerprint",
        f"{likeness('own', 'changed')} near_edited",
        f"{likeness('own', 'ahead')} near_next",
    )
