"""Text, money and wire expressions on literal rows."""

import html
import random
import re

import pytest
from pyspark.sql import functions as F

from shelfmark.functions import money, text, wire
from shelfmark.operators.pricing import with_headline_price


def one(spark, values, expression, kind="string"):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"n int, v {kind}")
    return [r.out for r in frame.select("n", expression(F.col("v")).alias("out")).orderBy("n").collect()]


def test_plain_text(spark):
    cases = {
        "<ul><li>Cotton</li><li>Machine wash</li></ul>": "Cotton Machine wash",
        "CoolTech&trade;": "CoolTech™",
        "&amp;lt; &amp;amp;": "&lt; &amp;",
        "&#65;&#x41;&#x1F600;": "AA😀",
        "&nope; &; & a&b &amp": "&nope; &; & a&b &amp",
        "&#0;|&#13;|&#x80;|&#xFFFE;|&#xD800;": "&#0;|&#13;|&#x80;|&#xFFFE;|&#xD800;",
        "a < b and c > d": "a < b and c > d",
        '<a title="x > y" b=\'>\'>q</a>': "q",
        "<!-- a <b> --> z <!--> y": "z y",
        "x  ᠎\n\ny": "x y",
        "a\tb  c": "a b c",
        "cut <p": "cut",
        'cut <p title="': "cut",
        "<p <b>lost</b> lost": "",
        "&NotEqualTilde;": "≂̸",
        "": "",
        None: None,
    }
    assert one(spark, list(cases), lambda c: text.plain_text("v")) == list(cases.values())


def test_entities_match_the_standard_table(spark):
    """All named references that end in ``;``, against the standard library."""
    names = [name for name in html.entities.html5 if name.endswith(";")]
    assert one(spark, [f"a&{n}b" for n in names], lambda c: text.decode_entities("v")) == [f"a{html.entities.html5[n]}b" for n in names]


def test_long_markup_does_not_overflow(spark):
    body = "don't \"stop\" < " * 50_000
    assert one(spark, ["<x " + body], lambda c: text.plain_text("v")) == [""]
    assert len(one(spark, ["<b>" + "word <i>x</i> " * 50_000], lambda c: text.plain_text("v"))[0]) > 300_000


def test_random_markup_matches_a_character_walk(spark):
    """Against a plain state machine over characters, without nesting and comments."""

    def walk(markup):
        out, tag, quote = [], False, None
        spaced = markup.replace("<", " <").replace(">", "> ")
        for i, c in enumerate(spaced):
            if not tag:
                if c == "<" and i + 1 < len(spaced) and not spaced[i + 1].isspace():
                    tag = True
                elif not (c == "<" and i + 1 == len(spaced)):
                    out.append(c)
                continue
            if quote:
                quote = None if c == quote else quote
            elif c in "\"'":
                quote = c
            elif c == ">":
                tag = False
        return re.sub(r"\s+", " ", "".join(out)).strip()

    rng = random.Random(5)
    tokens = ["<b>", "</b>", "<a x='1>2'>", '<i y="q">', " < ", ">", "word", " ", "\n", "'", '"', "é"]
    cases = ["".join(rng.choice(tokens) for _ in range(rng.randint(0, 25))) for _ in range(400)]
    assert one(spark, cases, lambda c: text.plain_text("v")) == [walk(c) for c in cases]


def test_split_values(spark):
    assert one(spark, ["301, 302", "303,,301", "", " ,\t7 ", None], text.split_values) == [
        ["301", "302"], ["303", "301"], [], ["7"], None,
    ]


def test_exponent_table(spark):
    assert len(money.EXPONENTS) == 51
    codes = ["USD", " jpy ", "kwd", "CLF", "UYW", "IQD", "", "xx"]
    assert one(spark, codes, money.exponent_of) == [2, 0, 3, 4, 4, 0, 2, 2]


@pytest.mark.parametrize(
    "amount, currency, rounded, strict",
    [
        ("19.9900", "USD", 1999, 1999),
        ("12000", "JPY", 12000, 12000),
        ("1000", "JPY", 1000, 1000),
        ("1.2345", "KWD", 1235, None),
        ("-1.005", "USD", -101, None),
        ("abc", "USD", 0, None),
        ("12.5", "CLF", 125000, 125000),
        ("19.995", "KWD", 19995, 19995),
        ("19.990", "USD", 1999, 1999),
        ("19.999", "USD", 2000, None),
        ("-1", "USD", -100, None),
        ("1,000", "USD", 0, None),
        ("0.00499999999999999999", "USD", 0, None),
        (" 5 ", "usd", 500, 500),
        ("1", "XX", 100, None),
        ("1.", "USD", 0, None),
        ("99999999999999999999999999999999", "USD", None, None),
        ("1234567890123456", "USD", 123456789012345600, 123456789012345600),
        ("123456789012345678", "JPY", 123456789012345678, 123456789012345678),
        ("92233720368547758.07", "USD", 9223372036854775807, 9223372036854775807),
        ("92233720368547758.08", "USD", None, None),
        ("-92233720368547758.08", "USD", -9223372036854775808, None),
        ("0000000000000000000000000000000000000000001.5", "KWD", 1500, 1500),
    ],
)
def test_minor_units(spark, amount, currency, rounded, strict):
    row = spark.createDataFrame([(amount, currency)], "a string, c string").select(
        money.round_minor_text(F.col("a"), F.col("c")).alias("rounded"),
        money.strict_minor(F.col("a"), F.col("c")).alias("strict"),
    )
    got = row.collect()[0]
    assert (got.rounded, got.strict) == (rounded, strict)


def test_headline_price_golden_rows(spark):
    rows = [
        ("simple", "32", "32", "32", 3200, False),
        ("simple", "32", "24", "24", 2400, True),
        ("configurable", "35", "28", "21", 2800, True),
        ("grouped", None, None, "14", 1400, False),
        ("bundle", "0", "0", "61", 6100, False),
        ("simple", "32", "31.9995", "31", 3200, False),
        ("simple", None, None, None, None, False),
        ("simple", "5", "0", "-3", None, True),
    ]
    frame = spark.createDataFrame(
        [(i, *r[:4]) for i, r in enumerate(rows)], "n int, type_id string, p string, f string, m string"
    ).select(
        "n", "type_id",
        *(F.col(c).cast("decimal(12,4)").alias(name) for c, name in (("p", "price"), ("f", "final_price"), ("m", "min_price"))),
    )
    got = with_headline_price(frame, F.lit("usd"), F.col("type_id")).orderBy("n").collect()
    assert [(r.price, r.on_sale) for r in got] == [r[4:] for r in rows]
    assert [r.price_reject for r in got] == [None] * 7 + ["negative price"]
    for r in got:
        assert len({r.price is None, r.currency is None, r.price_exponent is None}) == 1


def test_wire_expressions(spark):
    stamps = ["2026-08-10 14:03:11", "2026-08-10T14:03:11.5", "10/08/2026", "", None]
    assert one(spark, stamps, wire.wire_timestamp) == ["2026-08-10T14:03:11Z"] * 2 + [None] * 3
    codes = [200, 202, 299, 0, 500, 503, 401, 408, 409, 423, 425, 429, 400, 403, 404, 422]
    expected = ["done"] * 3 + ["retry"] * 9 + ["dropped"] * 4
    assert one(spark, codes, wire.classify, "int") == expected
    assert one(spark, ["1,2,,0,3", ""], wire.split_ids) == [["1", "2", "3"], []]
    refs = one(spark, [1, 2], lambda c: wire.order_ref(F.lit("shop"), c), "bigint")
    assert len(set(refs)) == 2 and all(len(r) == 64 for r in refs)


def test_amounts_beyond_a_long_have_a_reason(spark):
    row = spark.createDataFrame([("92233720368547758.08", "USD")], "a string, c string")
    assert row.select(money.strict_minor_reject(F.col("a"), F.col("c"))).first()[0] == "too large"


def walked(markup):
    """Markup removed by walking the characters, with tags, quotes and nesting counted."""
    spaced = markup.replace("<", " <").replace(">", "> ")
    out, depth, quote = [], 0, ""
    for i, c in enumerate(spaced):
        if quote:
            quote = "" if c == quote else quote
        elif c == "<" and not spaced[i + 1 : i + 2].isspace():
            depth += 1
        elif depth and c in "\"'":
            quote = c
        elif depth and c == ">":
            depth -= 1
        elif not depth:
            out.append(c)
    return " ".join("".join(out).split())


def test_nested_markup_of_any_depth(spark):
    deep = ["a" + "".join(f"<t{i} " for i in range(n)) + "x" + ">y" * n + "w" for n in (1, 2, 3, 4, 9, 50)]
    deep += ["a<b <c <d <e>x>y>z>w", "a<b <c <d <e 'q>\">x'>y>z>w", "p <a <b <c <d>>>> q <i>r</i> < s <u <v <w <x> e", "a <b <c <d <e>>> 1 > 2 <b>x</b>"]
    rows = spark.createDataFrame(list(enumerate(deep)), "n int, m string").select("n", text.plain_text("m").alias("t")).orderBy("n").collect()
    assert [r.t for r in rows] == [walked(m) for m in deep]
