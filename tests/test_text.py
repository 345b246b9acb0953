"""Cleaning rules and message features, one table per quirk."""

import pytest
from pyspark.sql import functions as F

from chatframe.functions import clean, message
from chatframe.functions.pytext import redact, strip, tokens


def apply(spark, texts, expression):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    return [r["x"] for r in df.select("i", expression(F.col("text")).alias("x")).orderBy("i").collect()]


@pytest.mark.parametrize(("rule", "cases"), [
    (clean.mask_pii, {
        "see https://a.b/c?x=1, ok": "see [URL] ok", "call +919876543210 or 09876543210": "call [PHONE] or [PHONE]", "+91 98765 43210": "+91 98765 43210", "a.b@mail5.example.com!": "[EMAIL].com!",
        "ravi@okaxis": "[UPI]", "ravi@okhdfcbank": "ravi@okhdfcbank", "9876543210@ybl": "[PHONE]@ybl", "2345 6789 0123": "[ID]", "234567890123": "[ID]", "612345678901": "[PHONE]01",
        "2123465659789240": "21234[PHONE]0", "x@upi.com": "[EMAIL]", "": "", None: None,
    }),
    (clean.remove_devanagari, {"aकb": "ab", "१ a।": " a", None: None}),
    (clean.normalise_space, {"a  b \t c ": "a b c", "a\tb": "a\tb", "   x": "x"}),
    (lambda c: clean.remove_words(c, ("the", "with")), {"The cat with, the hat": "cat with, hat", "": "", None: None}),
    (lambda c: clean.mask_words(c, ("foo", "क"), "[W]"), {"a Foo! b": "a [W] b", "(क) x": "[W] x", "क। x": "क। x", "a  b": "a b", None: None}),
    (lambda c: clean.mask_words(c, ()), {"a  b": "a  b"}),
    (clean.clean_text, {"<Media omitted>": None, "x Image Omitted": None, "": None, None: None, "a": None, "👍": None, "ok": "ok", "  hi  there ": "hi there", "नमस्ते": None}),
    (strip, {" a b\x1c": "a b"}),
    (lambda c: redact(c, 3, "-"), {" abcd ": "abc...", "abc": "abc", None: "-"}),
])
def test_rules(spark, rule, cases):
    assert apply(spark, list(cases), rule) == list(cases.values())


def test_clean_messages_drops_rows_and_keeps_columns(spark):
    df = spark.createDataFrame([("<Media omitted>", 1, "c"), ("hello  there", 2, "c"), (None, 3, "c")], "text string, i int, _cleaned2 string")
    out = clean.clean_messages(df)
    assert out.columns == df.columns and [tuple(r) for r in out.collect()] == [("hello there", 2, "c")]
    assert clean.clean_messages(df.limit(0)).count() == 0


def test_message_features(spark):
    texts = ["", "a b\x1cc", "OK", "[URL] x", "SSßung", "éAB", "A_BC", "LOLz", "AB2", "wait...", "wait…", "why? ", "👨‍👩‍👧 👍🏽🇮🇳 1️⃣", None, "x" * 200_000]
    df = message.message_features(spark.createDataFrame(list(enumerate(texts)), "i int, text string"))
    r = {t: row for t, row in zip(texts, df.orderBy("i").collect())}
    assert (r[""]["word_count"], r[""]["is_very_short"]) == (0, True) and r["a b\x1cc"]["word_count"] == 3
    assert {t for t in texts if r[t]["has_caps_word"]} == {"OK", "[URL] x"}
    assert r["wait..."]["ends_ellipsis"] and not r["wait…"]["ends_ellipsis"] and r["why? "]["ends_question"]
    assert r["👨‍👩‍👧 👍🏽🇮🇳 1️⃣"]["emoji_count"] == 4 and r[None]["word_count"] is None and r[texts[-1]]["message_length"] == 200_000


def test_tokens_and_ids(spark):
    assert apply(spark, [" a  b ", ""], tokens) == [["a", "b"], []]
    assert apply(spark, ["Rahul Chat"], message.conversation_id) == [__import__("hashlib").md5(b"Rahul Chat").hexdigest()[:8]]
    assert [r[0] for r in spark.range(24).select(message.twelve_hour(F.col("id"))).collect()][::11] == ["12 AM", "11 AM", "10 PM"]


def test_buckets(spark):
    def cleaned(text, **rules):
        return spark.range(1).select(clean.clean_text(F.lit(text), devanagari=False, **rules).alias("x")).first()["x"]

    assert cleaned("this is fucking wild bc", buckets=("english", "hinglish")) == "this is [NSFW] wild [NSFW]"
    assert cleaned("this is fucking wild bc", buckets=("english",)) == "this is [NSFW] wild bc"
    assert cleaned("तू हरामी है", buckets=("hindi",)) == "तू [NSFW] है" and cleaned("तू हरामी है") == "तू हरामी है"
    assert cleaned("a b, c", buckets=("own", "none"), lists={"own": ("B",)}) == "a [NSFW] c"
