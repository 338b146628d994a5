import html
import pytest
from pyspark.sql import functions as F

from kindred.functions import text as X


def one(spark, expr, value):
    return spark.createDataFrame([(value,)], "t string").select(expr(F.col("t")).alias("r")).first().r


def test_clean_a(spark):
    assert one(spark, X.clean_a, "A-b&nbsp;c  D") == "a b nbsp c d"


def test_clean_b(spark):
    assert one(spark, X.clean_b, " ,abc. ") == "ABC"
    assert one(spark, X.clean_b, "a, b 。") == "AB"


def test_alnum_lower_unicode(spark):
    assert one(spark, X.alnum_lower, "a1²Ⅷ五é-_") == "a1²ⅷ五é"


@pytest.mark.parametrize("text,jp", [("你好", True), ("ひらがな", True), ("abc", False), ("", False)])
def test_is_japanese(spark, text, jp):
    assert one(spark, X.is_japanese, text) is jp


@pytest.mark.parametrize("s,ok", [("1", True), (" 2.5 ", True), ("1e5", True), ("1_000", True), ("inf", True),
                                  ("nan", True), (".5", True), ("5.", True), ("1d", False), ("abc", False),
                                  ("", False), ("1__0", False)])
def test_is_number_python_float_rules(spark, s, ok):
    assert one(spark, X.is_number, s) is ok
    try:
        float(s)
        py = True
    except ValueError:
        py = False
    assert py is ok


def test_checks(spark):
    assert one(spark, X.is_han, "") is True
    assert one(spark, X.count_paren_pairs, "a()b()") == 2
    assert one(spark, X.contains_html, "x <b>y</b>") is True
    assert one(spark, X.contains_html, "x <\nb>") is False
    assert one(spark, X.contains_romaji, "Hello, world!") is True
    assert one(spark, X.contains_romaji, "Hello=world") is False
    assert one(spark, X.count_p_close, "<p>a</p><p>b</p>") == 2
    assert one(spark, X.strip_tag_attributes, '<p class="x">a</p>') == "<p>a</p>"
    assert one(spark, X.html_to_lines, "<div>a</div><b>c</b>") == "a\n\nc\n"


def test_answer_checks(spark):
    df = spark.createDataFrame([("ans: Apple[な]x", "foo\n apple. \n", "2"), ("", "", "1"), ("Pear", "x\ny", "0"),
                                ("Kiwi", "kiwi", "5")], "a string, b string, n string")
    got = [r.r for r in df.select(X.answer_check_index("a", "b", "n", r"[A-Z]\w+\[?な?\]?").alias("r")).collect()]
    assert got == [True, True, False, False]


def test_html_helpers(spark):
    html = '<p>A &amp; B</p><script>var t="</p>";</script><!-- c -->'
    assert one(spark, X.text_of_html, html) == 'A & Bvar t="</p>"; c '
    assert one(spark, X.text_of_html, "plain &amp;") == "plain &amp;"
    assert one(spark, X.p_tags_balanced, html) is False
    assert one(spark, X.p_tags_balanced, "<p class='x'>a</p>") is True
    assert one(spark, X.latin_text_of_html, "()<b>ab</b><i> 12 </i><u>--</u>") == "()ab12"


def test_row_checks_are_not_constant(spark, sf):
    from kindred.plans import registry
    from kindred.plans.text_queries import MIXED_CHECKS
    for name in [*MIXED_CHECKS, "T9", "T17"]:
        df = registry.queries()[name](spark, sf)
        column = [c for c in df.columns if c not in ("id", "n")][0]
        assert df.select(column).distinct().count() > 1, name


def test_character_references_as_html_defines_them(spark):
    texts = ["&eacute; caf&eacute &copy2; &notit; &notin;", "&#233;&#xE9;&#XE9 &#128512;&#x80;&#x81;&#0;&#xD800;&#x110000;&#11;&#xFFFF;",
             "&CounterClockwiseContourIntegral;&nosuch; & &; &# &#x; &amp;lt; &ampamp;", "&#0000000000000233;&#99999999999;", "", "&", None]
    texts += [f"a&{name}b" for name in X.NAMED_REFERENCES]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r.o for r in df.select("i", X.decode_entities("t").alias("o")).collect()}
    assert got == {i: None if t is None else html.unescape(t) for i, t in enumerate(texts)}
