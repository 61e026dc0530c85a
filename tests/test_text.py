"""Golden rows of the scalar functions."""

import pytest
from pyspark.sql import functions as F

from dictforge.config import Config
from dictforge.functions import text as T

CFG = Config()


def one(spark, expr, **values):
    schema = ", ".join(f"{k} string" for k in values) or "x int"
    row = tuple(values.values()) or (1,)
    return spark.createDataFrame([row], schema).select(expr.alias("r")).first()["r"]


def many(spark, fn, inputs):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(inputs)], "i int, s string")
    return [r["r"] for r in df.select("i", fn(F.col("s")).alias("r")).orderBy("i").collect()]


def test_normalize(spark):
    cases = {
        "a &amp; b": "a & b",
        "4, 32, 000": "4,32,000",
        "४, ३२, ०००": "४,३२,०००",
        "4, 3, 2, 1": "4,3, 2,1",
        "x.. y... z,, w": "x. y. z, w",
        "SV+AV + RV": "SV AV   RV",
        "a \t\nb": "a b",
        "a\x1cb c": "a b c",
        "&amp;amp; &lt;b&gt;": "&amp; <b>",
        None: "",
        "": "",
        "+a+": "a",
    }
    assert many(spark, T.normalize, list(cases)) == list(cases.values())


def test_validate(spark):
    bad = ["abcd", "  abcd ", "a NaN value", "nan।x y", "see N/A here", "x is defined as: .", "a" * 10001, None]
    good = ["abcde", "banana split", "nan_value", "कnan text", "a" * 10000]
    valid = many(spark, lambda c: T.is_valid_target(c, CFG.blocked_texts), bad + good)
    assert valid == [False] * len(bad) + [True] * len(good)


@pytest.mark.parametrize(
    "type_label, gender_label, tags",
    [
        ("Adjective and Adverb", "Masculine and Feminine", ["Adjective", "Adverb", "Feminine", "Masculine"]),
        ("Verb Transitive  and  Verb Intransitive", "", ["Verb Intransitive", "Verb Transitive"]),
        ("", "adjective, feminine, plural", ["adjective", "feminine", "plural"]),
        ("None", "", ["None"]),
        ("Noun", "Noun", ["Noun"]),
        ("Unknown type and Noun", None, ["Noun"]),
    ],
)
def test_tags(spark, type_label, gender_label, tags):
    tokens = [T.label_tokens(F.col(c), CFG.split_regex, CFG.exclude_keywords) for c in ("t", "g")]
    expr = T.managed_types(*tokens)
    assert one(spark, expr, t=type_label, g=gender_label) == tags


def test_word_list(spark):
    assert many(spark, T.clean_word_list, ["a| b ,, c|", " | ,", "", None]) == ["a, b, c", None, None, None]


def test_references(spark):
    raw = ('x <a class="k" href="/dictionary/text.manu/text?ref=Mn. 1.2..">Mn</a> '
           'y <a href="/dictionary/sv/text?ref=SV.">')
    got = one(spark, T.reference_codes(F.col("s"), CFG.reference_regex), s=raw)
    assert [tuple(r) for r in got] == [("text.manu", "Mn. 1.2"), ("sv", "SV")]


def test_html(spark):
    cases = {
        "<b>a</b>b &lt;i&gt;c&lt;/i&gt;": "a b c",
        "x<!-- no -->y<script>z()</script> w": "x y w",
        "1 &amp;lt; 2": "1 < 2",
        "a < b": "a < b",
        None: "",
    }
    assert many(spark, T.html_to_text, list(cases)) == list(cases.values())


@pytest.mark.parametrize(
    "text, left, usages",
    [
        ("A ring. Ex. gold ring", "A ring.", ["gold ring"]),
        ("A ring 'of gold' - Rv. 1 worn", "A ring  1 worn", ['"of gold" - Source: Rv']),
        ("A 'q one' - Src A. tail Ex. use 'two' - B.", "A  tail",
         ["use 'two' - B.", '"q one" - Source: Src A']),
        ("Rex. a", "Rex. a", []),
        ("plain", "plain", []),
    ],
)
def test_usages(spark, text, left, usages):
    from dictforge.operators.tasks import with_usages

    row = with_usages(spark.createDataFrame([(text, "w")], "text string, WordText string"), CFG).first()
    assert (row["clean_text"], row["usages"]) == (left, usages)


def test_suffix(spark):
    expr = T.substitute_suffix(F.col("s"), F.col("w"), CFG.suffix_regex)
    assert one(spark, expr, s="x ०जाल ०९", w="अंक") == "x अंकजाल ०९"
    assert one(spark, expr, s="x ०जाल ०९", w="a$b") == "x a$bजाल ०९"
    assert one(spark, expr, s="x ०जाल", w="a\\1") == "x a\\1जाल"


def test_sequence_key(spark):
    got = many(spark, T.sequence_key, ["3", "x 12,4", "१२", "", None, "none", "9" * 30])
    assert got == [3, 12, 12, 999999, 999999, 999999, 2**63 - 1]


def test_render_and_truncate(spark):
    text = T.render(CFG.template(), user_prompt=F.col("u"), target=F.col("t"))
    full = "<s>[INST] Def: w [/INST] " + "y" * 60 + " </s>"
    assert one(spark, text, u="Def: w", t="y" * 60) == full
    short = T.truncate_record(F.col("s"), CFG.template(), 60)
    cut = one(spark, short, s=full)
    assert cut == full[:50] + " ... " + " </s>" and len(cut) == 60
    assert one(spark, short, s=full[:60]) == full[:60]
    assert one(spark, text, u="{target} $1", t="\\n {x}") == "<s>[INST] {target} $1 [/INST] \\n {x} </s>"


def test_small_helpers(spark):
    assert one(spark, T.language_code(F.col("s")), s="iwn.lang.hin") == "HIN"
    assert one(spark, T.mask_secret(F.col("s")), s="abcdefghij") == "abcd**ghij"
    assert one(spark, T.mask_secret(F.col("s")), s="abcdef") == "abcdcdef"
    assert one(spark, T.path_safe(F.col("s")), s="a/b/c") == "a_b_c"
    assert one(spark, T.snippet(F.col("s")), s="z" * 600) == "z" * 500


@pytest.mark.parametrize("raw, text", [
    ('a <a title="x>y">c</a> d', "a c d"),
    ("a <?php echo 1 ?> b", "a b"),
    ("a <script>var x = 1; b", "a"),
    ("a <style type='t>u'>p{}</style >b", "a b"),
    ("a <!-- never closed", "a"),
    ("a <!DOCTYPE html><p class=x>b</p>", "a b"),
    ("1 < 2 and 3 > 2", "1 < 2 and 3 > 2"),
])
def test_markup_goes_as_a_parser_reads_it(spark, raw, text):
    df = spark.createDataFrame([(raw,)], "s string")
    assert df.select(T.html_to_text(F.col("s"))).first()[0] == text


def test_an_entity_cut_before_its_semicolon_may_stay(spark):
    cases = {"a &amp; b&amp c&am": "a & b&amp c&am", "x &amp;amp; y &#65 z &#65;": "x & y &#65 z A", "&amp,lt;": "&amp,lt;"}
    closed = many(spark, lambda c: T.html_to_text(c, bare_names=False), list(cases))
    assert closed == list(cases.values())
    assert many(spark, T.html_to_text, ["a &amp b"]) == ["a & b"]


def test_plus_signs_are_replaced_by_a_search(spark):
    rows = spark.createDataFrame([("a+b",), ("++",), ("é+ +अ+",), ("none",), ("",), (None,)], "x string")
    found = rows.select(T.normalize(F.col("x")).alias("y"))
    assert [r["y"] for r in found.collect()] == ["a b", "", "é   अ", "none", "", ""]
    assert "translate(" not in found._jdf.queryExecution().optimizedPlan().toString()
