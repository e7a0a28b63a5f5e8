import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from jobgrain.functions import text
from jobgrain.sources.processed import PLACE_TEXT
from tests.conftest import values


def one(spark, expression, value, kind="string"):
    df = spark.createDataFrame([(value,)], f"x {kind}")
    return df.select(expression(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize(
    "given, want",
    [
        ("Senior (m/f) Data-Engineer,  R&D", "senior data engineer r&d"),
        ("  A / B\tC\x1cD ", "a b c d"),
        ("(x)", ""),
        ("", ""),
        (None, None),
    ],
)
def test_normalize_title(spark, given, want):
    assert one(spark, text.normalize_title, given) == want
    if want is not None:
        assert one(spark, text.normalize_title, want) == want


def test_space_characters_are_pythons():
    assert set(text.SPACE_CHARS) == {c for c in map(chr, range(0x110000)) if c.isspace()}


def test_every_space_character_collapses_and_strips(spark):
    noisy = "a" + text.SPACE_CHARS + "b"
    assert one(spark, text.collapse_spaces, noisy) == "a b"
    assert one(spark, text.strip, text.SPACE_CHARS + "x y" + text.SPACE_CHARS) == "x y"


def test_keep_word_characters(spark):
    assert one(spark, text.keep_word_characters, "Côte d'Ivoire_1 (x)!") == "Côte dIvoire_1 x"


def test_has_text(spark):
    df = spark.createDataFrame([("a",), (" ",), ("",), (" None ",), (None,), ("none",)], "x string")
    assert values(df.where(text.has_text(F.col("x")))) == ["a", "none"]


@pytest.mark.parametrize(
    "written, want",
    [
        (
            "[{'country_code': 'US', 'subdivision_code': None, 'city': \"Coeur d'Alene\"}]",
            [("US", None, "Coeur d'Alene")],
        ),
        ("[{'city': 'it\\'s \"q\"'}]", [(None, None, "it's \"q\"")]),
        ("[{'city': 'a: None, b'}, {'city': 'Caf\\xe9'}]", [(None, None, "a: None, b"), (None, None, "Café")]),
        ('[{"city": "x", "country_code": null}]', [(None, None, "x")]),
        ("garbage", []),
        ("", []),
        (None, []),
        ("[]", []),
    ],
)
def test_decode_list(spark, written, want):
    got = one(spark, lambda c: text.decode_list(c, PLACE_TEXT), written)
    assert [(p.country_code, p.subdivision_code, p.city) for p in got] == want


def test_first_filled(spark):
    df = spark.createDataFrame([("", "b"), ("a", "b"), (None, ""), (None, None)], "x string, y string")
    assert values(df.select(text.first_filled(F.col("x"), F.col("y")))) == ["b", "a", "", None]


def test_lenient_casts(spark):
    assert one(spark, text.parse_number, "1e3") == 1000.0
    assert one(spark, text.parse_number, "n/a") is None
    assert one(spark, text.parse_timestamp, "2025-02-30T00:00:00Z") is None
    moment = one(spark, lambda c: text.parse_timestamp(c).cast("string"), "2025-01-02T03:04:05+02:00")
    assert moment == "2025-01-02 01:04:05"


@pytest.mark.parametrize("bad", ["x", None, "1.5x"])
def test_strict_id_fails(spark, bad):
    assert one(spark, text.strict_id, "5515985942") == 5515985942
    with pytest.raises(PySparkException):
        one(spark, text.strict_id, bad)


def test_first_name_strict_and_lenient(spark):
    kind = "array<struct<name:string>>"
    assert one(spark, text.first_name, [("a",), ("b",)], kind) == "a"
    for empty in ([], None):
        assert one(spark, text.first_name, empty, kind) is None
        with pytest.raises(PySparkException):
            one(spark, lambda c: text.first_name(c, strict=True), empty, kind)


@pytest.mark.parametrize(
    "typed, title, hit",
    [
        ("dev", "Senior DEVeloper", True),
        ("d_v", "a dxv b", True),
        ("100%", "100 and more", True),
        ("c\\d", "c\\d", True),
        ("c\\d", "cd", False),
        ("a\\%b", "a%b", True),
        ("a\\%b", "axb", False),
        ("x\\", "x\\", True),
    ],
)
def test_ilike_pattern(spark, typed, title, hit):
    assert one(spark, lambda c: c.ilike(text.ilike_pattern(typed)), title) is hit


def test_round_is_half_away_from_zero(spark):
    for x, want in ((2.5, 3), (3.5, 4), (-2.5, -3)):
        assert one(spark, text.round_whole, x, "double") == want
