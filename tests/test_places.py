import pytest
from pyspark.sql import functions as F

from jobgrain.functions import geo

NAMES = {
    "Washington, DC": ("US", "US-DC", "Washington"),
    "Flexible / Remote": ("Flexible/Remote",) * 3,
    "Berlin, Germany": ("DE", None, "Berlin"),
    "Austin, TX": ("US", "US-TX", "Austin"),
    "New York, NY": ("US", "US-NY", "New York City"),
    "NYC, NY": ("US", "US-NY", "New York City"),
    "London, UK": ("GB", None, "London"),
    "Istanbul, Turkey": ("TR", None, "Istanbul"),
    "Singapore": ("SG", None, "Singapore"),
    "Canada": ("CA", None, None),
    "Springfield": (None, None, "Springfield"),
    "nyc": (None, None, "nyc"),
    "A, B, C": (None, None, "A, B, C"),
    "Paris, Nowhere": ("Nowhere", None, "Paris"),
    "Berlin, DE": ("US", "US-DE", "Berlin"),
    "Austin, tx": ("tx", None, "Austin"),
    ", Germany": ("DE", None, None),
    "Paris,": ("", None, "Paris"),
}

AREAS = [
    (["US", "Kansas", "Johnson County", "Lenexa"], ("US", "US-KS", "Lenexa")),
    (["US", "Texas", "Taylor County", "Impact"], ("US", "US-TX", "Impact")),
    (["US", "Texas", "Dallas"], ("US", "US-TX", "Dallas")),
    (["US", "New York", "New York City"], ("US", "US-NY", "New York City")),
    (["US", "NY", "Albany"], ("US", "US-NY", "Albany")),
    (["US", "Texas"], ("US", "US-TX", None)),
    (["US", "Texas", "Taylor County"], ("US", "US-TX", None)),
    (["US", "New York", "New York"], ("US", "US-NY", None)),
    (["UK", "London"], ("GB", None, None)),
    (["US"], ("US", None, None)),
    (["Germany", "12", "nyc"], ("DE", None, "New York City")),
]


@pytest.fixture(scope="module")
def countries(spark):
    rows = geo.country_alias_table(spark).collect()
    return {r.alias: r.alpha_2 for r in rows}


def test_country_table_is_complete(countries):
    assert len(set(countries.values())) == 249
    for text, code in {
        "de": "DE", "deu": "DE", "276": "DE", "germany": "DE", "federal republic of germany": "DE",
        "usa": "US", "united states": "US", "united states of america": "US", "840": "US",
        "uk": "GB", "gb": "GB", "turkey": "TR", "türkiye": "TR", "004": "AF", "bolivia": "BO",
        "antigua and barbuda": "AG", "saint lucia": "LC", "viet nam": "VN", "vietnam": "VN",
        "russian federation": "RU", "hong kong": "HK", "macao": "MO", "czechia": "CZ",
        "czech republic": "CZ", "south korea": "KR", "curaçao": "CW", "brunei darussalam": "BN",
    }.items():
        assert countries.get(text) == code, text
    for text in ("russia", "280", "xk", "soviet union", "yugoslavia", "guinea-bissau", "england"):
        assert text not in countries, text


def test_country_table_from_file(spark, tmp_path):
    path = str(tmp_path / "countries.csv")
    with open(path, "w") as f:
        f.write("alias,alpha_2\nNarnia,NA\nU.S.,US\n")
    rows = {r.alias: r.alpha_2 for r in geo.country_alias_table(spark, path).collect()}
    assert rows == {"narnia": "NA", "turkey": "TR", "uk": "GB"}


def test_free_text_places(spark):
    named = [{"name": n} for n in NAMES]
    df = spark.createDataFrame([(named,)], "x array<struct<name:string>>")
    got = df.select(geo.places_from_names(F.col("x")).alias("p")).first().p
    assert [tuple(p) for p in got] == list(NAMES.values())


def test_blank_names_are_skipped(spark):
    rows = [([{"name": " "}, {"name": None}, {"name": "Canada"}],), ([],), (None,)]
    df = spark.createDataFrame(rows, "x array<struct<name:string>>")
    got = [r.p for r in df.select(geo.places_from_names(F.col("x")).alias("p")).collect()]
    assert [[tuple(p) for p in ps] for ps in got] == [[("CA", None, None)], [], []]


def test_area_paths(spark):
    rows = [(i, area) for i, (area, _) in enumerate(AREAS)] + [(98, []), (99, None)]
    df = spark.createDataFrame(rows, "i int, x array<string>")
    got = {r.i: [tuple(p) for p in r.p] for r in df.select("i", geo.places_from_area(F.col("x")).alias("p")).collect()}
    assert got == {i: [want] for i, (_, want) in enumerate(AREAS)} | {98: [], 99: []}
