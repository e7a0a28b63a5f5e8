"""Places: country codes, US subdivisions, city names, free-text locations."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobgrain.functions.text import blank_to_null, keep_word_characters, split_trimmed, strip

# Fixed values -----------------------------------------------------------------

REMOTE = "Flexible/Remote"

CITY_ALIASES = {"nyc": "New York City", "new york": "New York City"}

COUNTRY_ALIASES = {"turkey": "TR", "uk": "GB"}

# Singapore, Hong Kong, Monaco, Vatican City, Macau
CITY_STATES = ["SG", "HK", "MC", "VA", "MO"]

# ISO 3166-2:US subdivision names and codes
US_SUBDIVISIONS = {
    "Alabama": "AL", "Alaska": "AK", "American Samoa": "AS", "Arizona": "AZ",
    "Arkansas": "AR", "California": "CA", "Colorado": "CO", "Connecticut": "CT",
    "Delaware": "DE", "District of Columbia": "DC", "Florida": "FL", "Georgia": "GA",
    "Guam": "GU", "Hawaii": "HI", "Idaho": "ID", "Illinois": "IL", "Indiana": "IN",
    "Iowa": "IA", "Kansas": "KS", "Kentucky": "KY", "Louisiana": "LA", "Maine": "ME",
    "Maryland": "MD", "Massachusetts": "MA", "Michigan": "MI", "Minnesota": "MN",
    "Mississippi": "MS", "Missouri": "MO", "Montana": "MT", "Nebraska": "NE",
    "Nevada": "NV", "New Hampshire": "NH", "New Jersey": "NJ", "New Mexico": "NM",
    "New York": "NY", "North Carolina": "NC", "North Dakota": "ND",
    "Northern Mariana Islands": "MP", "Ohio": "OH", "Oklahoma": "OK", "Oregon": "OR",
    "Pennsylvania": "PA", "Puerto Rico": "PR", "Rhode Island": "RI",
    "South Carolina": "SC", "South Dakota": "SD", "Tennessee": "TN", "Texas": "TX",
    "United States Minor Outlying Islands": "UM", "Utah": "UT", "Vermont": "VT",
    "Virgin Islands, U.S.": "VI", "Virginia": "VA", "Washington": "WA",
    "West Virginia": "WV", "Wisconsin": "WI", "Wyoming": "WY",
}

# Region codes and numbers the locale library knows but ISO 3166-1 no longer
# (or never) assigns.
UNASSIGNED_CODES = [
    "AN", "BU", "CS", "DG", "EA", "FX", "IC", "NT", "SU", "TP", "XK", "YD", "YU", "ZR",
]
RETIRED_NUMBERS = [230, 249, 278, 280, 720, 736, 886]

# ISO 3166-1 names where they differ from the locale library's English name.
# An empty list means that no ISO name is free of punctuation.
ISO_NAMES = {
    "BN": ["Brunei Darussalam"],
    "BQ": [],
    "CC": [],
    "CD": [],
    "CG": ["Congo"],
    "CI": [],
    "CV": ["Cabo Verde"],
    "FK": [],
    "FM": ["Federated States of Micronesia"],
    "GS": ["South Georgia and the South Sandwich Islands"],
    "HK": ["Hong Kong", "Hong Kong Special Administrative Region of China"],
    "HM": ["Heard Island and McDonald Islands"],
    "MF": [],
    "MM": ["Myanmar"],
    "MO": ["Macao", "Macao Special Administrative Region of China"],
    "PN": ["Pitcairn"],
    "PS": ["the State of Palestine"],
    "RU": ["Russian Federation"],
    "SH": [],
    "ST": ["Sao Tome and Principe", "Democratic Republic of Sao Tome and Principe"],
    "SX": [],
    "UM": ["United States Minor Outlying Islands"],
    "VA": [],
    "VC": ["Saint Vincent and the Grenadines"],
    "VI": ["Virgin Islands of the United States"],
    "VN": ["Viet Nam", "Vietnam", "Socialist Republic of Viet Nam"],
}

# ISO 3166-1 official names: a form of state followed by the short name ...
OFFICIAL_FORMS = {
    "Republic of": (
        "AL AM AO AT AZ BG BI BJ BW BY CG CL CM CO CR CU CV CY DJ EC EE EG FI FJ GH "
        "GN GQ GT GY HN HR HT ID IN IQ IS KE KI KZ LR LT LV MD ME MG MK ML MM MT MU "
        "MV MW MZ NA NI NR PA PE PL PW PY RS SC SG SI SL SM SN SR SS SV TD TJ TN TR "
        "UG UZ VU YE ZA ZM ZW"
    ),
    "Republic of the": "GM MH NE PH SD",
    "Kingdom of": "BE BH BT DK ES KH LS MA NL NO SA SE SZ TH TO",
    "Federal Republic of": "DE NG SO",
    "Islamic Republic of": "AF IR MR PK",
    "Principality of": "AD LI MC",
    "State of": "IL KW QA",
    "Commonwealth of": "DM",
    "Commonwealth of the": "BS",
    "Federal Democratic Republic of": "ET NP",
    "Independent State of": "PG WS",
}
# ... or a name of its own.
OFFICIAL_NAMES = {
    "AR": "Argentine Republic",
    "BO": "Plurinational State of Bolivia",
    "BR": "Federative Republic of Brazil",
    "CH": "Swiss Confederation",
    "CZ": "Czech Republic",
    "EG": "Arab Republic of Egypt",
    "FR": "French Republic",
    "GA": "Gabonese Republic",
    "GB": "United Kingdom of Great Britain and Northern Ireland",
    "GR": "Hellenic Republic",
    "IT": "Italian Republic",
    "JO": "Hashemite Kingdom of Jordan",
    "KG": "Kyrgyz Republic",
    "KM": "Union of the Comoros",
    "LB": "Lebanese Republic",
    "LK": "Democratic Socialist Republic of Sri Lanka",
    "LU": "Grand Duchy of Luxembourg",
    "MX": "United Mexican States",
    "OM": "Sultanate of Oman",
    "PT": "Portuguese Republic",
    "RW": "Rwandese Republic",
    "SK": "Slovak Republic",
    "TG": "Togolese Republic",
    "TZ": "United Republic of Tanzania",
    "US": "United States of America",
    "UY": "Eastern Republic of Uruguay",
    "VE": "Bolivarian Republic of Venezuela",
}

PLACE_TYPE = "struct<country_code:string,subdivision_code:string,city:string>"


# --- country table ----------------------------------------------------------------


def country_alias_table(spark: SparkSession, path: str | None = None) -> DataFrame:
    """`(alias, alpha_2)`: every text that names a country.

    Codes, numbers and English names come from the locale library that ships with
    Spark; the differences from ISO 3166-1 are stated above. `path` names a CSV
    file with the two columns to use instead. Aliases are lower case, and those
    with punctuation are left out because the looked-up text never has any.
    """
    if path:
        found = spark.read.schema("alias STRING, alpha_2 STRING").csv(path, header=True)
    else:
        found = _library_aliases(spark)
    aliases = found.select(F.lower("alias").alias("alias"), "alpha_2")
    one = spark.range(0, 1, 1, 1)
    extra = one.select(F.explode(_constant_map(COUNTRY_ALIASES)).alias("alias", "alpha_2"))
    return (
        aliases.where(keep_word_characters(F.col("alias")) == F.col("alias"))
        .where(~F.col("alias").isin(list(COUNTRY_ALIASES)))
        .unionByName(extra)
        .groupBy("alias")
        .agg(F.min("alpha_2").alias("alpha_2"))
    )


def _library_aliases(spark: SparkSession) -> DataFrame:
    def call(method: str, *args: Column) -> Column:
        return F.try_reflect(F.lit("com.ibm.icu.util.ULocale"), F.lit(method), *args)

    letters = F.sequence(F.lit(ord("A")), F.lit(ord("Z")))
    pair = F.concat(F.char(F.col("a")), F.char(F.col("b")))
    tag = F.concat(F.lit("und_"), F.col("alpha_2"))
    one = spark.range(0, 1, 1, 1)
    codes = (
        one
        .select(F.explode(letters).alias("a"))
        .select("a", F.explode(letters).alias("b"))
        .select(pair.alias("alpha_2"))
        .where(~F.col("alpha_2").isin(UNASSIGNED_CODES))
        .select(
            "alpha_2",
            call("getISO3Country", tag).alias("alpha_3"),
            call("getDisplayCountry", tag, F.lit("en")).alias("shown"),
        )
        .where(F.col("alpha_3") != "")
    )
    short = F.regexp_replace(F.replace("shown", F.lit(" & "), F.lit(" and ")), r"^St\. ", "Saint ")
    own = F.from_json(F.lit(json.dumps(ISO_NAMES)), "map<string,array<string>>")
    forms = {
        code: form for form, members in OFFICIAL_FORMS.items() for code in members.split()
    }
    form = F.from_json(F.lit(json.dumps(forms)), "map<string,string>")
    official = F.from_json(F.lit(json.dumps(OFFICIAL_NAMES)), "map<string,string>")
    names = F.concat(
        F.array("alpha_2", "alpha_3"),
        F.coalesce(own[F.col("alpha_2")], F.array(short)),
        F.array(F.concat(form[F.col("alpha_2")], F.lit(" "), short)),
        F.array(official[F.col("alpha_2")]),
    )
    named = codes.select(F.explode(names).alias("alias"), "alpha_2")
    numbered = (
        one
        .select(F.explode(F.sequence(F.lit(1), F.lit(899))).alias("n"))
        .where(~F.col("n").isin(RETIRED_NUMBERS))
        .select(
            F.lpad(F.col("n").cast("string"), 3, "0").alias("alias"),
            F.try_reflect(
                F.lit("com.ibm.icu.util.Region"), F.lit("getInstance"), F.col("n")
            ).alias("alpha_2"),
        )
        .where(F.col("alpha_2").rlike("^[A-Z]{2}$") & ~F.col("alpha_2").isin(UNASSIGNED_CODES))
    )
    return named.unionByName(numbered).where("alias IS NOT NULL")


_country_json: dict[str | None, str] = {}


def country_map(spark: SparkSession | None = None, path: str | None = None) -> Column:
    """The alias table as one constant, grouped by first character so that a
    lookup compares a few dozen aliases only. The table holds some 1,300 rows
    whatever the data (a `path` table is the caller's, one row per alias), so it
    is read once and put into the plan as a constant."""
    if path not in _country_json:
        spark = spark or SparkSession.active()
        table: dict[str, dict[str, str]] = {}
        for alias, code in country_alias_table(spark, path).collect():
            table.setdefault(alias[0], {})[alias] = code
        _country_json[path] = json.dumps(table)
    return F.from_json(F.lit(_country_json[path]), "map<string,map<string,string>>")


# --- expressions --------------------------------------------------------------------


def _constant_map(entries: dict[str, str]) -> Column:
    return F.from_json(F.lit(json.dumps(entries)), "map<string,string>")


def country_key(c: Column) -> Column:
    """The form in which a country text is looked up."""
    return strip(keep_word_characters(F.lower(c)))


def normalize_country(c: Column, countries: Column | None = None) -> Column:
    """ISO alpha-2 code of a country name or code, NULL when unknown."""
    return _code_of_key(country_map() if countries is None else countries, country_key(c))


def _code_of_key(countries: Column, key: Column) -> Column:
    return countries[F.substring(key, 1, 1)][key]


def normalize_city(c: Column) -> Column:
    """Known short names spelled out; other cities unchanged; blank is NULL."""
    return F.coalesce(_constant_map(CITY_ALIASES)[F.lower(strip(c))], blank_to_null(c))


def _place(country: Column, subdivision: Column, city: Column) -> Column:
    return F.struct(
        country.alias("country_code"),
        subdivision.alias("subdivision_code"),
        city.alias("city"),
    )


def places_from_names(locations: Column) -> Column:
    """Array of places from an array of `{name}` records in free text.

    Per element, the first rule that fits: no name, skipped; remote work, the
    remote marker three times; a country, its code (with the text as city for a
    city state); anything but two comma parts, the text as city; a US state code
    after the comma, that state; else the country after the comma, or its text
    when it is unknown.
    """
    nothing = F.lit(None).cast("string")
    countries = country_map()

    # Each step keeps what the next one uses more than once.
    def read(x: Column) -> Column:
        name = strip(x["name"])
        return F.struct(name.alias("name"), split_trimmed(name).alias("parts"))

    def keyed(x: Column) -> Column:
        region = F.when(F.size(x["parts"]) == 2, F.get(x["parts"], F.lit(1)))
        return F.struct(
            x["name"].alias("name"),
            x["parts"].alias("parts"),
            country_key(x["name"]).alias("key"),
            country_key(region).alias("region_key"),
        )

    def found(x: Column) -> Column:
        return F.struct(
            x["name"].alias("name"),
            x["parts"].alias("parts"),
            x["region_key"].alias("region_key"),
            _code_of_key(countries, x["key"]).alias("country"),
        )

    def place(x: Column) -> Column:
        name, country = x["name"], x["country"]
        first, region = F.get(x["parts"], F.lit(0)), F.get(x["parts"], F.lit(1))
        in_us = region.isin(list(US_SUBDIVISIONS.values()))
        remote = F.lit(REMOTE)
        return (
            F.when(F.contains(F.lower(name), F.lit("remote")), _place(remote, remote, remote))
            .when(
                country.isNotNull(),
                _place(country, nothing, F.when(country.isin(CITY_STATES), name)),
            )
            .when(F.size(x["parts"]) != 2, _place(nothing, nothing, name))
            .when(
                in_us,
                _place(F.lit("US"), F.concat(F.lit("US-"), region), normalize_city(first)),
            )
            .otherwise(
                _place(
                    F.coalesce(_code_of_key(countries, x["region_key"]), region),
                    nothing,
                    normalize_city(first),
                )
            )
        )

    named = F.filter(F.transform(locations, read), lambda x: x["name"] != "")
    places = F.transform(F.transform(F.transform(named, keyed), found), place)
    return F.coalesce(places, F.array().cast(f"array<{PLACE_TYPE}>"))


def places_from_area(area: Column) -> Column:
    """Array with the one place an area path `[country, state, ..., city]` names.

    The state is a US state name or any two capitals; the city is the last part
    that is neither a county or district nor the same text as country or state.
    """
    head, second = F.get(area, F.lit(0)), F.get(area, F.lit(1))
    two_capitals = (F.length(second) == 2) & (F.upper(second) == second) & (
        F.lower(second) != second
    )
    state = F.coalesce(
        _constant_map(US_SUBDIVISIONS)[second], F.when(two_capitals, second)
    )

    def is_city(part: Column) -> Column:
        low = F.lower(part)
        region = F.contains(low, F.lit("county")) | F.contains(low, F.lit("district"))
        return ~region & ~part.eqNullSafe(head) & ~part.eqNullSafe(second)

    rest = F.slice(area, 2, F.greatest(F.size(area), F.lit(1)))
    cities = F.filter(rest, is_city)
    city = normalize_city(F.get(cities, F.size(cities) - 1))
    place = _place(normalize_country(head), F.concat(F.lit("US-"), state), city)
    return F.when(F.size(area) > 0, F.array(place)).otherwise(
        F.array().cast(f"array<{PLACE_TYPE}>")
    )
