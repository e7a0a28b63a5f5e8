"""Cleaning operators over the given tables."""

from __future__ import annotations

from pyspark.sql import Observation
from pyspark.sql import functions as F

from jobgrain.functions import geo, text, titles
from jobgrain.operators import lists, quality, rows
from jobgrain.plans import cleaning
from workload.common import SPACE_CLASS, table

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            SQL[fn.__name__] = sql
        return fn

    return add


# --- rows ------------------------------------------------------------------------


@query(
    """SELECT event_id, user_id, event_type, value FROM (
         SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rn
         FROM events) WHERE rn = 1"""
)
def keep_first(spark, sf):
    df = table(spark, sf, "events").select("event_id", "user_id", "event_type", "value", "ts")
    first = rows.keep_first(df, ["user_id", "event_type"], F.struct("ts", "event_id"))
    return first.drop("ts")


# An injected blank or NULL, the same in both languages.
_HOLES = """SELECT event_id, CASE WHEN event_id % 7 = 0 THEN '' ELSE event_type END AS event_type,
    CASE WHEN event_id % 11 = 0 THEN NULL ELSE value END AS value,
    CASE WHEN event_id % 5 = 0 THEN '' WHEN event_id % 3 = 0 THEN NULL ELSE props END AS props
  FROM events"""


def _holes(spark, sf):
    i = F.col("event_id")
    return table(spark, sf, "events").select(
        "event_id",
        F.when(i % 7 == 0, "").otherwise(F.col("event_type")).alias("event_type"),
        F.when(i % 11 != 0, F.col("value")).alias("value"),
        F.when(i % 5 == 0, "").when(i % 3 != 0, F.col("props")).alias("props"),
    )


@query(f"SELECT * FROM ({_HOLES}) WHERE value IS NOT NULL AND props IS NOT NULL")
def required_columns(spark, sf):
    return rows.require(_holes(spark, sf), ["value", "props"])


@query(_HOLES)
def required_columns_none(spark, sf):
    return rows.require(_holes(spark, sf), [])


@query(
    f"""SELECT event_id, nullif(event_type, '') AS event_type, value, nullif(props, '') AS props
        FROM ({_HOLES})"""
)
def blank_to_null(spark, sf):
    return rows.blanks_to_null(_holes(spark, sf))


@query(
    """SELECT p_partkey, CASE WHEN p_size % 3 <> 0 THEN array_to_string(string_split(p_name, ' '), '+') END
         AS words FROM part"""
)
def empty_list_to_null(spark, sf):
    none = F.array().cast("array<string>")
    words = F.when(F.col("p_size") % 3 == 0, none).otherwise(F.split("p_name", " "))
    lists_ = rows.blanks_to_null(table(spark, sf, "part").select("p_partkey", words.alias("words")))
    return lists_.select("p_partkey", F.array_join("words", "+").alias("words"))


@query(
    f"""WITH h AS (SELECT event_id, nullif(event_type, '') AS event_type, value,
          nullif(props, '') AS props FROM ({_HOLES})),
        c AS (SELECT count(*) - count(event_id) AS a, count(*) - count(event_type) AS b,
          count(*) - count(value) AS c, count(*) - count(props) AS d FROM h)
        SELECT 'event_id' AS column_name, a AS null_count FROM c
        UNION ALL SELECT 'event_type', b FROM c UNION ALL SELECT 'value', c FROM c
        UNION ALL SELECT 'props', d FROM c UNION ALL SELECT '(total)', a + b + c + d FROM c"""
)
def null_profile(spark, sf):
    return quality.null_profile(rows.blanks_to_null(_holes(spark, sf)))


@query(
    f"""WITH h AS ({_HOLES}), k AS (SELECT event_id % 1000 AS key, event_id, props,
          row_number() OVER (PARTITION BY event_id % 1000 ORDER BY event_id) AS rn FROM h),
        n AS (SELECT count(*) AS total, count(*) FILTER (rn = 1) AS firsts,
          count(*) FILTER (rn = 1 AND props IS NOT NULL) AS valid FROM k)
        SELECT 'duplicates' AS step, total - firsts AS removed FROM n
        UNION ALL SELECT 'required columns', firsts - valid FROM n"""
)
def removed_rows(spark, sf):
    """Rows each cleaning step removes, counted while the one job runs."""
    before, firsts, valid = Observation(), Observation(), Observation()
    df = rows.counted(
        _holes(spark, sf).withColumn("key", F.col("event_id") % 1000), before
    )
    first = rows.counted(rows.keep_first(df, ["key"], "event_id"), firsts)
    kept = rows.counted(rows.require(first, ["props"]), valid)
    kept.write.format("noop").mode("overwrite").save()
    n = [o.get["rows"] for o in (before, firsts, valid)]
    removed = F.array(
        F.struct(F.lit("duplicates").alias("step"), F.lit(n[0] - n[1]).cast("bigint").alias("removed")),
        F.struct(F.lit("required columns").alias("step"), F.lit(n[1] - n[2]).cast("bigint").alias("removed")),
    )
    return spark.range(1).select(F.inline(removed))


# --- lists ------------------------------------------------------------------------


def _named_words(spark, sf):
    """Two lists of records per part; the second is empty or NULL for some."""
    named = lambda a: F.transform(a, lambda w: F.struct(w.alias("name")))
    first = named(F.split("p_name", " "))
    second = named(F.split(F.lower("p_type"), "m"))
    none = F.array().cast("array<struct<name:string>>")
    return table(spark, sf, "part").select(
        "p_partkey",
        first.alias("first"),
        F.when(F.col("p_size") % 4 == 0, none)
        .when(F.col("p_size") % 4 == 1, F.lit(None))
        .otherwise(second)
        .alias("second"),
    )


_WORDS = """SELECT p_partkey, string_split(p_name, ' ') AS first,
    CASE WHEN p_size % 4 > 1 THEN string_split(lower(p_type), 'm') END AS second FROM part"""


@query(f"SELECT p_partkey, first[1] AS first_word, second[1] AS second_word FROM ({_WORDS})")
def first_element(spark, sf):
    return _named_words(spark, sf).select(
        "p_partkey",
        text.first_name(F.col("first"), strict=True).alias("first_word"),
        text.first_name(F.col("second")).alias("second_word"),
    )


@query(
    f"""SELECT p_partkey, unnest(CASE WHEN second IS NULL THEN [NULL] ELSE second END) AS word
        FROM ({_WORDS})"""
)
def array_explode_outer(spark, sf):
    df = lists.explode_keep(_named_words(spark, sf).drop("first"), "second", "word")
    return df.select("p_partkey", F.col("word.name").alias("word"))


@query(
    f"""WITH a AS (SELECT p_partkey, second, unnest(first) AS first_word FROM ({_WORDS}))
        SELECT p_partkey, first_word,
          unnest(CASE WHEN second IS NULL THEN [NULL] ELSE second END) AS second_word FROM a"""
)
def list_product(spark, sf):
    df = lists.list_product(_named_words(spark, sf), {"first": "a", "second": "b"})
    return df.select(
        "p_partkey", F.col("a.name").alias("first_word"), F.col("b.name").alias("second_word")
    )


@query(
    """SELECT DISTINCT p_partkey, word FROM (
         SELECT p_partkey, unnest(string_split(p_name || ',' || p_type || ', ,' || p_name, ',')) AS w
         FROM part), LATERAL (SELECT trim(w, ' ') AS word) WHERE word <> ''"""
)
def split_unnest_bridge(spark, sf):
    joined = F.concat_ws(",", "p_name", "p_type", F.lit(" "), "p_name")
    return lists.explode_parts(
        table(spark, sf, "part"), F.transform(F.split(joined, ","), lambda w: F.trim(w)), "word", ["p_partkey"]
    )


# --- text ---------------------------------------------------------------------------


def _clean_sql(c: str) -> str:
    bare = f"regexp_replace(lower({c}), '\\([^)]*\\)', '', 'g')"
    return (
        f"trim(regexp_replace(translate({bare}, '-/,', '   '), '[{SPACE_CLASS}]+', ' ', 'g'), ' ')"
    )


def _key_sql(c: str) -> str:
    return f"trim(regexp_replace(lower({c}), '[^\\p{{L}}\\p{{N}}_{SPACE_CLASS}]', '', 'g'), ' ')"


@query(f"SELECT doc_id, {_clean_sql('text')} AS title FROM documents")
def title_clean(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", text.normalize_title(F.col("text")).alias("title")
    )


@query(
    f"SELECT doc_id, trim(regexp_replace(text, '[{SPACE_CLASS}]+', ' ', 'g'), ' ') AS text FROM documents"
)
def whitespace_collapse(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", text.collapse_spaces(F.col("text")).alias("text")
    )


@query(
    f"""SELECT conv_id, turn,
          trim(regexp_replace(lower(text), '[^\\p{{L}}\\p{{N}}_{SPACE_CLASS}]', '', 'g'),
               chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ' || chr(160)) AS words
        FROM conversations"""
)
def word_characters(spark, sf):
    return table(spark, sf, "conversations").select(
        "conv_id", "turn", geo.country_key(F.col("text")).alias("words")
    )


def _case(column: str, groups: dict[str, list[str]], default: str | None) -> str:
    whens = " ".join(
        "WHEN " + " OR ".join(f"contains({column}, '{w}')" for w in words) + f" THEN '{label}'"
        for label, words in groups.items()
    )
    return f"CASE {whens} ELSE {'NULL' if default is None else repr(default)} END"


# Titles of the workload: part names with a few words around them, page titles, and
# whole documents.
_PAGE_TITLE = "regexp_extract(html, '(?s)<title>(.*?)</title>', 1)"


def _titles(spark, sf):
    key = F.col("p_partkey")
    prefix = (
        F.when(key % 8 == 0, "Senior Data Analyst (GEM) ")
        .when(key % 8 == 1, "Sr-")
        .when(key % 8 == 2, "Graduate/Trainee, ")
        .when(key % 8 == 3, "IT Manager ")
        .when(key % 8 == 4, "Helpdsk ")
        .when(key % 8 == 5, "Lead\tStatistcs\n")
        .otherwise("")
    )
    parts = table(spark, sf, "part").select(
        F.lit("part").alias("kind"), key.alias("id"), F.concat(prefix, "p_name").alias("title")
    )
    pages = table(spark, sf, "pages").select(
        F.lit("page").alias("kind"),
        F.col("page_id").alias("id"),
        F.regexp_extract("html", "(?s)<title>(.*?)</title>", 1).alias("title"),
    )
    return parts.unionByName(pages).withColumn("title", text.normalize_title(F.col("title")))


_TITLES = f"""SELECT 'part' AS kind, p_partkey AS id, {_clean_sql('''(CASE p_partkey % 8
      WHEN 0 THEN 'Senior Data Analyst (GEM) ' WHEN 1 THEN 'Sr-' WHEN 2 THEN 'Graduate/Trainee, '
      WHEN 3 THEN 'IT Manager ' WHEN 4 THEN 'Helpdsk '
      WHEN 5 THEN 'Lead' || chr(9) || 'Statistcs' || chr(10) ELSE '' END || p_name)''')} AS title
    FROM part
  UNION ALL SELECT 'page', page_id, {_clean_sql(_PAGE_TITLE)} FROM pages"""


@query(
    f"""SELECT kind, id, title, {_case('lower(title)', titles.LEVEL_KEYWORDS, titles.DEFAULT_LEVEL)} AS level
        FROM ({_TITLES})"""
)
def title_level(spark, sf):
    return _titles(spark, sf).withColumn("level", titles.level(F.col("title")))


@query(
    f"""SELECT doc_id, {_case('title', titles.LEVEL_KEYWORDS, titles.DEFAULT_LEVEL)} AS level,
          {_case('title', titles.CATEGORY_KEYWORDS, None)} AS category
        FROM (SELECT doc_id, {_clean_sql('text')} AS title FROM documents)"""
)
def title_category_keywords(spark, sf):
    title = F.col("title")
    return (
        table(spark, sf, "documents")
        .select("doc_id", text.normalize_title(F.col("text")).alias("title"))
        .select(
            "doc_id",
            titles.level(title).alias("level"),
            titles.keyword_category(title).alias("category"),
        )
    )


def _fuzzy_sql() -> str:
    """Best window score of every distinct open title and keyword, by a dynamic
    programme of its own: one bit per keyword position."""
    pairs = [(w, c) for c, words in titles.CATEGORY_KEYWORDS.items() for w in words]
    values = ", ".join(f"({i}, '{w}', '{c}')" for i, (w, c) in enumerate(pairs))
    return f"""
    WITH t AS ({_TITLES}),
    named AS (SELECT *, {_case('title', titles.CATEGORY_KEYWORDS, None)} AS settled FROM t),
    open AS (SELECT DISTINCT title FROM named WHERE settled IS NULL AND title <> ''),
    kw(pos, word, label) AS (VALUES {values}),
    pair AS (SELECT title, pos, word, label,
        CASE WHEN length(title) < length(word) THEN title ELSE word END AS a,
        CASE WHEN length(title) < length(word) THEN word ELSE title END AS b FROM open, kw
      UNION ALL SELECT title, pos, word, label, title, word FROM open, kw
        WHERE length(title) = length(word)),
    win AS (SELECT title, pos, label, a, length(a) AS m,
        substr(b, greatest(s, 1), least(s + length(a) - 1, length(b)) - greatest(s, 1) + 1) AS w
      FROM pair, LATERAL unnest(range(2 - length(a), length(b) + 1)) AS u(s)),
    lcs AS (SELECT title, pos, label, 200.0 * (m - bit_count(list_reduce(
          list_prepend((1::BIGINT << m) - 1, list_transform(string_split(w, ''), lambda ch:
            list_sum(list_transform(range(0, m), lambda i:
              CASE WHEN substr(a, (i + 1)::BIGINT, 1) = ch THEN 1::BIGINT << i ELSE 0 END))::BIGINT)),
          lambda s, h: ((s + (s & h)) | (s - (s & h))) & ((1::BIGINT << m) - 1))))
          / (m + length(w)) AS score FROM (SELECT DISTINCT * FROM win)),
    best AS (SELECT title, pos, label, max(score) AS score FROM lcs GROUP BY ALL),
    picked AS (SELECT title, arg_max(label, (score, -pos)) AS label, max(score) AS score
      FROM best GROUP BY title)
    SELECT kind, id, coalesce(settled,
        CASE WHEN score >= {titles.FUZZY_THRESHOLD} THEN label END,
        '{titles.DEFAULT_CATEGORY}') AS category
    FROM named LEFT JOIN picked USING (title)"""


@query(_fuzzy_sql())
def title_category(spark, sf):
    return titles.with_category(_titles(spark, sf), "title", "category").drop("title")


# --- places ------------------------------------------------------------------------

# Country texts that occur in the workload and the codes they have.
_COUNTRIES = """(VALUES ('germany', 'DE'), ('singapore', 'SG'), ('canada', 'CA'), ('uk', 'GB'),
  ('turkey', 'TR'), ('brazil', 'BR'), ('hong kong', 'HK'), ('us', 'US'), ('usa', 'US'),
  ('840', 'US'), ('de', 'DE'), ('united states of america', 'US')) AS k(alias, code)"""

_PICK = """CASE ({0}) % 16 WHEN 0 THEN 'Austin, TX' WHEN 1 THEN 'Berlin, Germany'
  WHEN 2 THEN 'Flexible / Remote' WHEN 3 THEN 'Singapore' WHEN 4 THEN ' Canada '
  WHEN 5 THEN c_name WHEN 6 THEN n_name || ', ' || r_name WHEN 7 THEN 'NYC, NY'
  WHEN 8 THEN 'London, UK' WHEN 9 THEN 'Istanbul, Turkey' WHEN 10 THEN '  ' WHEN 11 THEN NULL
  WHEN 12 THEN 'Berlin, DE' WHEN 13 THEN n_name || ', X, ' || r_name
  WHEN 14 THEN 'São Paulo, Brazil' ELSE 'Hong Kong' END"""

_CUSTOMER = """customer JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey"""

_STATES = ", ".join(f"'{c}'" for c in geo.US_SUBDIVISIONS.values())


def _customers(spark, sf):
    return (
        table(spark, sf, "customer")
        .join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )


@query(
    f"""SELECT c_custkey, given, code FROM (SELECT c_custkey, CASE c_custkey % 9
          WHEN 0 THEN 'Germany' WHEN 1 THEN 'U.S.A.' WHEN 2 THEN 'UK' WHEN 3 THEN n_name
          WHEN 4 THEN ' Hong Kong ' WHEN 5 THEN 'Turkey' WHEN 6 THEN NULL WHEN 7 THEN '840'
          ELSE 'United States of America!' END AS given FROM {_CUSTOMER})
        LEFT JOIN {_COUNTRIES} ON alias = {_key_sql('given')}"""
)
def country_lookup(spark, sf):
    k = F.col("c_custkey") % 9
    given = F.expr(
        "CASE c_custkey % 9 WHEN 0 THEN 'Germany' WHEN 1 THEN 'U.S.A.' WHEN 2 THEN 'UK' "
        "WHEN 3 THEN n_name WHEN 4 THEN ' Hong Kong ' WHEN 5 THEN 'Turkey' WHEN 6 THEN NULL "
        "WHEN 7 THEN '840' ELSE 'United States of America!' END"
    )
    df = _customers(spark, sf).select("c_custkey", given.alias("given")).where(k.isNotNull())
    return df.withColumn("code", geo.normalize_country(F.col("given"), geo.country_map(spark)))


_FREE_TEXT_SQL = f"""
  WITH given AS (SELECT c_custkey, trim(unnest([{_PICK.format('c_custkey')},
      {_PICK.format('c_custkey // 16')}]), ' ') AS name FROM {_CUSTOMER}),
  parts AS (SELECT c_custkey, name, string_split(name, ',') AS p FROM given WHERE name <> ''),
  named AS (SELECT c_custkey, name, len(p) AS n, trim(p[1], ' ') AS town,
      trim(p[2], ' ') AS area, k.code AS whole FROM parts
    LEFT JOIN {_COUNTRIES} ON k.alias = {_key_sql('name')}),
  known AS (SELECT named.*, k.code AS area_code FROM named
    LEFT JOIN {_COUNTRIES} ON k.alias = {_key_sql('area')})
  SELECT c_custkey,
    CASE WHEN contains(lower(name), 'remote') THEN 'Flexible/Remote' WHEN whole IS NOT NULL THEN whole
      WHEN n <> 2 THEN NULL WHEN area IN ({_STATES}) THEN 'US' ELSE coalesce(area_code, area)
      END AS country_code,
    CASE WHEN contains(lower(name), 'remote') THEN 'Flexible/Remote'
      WHEN whole IS NULL AND n = 2 AND area IN ({_STATES}) THEN 'US-' || area END AS subdivision_code,
    CASE WHEN contains(lower(name), 'remote') THEN 'Flexible/Remote'
      WHEN whole IS NOT NULL THEN CASE WHEN whole IN ('SG', 'HK', 'MC', 'VA', 'MO') THEN name END
      WHEN n <> 2 THEN name WHEN lower(town) IN ('nyc', 'new york') THEN 'New York City'
      ELSE town END AS city
  FROM known"""


@query(_FREE_TEXT_SQL)
def free_text_locations(spark, sf):
    given = F.expr(
        f"array(named_struct('name', {_PICK.format('c_custkey')}), "
        f"named_struct('name', {_PICK.format('c_custkey div 16')}))"
    )
    geo.country_map(spark)
    places = _customers(spark, sf).select(
        "c_custkey", geo.places_from_names(given).alias("places")
    )
    return places.select("c_custkey", F.inline("places"))


_AREA = """CASE s_suppkey % 9 WHEN 0 THEN {0}('US', 'Texas', 'Taylor County', n_name)
  WHEN 1 THEN {0}('US', 'New York', 'New York') WHEN 2 THEN {0}('UK', 'London')
  WHEN 3 THEN {0}('US', 'NY', 'Albany') WHEN 4 THEN {0}(r_name, n_name)
  WHEN 5 THEN {0}('Germany', 'Berlin', 'Mitte District', 'NYC') WHEN 6 THEN {0}('US')
  WHEN 7 THEN {0}('US', 'Kansas', 'Johnson County', 'Lenexa')
  ELSE {0}('US', 'Texas', 'Dallas', 'Texas', 'Other county') END"""

_STATE_NAMES = ", ".join(f"('{n}', '{c}')" for n, c in geo.US_SUBDIVISIONS.items())


@query(
    f"""WITH given AS (SELECT s_suppkey, {_AREA.format('list_value')} AS area FROM supplier
          JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
        found AS (SELECT *, list_filter(area[2:], lambda x: NOT contains(lower(x), 'county')
          AND NOT contains(lower(x), 'district') AND x <> area[1] AND x <> area[2]) AS towns FROM given)
        SELECT s_suppkey, code AS country_code, CASE WHEN st.abbr IS NOT NULL THEN 'US-' || st.abbr
            WHEN regexp_full_match(area[2], '[A-Z]{{2}}') THEN 'US-' || area[2] END AS subdivision_code,
          CASE WHEN lower(towns[-1]) IN ('nyc', 'new york') THEN 'New York City' ELSE towns[-1] END AS city
        FROM found LEFT JOIN {_COUNTRIES} ON alias = lower(area[1])
        LEFT JOIN (VALUES {_STATE_NAMES}) AS st(full_name, abbr) ON full_name = area[2]"""
)
def area_path_location(spark, sf):
    geo.country_map(spark)
    given = (
        table(spark, sf, "supplier")
        .join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("s_suppkey", F.expr(_AREA.format("array")).alias("area"))
    )
    return given.select("s_suppkey", F.inline(geo.places_from_area(F.col("area"))))


# --- casts and nested access ----------------------------------------------------------

_JUNK = "CASE WHEN event_id % 6 = 0 THEN 'n/a' WHEN event_id % 6 = 1 THEN NULL ELSE {0} END"


@query(
    f"""SELECT event_id, TRY_CAST({_JUNK.format("CAST(value AS VARCHAR)")} AS DOUBLE) AS number,
          CAST(epoch_us(TRY_CAST({_JUNK.format("strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ')")}
            AS TIMESTAMPTZ)) AS BIGINT) AS moment,
          CAST(event_id AS BIGINT) AS id
        FROM events"""
)
def lenient_casts(spark, sf):
    junk = lambda c: F.expr(_JUNK.format(c))
    iso = "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'\")"
    return table(spark, sf, "events").select(
        "event_id",
        text.parse_number(junk("CAST(value AS STRING)")).alias("number"),
        F.unix_micros(text.parse_timestamp(junk(iso))).alias("moment"),
        text.strict_id(F.col("event_id").cast("string")).alias("id"),
    )


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_field(spark, sf):
    props = F.from_json("props", "k BIGINT")
    return table(spark, sf, "events").select("event_id", props["k"].alias("k"))


# --- whole cleaning jobs -----------------------------------------------------------------
# Jobs from orders, advertisements from line items, companies from suppliers, each with
# repeated ids, blanks and holes.

_ORDER_PICK = _PICK.replace("c_name", "o_orderpriority")


@query(
    f"""WITH src AS (SELECT o_orderkey // 2 AS job_id, o_custkey AS company_id, o_orderkey,
          chr(9) || o_orderpriority || ' ' || o_orderstatus || chr(10) AS job_name,
          CASE o_orderstatus WHEN 'F' THEN 'Senior Level' WHEN 'O' THEN '' ELSE 'Mid Level' END AS level,
          CASE WHEN o_orderkey % 10 = 0 THEN 'soon' ELSE strftime(o_orderdate, '%Y-%m-%dT00:00:00Z') END AS d,
          o_orderkey % 16 AS pick,
          CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderpriority END AS categories,
          row_number() OVER (PARTITION BY o_orderkey // 2 ORDER BY o_orderkey) AS rn FROM orders)
        SELECT job_id, company_id, trim(job_name, chr(9) || chr(10)) AS job_name,
          nullif(level, '') AS level,
          CAST(epoch_us(TRY_CAST(d AS TIMESTAMPTZ)) AS BIGINT) AS publication_us,
          categories, CASE pick WHEN 0 THEN 'US|US-TX|Austin' WHEN 1 THEN 'DE|-|Berlin'
            WHEN 2 THEN 'Flexible/Remote|Flexible/Remote|Flexible/Remote' WHEN 3 THEN 'SG|-|Singapore'
            WHEN 4 THEN 'CA|-|-' ELSE 'GB|-|London' END AS place
        FROM src WHERE rn = 1 AND pick NOT IN (6, 7)"""
)
def clean_jobs(spark, sf):
    key = F.col("o_orderkey")
    pick = F.expr(
        "CASE o_orderkey % 16 WHEN 0 THEN 'Austin, TX' WHEN 1 THEN 'Berlin, Germany' "
        "WHEN 2 THEN 'Remote' WHEN 3 THEN 'Singapore' WHEN 4 THEN 'Canada' WHEN 6 THEN ' ' "
        "ELSE 'London, UK' END"
    )
    named = F.array(F.struct(pick.alias("name")))
    none = F.array().cast("array<struct<name:string>>")
    geo.country_map(spark)
    records = table(spark, sf, "orders").select(
        F.floor(key / 2).cast("string").alias("job_id"),
        F.col("o_custkey").cast("string").alias("company_id"),
        F.concat(F.lit("\t"), "o_orderpriority", F.lit(" "), "o_orderstatus", F.lit("\n")).alias("job_name"),
        F.expr(
            "CASE o_orderstatus WHEN 'F' THEN 'Senior Level' WHEN 'O' THEN '' ELSE 'Mid Level' END"
        ).alias("level"),
        F.when(key % 10 == 0, "soon")
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .alias("publication_date"),
        F.when(key % 16 == 7, none).otherwise(named).alias("locations"),
        F.when(key % 3 == 0, none)
        .otherwise(F.array(F.struct(F.col("o_orderpriority").alias("name")), F.struct(F.lit("x").alias("name"))))
        .alias("categories"),
        key.alias("_order"),
    )
    place = F.get("locations", F.lit(0))
    fields = [F.coalesce(place[c], F.lit("-")) for c in ("country_code", "subdivision_code", "city")]
    return cleaning.clean_jobs(records, order="_order").select(
        "job_id", "company_id", "job_name", "level",
        F.unix_micros("publication_date").alias("publication_us"),
        "categories", F.concat_ws("|", *fields).alias("place"),
    )


@query(
    """WITH src AS (SELECT s_suppkey // 2 AS company_id, s_suppkey, nullif(CASE WHEN s_suppkey % 5 < 2
          THEN '' ELSE s_name END, '') AS company_name,
          CASE WHEN s_suppkey % 3 = 0 THEN 'text of ' || s_name END AS description,
          CASE WHEN s_nationkey % 3 = 0 THEN NULL ELSE n_name END AS size,
          CASE WHEN s_suppkey % 4 < 2 THEN n_name || '|' || r_name END AS place,
          CASE WHEN s_nationkey % 2 = 0 THEN epoch_us(TIMESTAMP '2024-01-01 10:00:00' + to_days(s_nationkey))
            END AS publication_us, CASE WHEN s_nationkey % 4 < 2 THEN n_name END AS industry,
          row_number() OVER (PARTITION BY s_suppkey // 2 ORDER BY s_suppkey) AS rn
          FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
        SELECT company_id, company_name, description, size, place, publication_us, industry
        FROM src WHERE rn = 1"""
)
def clean_companies(spark, sf):
    key = F.col("s_suppkey")
    none = F.array().cast("array<struct<name:string>>")
    geo.country_map(spark)
    records = (
        table(spark, sf, "supplier")
        .join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.floor(key / 2).cast("string").alias("company_id"),
            F.when(key % 5 < 2, "").otherwise(F.col("s_name")).alias("company_name"),
            F.when(key % 3 == 0, F.concat(F.lit(" text of \n\t"), "s_name", F.lit("\r\n")))
            .when(key % 3 == 1, "  ")
            .alias("description"),
            F.when(
                F.col("s_nationkey") % 2 == 0,
                F.concat(F.date_add(F.lit("2024-01-01").cast("date"), F.col("s_nationkey")).cast("string"), F.lit("T10:00:00Z")),
            )
            .otherwise("2024-02-30T00:00:00Z")
            .alias("publication_date"),
            F.when(F.col("s_nationkey") % 3 == 0, "").otherwise(F.col("n_name")).alias("size"),
            F.when(
                key % 4 < 2, F.array(F.struct(F.concat_ws(", ", "n_name", "r_name").alias("name")))
            ).otherwise(none).alias("locations"),
            F.when(F.col("s_nationkey") % 4 < 2, F.array(F.struct(F.col("n_name").alias("name"))))
            .otherwise(none)
            .alias("industries"),
            key.alias("_order"),
        )
    )
    place = F.get("locations", F.lit(0))
    return cleaning.clean_companies(records, order="_order").select(
        "company_id", "company_name", "description", "size",
        F.concat(place["city"], F.lit("|"), place["country_code"]).alias("place"),
        F.unix_micros("publication_date").alias("publication_us"),
        F.get("industries", F.lit(0))["name"].alias("industry"),
    )


@query(
    f"""WITH src AS (SELECT l_orderkey AS id, l_linenumber, l_partkey, l_suppkey, l_shipdate,
          CASE WHEN l_linenumber = 3 THEN '' ELSE 'Company ' || l_suppkey END AS company_name,
          CASE l_partkey % 6 WHEN 0 THEN 'Internal Auditor (m/f)' WHEN 1 THEN 'Senior Data-Engineer'
            WHEN 2 THEN 'Statistcs' WHEN 3 THEN 'IT Manager' WHEN 4 THEN 'Helpdsk' ELSE 'Zzz' END AS title,
          CASE WHEN l_suppkey % 10 = 0 THEN NULL ELSE l_extendedprice END AS low,
          l_extendedprice + 1000 AS high,
          row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey,
            l_extendedprice) AS rn FROM lineitem)
        SELECT id AS adz_job_id, company_name, title AS adz_job_name, low AS salary_min,
          high AS salary_max, CASE title WHEN 'Internal Auditor (m/f)' THEN 'Software Engineering'
            WHEN 'Senior Data-Engineer' THEN 'Data and Analytics' WHEN 'Statistcs' THEN 'Data and Analytics'
            WHEN 'IT Manager' THEN 'Computer and IT' WHEN 'Helpdsk' THEN 'Computer and IT'
            ELSE 'Software Engineering' END AS categories,
          CASE title WHEN 'Internal Auditor (m/f)' THEN 'Internship' WHEN 'Senior Data-Engineer'
            THEN 'Senior Level' WHEN 'IT Manager' THEN 'Senior Level' ELSE 'Mid Level' END AS level,
          CASE WHEN l_partkey % 2 = 0 THEN 'US-TX' END AS subdivision,
          CASE WHEN l_partkey % 2 = 0 THEN 'US' ELSE 'DE' END AS country,
          CASE WHEN l_partkey % 2 = 0 THEN 'Dallas' END AS city, 'IT Jobs' AS adz_category,
          CAST(0 AS INTEGER) AS salary_is_predicted, epoch_us(l_shipdate) AS publication_us
        FROM src WHERE rn = 1 AND low IS NOT NULL AND company_name <> ''"""
)
def clean_salaries(spark, sf):
    part, supp = F.col("l_partkey"), F.col("l_suppkey")
    geo.country_map(spark)
    title = F.expr(
        "CASE l_partkey % 6 WHEN 0 THEN 'Internal Auditor (m/f)' WHEN 1 THEN 'Senior Data-Engineer' "
        "WHEN 2 THEN 'Statistcs' WHEN 3 THEN 'IT Manager' WHEN 4 THEN 'Helpdsk' ELSE 'Zzz' END"
    )
    records = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("adz_job_id"),
        F.when(F.col("l_linenumber") == 3, "")
        .otherwise(F.concat(F.lit("Company "), supp.cast("string")))
        .alias("company_name"),
        title.alias("adz_job_name"),
        F.lit("IT Jobs").alias("adz_category"),
        F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("publication_date"),
        F.when(part % 2 == 0, F.expr("array('US', 'Texas', 'Dallas')"))
        .otherwise(F.expr("array('Germany', 'Berlin')"))
        .alias("locations"),
        F.when(supp % 10 == 0, "n/a")
        .otherwise(F.col("l_extendedprice").cast("string"))
        .alias("salary_min"),
        (F.col("l_extendedprice") + 1000).cast("string").alias("salary_max"),
        F.lit("0").alias("salary_is_predicted"),
        F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice").alias("_order"),
    )
    return cleaning.clean_salaries(records, order="_order").select(
        "adz_job_id", "company_name", "adz_job_name", "salary_min", "salary_max",
        "categories", "level", F.get("locations", F.lit(0))["subdivision_code"].alias("subdivision"),
        F.get("locations", F.lit(0))["country_code"].alias("country"),
        F.get("locations", F.lit(0))["city"].alias("city"),
        "adz_category", "salary_is_predicted",
        F.unix_micros("publication_date").alias("publication_us"),
    )
