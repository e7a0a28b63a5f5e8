"""The registered queries of this package: thin digests of the operators' results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobgrain.llm import annsearch, chatformat, collocation, decontaminate, htmlextract
from jobgrain.llm import linededup, lmscore, mixing, secretscan, similarjoin, tokenalign
from jobgrain.llm import tokencount, toxicity
from jobgrain.llm.shared import table

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            SQL[fn.__name__] = sql
        return fn

    return add


def prepared(spark: SparkSession) -> SparkSession:
    """Bound the bytes of the batches that go to Python."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))
    return spark


_WORDS = (
    "regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
)
DECONTAMINATE_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce({_WORDS.format('text')}, []) AS w FROM documents
), i AS (
  SELECT item_id, {_WORDS.format('text')} AS w FROM benchmark WHERE item_id IS NOT NULL
), p AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS n,
    array_to_string(w[k:k + least(13, len(w)) - 1], ' ') AS window_words
  FROM i, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS s(k) WHERE len(w) > 0
), s AS (
  SELECT r, n, k, array_to_string(w[k:k + n - 1], ' ') AS window_words
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, (SELECT DISTINCT n FROM p))
), h AS (
  SELECT r, n, k, item_id FROM s JOIN p USING (n, window_words)
), c AS (
  SELECT r, count(DISTINCT place) AS n_hit FROM (SELECT r, unnest(range(k, k + n)) AS place FROM h) GROUP BY r
), t AS (
  SELECT r, count(DISTINCT item_id) AS n_items,
    string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items FROM h GROUP BY r
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN c USING (r) LEFT JOIN t USING (r)
"""


@query(DECONTAMINATE_SQL)
def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_passages(docs, table(spark, sf_dir, "benchmark"))
    r = F.col("found")
    items = F.array_join(F.array_sort(F.transform(r["items"], lambda i: i.cast("string"))), ",")
    return found.select(
        "doc_id",
        r["n_words"].alias("n_words"),
        decontaminate.hit_words(r).alias("n_hit"),
        F.size(r["items"]).cast("long").alias("n_items"),
        F.sha2(items, 256).alias("items_sha256"),
        decontaminate.contaminated(r).alias("contaminated"),
    )


def _either_case(pattern: str) -> str:
    """`(?i:...)` spelled out: another engine's flag also folds letters beyond ASCII."""
    before, sign, rest = pattern.partition("(?i:")
    if not sign:
        return pattern
    depth, end = 1, 0
    while depth:
        depth += {"(": 1, ")": -1}.get(rest[end], 0)
        end += 1
    letters = "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in rest[: end - 1])
    return before + letters + rest[end:]


def _spans_sql(number: int, kind: str, pattern: str, group: int, least: int) -> str:
    """Spans of one rule: what lies before a match are the pieces between matches and the
    matches before it."""
    quoted = _either_case(pattern).replace("'", "''")
    return f"""
  SELECT r, {number} AS rule, '{kind}' AS kind,
    CAST(list_sum(list_transform(p[1:k], lambda x: length(x)))
      + coalesce(list_sum(list_transform(m[1:k - 1], lambda x: length(x))), 0) AS BIGINT) AS first,
    length(m[k]) AS size
  FROM (SELECT r, m, g, string_split_regex(text, '{quoted}') AS p, unnest(range(1, len(m) + 1)) AS k
    FROM (SELECT r, text, regexp_extract_all(text, '{quoted}') AS m,
      regexp_extract_all(text, '{quoted}', {group}) AS g FROM d))
  WHERE length(g[k]) >= {least}"""


SECRET_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
s AS ({" UNION ALL ".join(_spans_sql(k, *rule) for k, rule in enumerate(secretscan.RULES))}),
j AS (
  SELECT r, count(*) FILTER (rule = 0) AS n_assign, count(*) FILTER (rule = 1) AS n_access,
    count(*) FILTER (rule = 2) AS n_hex,
    string_agg(kind || ':' || first || ':' || (first + size), ',' ORDER BY first, rule) FILTER (rule < 3) AS base,
    string_agg(kind || ':' || first || ':' || (first + size), ',' ORDER BY first, rule) AS spans
  FROM s GROUP BY r
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN j USING (r)
"""


@query(SECRET_SQL)
def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    spans = F.col("found")["spans"]
    kinds = [rule[0] for rule in secretscan.BASE_RULES]
    base = F.filter(spans, lambda s: s["kind"].isin(kinds))

    def count(kind):
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return secretscan.find_secrets(docs).select(
        "doc_id",
        *map(count, kinds),
        F.sha2(secretscan.spans_text(base), 256).alias("base_sha256"),
        secretscan.spans_text(spans).alias("spans"),
    )


MIX_SQL = """
WITH d AS (
  SELECT doc_id, coalesce('0' || source, '1') AS src,
    coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS size,
    md5(concat_ws('|', CAST(doc_id AS VARCHAR), text)) AS digest
  FROM documents
), s AS (
  SELECT src, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY src) AS rank
  FROM d GROUP BY src
), w AS (
  SELECT src, source_size, 2 * source_size AS cap, [3, 1, 2][1 + (rank - 1) % 3] AS weight FROM s
), r AS (
  SELECT *, cap / CAST(weight AS DOUBLE) AS ratio FROM w
), f AS (
  SELECT *, row_number() OVER o AS place,
    (1.5 * sum(source_size) OVER () - (sum(cap) OVER o - cap))
      / CAST(sum(weight) OVER () - (sum(weight) OVER o - weight) AS DOUBLE) AS level
  FROM r WINDOW o AS (ORDER BY ratio, src ROWS UNBOUNDED PRECEDING)
), t AS (
  SELECT src, source_size, coalesce(least(CAST(cap AS DOUBLE), weight
    * (SELECT arg_min(level, place) FROM f WHERE level <= ratio)), CAST(cap AS DOUBLE)) AS target
  FROM f
), q AS (
  SELECT *, sum(size) OVER (PARTITION BY src ORDER BY digest, size ROWS UNBOUNDED PRECEDING) AS words
  FROM d JOIN t USING (src)
), c AS (
  SELECT *, CASE WHEN target > 0 THEN (words + turn * source_size) / target ELSE 0 END AS finish
  FROM q, (VALUES (0), (1)) AS turns(turn)
), g AS (
  SELECT *, sum(size) OVER (ORDER BY finish, src, digest, size, turn ROWS UNBOUNDED PRECEDING) AS total
  FROM c
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
  CAST(sum(CASE WHEN total <= 1.5 * (SELECT sum(size) FROM d) THEN size ELSE 0 END) AS BIGINT) AS taken
FROM g GROUP BY doc_id, src, digest, size, source_size, target
"""


@query(MIX_SQL)
def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared(spark)
    return mixing.mix(table(spark, sf_dir, "documents"))


@query()
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id",
        (toxicity.fold(F.col("doc_id")) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query()
def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared(spark)
    docs = table(spark, sf_dir, "documents")
    found = similarjoin.similar_documents(docs)
    return found.select("doc_id", "class_id", "n_links", "n_copies")


@query()
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return tokencount.count_tokens(docs).select("doc_id", "counted.n_pretokens", "counted.n_tokens")


@query()
def op5_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lmscore.score_documents(docs, table(spark, sf_dir, "labels"))


CHAT_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT -1, turn, role, '<|im_end|><|im_start|>assistant ok'
  FROM (VALUES (0, 'user'), (1, 'assistant')) AS added(turn, role)
), e AS (
  SELECT *, replace(replace(regexp_replace(role, '<(\\*)\|', '<\\\1|', 'g'), '\', '\\'), chr(10), '\n') AS line,
    regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g') AS safe
  FROM c
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(12 + length(line) + 1 + length(safe) + 10 + 1) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""


@query(CHAT_SQL)
def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared(spark)
    said = "<|im_end|><|im_start|>assistant ok"
    added = spark.range(2).selectExpr(
        "-1L AS conv_id", "id AS turn", "if(id = 0, 'user', 'assistant') AS role", f"'{said}' AS text"
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chatformat.read_back(chatformat.format_conversations(turns.unionByName(added)))


@query()
def op7_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared(spark)
    found = annsearch.nearest_neighbours(
        table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20
    )
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


@query()
def op9_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared(spark)
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = htmlextract.extract_main_text(pages, htmlextract.train(pages))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query()
def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return tokenalign.align_tokens(docs).select("doc_id", "aligned.*")


PHRASES_SQL = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), w AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p
), g AS (
  SELECT lang, size, phrase, count(*) AS f FROM (
    SELECT lang, size, unnest(list_transform(range(1, len(w) - size + 2),
      lambda k: array_to_string(w[k:k + size - 1], ' '))) AS phrase
    FROM w, (VALUES (1), (2), (3), (4)) AS sizes(size)
  ) GROUP BY ALL
), t AS (
  SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM g WHERE size = 1 GROUP BY lang
), c AS (
  SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM g WHERE size > 1 AND f >= 30
), s AS (
  SELECT c.lang, c.phrase, a, cut, l.f AS l, r.f AS r,
    CAST((CAST(a AS HUGEINT) * 2000000) // (CAST(l.f AS HUGEINT) + r.f) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, size)) AS cut FROM c) AS c
  JOIN g AS l ON l.lang = c.lang AND l.size = cut AND l.phrase = array_to_string(w[1:cut], ' ')
  JOIN g AS r ON r.lang = c.lang AND r.size = c.size - cut AND r.phrase = array_to_string(w[cut + 1:], ' ')
), m AS (
  SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), i AS (
  SELECT lang, array_to_string(w[k:k + inner_size - 1], ' ') AS phrase, max(a) AS longer
  FROM (SELECT *, unnest(range(1, size - inner_size + 2)) AS k
    FROM c, (VALUES (2), (3)) AS inner_sizes(inner_size) WHERE inner_size < size)
  GROUP BY ALL
), b AS (
  SELECT m.* FROM m LEFT JOIN i USING (lang, phrase)
  WHERE longer IS NULL OR CAST(longer AS HUGEINT) * 100 < CAST(a AS HUGEINT) * 80
)
SELECT lang, row_number() OVER o AS rank, phrase, a, l, r, n, score
FROM b JOIN t USING (lang)
WINDOW o AS (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)
QUALIFY rank <= 2000
"""


@query(PHRASES_SQL)
def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared(spark)
    return collocation.mine_phrases(table(spark, sf_dir, "documents").select("text", "lang"))


LINES_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
l AS (
  SELECT r, doc_id, generate_subscripts(lines, 1) AS place, unnest(lines) AS line
  FROM (SELECT r, doc_id, string_split(text, chr(10)) AS lines FROM d)
), k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
), h AS (
  SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) + max(CASE WHEN doc_id IS NULL THEN 1 ELSE 0 END) >= 3
), j AS (
  SELECT r, doc_id, place, line, h.key IS NOT NULL AND doc_id IS DISTINCT FROM keeper AS lost
  FROM k LEFT JOIN h USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (lost) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT lost), '')) AS kept_sha256
FROM j GROUP BY r, doc_id
"""


@query(LINES_SQL)
def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = F.sha2(F.col("lines")["kept"], 256).alias("kept_sha256")
    return linededup.drop_repeated_lines(docs).select("doc_id", "lines.n_lines", "lines.n_dropped", kept)
