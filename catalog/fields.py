"""Field parsers on phrases that are built from columns of the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import SQL_SECOND, Registry, second_text, table
from voxspark.functions import parsers as P, text as X
from voxspark.operators import relational as R

Q = Registry()

_UNITS_PT = ("ano", "mês", "semana", "dia", "hora", "minuto", "segundo")
_PLURAL_PT = ("anos", "meses", "semanas", "dias", "horas", "minutos", "segundos")


def _pick(words: tuple, index) -> F.Column:
    return F.element_at(F.array(*[F.lit(w) for w in words]), index.cast("int") + 1)


@Q.add("relative_dates", f"""
WITH e AS (SELECT event_id, ts, event_id % 7 AS u, (event_id // 7) % 13 AS n FROM events)
SELECT event_id, CASE WHEN n = 0 THEN NULL ELSE strftime(CASE u
    WHEN 0 THEN ts - to_years(n::INT) WHEN 1 THEN ts - to_months(n::INT) WHEN 2 THEN ts - to_days((7 * n)::INT)
    WHEN 3 THEN ts - to_days(n::INT) WHEN 4 THEN ts - to_hours(n) WHEN 5 THEN ts - to_minutes(n)
    ELSE ts - to_seconds(n::DOUBLE) END, {SQL_SECOND}) END AS review_date FROM e""")
def relative_dates(spark, sf):
    """Portuguese phrases; n = 0 gives an empty phrase, n = 1 the word form."""
    unit, n = F.col("event_id") % 7, F.floor(F.col("event_id") / 7) % 13
    article = F.when(unit.isin(2, 4), "uma ").otherwise("um ")
    phrase = (
        F.when(n == 0, "")
        .when(n == 1, F.concat(article, _pick(_UNITS_PT, unit), F.lit(" atrás")))
        .otherwise(F.concat(n.cast("string"), F.lit(" "), _pick(_PLURAL_PT, unit), F.lit(" atrás")))
    )
    events = table(spark, sf, "events").select("event_id", "ts", phrase.alias("phrase"))
    return events.select("event_id", second_text(P.relative_date("phrase", "ts")).alias("review_date"))


@Q.add("relative_dates_by_language", f"""
SELECT o_orderkey, strftime(CASE WHEN o_orderkey % 2 = 0 THEN o_orderdate - to_hours(1)
  ELSE o_orderdate - to_months(1) END, {SQL_SECOND}) AS seen FROM orders""")
def relative_dates_by_language(spark, sf):
    even = F.col("o_orderkey") % 2 == 0
    rows = table(spark, sf, "orders").withColumns({
        "phrase": F.when(even, "an hour ago").otherwise("um mês atrás"),
        "hl": F.when(even, "en").otherwise("pt-br"),
    })
    return rows.select("o_orderkey", second_text(P.relative_date("phrase", "o_orderdate", F.col("hl"))).alias("seen"))


@Q.add("translated_texts", """
SELECT doc_id, lang <> 'en' AS is_other_language, md5(regexp_replace(text, '^\\s+|\\s+$', '', 'g')) AS text_md5
FROM documents""")
def translated_texts(spark, sf):
    """Marks are put around every text that is not English."""
    plain = X.strip("text")
    marked = F.when(
        F.col("lang") != "en",
        F.concat(F.lit("(Tradução do Google) "), F.col("text"), F.lit(" (Original) "), F.replace("text", F.lit("\n"), F.lit(" "))),
    ).otherwise(plain)
    docs = table(spark, sf, "documents").select("doc_id", marked.alias("marked"))
    parsed = docs.select("doc_id", P.translated_text("marked").alias("p"))
    return parsed.select("doc_id", "p.is_other_language", F.md5("p.text").alias("text_md5"))


@Q.add("sub_ratings", """
SELECT p_partkey, CASE WHEN p_size % 4 = 0 THEN NULL ELSE (p_size % 5 + 1)::DOUBLE END AS rooms,
  (p_partkey % 5 + 1)::DOUBLE AS locale, CASE WHEN p_size % 3 = 0 THEN NULL ELSE (p_size % 5 + 1)::DOUBLE END AS service,
  p_brand || '|' || p_type || '|' || p_name AS highlights
FROM part""")
def sub_ratings(spark, sf):
    def note(label: str, c: str, keep):
        return F.when(keep, F.concat(F.lit(f"{label} : "), (F.col(c) % 5 + 1).cast("string"), F.lit("/5 "))).otherwise("")

    line = F.concat(
        note("Quartos", "p_size", F.col("p_size") % 4 != 0), note("Local", "p_partkey", F.lit(True)),
        note("Serviço", "p_size", F.col("p_size") % 3 != 0), F.lit("Destaques do hotel "),
        F.col("p_brand"), F.lit(", "), F.col("p_type"), F.lit(" e "), F.col("p_name"),
    )
    parsed = table(spark, sf, "part").select("p_partkey", P.other_ratings(line).alias("r"))
    return parsed.select("p_partkey", "r.rooms", "r.locale", "r.service", F.array_join("r.highlights", "|").alias("highlights"))


@Q.add("topic_strips", """
SELECT p_partkey, p_name || '|' || lower(p_type) || '|''2016' AS names, p_size + 7 + p_partkey % 9 AS total FROM part""")
def topic_strips(spark, sf):
    strip = F.concat(
        F.lit("Todas 0 "), F.col("p_name"), F.lit(" "), F.col("p_size").cast("string"), F.lit(" +6 "),
        F.lower("p_type"), F.lit(" 7 2016 "), (F.col("p_partkey") % 9).cast("string"),
    )
    parsed = table(spark, sf, "part").select("p_partkey", P.topics(strip).alias("t"))
    total = F.aggregate("t.counts", F.lit(0).cast("bigint"), lambda a, b: a + b)
    return parsed.select("p_partkey", F.array_join("t.names", "|").alias("names"), total.alias("total"))


@Q.add("identifiers", """
SELECT c_custkey, lpad(c_custkey::VARCHAR, 21, '1') AS user_id, '0x0:0x' || c_custkey AS feature_id, c_name || ' é' AS place_name,
  lower(c_name) || '-hotel-gm-reviews' AS slug FROM customer""")
def identifiers(spark, sf):
    key = F.col("c_custkey").cast("string")
    rows = table(spark, sf, "customer").select(
        "c_custkey", "c_name",
        F.concat(F.lit("https://www.site/maps/contrib/"), F.lpad(key, 21, "1"), F.lit("?hl=pt-BR")).alias("user_url"),
        F.concat(
            F.lit("https://www.site/maps/place/"), F.url_encode("c_name"), F.lit("+%C3%A9/@-23.9,15z/data=!4m2!1s0x0:0x"), key, F.lit("?sa=X"),
        ).alias("url"),
    )
    return rows.select(
        "c_custkey", P.user_id("user_url").alias("user_id"), P.feature_id("url").alias("feature_id"),
        P.place_name("url").alias("place_name"), P.slug(F.concat(F.lit(" "), F.col("c_name"), F.lit(" Hotel ")), "-gm-reviews").alias("slug"),
    )


@Q.add("page_urls", r"""
SELECT page_id, regexp_extract(url, '^https?://([^/]+)', 1) AS host, regexp_extract(url, '^https?://[^/]+/([^?#]*)', 1) AS path,
  regexp_replace(regexp_replace(url, '\s', ' ', 'g'), '[''"]', '', 'g') AS line FROM pages""")
def page_urls(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id", F.regexp_extract("url", "^https?://([^/]+)", 1).alias("host"),
        F.regexp_extract("url", "^https?://[^/]+/([^?#]*)", 1).alias("path"), X.one_line("url").alias("line"),
    )


@Q.add("localized_numbers", """
SELECT p_partkey, p_size::DOUBLE AS stars, p_retailprice AS price, p_partkey AS n_reviews, (p_size % 5)::DOUBLE + 0.5 AS rating, 5.0::DOUBLE AS rating_max,
  p_size::VARCHAR AS user_reviews, CASE WHEN p_size % 2 = 0 THEN NULL ELSE '1.0' || (p_size % 10) END AS user_photos,
  ceil(p_size / 10)::BIGINT AS pages
FROM part""")
def localized_numbers(spark, sf):
    size, one = F.col("p_size").cast("string"), F.col("p_size") % 2 == 0
    last = (F.col("p_size") % 10).cast("string")
    label = F.concat(F.lit("Classificado como "), (F.col("p_size") % 5).cast("string"), F.lit(",5 de 5,0,"))
    user = F.concat(
        F.lit("Local Guide·"), size, F.lit(" comentários"), F.when(one, "").otherwise(F.concat(F.lit("·1.0"), last, F.lit(" fotos"))),
    )
    grouped = F.replace(F.format_number("p_partkey", 0), F.lit(","), F.lit("."))
    rows = table(spark, sf, "part").select(
        "p_partkey", "p_size", P.stars(F.concat(size, F.lit(" estrelas"))).alias("stars"),
        P.localized_number(F.replace(F.col("p_retailprice").cast("string"), F.lit("."), F.lit(","))).alias("price"),
        P.count_text(F.concat(grouped, F.lit(" comentários"))).alias("n_reviews"),
        P.label_ratings(label).alias("l"), P.user_counts(user).alias("u"),
    )
    return rows.select(
        "p_partkey", "stars", "price", "n_reviews", "l.rating", "l.rating_max",
        F.col("u.reviews").alias("user_reviews"), F.col("u.photos").alias("user_photos"), P.page_count("p_size").alias("pages"),
    )


@Q.add("collected_flags", """
SELECT o_orderkey, CASE WHEN o_custkey % 5 < 2 THEN 0.0 ELSE (o_custkey % 5)::DOUBLE END AS likes,
  CASE WHEN o_orderstatus = 'F' THEN 1.0::DOUBLE ELSE 0.0 END AS local_guide,
  strftime(o_orderdate, '%Y-%m-%d') AS day, (o_orderdate > TIMESTAMP '1999-06-01')::INT::DOUBLE AS recent,
  CASE o_orderstatus WHEN 'O' THEN 'ratingHigh' WHEN 'P' THEN 'qualityScore' ELSE 'newestFirst' END AS sort_order,
  o_orderstatus || '|' || o_orderpriority AS trip_types, left(o_orderpriority, 4) AS short
FROM orders""")
def collected_flags(spark, sf):
    status = F.col("o_orderstatus")
    n = F.col("o_custkey") % 5
    likes = F.when(n == 0, "-1").when(n == 1, None).otherwise(n.cast("string"))
    guide = F.when(status == "F", "True").when(status == "O", "False")
    asked = F.when(status == "O", "highest_rating").when(status == "P", "most_relevant").otherwise("whatever")
    return table(spark, sf, "orders").select(
        "o_orderkey", P.likes(likes).alias("likes"), P.flag_number(guide).alias("local_guide"),
        P.day_text("o_orderdate").alias("day"), P.is_recent("o_orderdate", "1999-06-01").alias("recent"),
        P.sort_order(asked).alias("sort_order"),
        F.array_join(P.trip_types(F.concat(status, F.lit(" | "), F.col("o_orderpriority"))), "|").alias("trip_types"),
        P.truncated("o_orderpriority", 4).alias("short"),
    )


@Q.add("reply_scores", """
SELECT conv_id, round(avg(CASE WHEN length(text) % 3 = 0 THEN NULL ELSE length(text) % 5 + 1 END), 6) AS score_mean,
  count(CASE WHEN length(text) % 3 = 0 THEN NULL ELSE 1 END) AS n_scores, count(*) AS n_replies
FROM conversations GROUP BY conv_id""")
def reply_scores(spark, sf):
    from voxspark.plans import retrieval

    size = F.length("text")
    reply = F.when(size % 3 == 0, "sem nota").otherwise(F.concat(F.lit("Nota: "), (size % 5 + 1).cast("string"), F.lit("/5")))
    scored = retrieval.eval_scores(table(spark, sf, "conversations").select("conv_id", reply.alias("response")))
    return retrieval.mean_scores(scored, ["conv_id"]).withColumn("score_mean", F.round("score_mean", 6))


@Q.add("filter_replies", """
SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN NULL ELSE '{"estrelas": {"$gte": ' || p_size || '}}' END AS filter_json,
  CASE WHEN p_size % 3 = 2 THEN p_brand ELSE p_name END AS asked FROM part WHERE true""")
def filter_replies(spark, sf):
    """Fenced JSON, single quotes, broken JSON and replies without a fence."""
    from voxspark.plans import retrieval

    size = F.col("p_size").cast("string")
    good = F.concat(F.lit("```json {'estrelas': {'$gte': "), size, F.lit("}} ``` "))
    kind = F.col("p_size") % 3
    reply = (
        F.when(kind == 2, F.concat(good, F.col("p_brand"), F.lit(" ")))
        .when(kind == 1, F.concat(good, F.col("p_name")))
        .when(F.col("p_size") % 2 == 0, F.lit("não sei"))
        .otherwise(F.concat(F.lit("```json {broken ``` "), F.col("p_name")))
    )
    rows = table(spark, sf, "part").select("p_partkey", "p_name", reply.alias("reply"))
    return retrieval.parsed_questions(rows, "reply", "p_name").select("p_partkey", "filter_json", "asked")


@Q.add("first_topics", """
SELECT o_orderkey, (CASE greatest(o_orderkey % 3, o_custkey % 3, o_orderkey % 2) WHEN o_orderkey % 3 THEN 0 WHEN o_custkey % 3 THEN 1 ELSE 2 END)::INT AS first_topic
FROM orders""")
def first_topics(spark, sf):
    shares = F.array(F.col("o_orderkey") % 3, F.col("o_custkey") % 3, F.col("o_orderkey") % 2)
    return table(spark, sf, "orders").select("o_orderkey", R.argmax(shares).alias("first_topic"))
