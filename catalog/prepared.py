"""Raw rows to the prepared table, the place report and the index table.

Orders play the reviews and customers the places; every order arrives twice, as
review files do when a place is collected again.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import SQL_SECOND, Registry, second_text, table
from voxspark import schemas as S
from voxspark.operators import joins
from voxspark.plans import prepare
from voxspark.session import settle
from voxspark.sources.readers import raw_reviews

Q = Registry()


def _raw(spark, sf):
    key = F.col("o_orderkey")
    fields = {
        "token": F.lit("t"),
        "review_id": key.cast("string"),
        "retrieval_date": second_text("o_orderdate"),
        "rating": F.concat((key % 5 + 1).cast("string"), F.lit(".0")),
        "rating_max": F.lit("5.0"),
        "relative_date": F.concat((key % 9 + 2).cast("string"), F.lit(" dias atrás")),
        "likes": (key % 4 - 1).cast("string"),
        "other_ratings": F.when(key % 3 == 0, F.concat(F.lit("Quartos : "), (key % 5 + 1).cast("string"), F.lit("/5 Destaques do hotel Luxo e Vista"))).otherwise(""),
        "user_is_local_guide": F.when(key % 2 == 0, "True").otherwise("False"),
        "user_url": F.concat(F.lit("https://x/contrib/"), F.lpad(key.cast("string"), 21, "7"), F.lit("?hl=pt")),
        "text": F.when(key % 7 == 0, "").otherwise(F.concat_ws(" ", "o_orderpriority", *["o_orderstatus"] * 9)),
        "response_text": F.when(key % 11 == 0, "Obrigado").otherwise(""),
        "response_relative_date": F.when(key % 11 == 0, "um dia atrás").otherwise(""),
        "errors": F.lit("[]"),
    }
    rows = table(spark, sf, "orders").select(
        F.col("o_custkey").cast("string").alias("file_name"),
        *[fields.get(c, F.lit("")).alias(c) for c in S.REVIEW_FIELDS],
    )
    again = rows.withColumn("retrieval_date", F.lit("2030-01-01 00:00:00")).withColumn("rating", F.lit("1.0"))
    headers = table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("file_name"), *[F.lit(c).alias(c) for c in S.REVIEW_FIELDS]
    )
    return raw_reviews(rows.unionByName(again).unionByName(headers))


def _joined(spark, sf):
    nation = table(spark, sf, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    customer = joins.lookup_join(table(spark, sf, "customer"), nation, "c_nationkey")
    key = F.col("c_custkey").cast("string")
    url = F.concat(F.lit("u/"), key).alias("url")
    inputs = customer.select(
        url, F.col("c_name").alias("name"), F.lit(-1).alias("n_reviews"), F.lit("pt-br").alias("hl"), (F.col("c_custkey") % 6).cast("double").alias("stars"),
        F.lit("Itu").alias("city"), F.lpad(F.col("c_nationkey").cast("string"), 2, "0").alias("sigla"), F.col("n_name").alias("estado"),
        F.lit("C").alias("capital"), F.lit("R").alias("regiao"), F.col("c_mktsegment").alias("category"), F.lit("hotel").alias("subtypes"),
    )
    meta = customer.select(
        url, F.col("c_name").alias("name"), key.alias("file_name"), F.concat(F.lit("P "), F.col("c_name")).alias("place_name"), F.lit("Rua").alias("address"),
        F.lit(4.5).alias("overall_rating"), (F.col("c_custkey") % 30).alias("n_reviews"),
    )
    return prepare.join_sources(inputs, meta, _raw(spark, sf))


def _prepared(spark, sf):
    return prepare.prepare(prepare.first_reviews(_joined(spark, sf)))


@Q.add("joined_sources", """
SELECT 'u/' || c_custkey AS url, count(*) AS n, count(DISTINCT o_orderkey) AS n_reviews FROM customer JOIN (FROM orders UNION ALL FROM orders) ON o_custkey = c_custkey GROUP BY ALL""")
def joined_sources(spark, sf):
    return _joined(spark, sf).groupBy("url").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("review_id").alias("n_reviews"))


_SQL = f"""(SELECT o_orderkey::VARCHAR AS review_id, c_name AS name, c_custkey, (o_orderkey % 5 + 1)::DOUBLE AS rating, greatest(o_orderkey % 4 - 1, 0)::DOUBLE AS likes,
  o_orderdate - to_days((o_orderkey % 9 + 2)::INT) AS review_date, CASE WHEN o_orderkey % 11 = 0 THEN o_orderdate - to_days(1) END AS response_date,
  CASE WHEN o_orderkey % 3 = 0 THEN (o_orderkey % 5 + 1)::DOUBLE END AS rooms, CASE WHEN o_orderkey % 3 = 0 THEN 'Luxo|Vista' END AS highlights,
  (o_orderkey % 2 = 0)::INT::DOUBLE AS guide, lpad(o_orderkey::VARCHAR, 21, '7') AS user_id,
  CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderpriority || repeat(' ' || o_orderstatus, 9) END AS text,
  CASE WHEN o_orderkey % 11 = 0 THEN 'Obrigado' END AS response_text, c_nationkey, c_mktsegment, o_orderdate
  FROM orders JOIN customer ON c_custkey = o_custkey)"""


@Q.add("prepared_reviews", f"""
SELECT review_id, name, rating, likes, strftime(review_date, {SQL_SECOND}) AS review_date, strftime(response_date, {SQL_SECOND}) AS response_date,
  rooms, highlights, guide, user_id, text FROM {_SQL}""")
def prepared_reviews(spark, sf):
    return _prepared(spark, sf).select(
        "review_id", "name", "rating", "likes", second_text("review_date").alias("review_date"), second_text("response_date").alias("response_date"),
        "rooms", F.array_join("highlights", "|").alias("highlights"), F.col("user_is_local_guide").alias("guide"), "user_id", "text",
    )


@Q.add("place_report", f"""
SELECT name, any_value(name) AS name_input, NULL::DOUBLE AS sort_by, 'pt-br' AS hl, any_value('u/' || c_custkey) AS url, NULL::DOUBLE AS n_reviews_max,
  'Itu' AS city, any_value('NATION_' || c_nationkey) AS estado, 'C' AS capital, 'R' AS regiao, any_value(c_mktsegment) AS category, 'hotel' AS subtypes,
  any_value((c_custkey % 6)::DOUBLE) AS stars, NULL::DOUBLE AS feature_id, NULL::DOUBLE AS retrieval_date_metadata, any_value('P ' || name) AS place_name,
  'Rua' AS address, 4.5::DOUBLE AS overall_rating, any_value(c_custkey) % 30 AS n_reviews, NULL::DOUBLE AS topics, any_value(c_custkey::VARCHAR) AS file_name,
  count(*) AS review_id, count(*) AS relative_date, count(rooms) AS other_ratings, 0::BIGINT AS trip_type_travel_group, 0::BIGINT AS user_name,
  0::BIGINT AS user_reviews, 0::BIGINT AS user_photos, count(*) AS user_url, count(text) AS text, count(response_text) AS response_text,
  count(response_text) AS response_relative_date, strftime(max(o_orderdate), {SQL_SECOND}) AS retrieval_date, round(avg(rating), 6) AS rating,
  sum(likes) AS likes, sum(guide) AS user_is_local_guide, any_value(c_custkey) % 30 - count(*) AS n_reviews_diff,
  round(count(text) / count(*), 6) AS text_percentage
FROM {_SQL} GROUP BY name""")
def place_report(spark, sf):
    """All aggregates of the report."""
    report = prepare.place_report(_prepared(spark, sf))
    return report.withColumns({
        "retrieval_date": second_text("retrieval_date"), "rating": F.round("rating", 6), "text_percentage": F.round("text_percentage", 6)})


@Q.add("index_table", f"""
SELECT (c_custkey % 6)::DOUBLE AS estrelas, 'Itu' AS cidade, lpad(c_nationkey::VARCHAR, 2, '0') AS sigla_estado, 'NATION_' || c_nationkey AS estado,
  'C' AS capital_estado, 'R' AS regiao, c_mktsegment AS categoria, 'hotel' AS subcategoria, 'P ' || name AS nome, 'Rua' AS endereco,
  4.5::DOUBLE AS classificacao_geral, c_custkey % 30 AS quantidade_avaliacoes, CASE WHEN rating = 3 THEN 0.0::DOUBLE ELSE rating END AS nota_avaliacao,
  likes AS curtidas_avaliacao, guide AS usuario_guia_local, text, strftime(review_date, '%Y-%m-%d') AS data_avaliacao, rooms AS nota_quartos,
  NULL::DOUBLE AS nota_localizacao, NULL::DOUBLE AS nota_servico, 0.0::DOUBLE AS avaliacao_recente,
  (9 + len(string_split(split_part(text, ' ' || right(text, 1), 1), ' ')))::INT AS numero_palavras_avaliacao
FROM {_SQL} WHERE text IS NOT NULL""")
def index_table(spark, sf):
    """Version 3 corrects the reviews rated 3 and wins over version 2."""
    rows = settle(_prepared(spark, sf))
    newer = rows.where("rating = 3").withColumn("rating", F.lit(0.0))
    return prepare.index_table({2: rows, 3: newer})


@Q.add("unique_join", """
SELECT s_suppkey, s_name, c_acctbal FROM supplier JOIN customer ON c_custkey = s_suppkey""")
def unique_join(spark, sf):
    a = table(spark, sf, "supplier").select("s_suppkey", "s_name")
    b = table(spark, sf, "customer").select(F.col("c_custkey").alias("s_suppkey"), "c_acctbal")
    return joins.unique_join(a, b, "s_suppkey")
