"""Joins, aggregates, dedup, top-k, set operations and filters on the star tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import SQL_SECOND, Registry, second_text, table
from voxspark.functions import parsers as P
from voxspark.functions.filters import compile_filter
from voxspark.operators import joins, ordering, profile, relational as R
from voxspark.plans import places as places_plan, retrieval

Q = Registry()


@Q.add("entity_overview", f"""
WITH s AS (
  SELECT o_custkey, count(o_orderkey) AS n_orders, sum(o_totalprice) AS total,
         strftime(min(o_orderdate), {SQL_SECOND}) AS first_order,
         first(o_orderpriority ORDER BY o_orderdate, o_orderkey) AS first_priority
  FROM orders GROUP BY o_custkey)
SELECT c_custkey, c_name, n_name, r_name, coalesce(n_orders, 0) AS n_orders, round(total, 2) AS total,
       first_order, first_priority
FROM customer LEFT JOIN s ON o_custkey = c_custkey
JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey""")
def entity_overview(spark, sf):
    """Per customer: orders, spending, first order, nation and region."""
    spec = {
        "n_orders": ("o_orderkey", "count"), "total": ("o_totalprice", "sum"),
        "first_order": ("o_orderdate", "min"), "first_priority": ("o_orderpriority", "first"),
    }
    orders = table(spark, sf, "orders").withColumnRenamed("o_custkey", "c_custkey")
    per_customer = profile.entity_summary(orders, "c_custkey", spec, ["o_orderdate", "o_orderkey"])
    nation = table(spark, sf, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    region = table(spark, sf, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    places = joins.lookup_join(nation, region, "n_regionkey", "inner")
    customers = joins.lookup_join(table(spark, sf, "customer"), places, "c_nationkey", "inner")
    return customers.join(per_customer, "c_custkey", "left").select(
        "c_custkey", "c_name", "n_name", "r_name", F.coalesce("n_orders", F.lit(0)).alias("n_orders"),
        F.round("total", 2).alias("total"), second_text("first_order").alias("first_order"), "first_priority",
    )


# --- aggregates -----------------------------------------------------------------------------
@Q.add("entity_summary", f"""
SELECT o_custkey, count(o_orderkey) AS n_orders, round(sum(o_totalprice), 2) AS total,
       round(avg(o_totalprice), 6) AS mean_price,
       strftime(max(o_orderdate), {SQL_SECOND}) AS last_order,
       first(o_orderstatus ORDER BY o_orderdate, o_orderkey) AS first_status,
       first(o_orderpriority ORDER BY o_orderdate, o_orderkey) AS first_priority
FROM orders GROUP BY o_custkey""")
def entity_summary(spark, sf):
    spec = {
        "n_orders": ("o_orderkey", "count"), "total": ("o_totalprice", "sum"),
        "mean_price": ("o_totalprice", "mean"), "last_order": ("o_orderdate", "max"),
        "first_status": ("o_orderstatus", "first"), "first_priority": ("o_orderpriority", "first"),
    }
    out = profile.entity_summary(table(spark, sf, "orders"), "o_custkey", spec, ["o_orderdate", "o_orderkey"])
    return out.withColumns({
        "total": F.round("total", 2), "mean_price": F.round("mean_price", 6),
        "last_order": second_text("last_order"),
    })


def _lines_per_part(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_partkey").agg(
        F.count(F.lit(1)).alias("n_lines"), F.count_if(F.col("l_returnflag") == "R").alias("n_returned"),
    )


_LINES_PER_PART = """(SELECT l_partkey, count(*) AS n_lines,
  count(*) FILTER (WHERE l_returnflag = 'R') AS n_returned FROM lineitem GROUP BY l_partkey)"""


@Q.add("coverage", f"""
SELECT p_partkey, p_size - n_lines AS n_reviews_diff,
       round(n_returned / n_lines, 6) AS text_percentage
FROM part JOIN {_LINES_PER_PART} ON p_partkey = l_partkey""")
def coverage(spark, sf):
    lines = _lines_per_part(spark, sf).withColumnRenamed("l_partkey", "p_partkey")
    parts = table(spark, sf, "part").join(lines, "p_partkey")
    out = profile.coverage(parts, "p_size", "n_lines", "n_returned")
    return out.select("p_partkey", "n_reviews_diff", F.round("text_percentage", 6).alias("text_percentage"))


@Q.add("coverage_totals", f"""
SELECT round(avg(n_returned / n_lines), 6) AS text_percentage,
       sum(n_returned)::BIGINT AS n_returned, sum(n_lines)::BIGINT AS n_lines
FROM {_LINES_PER_PART}""")
def coverage_totals(spark, sf):
    shares = profile.coverage(_lines_per_part(spark, sf), "n_lines", "n_lines", "n_returned")
    out = profile.coverage_totals(shares, "n_lines", "n_returned")
    return out.withColumn("text_percentage", F.round("text_percentage", 6))


@Q.add("value_counts", """
SELECT o_orderpriority, o_orderstatus, count(*) AS n FROM orders GROUP BY ALL""")
def value_counts(spark, sf):
    return profile.value_counts(table(spark, sf, "orders"), ["o_orderpriority", "o_orderstatus"])


# every column, and every number, of lineitem
_NUMBERS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_TEXTS = ["l_returnflag", "l_linestatus"]


def _stacked(parts: dict[str, str]) -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS column_name, {v} AS value FROM lineitem" for c, v in parts.items())


@Q.add("column_profile", f"""
WITH long AS ({_stacked({c: f"{c}::VARCHAR" for c in _NUMBERS + _TEXTS} | {"l_shipdate": "strftime(l_shipdate, '%Y-%m-%d %H:%M:%S')"})}),
counts AS (SELECT column_name, value, count(*) AS n FROM long WHERE value IS NOT NULL GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY n DESC, value) AS rank FROM counts)
SELECT column_name, value, n, rank::INT AS rank FROM ranked WHERE rank <= 5""")
def column_profile(spark, sf):
    return profile.column_profile(table(spark, sf, "lineitem"), k=5)


@Q.add("pivot_count", """
SELECT n_name, count(c_custkey) FILTER (WHERE c_mktsegment = 'BUILDING') AS BUILDING,
       count(c_custkey) FILTER (WHERE c_mktsegment = 'HOUSEHOLD') AS HOUSEHOLD,
       count(c_custkey) FILTER (WHERE c_mktsegment = 'MACHINERY') AS MACHINERY,
       count(c_custkey) FILTER (WHERE c_mktsegment = 'AUTOMOBILE') AS AUTOMOBILE,
       count(c_custkey) FILTER (WHERE c_mktsegment = 'FURNITURE') AS FURNITURE
FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""")
def pivot_count(spark, sf):
    nation = table(spark, sf, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    customers = joins.lookup_join(table(spark, sf, "customer"), nation, "c_nationkey", "inner")
    return profile.pivot_count(customers, "n_name", "c_mktsegment", ["BUILDING", "HOUSEHOLD", "MACHINERY", "AUTOMOBILE", "FURNITURE"], "c_custkey")


@Q.add("median_by_group", """
SELECT o_custkey, round(median(o_totalprice), 4) AS o_totalprice,
       round(median(o_orderkey), 4) AS o_orderkey
FROM orders GROUP BY o_custkey""")
def median_by_group(spark, sf):
    out = profile.group_median(table(spark, sf, "orders"), "o_custkey", ["o_totalprice", "o_orderkey"])
    return out.select("o_custkey", *[F.round(c, 4).alias(c) for c in ("o_totalprice", "o_orderkey")])


@Q.add("entity_counts_banded", """
WITH c AS (SELECT o_custkey, count(o_orderkey) AS count_ FROM orders GROUP BY o_custkey)
SELECT o_custkey, count_, count_ >= 15 AS big,
       CASE WHEN count_ < 10 THEN 'lt10' WHEN count_ < 15 THEN 'gte10_lt15' ELSE 'gte15' END AS band
FROM c WHERE count_ >= 5""")
def entity_counts_banded(spark, sf):
    counts = profile.entity_counts(table(spark, sf, "orders"), "o_custkey", "o_orderkey", 5, 15)
    return R.banded(counts, "count_", [10, 15])


@Q.add("histogram", """
SELECT b.low, b.high, count(o_orderkey) AS n
FROM (VALUES (0.0::DOUBLE, 100000.0::DOUBLE), (100000.0, 200000.0), (200000.0, 300000.0),
             (300000.0, 400000.0)) b(low, high)
LEFT JOIN orders ON o_totalprice >= b.low
  AND (o_totalprice < b.high OR (b.high = 400000 AND o_totalprice = 400000))
GROUP BY b.low, b.high""")
def histogram(spark, sf):
    return profile.histogram(table(spark, sf, "orders"), "o_totalprice", [0, 100000, 200000, 300000, 400000])


@Q.add("describe", f"""
WITH long AS ({_stacked({c: f"{c}::DOUBLE" for c in _NUMBERS})})
SELECT column_name, count(value) AS count, round(avg(value), 4) AS mean, round(stddev_samp(value), 4) AS std,
       min(value) AS min, max(value) AS max, round(quantile_cont(value, 0.25), 4) AS p25,
       round(quantile_cont(value, 0.5), 4) AS p50, round(quantile_cont(value, 0.75), 4) AS p75
FROM long GROUP BY column_name""")
def describe(spark, sf):
    out = profile.describe(table(spark, sf, "lineitem"), _NUMBERS)
    return out.withColumns({c: F.round(c, 4) for c in ("mean", "std", "p25", "p50", "p75")})


@Q.add("ranked_entities", """
SELECT o_custkey, count(o_orderkey) AS count_, count(o_orderkey) >= 15 AS big FROM orders GROUP BY o_custkey HAVING count(o_orderkey) >= 10
ORDER BY count_ DESC, o_custkey LIMIT 100""")
def ranked_entities(spark, sf):
    counts = profile.entity_counts(table(spark, sf, "orders"), "o_custkey", "o_orderkey", 10, 15)
    return profile.ranked_entities(counts, "o_custkey")


@Q.add("macro_average", """
WITH per AS (SELECT l_suppkey, sum(l_quantity) AS q, count(*) AS n, sum(l_extendedprice) AS e
             FROM lineitem GROUP BY l_suppkey)
SELECT round(avg(q / n), 6) AS quantity_per_line, round(avg(e / n), 4) AS price_per_line FROM per""")
def macro_average(spark, sf):
    per = table(spark, sf, "lineitem").groupBy("l_suppkey").agg(
        F.sum("l_quantity").alias("q"), F.count(F.lit(1)).alias("n"), F.sum("l_extendedprice").alias("e")
    )
    out = profile.macro_average(per, {"quantity_per_line": ("q", "n"), "price_per_line": ("e", "n")})
    return out.select(F.round("quantity_per_line", 6).alias("quantity_per_line"),
                      F.round("price_per_line", 4).alias("price_per_line"))


@Q.add("scalar_totals", f"""
SELECT count(DISTINCT user_id) AS n_users, strftime(min(ts), {SQL_SECOND}) AS first_ts,
       round(sum(value), 2) AS total, min(value) AS least FROM events""")
def scalar_totals(spark, sf):
    return table(spark, sf, "events").agg(
        F.countDistinct("user_id").alias("n_users"), second_text(F.min("ts")).alias("first_ts"),
        F.round(F.sum("value"), 2).alias("total"), F.min("value").alias("least"),
    )


@Q.add("run_summary", """
WITH done AS (SELECT user_id AS k, count(*) AS n_scraped,
                     count(*) FILTER (WHERE event_type = 'error') AS n_errors FROM events GROUP BY user_id)
SELECT c_custkey, c_custkey % 50 AS n_input, c_name AS place_name, c_nationkey::BIGINT AS n_max,
       coalesce(n_scraped, 0) AS n_scraped, coalesce(n_errors, 0) AS n_errors
FROM customer LEFT JOIN done ON k = c_custkey""")
def run_summary(spark, sf):
    customer = table(spark, sf, "customer")
    inputs = customer.select("c_custkey", (F.col("c_custkey") % 50).alias("n_reviews"))
    meta = customer.select("c_custkey", F.col("c_name").alias("place_name"), F.col("c_nationkey").cast("bigint").alias("n_reviews"))
    events = table(spark, sf, "events").withColumnRenamed("user_id", "c_custkey")
    return profile.run_summary(events, meta, inputs, "c_custkey", (F.col("event_type") == "error").cast("int"))


# --- joins --------------------------------------------------------------------------------------
def _states(spark, sf):
    region = table(spark, sf, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    return table(spark, sf, "nation").join(region, "n_regionkey").select(
        F.lpad(F.col("n_nationkey").cast("string"), 2, "0").alias("sigla"), F.col("n_name").alias("estado"),
        F.concat(F.lit("C"), F.col("n_nationkey").cast("string")).alias("capital"), F.col("r_name").alias("regiao"),
    )


@Q.add("state_enrichment", """
SELECT c_custkey, lpad(c_nationkey::VARCHAR, 2, '0') AS sigla, n_name AS estado,
       'C' || c_nationkey AS capital, r_name AS regiao
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""")
def state_enrichment(spark, sf):
    """Half of the segments carry a two-letter code, the others the lower-case name."""
    code = F.lpad(F.col("c_nationkey").cast("string"), 2, "0")
    name = F.concat(F.lit("nation_"), F.col("c_nationkey").cast("string"))
    customers = table(spark, sf, "customer").select(
        "c_custkey", F.when(F.col("c_mktsegment") < "F", code).otherwise(name).alias("state")
    )
    return places_plan.enrich_by_state(customers, _states(spark, sf)).drop("state")


@Q.add("attach_aggregate", """
SELECT c_custkey, c_mktsegment, round(m.v, 6) AS mean_price
FROM customer LEFT JOIN (SELECT o_custkey, avg(o_totalprice) AS v FROM orders GROUP BY o_custkey) m
  ON o_custkey = c_custkey""")
def attach_aggregate(spark, sf):
    means = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.round(F.avg("o_totalprice"), 6).alias("mean_price")
    )
    return retrieval.attach(table(spark, sf, "customer").select("c_custkey", "c_mktsegment"), means, "c_custkey")


@Q.add("assemble_features", """
WITH a AS (SELECT o_custkey AS id, sum(o_totalprice) AS total FROM orders GROUP BY 1),
     b AS (SELECT user_id AS id, max(value) AS best FROM events GROUP BY 1),
     c AS (SELECT c_custkey AS id, c_acctbal FROM customer)
SELECT id, round(total, 2) AS total, best, c_acctbal
FROM a FULL JOIN b USING (id) FULL JOIN c USING (id)""")
def assemble_features(spark, sf):
    a = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("id")).agg(F.round(F.sum("o_totalprice"), 2).alias("total"))
    b = table(spark, sf, "events").groupBy(F.col("user_id").alias("id")).agg(F.max("value").alias("best"))
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), "c_acctbal")
    return R.assemble([a, b, c], "id")


@Q.add("salted_join", """
SELECT l_returnflag, count(*) AS n, round(sum(s_acctbal), 2) AS balance
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY l_returnflag""")
def salted_join(spark, sf):
    """The join that runs when a dimension is too large to broadcast."""
    supplier = table(spark, sf, "supplier").withColumnRenamed("s_suppkey", "l_suppkey")
    joined = joins.salted_join(table(spark, sf, "lineitem"), supplier, ["l_suppkey"], "inner")
    return joined.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("s_acctbal"), 2).alias("balance")
    )


@Q.add("keep_in", "SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)")
def keep_in(spark, sf):
    good = table(spark, sf, "labels").where("quality = 1")
    return joins.keep_in(table(spark, sf, "documents").select("doc_id", "lang"), good, "doc_id")


@Q.add("pending_entities", """
SELECT c_custkey FROM customer
WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')""")
def pending_entities(spark, sf):
    done = table(spark, sf, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return retrieval.pending(table(spark, sf, "customer").select("c_custkey"), done, "c_custkey")


@Q.add("next_pending", """
WITH c AS (SELECT source, lang, count(*) AS count_ FROM documents GROUP BY source, lang),
k AS (SELECT source || '-' || lang AS nome, count_ FROM c)
SELECT nome, count_ FROM k WHERE nome NOT IN (SELECT nome FROM k WHERE nome LIKE '%-en')
ORDER BY count_ DESC, nome LIMIT 1""")
def next_pending(spark, sf):
    name = F.concat_ws("-", "source", "lang").alias("nome")
    counts = table(spark, sf, "documents").groupBy(name).agg(F.count(F.lit(1)).alias("count_"))
    return retrieval.next_pending(counts, counts.where(F.col("nome").endswith("-en")).select("nome"))


@Q.add("containment", """
SELECT count(*) = 0 AS contained FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)""")
def containment(spark, sf):
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"))
    missing = joins.keep_not_in(table(spark, sf, "orders"), customers, "o_custkey")
    return missing.agg((F.count(F.lit(1)) == 0).alias("contained"))


@Q.add("key_violations", """
SELECT user_id, event_type, count(*) AS n_rows FROM events GROUP BY ALL HAVING count(*) > 1""")
def key_violations(spark, sf):
    return joins.key_violations(table(spark, sf, "events"), ["user_id", "event_type"])


# --- dedup, order, top-k ------------------------------------------------------------------------
@Q.add("dedupe_first", """
SELECT doc_id, lang, source FROM (
  SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS r FROM documents) WHERE r = 1""")
def dedupe_first(spark, sf):
    """Texts are compared by their SHA-256, so that the texts need not be shuffled."""
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source", F.sha2("text", 256).alias("digest"))
    return ordering.dedupe_first(docs, ["digest"], ["doc_id"]).drop("digest")


@Q.add("best_per_key", """
SELECT user_id, event_id, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS r FROM events) WHERE r = 1""")
def best_per_key(spark, sf):
    events = table(spark, sf, "events").select("user_id", "event_id", "value")
    return R.best_per_key(events, ["user_id"], "value", ["event_id"])


@Q.add("duplicates_report", """
SELECT doc_id, source FROM documents
WHERE text IN (SELECT text FROM documents GROUP BY text HAVING count(*) > 1)""")
def duplicates_report(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "source", F.sha2("text", 256).alias("digest"))
    return R.duplicates_report(docs, ["digest"]).drop("digest")


@Q.add("newest_n_per_group", """
SELECT o_custkey, o_orderkey, rank::INT AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS rank FROM orders)
WHERE rank <= 3""")
def newest_n_per_group(spark, sf):
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return ordering.top_n_per_group(orders, ["o_custkey"], [F.desc("o_orderdate"), "o_orderkey"], 3, rank="rank").drop("o_orderdate")


@Q.add("newest_many_per_group", """
SELECT event_type, event_id, rank::INT AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id) AS rank FROM events)
WHERE rank <= 100""")
def newest_many_per_group(spark, sf):
    """A longer list per key takes the salted round."""
    events = table(spark, sf, "events").select("event_type", "event_id", "ts")
    return ordering.top_n_per_group(events, ["event_type"], [F.desc("ts"), "event_id"], 100, rank="rank").drop("ts")


@Q.add("top_union", """
WITH r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS a,
                  row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice, o_orderkey) AS b,
                  row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS c FROM orders)
SELECT o_custkey, o_orderkey FROM r WHERE a = 1 OR b = 1 OR c = 1""")
def top_union(spark, sf):
    criteria = [[F.desc("o_totalprice")], [F.asc("o_totalprice")], [F.desc("o_orderdate")]]
    return R.top_union(table(spark, sf, "orders"), ["o_custkey"], criteria, "o_orderkey")


@Q.add("top_rows", "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey LIMIT 20")
def top_rows(spark, sf):
    return (
        table(spark, sf, "lineitem")
        .orderBy(F.desc("l_extendedprice"), "l_orderkey", "l_linenumber", "l_partkey").limit(20)
        .select("l_orderkey", "l_linenumber", "l_extendedprice")
    )


@Q.add("sample_rows", "SELECT doc_id, source FROM documents ORDER BY md5('42-' || doc_id), doc_id LIMIT 100")
def sample_rows(spark, sf):
    return R.sample_n(table(spark, sf, "documents").select("doc_id", "source"), "doc_id", 100, 42)


@Q.add("distinct_values", "SELECT DISTINCT source, lang FROM documents")
def distinct_values(spark, sf):
    return table(spark, sf, "documents").select("source", "lang").distinct().orderBy("source", "lang")


# --- sets -------------------------------------------------------------------------------------------
@Q.add("union_sources", """
SELECT s_suppkey AS id, s_name AS name, s_nationkey AS nation, NULL::VARCHAR AS segment FROM supplier
UNION ALL SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer""")
def union_sources(spark, sf):
    a = R.select_rename(table(spark, sf, "supplier"), {"s_suppkey": "id", "s_name": "name", "s_nationkey": "nation"})
    b = R.select_rename(table(spark, sf, "customer"), {"c_custkey": "id", "c_name": "name", "c_nationkey": "nation", "c_mktsegment": "segment"})
    return R.union_all([a, b])


@Q.add("consolidate_versions", """
WITH v AS (
  SELECT 2 AS version, l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem WHERE l_returnflag <> 'N'
  UNION ALL SELECT 3, l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem WHERE l_quantity > 20)
SELECT version, l_orderkey, l_quantity FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey
    ORDER BY version DESC, l_linenumber, l_partkey, l_quantity) AS r FROM v) WHERE r = 1""")
def consolidate_versions(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_returnflag")
    versions = {3: lines.where("l_quantity > 20").drop("l_returnflag"), 2: lines.where("l_returnflag <> 'N'").drop("l_returnflag")}
    out = R.consolidate(versions, "l_orderkey", ["l_linenumber", "l_partkey", "l_quantity"])
    return out.select("version", "l_orderkey", "l_quantity")


@Q.add("place_list", """
WITH place AS (
  SELECT s_suppkey AS place_id, s_name AS name, s_suppkey % 40 AS reviews,
         CASE WHEN s_acctbal < 500 THEN 'CLOSED' ELSE 'OPERATIONAL' END AS business_status, s_nationkey AS nk,
         CASE s_suppkey % 3 WHEN 0 THEN (s_suppkey % 6)::VARCHAR || ' estrelas' WHEN 1 THEN '$$' END AS range
  FROM supplier),
kept AS (SELECT * FROM place WHERE business_status = 'OPERATIONAL' AND reviews >= 5),
listed AS (
  SELECT '0x0:0x' || place_id AS google_id, name, reviews AS n_reviews_max, 2025 AS dt_selection,
         CASE WHEN range LIKE '%estrelas' THEN replace(range, ' estrelas', '')::DOUBLE ELSE 0.0 END AS stars,
         lpad(nk::VARCHAR, 2, '0') AS sigla FROM kept
  UNION ALL
  SELECT '0x0:0x' || c_custkey, c_name, c_custkey % 70, 2023, 3.0, lpad(c_nationkey::VARCHAR, 2, '0') FROM customer),
newest AS (SELECT *, row_number() OVER (PARTITION BY google_id ORDER BY dt_selection DESC, name) AS r FROM listed)
SELECT google_id, name, n_reviews_max, dt_selection, stars, newest.sigla, n_name AS estado, r_name AS regiao,
       CASE WHEN n_reviews_max < 10 THEN 'lt10' WHEN n_reviews_max < 30 THEN 'gte10_lt30' ELSE 'gte30' END AS band
FROM newest LEFT JOIN nation ON lpad(n_nationkey::VARCHAR, 2, '0') = newest.sigla
LEFT JOIN region ON r_regionkey = n_regionkey WHERE r = 1""")
def place_list(spark, sf):
    """Suppliers as exported places, customers as the older list."""
    states = _states(spark, sf)
    key = F.col("s_suppkey")
    text = key.cast("string")
    exports = table(spark, sf, "supplier").select(
        key.alias("place_id"), F.col("s_name").alias("name"), (key % 40).alias("reviews"),
        F.when(F.col("s_acctbal") < 500, "CLOSED").otherwise("OPERATIONAL").alias("business_status"),
        F.concat(F.lit("nation_"), F.col("s_nationkey").cast("string")).alias("state"),
        F.when(key % 3 == 0, F.concat((key % 6).cast("string"), F.lit(" estrelas"))).when(key % 3 == 1, "$$").alias("range"),
        F.concat(F.lit("https://maps/place/x/!1s0x0:0x"), text).alias("location_link"),
        F.lit("city").alias("city"), F.lit("hotel").alias("category"), F.lit("hotel").alias("subtypes"),
    )
    old = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("place"), F.col("c_name").alias("name"), F.lit(-1).alias("n_reviews"), F.lit("pt-br").alias("hl"),
        F.concat(F.lit("https://maps/place/x/!1s0x0:0x"), F.col("c_custkey").cast("string")).alias("url"),
        (F.col("c_custkey") % 70).alias("n_reviews_max"), F.lit(3.0).alias("stars"),
        F.lpad(F.col("c_nationkey").cast("string"), 2, "0").alias("state"), F.lit("x").alias("region"),
    )
    new = places_plan.new_places(places_plan.operational_places(exports, ["name"]), states, 2025)
    merged = places_plan.merged_places([new, places_plan.old_places(old, states, 2023)])
    return R.banded(merged, "n_reviews_max", [10, 30]).select(
        "google_id", "name", "n_reviews_max", "dt_selection", "stars", "sigla", "estado", "regiao", "band"
    )


# --- filters and columns ------------------------------------------------------------------------------
@Q.add("filter_documents", """
SELECT p_partkey FROM part
WHERE (p_type IN ('ECONOMY', 'SMALL') OR p_size >= 40)
  AND NOT (p_brand = 'Brand#7' OR p_retailprice > 1500)
  AND p_size <> 13 AND p_brand NOT IN ('Brand#1', 'Brand#2')""")
def filter_documents(spark, sf):
    part = table(spark, sf, "part")
    spec = {
        "$or": [{"p_type": {"$in": ["ECONOMY", "SMALL"]}}, {"p_size": {"$gte": 40}}],
        "$not": {"$or": [{"p_brand": "Brand#7"}, {"p_retailprice": {"$gt": 1500}}]},
        "p_size": {"$neq": 13},
        "p_brand": {"$nin": ["Brand#1", "Brand#2"]},
    }
    return part.where(compile_filter(spec, part.schema)).select("p_partkey")


@Q.add("filter_fields_and", """
SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_totalprice >= 100000
  AND o_totalprice < 300000 AND o_orderstatus <> 'F'""")
def filter_fields_and(spark, sf):
    orders = table(spark, sf, "orders")
    spec = {
        "$and": [{"o_orderpriority": {"$eq": "1-URGENT"}}, {"o_totalprice": {"$gte": 100000, "$lt": 300000}}],
        "o_orderstatus": {"$not": {"$eq": "F"}},
    }
    return orders.where(compile_filter(spec, orders.schema)).select("o_orderkey")


@Q.add("derived_columns", """
SELECT o_orderkey, o_totalprice - 1000 AS o_diff, o_totalprice / o_custkey AS o_ratio, 0 AS done, 'pt-br' AS hl,
       CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END IS NOT NULL AS has_o_status,
       CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END IS NULL AS o_status_na,
       coalesce(CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END, '') AS o_status,
       try_cast(left(o_orderpriority, 1) AS DOUBLE) AS o_level
FROM orders WHERE o_custkey > 0""")
def derived_columns(spark, sf):
    """Constants, casts, flags, fills, arithmetic and choice by pattern."""
    orders = table(spark, sf, "orders").where("o_custkey > 0")
    status = F.when(F.col("o_orderstatus") == "P", None).otherwise(F.col("o_orderstatus"))
    rows = orders.withColumns({
        "o_status": status, "o_level": F.left("o_orderpriority", F.lit(1)),
        "o_diff": F.col("o_totalprice") - 1000, "o_ratio": F.col("o_totalprice") / F.col("o_custkey"),
    })
    rows = R.text_flags(R.cast_columns(rows, {"o_level": "double"}), ["o_status"])
    rows = R.with_constants(rows.na.fill("", ["o_status"]), {"done": 0, "hl": "pt-br"})
    return R.without(
        R.select_matching(rows, "^o_|^has_|^done$|^hl$"),
        ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority", "missing"],
    )


@Q.add("complete_rows", """
SELECT p_partkey, b.doc_id FROM part b2 JOIN (SELECT doc_id, quality, CASE WHEN toxic = 1 THEN NULL ELSE toxic END AS t FROM labels) b
  ON b.doc_id = b2.p_partkey WHERE b.t IS NOT NULL""")
def complete_rows(spark, sf):
    labels = table(spark, sf, "labels").withColumn("t", F.when(F.col("toxic") == 1, None).otherwise(F.col("toxic")))
    part = table(spark, sf, "part").select("p_partkey", F.col("p_partkey").alias("doc_id"))
    return part.join(labels, "doc_id").na.drop("any").select("p_partkey", "doc_id")
