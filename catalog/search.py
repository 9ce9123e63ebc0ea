"""Vector search, clusters, and the context and prompt tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import Registry, table, texts
from voxspark.functions.filters import compile_filter
from voxspark.operators import clusters, ordering, vectors
from voxspark.plans import retrieval
from voxspark.session import scratch_path

Q = Registry()

_DIMS = 64


def _vectors(spark, sf):
    return table(spark, sf, "embeddings")


def _centroids(spark, sf):
    """Query vectors: the mean vector of every label, from all rows."""
    long = _vectors(spark, sf).select("label", F.posexplode("embedding").alias("i", "x"))
    means = long.groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("m"))
    return means.groupBy("label").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))), lambda s: s["m"]).alias("query_vec")
    ).withColumnRenamed("label", "query_id")


_CENTROIDS = """(SELECT label AS query_id, list(m ORDER BY i) AS qv FROM
  (SELECT label, i, avg(x::DOUBLE) AS m FROM
    (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings) GROUP BY label, i)
  GROUP BY label)"""
_DOT = "list_sum(list_transform(list_zip(qv, embedding), lambda p: p[1]::DOUBLE * p[2]::DOUBLE))"
_L2 = "list_sum(list_transform(list_zip(qv, embedding), lambda p: (p[1]::DOUBLE - p[2]::DOUBLE) * (p[1]::DOUBLE - p[2]::DOUBLE)))"


def _search_sql(score: str, order: str, n: int, where: str = "true") -> str:
    return f"""
WITH s AS (SELECT query_id, vec_id, round({score}, 9) AS score FROM {_CENTROIDS} JOIN embeddings ON {where}),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score {order}, vec_id) AS rank FROM s)
SELECT query_id, vec_id, round(score, 6) AS score, rank::INT AS rank FROM r WHERE rank <= {n}"""


def _search(spark, sf, metric, n, where=None):
    out = vectors.search(
        _vectors(spark, sf), _centroids(spark, sf), id="vec_id", vector="embedding", query_id="query_id",
        query_vector="query_vec", metric=metric, n=n, where=where,
    )
    return out.withColumn("score", F.round("score", 6))


@Q.add("search_inner_product", _search_sql(_DOT, "DESC", 10))
def search_inner_product(spark, sf):
    return _search(spark, sf, "ip", 10)


@Q.add("search_l2", _search_sql(_L2, "ASC", 10))
def search_l2(spark, sf):
    return _search(spark, sf, "l2", 10)


@Q.add("search_filtered", _search_sql(_DOT, "DESC", 5, "label IN (1, 4, 7) OR NOT label < 9"))
def search_filtered(spark, sf):
    spec = {"$or": [{"label": {"$in": [1, 4, 7]}}, {"label": {"$not": {"$lt": 9}}}]}
    where = compile_filter(spec, _vectors(spark, sf).schema)
    return _search(spark, sf, "ip", 5, where)


@Q.add("search_within_entity", f"""
WITH s AS (SELECT label, vec_id, round({_DOT}, 9) AS score FROM {_CENTROIDS} JOIN embeddings ON label = query_id),
t AS (SELECT label, vec_id, 'near' AS query_id, score FROM s WHERE vec_id % 3 <> 0
  UNION ALL SELECT label, vec_id, 'far', -score FROM s WHERE vec_id % 3 <> 1),
r AS (SELECT *, row_number() OVER (PARTITION BY label, query_id ORDER BY score DESC, vec_id) AS rank FROM t)
SELECT label, query_id, vec_id, round(score, 6) AS score, rank::INT AS rank FROM r WHERE rank <= 4""")
def search_within_entity(spark, sf):
    """Two queries per label, its centre and the opposite, each with its own condition."""
    centre = _centroids(spark, sf).withColumnRenamed("query_id", "label")
    near = centre.select("label", F.lit("near").alias("query_id"), "query_vec", F.lit(0).alias("skip"))
    far = centre.select("label", F.lit("far").alias("query_id"), F.transform("query_vec", lambda x: -x).alias("query_vec"), F.lit(1).alias("skip"))
    out = vectors.search_within(
        _vectors(spark, sf), near.unionByName(far), on="label", id="vec_id", vector="embedding",
        query_id="query_id", query_vector="query_vec", n=4, query_carry=["skip"],
        keep=F.col("vec_id") % 3 != F.col("skip"),
    )
    return out.select("label", "query_id", "vec_id", F.round("score", 6).alias("score"), "rank")


@Q.add("norm_report", """
WITH n AS (SELECT label, len(embedding) AS d, sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))) AS l FROM embeddings)
SELECT label, count(*) AS n_vectors, min(d)::INT AS min_dim, max(d)::INT AS max_dim, count(*) FILTER (WHERE abs(l - 1) >= 1e-4) AS n_not_unit
FROM n GROUP BY label""")
def norm_report(spark, sf):
    return vectors.norm_report(_vectors(spark, sf), "embedding", ["label"])


#: All components of a vector as whole numbers in one text.
_WHOLE_SQL = "md5(array_to_string(list_transform(v, lambda x: round(x * 1048576)::BIGINT), ','))"


def _whole(c):
    return F.md5(F.array_join(F.transform(c, lambda x: F.round(x.cast("double") * 1048576).cast("bigint").cast("string")), ","))


@Q.add("normalized_vectors", f"""
WITH n AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
u AS (SELECT vec_id, list_transform(e, lambda x: (x / sqrt(list_sum(list_transform(e, lambda y: y * y))))::FLOAT::DOUBLE) AS v FROM n)
SELECT vec_id, {_WHOLE_SQL} AS vector, round(sqrt(list_sum(list_transform(v, lambda y: y * y))), 5) AS length FROM u""")
def normalized_vectors(spark, sf):
    """All components, after a scaling that changes no digit."""
    scaled = _vectors(spark, sf).withColumn("embedding", F.transform("embedding", lambda x: (x * 4).cast("float")))
    out = vectors.normalize_vectors(scaled, "embedding")
    return out.select("vec_id", _whole("embedding").alias("vector"), F.round(vectors.norm("embedding"), 5).alias("length"))


@Q.add("index_shards", """
SELECT doc_id, ((row_number() OVER (ORDER BY doc_id) - 1) // 300)::INT AS shard FROM documents""")
def index_shards(spark, sf):
    return vectors.with_shards(table(spark, sf, "documents").select("doc_id"), "doc_id", 300)


@Q.add("index_round_trip", f"""
SELECT ((row_number() OVER (ORDER BY vec_id) - 1) // 200)::INT AS shard, vec_id, label, 'v' || vec_id AS text, {_WHOLE_SQL} AS vector
FROM (SELECT *, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings)""")
def index_round_trip(spark, sf):
    path = scratch_path(spark, "index")
    rows = _vectors(spark, sf).withColumn("text", F.concat(F.lit("v"), F.col("vec_id").cast("string")))
    vectors.build_index(rows, path, id="vec_id", vector="embedding", text="text", shard_rows=200)
    index = vectors.load_index(spark, "main", {"main": path}, default="main")
    return index.select("shard", F.col("id").alias("vec_id"), F.col("metadata.label").alias("label"), "text", _whole("embedding").alias("vector"))


@Q.add("index_difference", """
SELECT vec_id, true AS in_a, label <> 2 AS in_b FROM embeddings WHERE label IN (2, 5)""")
def index_difference(spark, sf):
    a = _vectors(spark, sf)
    b = a.where("label <> 2").withColumn(
        "embedding", F.when(F.col("label") == 5, F.transform("embedding", lambda x: -x)).otherwise(F.col("embedding"))
    )
    return vectors.same_index(a, b, "vec_id", "embedding")


@Q.add("cluster_representatives")
def cluster_representatives(spark, sf):
    rows = _vectors(spark, sf).select(
        "label", "vec_id", *[F.col("embedding")[i].alias(f"f{i}") for i in range(_DIMS)]
    )
    out = clusters.cluster_representatives(rows, "label", "vec_id", [f"f{i}" for i in range(_DIMS)], 5)
    return out.withColumn("distance", F.round("distance", 6))


@Q.add("cluster_summary")
def cluster_summary(spark, sf):
    docs = texts(spark, sf, "documents")

    def share(letters: str):
        left = F.length(F.translate("text", letters, ""))
        return 1 - F.try_divide(left, F.col("n_chars"))

    shape = docs.select(
        "source", "doc_id", F.ln(F.col("n_chars") + 1).alias("size"),
        share(".").alias("stops"), share("aeiou").alias("vowels"),
    )
    best = clusters.cluster_representatives(shape, "source", "doc_id", ["size", "stops", "vowels"], 5)
    out = clusters.cluster_summary(docs, "source", "doc_id", "text", best)
    return out.withColumn("summary", F.md5("summary"))


# --- context and prompts --------------------------------------------------------------------------
def _reviews(spark, sf):
    """Orders as reviews of their customer, under the index column names."""
    from voxspark.operators.joins import lookup_join

    nation = table(spark, sf, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    region = table(spark, sf, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    customer = table(spark, sf, "customer").join(nation.join(region, "n_regionkey"), "c_nationkey")
    hotels = customer.select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_name").alias("nome"), (F.col("c_custkey") % 6).cast("double").alias("estrelas"),
        F.col("r_name").alias("regiao"), F.col("n_name").alias("estado"), F.lit("Itu").alias("cidade"), F.col("c_mktsegment").alias("subcategoria"),
        ((F.col("c_custkey") % 50) / 10).alias("classificacao_geral"), (F.col("c_custkey") % 1000).alias("quantidade_avaliacoes"),
    )
    key = F.col("o_orderkey")
    return lookup_join(table(spark, sf, "orders"), hotels, "o_custkey", "inner").select(
        key, "nome", "estrelas", "regiao", "estado", "cidade", "subcategoria", "classificacao_geral", "quantidade_avaliacoes",
        (key % 5 + 1).cast("double").alias("nota_avaliacao"), (key % 4).cast("double").alias("curtidas_avaliacao"),
        (key % 2).cast("double").alias("usuario_guia_local"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("data_avaliacao"),
        F.when(key % 3 == 0, key % 5 + 1).cast("double").alias("nota_quartos"), F.when(key % 4 == 0, key % 5 + 1).cast("double").alias("nota_localizacao"),
        F.when(key % 5 == 0, key % 5 + 1).cast("double").alias("nota_servico"), F.concat_ws(" ", "o_orderpriority", "o_orderstatus").alias("text"),
    )


_REVIEWS = """(SELECT o_orderkey, c_name AS nome, c_custkey % 6 AS estrelas, r_name AS regiao, n_name AS estado, 'Itu' AS cidade,
  c_mktsegment AS subcategoria, (c_custkey % 50) / 10 AS classificacao_geral, c_custkey % 1000 AS quantidade_avaliacoes,
  o_orderkey % 5 + 1 AS nota, o_orderkey % 4 AS curtidas, o_orderkey % 2 AS guia, strftime(o_orderdate, '%Y-%m-%d') AS data_avaliacao,
  o_orderpriority || ' ' || o_orderstatus AS text
  FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey)"""
# the same with gaps: notes, types, texts and cities that are not known
_GAPS = f"""(SELECT * REPLACE (CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE nota END AS nota, CASE WHEN subcategoria = 'MACHINERY' THEN NULL ELSE subcategoria END AS subcategoria,
  CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE text END AS text, CASE WHEN estrelas = 0 THEN NULL ELSE cidade END AS cidade), o_orderkey % 5 + 1 AS sub FROM {_REVIEWS})"""
_HEADER = """('Hotel: ' || nome || ', ' || estrelas || ' Estrelas.' || chr(10) || 'Região:' || regiao || '; Estado:' || estado || '; Cidade:' || cidade
  || chr(10) || 'Tipo:' || subcategoria || '; Classificação:' || classificacao_geral || '; Quantidade Avaliações:' || quantidade_avaliacoes || chr(10))"""


def _block(header: str = "''", score: str = "''") -> str:
    return f"""(' - Avaliação ' || rank || {score} || chr(10) || {header} || 'Nota:' || nota || '; Curtidas:' || curtidas
  || CASE WHEN guia = 1 THEN '; Usuário é guia local' ELSE '; Usuário não é guia local' END
  || CASE WHEN o_orderkey % 3 = 0 THEN '; Nota Quartos:' || nota ELSE '' END || CASE WHEN o_orderkey % 4 = 0 THEN '; Nota Localização:' || nota ELSE '' END
  || CASE WHEN o_orderkey % 5 = 0 THEN '; Nota Serviço:' || nota ELSE '' END || chr(10) || 'Avaliação: ' || text || chr(10) || chr(10))"""


def _gaps(spark, sf):
    key = F.col("o_orderkey")
    return _reviews(spark, sf).withColumns({
        "nota_avaliacao": F.when(key % 7 != 0, F.col("nota_avaliacao")), "subcategoria": F.when(F.col("subcategoria") != "MACHINERY", F.col("subcategoria")),
        "text": F.when(key % 11 != 0, F.col("text")), "cidade": F.when(F.col("estrelas") != 0, F.col("cidade")),
    })


def _told(c: str) -> str:
    return f"coalesce({c}::VARCHAR, 'não informado')"


_GAP_HEADER = _HEADER.replace("|| cidade\n", f"|| {_told('cidade')}\n").replace("|| subcategoria ||", f"|| {_told('subcategoria')} ||")
_GAP_BLOCK = (
    _block().replace("'Nota:' || nota ||", f"'Nota:' || {_told('nota')} ||").replace("Quartos:' || nota", "Quartos:' || sub")
    .replace("Localização:' || nota", "Localização:' || sub").replace("Serviço:' || nota", "Serviço:' || sub").replace("|| text ||", f"|| {_told('text')} ||"))


@Q.add("gap_context", f"""
WITH r AS (SELECT *, row_number() OVER (PARTITION BY nome ORDER BY data_avaliacao DESC, o_orderkey) AS rank FROM {_GAPS})
SELECT nome, count(*) AS n_blocks, 'Informações gerais sobre o hotel:' || first({_GAP_HEADER} ORDER BY rank) || chr(10)
  || 'Top ' || count(*) || ' avaliações do hotel mais semelhantes à pergunta:' || chr(10) || string_agg({_GAP_BLOCK}, '' ORDER BY rank) AS context
FROM r WHERE rank <= 5 GROUP BY nome""")
def gap_context(spark, sf):
    """Every review is in its context, also where notes, types, cities or texts are missing."""
    return retrieval.newest_context(_gaps(spark, sf), "o_orderkey", 5)


_NEWEST = f"""(SELECT *, row_number() OVER (PARTITION BY nome ORDER BY data_avaliacao DESC, o_orderkey) AS rank FROM {_REVIEWS})"""
_CONTEXT = f"""(SELECT nome, count(*) AS n_blocks, 'Informações gerais sobre o hotel:' || first({_HEADER} ORDER BY rank) || chr(10)
  || 'Top ' || count(*) || ' avaliações do hotel mais semelhantes à pergunta:' || chr(10) || string_agg({_block()}, '' ORDER BY rank) AS context
  FROM {_NEWEST} WHERE rank <= 5 GROUP BY nome)"""


@Q.add("review_blocks", f"""
SELECT o_orderkey, {_block(_HEADER, "', Similaridade: ' || printf('%.3f', nota / 8)")} AS block FROM {_NEWEST}""")
def review_blocks(spark, sf):
    reviews = _reviews(spark, sf).withColumn("_score", F.col("nota_avaliacao") / 8)
    ranked = ordering.with_row_number(reviews, ["nome"], [F.desc("data_avaliacao"), "o_orderkey"], "rank")
    return ranked.select("o_orderkey", retrieval.render_review("rank", "_score").alias("block"))


@Q.add("newest_context", f"SELECT nome, n_blocks, context FROM {_CONTEXT}")
def newest_context(spark, sf):
    return retrieval.newest_context(_reviews(spark, sf), "o_orderkey", 5)


_ASK = """('Faça um resumo do hotel "' || nome || '" com base nos seguintes tópicos:' || chr(10) || '1. Quarto' || chr(10) || '2. Café' || chr(10)
  || 'Para cada tópico, escreva um parágrafo com os principais aspectos positivos e negativos do hotel com base em suas avaliações.')"""


@Q.add("full_prompts", f"SELECT nome, md5('C=' || context || chr(10) || 'Q=' || {_ASK}) AS prompt FROM {_CONTEXT}")
def full_prompts(spark, sf):
    contexts = retrieval.newest_context(_reviews(spark, sf), "o_orderkey", 5)
    out = retrieval.full_prompts(contexts, template="C={context}\nQ={query}", topics=("Quarto", "Café"))
    return out.select("nome", F.md5("prompt").alias("prompt"))


@Q.add("topic_table", """
SELECT c_name AS nome, topic_no::INT AS topic_no, positive, topic,
  'Quais os aspectos ' || CASE WHEN positive THEN 'positivos' ELSE 'negativos' END || ' do hotel "' || c_name || '" no quesito "' || topic || '"?' AS query
FROM customer CROSS JOIN (VALUES (0, 'Quarto'), (1, 'Café')) t(topic_no, topic) CROSS JOIN (VALUES (true), (false)) p(positive)""")
def topic_table(spark, sf):
    hotels = table(spark, sf, "customer").select(F.col("c_name").alias("nome"))
    return retrieval.topic_table(hotels, topics=("Quarto", "Café"))


@Q.add("topic_prompts", f"""
WITH r AS (SELECT *, [nota, curtidas, guia + 1]::DOUBLE[] AS embedding FROM {_REVIEWS}),
h AS (SELECT DISTINCT nome FROM r),
q AS (SELECT nome, topic_no, topic, positive, CASE WHEN positive THEN [1.0, topic_no, 1.0] ELSE [-1.0, topic_no, 0.0] END::DOUBLE[] AS qv
  FROM h CROSS JOIN (VALUES (0, 'Quarto'), (1, 'Café')) t(topic_no, topic) CROSS JOIN (VALUES (true), (false)) p(positive)),
s AS (SELECT r.*, q.topic_no, q.topic, q.positive, round({_DOT}, 9) AS score FROM q JOIN r USING (nome)
  WHERE CASE WHEN positive THEN nota >= 3 ELSE nota <= 3 END),
k AS (SELECT *, row_number() OVER (PARTITION BY nome, topic_no, positive ORDER BY score DESC, o_orderkey) AS rank FROM s),
c AS (SELECT nome, topic_no, topic, positive, count(*) AS n_blocks, 'Informações gerais sobre o hotel:' || first({_HEADER} ORDER BY rank) || chr(10)
  || 'Top ' || count(*) || ' avaliações do hotel mais semelhantes à pergunta:' || chr(10)
  || string_agg({_block("''", "', Similaridade: ' || printf('%.3f', score)")}, '' ORDER BY rank) AS context
  FROM k WHERE rank <= 3 GROUP BY ALL)
SELECT nome, topic_no::INT AS topic_no, positive, coalesce(n_blocks, 0) AS n_blocks, md5('C=' || coalesce(context, '') || 'Q=Quais os aspectos ' ||
  CASE WHEN positive THEN 'positivos' ELSE 'negativos' END || ' do hotel "' || nome || '" no quesito "' || topic || '"?') AS prompt
FROM q LEFT JOIN c USING (nome, topic_no, topic, positive)""")
def topic_prompts(spark, sf):
    docs = _reviews(spark, sf).withColumn(
        "embedding", F.array(F.col("nota_avaliacao"), F.col("curtidas_avaliacao"), F.col("usuario_guia_local") + 1)
    )
    asked = retrieval.topic_table(docs.select("nome").distinct(), topics=("Quarto", "Café"))
    no = F.col("topic_no").cast("double")
    asked = asked.withColumn(
        "query_vec", F.when(F.col("positive"), F.array(F.lit(1.0), no, F.lit(1.0))).otherwise(F.array(F.lit(-1.0), no, F.lit(0.0)))
    )
    out = retrieval.topic_prompts(docs, asked, "o_orderkey", "embedding", "query_vec", "C={context}Q={query}", 3)
    return out.select("nome", "topic_no", "positive", "n_blocks", F.md5("prompt").alias("prompt"))


@Q.add("final_prompts", """
WITH t AS (SELECT conv_id::VARCHAR AS nome, turn, text FROM conversations),
b AS (SELECT nome, count(*) AS n_blocks, string_agg(CASE WHEN turn % 2 = 0 THEN 'Aspectos positivos' ELSE 'Aspectos negativos' END
  || ' do hotel no quesito "T' || turn // 2 || '":' || chr(10) || text || chr(10), '' ORDER BY turn) AS blocks FROM t GROUP BY nome)
SELECT nome, n_blocks, md5('A seguir, uma lista de resumos do hotel "' || nome || '" por tópico e aspecto:' || blocks) AS context FROM b""")
def final_prompts(spark, sf):
    """Conversation turns as the topic replies of a hotel."""
    no = F.floor(F.col("turn") / 2).cast("int")
    replies = table(spark, sf, "conversations").select(
        F.col("conv_id").cast("string").alias("nome"), no.alias("topic_no"), (F.col("turn") % 2 == 0).alias("positive"),
        F.concat(F.lit("T"), no.cast("string")).alias("topic"), F.col("text").alias("response"),
    )
    return retrieval.final_prompts(replies, "{context}{query}", ()).select("nome", "n_blocks", F.md5("context").alias("context"))


@Q.add("gap_replies", """
WITH t AS (SELECT conv_id::VARCHAR AS nome, turn, CASE WHEN turn % 3 = 1 THEN 'não informado' ELSE text END AS text FROM conversations)
SELECT nome, count(*) AS n_blocks, md5('A seguir, uma lista de resumos do hotel "' || nome || '" por tópico e aspecto:' || string_agg(
  CASE WHEN turn % 2 = 0 THEN 'Aspectos positivos' ELSE 'Aspectos negativos' END || ' do hotel no quesito "T' || turn // 2 || '":' || chr(10) || text || chr(10),
  '' ORDER BY turn)) AS context FROM t GROUP BY nome""")
def gap_replies(spark, sf):
    """Topic replies, every third of them missing."""
    no = F.floor(F.col("turn") / 2).cast("int")
    replies = table(spark, sf, "conversations").select(
        F.col("conv_id").cast("string").alias("nome"), no.alias("topic_no"), (F.col("turn") % 2 == 0).alias("positive"),
        F.concat(F.lit("T"), no.cast("string")).alias("topic"), F.when(F.col("turn") % 3 != 1, F.col("text")).alias("response"),
    )
    return retrieval.final_prompts(replies, "{context}{query}", ()).select("nome", "n_blocks", F.md5("context").alias("context"))


@Q.add("similar_prompts", f"""
WITH r AS (SELECT *, [nota, curtidas, guia + 1]::DOUBLE[] AS embedding, [estrelas, 1.0, -1.0]::DOUBLE[] AS qv FROM {_REVIEWS}),
s AS (SELECT *, round({_DOT}, 9) AS score FROM r),
k AS (SELECT *, row_number() OVER (PARTITION BY nome ORDER BY score DESC, o_orderkey) AS rank FROM s),
c AS (SELECT nome, count(*) AS n_blocks, 'Informações gerais sobre o hotel:' || first({_HEADER} ORDER BY rank) || chr(10)
  || 'Top ' || count(*) || ' avaliações do hotel mais semelhantes à pergunta:' || chr(10)
  || string_agg({_block("''", "', Similaridade: ' || printf('%.3f', score)")}, '' ORDER BY rank) AS context FROM k WHERE rank <= 4 GROUP BY nome)
SELECT nome, n_blocks, md5('C=' || context || chr(10) || 'Q=' || {_ASK}) AS prompt FROM c""")
def similar_prompts(spark, sf):
    """The summary prompt of a hotel from its reviews nearest to the instruction."""
    docs = _reviews(spark, sf).withColumn("embedding", F.array("nota_avaliacao", "curtidas_avaliacao", F.col("usuario_guia_local") + 1))
    queries = docs.select("nome", F.array("estrelas", F.lit(1.0), F.lit(-1.0)).alias("query_vec")).distinct()
    out = retrieval.similar_prompts(docs, queries, "o_orderkey", "embedding", "query_vec", "C={context}\nQ={query}", ("Quarto", "Café"), 4)
    return out.select("nome", "n_blocks", F.md5("prompt").alias("prompt"))


@Q.add("answer_prompts", f"""
WITH v AS (SELECT *, [nota, curtidas, guia + 1]::DOUBLE[] AS embedding FROM {_REVIEWS}),
q AS (SELECT n_nationkey, 'Q' || n_nationkey AS query_id, 'Onde ' || n_name || '?' AS question, [n_regionkey, 1.0, 2.0]::DOUBLE[] AS qv FROM nation),
s AS (SELECT query_id, question, v.*, round({_DOT}, 9) AS score FROM q JOIN v ON CASE n_nationkey % 5
  WHEN 0 THEN nota >= 4 WHEN 1 THEN estado IN ('NATION_3', 'NATION_4') AND nota < 3 ELSE true END),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, o_orderkey) AS rank FROM s),
c AS (SELECT query_id, string_agg({_block(_HEADER, "', Similaridade: ' || printf('%.3f', score)")}, '' ORDER BY rank) AS context FROM r WHERE rank <= 3 GROUP BY query_id)
SELECT query_id, md5('P:' || question || coalesce(context, '')) AS prompt FROM q LEFT JOIN c USING (query_id)""")
def answer_prompts(spark, sf):
    """A question per nation: good filters, one that is broken, one on an unknown field, and none."""
    docs = _reviews(spark, sf).withColumn("embedding", F.array("nota_avaliacao", "curtidas_avaliacao", F.col("usuario_guia_local") + 1))
    kind, name = F.col("n_nationkey") % 5, F.col("n_name")
    reply = (
        F.when(kind == 0, "```json{'nota_avaliacao': {'$gte': 4}}```").when(kind == 1, "{'$and': [{'estado': {'$in': ['NATION_3', 'NATION_4']}}, {'nota_avaliacao': {'$lt': 3}}]}``` x")
        .when(kind == 2, "{'nota_avaliacao': ").when(kind == 3, "{'nothing': 1}```")
    )
    questions = table(spark, sf, "nation").select(
        F.concat(F.lit("Q"), F.col("n_nationkey").cast("string")).alias("query_id"), F.concat(F.lit("Onde "), name, F.lit("?")).alias("question"),
        reply.alias("reply"), F.array(F.col("n_regionkey").cast("double"), F.lit(1.0), F.lit(2.0)).alias("query_vec"),
    )
    out = retrieval.answer_prompts(
        docs, questions, id="o_orderkey", vector="embedding", query_id="query_id", question="question", reply="reply",
        query_vector="query_vec", template="P:{question}{context}", n=3)
    return out.select("query_id", F.md5("prompt").alias("prompt"))


@Q.add("eval_prompts", """
SELECT doc_id, metric_name, md5('Nota de ' || metric_name || ': {' || text || '} ' || source || criteria || steps) AS prompt
FROM documents CROSS JOIN (SELECT DISTINCT 'M' || quality AS metric_name, 'c' || quality AS criteria, 's{summary}' AS steps FROM labels)""")
def eval_prompts(spark, sf):
    criteria = table(spark, sf, "labels").select(
        F.concat(F.lit("M"), F.col("quality").cast("string")).alias("metric_name"),
        F.concat(F.lit("c"), F.col("quality").cast("string")).alias("criteria"), F.lit("s{summary}").alias("steps"),
    ).distinct()
    docs = table(spark, sf, "documents").select("doc_id", F.col("text").alias("document"), F.col("source").alias("summary"))
    out = retrieval.eval_prompts(docs, criteria, "Nota de {metric_name}: {{document}} {summary}{criteria}{steps}")
    return out.select("doc_id", "metric_name", F.md5("prompt").alias("prompt"))


@Q.add("question_prompts", f"""
WITH v AS (SELECT nome, o_orderkey, nota, curtidas, guia, text, estrelas, regiao, estado, cidade, subcategoria, classificacao_geral, quantidade_avaliacoes,
  [nota, curtidas, guia + 1]::DOUBLE[] AS embedding FROM {_REVIEWS}),
q AS (SELECT DISTINCT 'Q' || n_regionkey AS query_id, 'Onde ' || n_regionkey || '?' AS question, [n_regionkey, 1.0, 2.0]::DOUBLE[] AS qv FROM nation),
s AS (SELECT query_id, question, v.*, round({_DOT}, 9) AS score FROM q JOIN v ON true),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, o_orderkey) AS rank FROM s),
c AS (SELECT query_id, question, string_agg({_block(_HEADER, "', Similaridade: ' || printf('%.3f', score)")}, '' ORDER BY rank) AS context
  FROM r WHERE rank <= 4 GROUP BY ALL)
SELECT query_id, md5('P:' || question || context) AS prompt FROM c""")
def question_prompts(spark, sf):
    """One question per region over all reviews."""
    docs = _reviews(spark, sf).withColumn(
        "embedding", F.array(F.col("nota_avaliacao"), F.col("curtidas_avaliacao"), F.col("usuario_guia_local") + 1)
    )
    key = F.col("n_regionkey")
    questions = table(spark, sf, "nation").select(
        F.concat(F.lit("Q"), key.cast("string")).alias("query_id"), F.concat(F.lit("Onde "), key.cast("string"), F.lit("?")).alias("question"),
        F.array(key.cast("double"), F.lit(1.0), F.lit(2.0)).alias("query_vec"),
    ).distinct()
    best = vectors.search(docs, questions, id="o_orderkey", vector="embedding", query_id="query_id", query_vector="query_vec", n=4)
    found = best.join(docs.drop("embedding"), "o_orderkey")
    out = retrieval.question_prompts(found, questions, "query_id", "question", "P:{question}{context}")
    return out.select("query_id", F.md5("prompt").alias("prompt"))
