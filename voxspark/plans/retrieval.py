"""Context blocks, prompts and scores around a language model.

The model itself stays outside: its replies and the embedding vectors come in as
tables, prompts go out as tables.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from voxspark import fixed_values as V
from voxspark.functions import parsers as P
from voxspark.functions.filters import compile_filter, parse_filter
from voxspark.operators.joins import keep_not_in
from voxspark.operators.ordering import top_n_per_group
from voxspark.operators.relational import union_all
from voxspark.operators.vectors import search, search_within
from voxspark.session import settle

MAX_CRITERIA = 1000
MAX_FILTERS = 200


def fill(template: str, values: Mapping[str, Column]) -> Column:
    """A text template with ``{name}`` places filled from columns.

    The template is cut at its places, so inserted text is never scanned again.
    A missing value leaves its place as V.UNKNOWN.
    """
    parts, rest = [], template
    while rest:
        found = [(rest.find("{" + n + "}"), n) for n in values if "{" + n + "}" in rest]
        if not found:
            break
        at, name = min(found)
        parts += [F.lit(rest[:at]), _known(values[name])]
        rest = rest[at + len(name) + 2 :]
    return F.concat(*parts, F.lit(rest))


def _known(c: Column | str) -> Column:
    """A value as text; what is not known is said to be so."""
    return F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(V.UNKNOWN))


def _whole(c: str) -> Column:
    return _known(F.col(c).cast("bigint"))


def hotel_header() -> Column:
    """Three header lines of the hotel a review belongs to."""
    return F.concat(
        F.lit("Hotel: "), _known("nome"), F.lit(", "), _whole("estrelas"), F.lit(" Estrelas.\n"),
        F.lit("Região:"), _known("regiao"), F.lit("; Estado:"), _known("estado"),
        F.lit("; Cidade:"), _known("cidade"), F.lit("\nTipo:"), _known("subcategoria"),
        F.lit("; Classificação:"), _known("classificacao_geral"),
        F.lit("; Quantidade Avaliações:"), _whole("quantidade_avaliacoes"), F.lit("\n"),
    )


def render_review(
    rank: Column | str, score: Column | str | None = None, with_hotel: bool = True
) -> Column:
    """One review as a context block; missing sub-ratings are left out, the rest is V.UNKNOWN."""
    no = F.col(rank) if isinstance(rank, str) else rank
    likeness = F.lit("")
    if score is not None:
        value = F.col(score) if isinstance(score, str) else score
        likeness = F.when(
            value.isNotNull(), F.concat(F.lit(", Similaridade: "), F.format_string("%.3f", value))
        ).otherwise("")
    notes = [
        F.when(
            F.col(c).isNotNull(), F.concat(F.lit(f"; Nota {label}:"), _whole(c))
        ).otherwise("")
        for c, label in V.OTHER_NOTES.items()
    ]
    guide = F.when(
        F.coalesce(F.col("usuario_guia_local") != 0, F.lit(True)), V.LOCAL_GUIDE
    ).otherwise(V.NOT_LOCAL_GUIDE)
    return F.concat(
        F.lit(" - Avaliação "), _known(no), likeness, F.lit("\n"),
        hotel_header() if with_hotel else F.lit(""),
        F.lit("Nota:"), _whole("nota_avaliacao"), F.lit("; Curtidas:"), _whole("curtidas_avaliacao"),
        guide, *notes, F.lit("\nAvaliação: "), _known("text"), F.lit("\n\n"),
    )


def blocks_in_order(df: DataFrame, keys: Sequence[str], rank: str, block: Column, out: str) -> DataFrame:
    """Blocks of at most a few hundred ranked rows per key, concatenated by rank."""
    return df.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct(F.col(rank).alias("r"), block.alias("b")))).alias("_b"),
        F.count(F.lit(1)).alias("n_blocks"),
    ).select(*keys, "n_blocks", F.array_join(F.col("_b.b"), "").alias(out))


def hotel_context(
    ranked: DataFrame, keys: Sequence[str], rank: str = "rank", score: str | None = None,
    max_chars: int | None = None,
) -> DataFrame:
    """Header plus numbered reviews per key: (keys, n_blocks, context)."""
    numbered = ranked.withColumn("_intro", F.when(F.col(rank) == 1, hotel_header()))
    block = render_review(rank, score, with_hotel=False)
    rows = numbered.withColumn("_block", block)
    out = rows.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct(F.col(rank).alias("r"), F.col("_block").alias("b")))).alias("_b"),
        F.count(F.lit(1)).alias("n_blocks"),
        F.max("_intro").alias("_intro"),
    )
    text = F.concat(
        F.lit(V.SUMMARY_CONTEXT_INTRO), F.col("_intro"),
        fill(V.SUMMARY_CONTEXT_TOP, {"n": F.col("n_blocks").cast("string")}),
        F.array_join(F.col("_b.b"), ""),
    )
    if max_chars is not None:
        text = P.truncated(text, max_chars)
    return out.select(*keys, "n_blocks", text.alias("context"))


def newest_context(
    docs: DataFrame, id: str, n: int = 1000, key: str = "nome", **options
) -> DataFrame:
    """Context of the ``n`` newest reviews of every hotel."""
    newest = top_n_per_group(
        docs.where(F.col(key).isNotNull()), [key], [F.desc_nulls_last("data_avaliacao"), id], n, rank="rank"
    )
    return hotel_context(newest, [key], **options)


def ask_full(hotel: Column, topics: Sequence[str]) -> Column:
    """The instruction that asks for all topics at once."""
    listed = "".join(f"{i}. {t}\n" for i, t in enumerate(topics, 1))
    return F.concat(fill(V.ASK_FULL_HEAD, {"hotel": hotel}), F.lit(listed + V.ASK_FULL_TAIL))


def topic_table(hotels: DataFrame, topics: Sequence[str], key: str = "nome") -> DataFrame:
    """(key, topic_no, positive, topic, query): every topic in both polarities.

    The topics are a constant array on each row, so no join is involved.
    """
    pairs = F.array(*[
        F.struct(
            F.lit(i).alias("topic_no"), F.lit(p).alias("positive"), F.lit(t).alias("topic"),
        )
        for i, t in enumerate(topics) for p in (True, False)
    ])
    rows = hotels.select(key, F.inline(pairs))
    values = {"hotel": F.col(key), "topic": F.col("topic")}
    return rows.withColumn(
        "query",
        F.when(F.col("positive"), fill(V.ASK_TOPIC[True], values)).otherwise(
            fill(V.ASK_TOPIC[False], values)
        ),
    )


def polarity_filter(positive: str = "positive", note: str = "nota_avaliacao") -> Column:
    """Notes from 3 up are positive, up to 3 negative; 3 itself is both."""
    return F.coalesce(
        F.when(F.col(positive), F.col(note) >= V.MIN_POSITIVE_NOTE).otherwise(
            F.col(note) <= V.MAX_NEGATIVE_NOTE
        ),
        F.lit(False),
    )


def full_prompts(contexts: DataFrame, template: str, topics: Sequence[str], key: str = "nome") -> DataFrame:
    """(key, prompt, context): one summary prompt per hotel."""
    query = ask_full(F.col(key), topics)
    return contexts.withColumn("prompt", fill(template, {"context": F.col("context"), "query": query}))


def topic_prompts(
    docs: DataFrame, topic_queries: DataFrame, id: str, vector: str, query_vector: str, template: str,
    n: int = 100, key: str = "nome", metric: str = "ip",
) -> DataFrame:
    """Prompt per (hotel, topic, polarity) from its ``n`` most similar fitting reviews.

    ``topic_queries`` is ``topic_table`` with a query vector. Per hotel and topic
    the reviews are ranked where they lie; only the best ``n`` ids are joined
    back to their texts. A topic without a fitting review has an empty context.
    """
    queries = topic_queries.withColumn("_query", F.struct("topic_no", "positive"))
    best = search_within(
        docs, queries, on=key, id=id, vector=vector, query_id="_query", query_vector=query_vector,
        metric=metric, n=n, keep=polarity_filter("_query.positive"), carry=["nota_avaliacao"],
    )
    picked = best.select(key, id, F.col("_query.topic_no"), F.col("_query.positive"), "score", "rank")
    rows = picked.join(docs.drop(vector), [key, id])
    keys = [key, "topic_no", "positive"]
    contexts = hotel_context(rows, keys, score="score")
    asked = topic_queries.select(*keys, "topic", "query")
    return asked.join(contexts, keys, "left").na.fill({"n_blocks": 0, "context": ""}).withColumn(
        "prompt", fill(template, {"context": F.col("context"), "query": F.col("query")})
    )


def similar_prompts(
    docs: DataFrame, queries: DataFrame, id: str, vector: str, query_vector: str, template: str,
    topics: Sequence[str], n: int = 100, key: str = "nome", metric: str = "ip",
) -> DataFrame:
    """(key, n_blocks, context, prompt): a full summary from the ``n`` reviews nearest to its instruction.

    ``queries`` has one row per hotel with the vector of its ``ask_full`` text.
    """
    asked = queries.withColumn("_query", F.lit(0))
    best = search_within(
        docs, asked, on=key, id=id, vector=vector, query_id="_query", query_vector=query_vector, metric=metric, n=n)
    rows = best.select(key, id, "score", "rank").join(docs.drop(vector), [key, id])
    contexts = hotel_context(rows, [key], score="score")
    out = queries.select(key).join(contexts, key, "left").na.fill({"n_blocks": 0, "context": ""})
    return full_prompts(out, template, topics, key)


def final_prompts(
    replies: DataFrame, template: str, topics: Sequence[str], key: str = "nome"
) -> DataFrame:
    """(key, context, prompt): the topic replies of a hotel merged into one prompt.

    ``replies`` has (key, topic_no, positive, topic, response).
    """
    title = F.when(F.col("positive"), fill(V.FINAL_TITLE[True], {"topic": F.col("topic")})).otherwise(
        fill(V.FINAL_TITLE[False], {"topic": F.col("topic")})
    )
    ordered = replies.withColumn("_r", F.col("topic_no") * 2 + F.when(F.col("positive"), 0).otherwise(1))
    merged = blocks_in_order(ordered, [key], "_r", F.concat(title, _known("response"), F.lit("\n")), "_blocks")
    out = merged.withColumn(
        "context", F.concat(fill(V.FINAL_INTRO, {"hotel": F.col(key)}), F.col("_blocks"))
    ).drop("_blocks")
    return full_prompts(out, template, topics, key)


def eval_prompts(
    summaries: DataFrame, criteria: DataFrame, template: str, summary: str = "summary", document: str = "document"
) -> DataFrame:
    """One prompt per summary and criterion (metric_name, criteria, steps).

    The handful of criteria becomes a constant array on each summary row.
    """
    listed = criteria.orderBy("metric_name").limit(MAX_CRITERIA + 1).collect()
    if len(listed) > MAX_CRITERIA:
        raise ValueError(f"more than {MAX_CRITERIA} criteria")
    table = F.array(*[
        F.struct(*[F.lit(r[c]).alias(c) for c in ("metric_name", "criteria", "steps")]) for r in listed
    ])
    rows = summaries.select("*", F.inline(table))
    places = {c: F.col(c) for c in ("criteria", "steps", "metric_name")}
    return rows.withColumn(
        "prompt", fill(template, {**places, "document": F.col(document), "summary": F.col(summary)})
    )


def eval_scores(replies: DataFrame, response: str = "response") -> DataFrame:
    """Add ``score``: the first integer of a reply, missing without one."""
    return replies.withColumn("score", P.reply_score(response))


def mean_scores(scores: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Mean score per summary, replies without a score left out of the mean."""
    return scores.groupBy(*keys).agg(
        F.avg("score").alias("score_mean"), F.count("score").alias("n_scores"),
        F.count(F.lit(1)).alias("n_replies"),
    )


def parsed_questions(df: DataFrame, reply: str, question: str) -> DataFrame:
    """Add filter_json and asked: the model's filter and the reworded question."""
    parsed = P.filter_reply(reply, question)
    return df.withColumns({"filter_json": parsed["filter_json"], "asked": parsed["question"]})


def answer_prompts(
    docs: DataFrame, questions: DataFrame, *, id: str, vector: str, query_id: str, question: str, reply: str,
    query_vector: str, template: str, n: int = 5, metric: str = "ip", max_filters: int = MAX_FILTERS,
) -> DataFrame:
    """(query_id, filter_json, context, prompt): each question answered under the filter of its reply.

    ``reply`` is the model's answer to "which filter?". One that is no filter
    document, or one that does not fit the index columns, filters nothing.
    Questions with the same filter are searched together, one scan for each
    distinct filter; more than ``max_filters`` of them are refused.
    """
    parsed = settle(parsed_questions(questions, reply, question))
    filters = [r[0] for r in parsed.select("filter_json").distinct().orderBy("filter_json").limit(max_filters + 1).collect()]
    if len(filters) > max_filters:
        raise ValueError(f"more than {max_filters} distinct filters")
    found = []
    for text in filters:
        own = parsed.where(F.col("filter_json").eqNullSafe(F.lit(text)))
        found.append(search(
            docs, own, id=id, vector=vector, query_id=query_id, query_vector=query_vector, metric=metric, n=n,
            where=_lenient_filter(text, docs)))
    ranked = union_all(found) if found else None
    if ranked is None:
        return parsed.select(query_id, "filter_json", F.lit("").alias("context"), F.lit("").alias("prompt"))
    out = question_prompts(ranked.join(docs.drop(vector), id), parsed, query_id, question, template)
    return parsed.select(query_id, "filter_json").join(out.drop(question), query_id)


def _lenient_filter(text: str | None, docs: DataFrame) -> Column:
    try:
        return compile_filter(parse_filter(text), docs.schema)
    except (ValueError, TypeError, AttributeError):
        return F.lit(True)


def question_prompts(
    ranked: DataFrame, questions: DataFrame, query_id: str, question: str, template: str
) -> DataFrame:
    """(query_id, context, prompt): the found reviews of each question in a template."""
    contexts = blocks_in_order(ranked, [query_id], "rank", render_review("rank", "score"), "context")
    joined = questions.select(query_id, question).join(contexts, query_id, "left")
    context = F.coalesce(F.col("context"), F.lit(""))
    return joined.withColumn("context", context).withColumn(
        "prompt", fill(template, {"context": F.col("context"), "question": F.col(question)})
    )


def pending(counts: DataFrame, done: DataFrame, key: str = "nome") -> DataFrame:
    """Hotels that have no output yet."""
    return keep_not_in(counts, done, key)


def next_pending(counts: DataFrame, done: DataFrame, key: str = "nome", count: str = "count_") -> DataFrame:
    """The pending hotel with most reviews."""
    return pending(counts, done, key).orderBy(F.desc(count), key).limit(1)


def attach(df: DataFrame, aggregate: DataFrame, key: str) -> DataFrame:
    """Put a per-entity aggregate back on the entity table; both have a row per key."""
    return df.join(aggregate, key, "left")
