"""Text preparation, vocabulary, summaries and overlap scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import Registry, table, texts
from voxspark.functions import stemming, text as X
from voxspark.operators import chunks, overlap, profile, sentiment, summaries, vocabulary
from voxspark.plans import prepare
from voxspark.session import settle

Q = Registry()

STOPWORDS = ["the", "and", "les", "des", "que", "der", "die", "und", "los", "las"]
_STOP = ", ".join(f"'{w}'" for w in STOPWORDS)
_BLANK = r"[\s\p{Z}\x0b\x1c-\x1f\x{85}]"
_NOT_BLANK = r"[^\s\p{Z}\x0b\x1c-\x1f\x{85}]"


def _tokens(c: str, min_len: int = 3) -> str:
    return (
        f"list_transform(list_filter(regexp_extract_all({c}, '[\\p{{L}}\\p{{N}}_]+'), "
        f"lambda t: regexp_full_match(t, '\\p{{L}}+') AND length(t) >= {min_len} AND lower(t) NOT IN ({_STOP})), "
        f"lambda t: lower(t))"
    )


def _docs(spark, sf):
    return texts(spark, sf, "documents")


def _tokenized(spark, sf):
    return _docs(spark, sf).select("doc_id", "source", X.tokenize("text", STOPWORDS).alias("tokens"))


_TOKENIZED = f"(SELECT doc_id, source, {_tokens('text')} AS tokens FROM documents)"


@Q.add("text_cleaning", rf"""
SELECT doc_id, md5(regexp_replace(regexp_replace(text, '{_BLANK}+', ' ', 'g'), '[.]+', '.', 'g')) AS clean,
  md5(regexp_replace(regexp_replace(text, '\n+', ' ' || chr(10) || ' ', 'g'), '[.]+', ' . ', 'g')) AS spaced,
  md5(translate(text, '.' || chr(10), ';.')) AS lines,
  md5(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '{_BLANK}', ' ', 'g'), ' +[.] *', '. ', 'g'), ' +[,] *', ', ', 'g'), '^ +| +$', '', 'g')) AS full_text,
  md5(regexp_replace(text, '{_BLANK}|[''"]', ' ', 'g')) AS error_line
FROM documents""")
def text_cleaning(spark, sf):
    forms = {"clean": X.clean, "spaced": X.space_marks, "lines": X.newline_sentences, "full_text": X.clean_full, "error_line": X.error_line}
    return _docs(spark, sf).select("doc_id", *[F.md5(fn("text")).alias(n) for n, fn in forms.items()])


@Q.add("text_normalize", """
SELECT doc_id, md5(lower(strip_accents(replace(text, 'ß', 'ss')))) AS normalized FROM documents""")
def text_normalize(spark, sf):
    return _docs(spark, sf).select("doc_id", F.md5(X.normalize("text")).alias("normalized"))


@Q.add("word_counts", rf"""
SELECT doc_id, len(regexp_extract_all(text, '{_NOT_BLANK}+'))::INT AS n_words FROM documents""")
def word_counts(spark, sf):
    return _docs(spark, sf).select("doc_id", X.word_count("text").alias("n_words"))


@Q.add("long_texts", rf"""
SELECT doc_id, lang FROM documents WHERE len(regexp_extract_all(text, '{_NOT_BLANK}+')) >= 10""")
def long_texts(spark, sf):
    return _docs(spark, sf).where(X.word_count("text") >= 10).select("doc_id", "lang")


@Q.add("tokens", f"""
SELECT doc_id, len(tokens)::INT AS n_tokens, md5(array_to_string(tokens, ' ')) AS tokens FROM {_TOKENIZED}""")
def tokens(spark, sf):
    return _tokenized(spark, sf).select("doc_id", F.size("tokens").alias("n_tokens"), F.md5(F.array_join("tokens", " ")).alias("tokens"))


@Q.add("sentence_tokens", f"""
WITH s AS (SELECT doc_id, list_transform(string_split(text, '.'), lambda p: array_to_string({_tokens('p')}, ' ')) AS s FROM documents)
SELECT doc_id, len(s)::INT AS n_sentences, md5(array_to_string(s, '|')) AS tokens FROM s""")
def sentence_tokens(spark, sf):
    s = _docs(spark, sf).select("doc_id", X.sentence_tokens("text", STOPWORDS).alias("s"))
    flat = F.array_join(F.transform("s", lambda t: F.array_join(t, " ")), "|")
    return s.select("doc_id", F.size("s").alias("n_sentences"), F.md5(flat).alias("tokens"))


@Q.add("corpus_stats", f"""
WITH s AS (SELECT source, text, list_transform(string_split(text, '.'), lambda p: {_tokens('p')}) AS s FROM documents)
SELECT count(DISTINCT source) AS n_entities, count(*) FILTER (WHERE text <> '') AS n_texts,
  sum(CASE WHEN text <> '' THEN len(s) END)::BIGINT AS n_sentences, sum(len(flatten(s)))::BIGINT AS n_tokens FROM s""")
def corpus_stats(spark, sf):
    s = _docs(spark, sf).select("source", "text", X.sentence_tokens("text", STOPWORDS).alias("s"))
    return profile.corpus_stats(s, "source", "text", "s")


@Q.add("vocabulary", f"""
WITH t AS (SELECT doc_id, unnest(tokens) AS token FROM {_TOKENIZED})
SELECT token, count(DISTINCT doc_id) AS n_docs, count(*) AS n_tokens FROM t GROUP BY token""")
def vocabulary_table(spark, sf):
    return vocabulary.vocabulary(_tokenized(spark, sf), "tokens")


@Q.add("bag_of_words", f"""
SELECT doc_id, token, count(*) AS n FROM (SELECT doc_id, unnest(tokens) AS token FROM {_TOKENIZED}) GROUP BY ALL""")
def bag_of_words(spark, sf):
    return vocabulary.bag_of_words(_tokenized(spark, sf), "doc_id", "tokens")


@Q.add("group_word_counts", f"""
SELECT source, token, count(*) AS n_group FROM (SELECT source, unnest(tokens) AS token FROM {_TOKENIZED}) GROUP BY ALL""")
def group_word_counts(spark, sf):
    return vocabulary.group_word_counts(_tokenized(spark, sf), "source", "tokens")


@Q.add("word_points", f"""
WITH t AS (SELECT doc_id, source, unnest(tokens) AS token FROM {_TOKENIZED}),
c AS (SELECT source, token, count(*) AS n_group FROM t GROUP BY ALL),
p AS (SELECT doc_id, sum(n_group)::BIGINT AS pts FROM t JOIN c USING (source, token) GROUP BY doc_id)
SELECT d.source, d.doc_id, coalesce(pts, 0) AS text_points FROM documents d LEFT JOIN p USING (doc_id)""")
def word_points(spark, sf):
    return vocabulary.word_points(_tokenized(spark, sf), "source", "doc_id", "tokens")


@Q.add("token_reduction", f"""
WITH d AS (SELECT DISTINCT unnest({_tokens('text')}) AS form FROM benchmark),
m AS (SELECT form, left(form, length(form) - 1) AS canonical FROM d WHERE form LIKE '%n'),
t AS (SELECT doc_id, unnest(tokens) AS form, generate_subscripts(tokens, 1) AS pos FROM {_TOKENIZED}),
r AS (SELECT doc_id, string_agg(coalesce(canonical, t.form), ' ' ORDER BY pos) AS reduced FROM t LEFT JOIN m ON m.form = t.form GROUP BY doc_id)
SELECT doc_id, md5(coalesce(reduced, '')) AS reduced FROM documents LEFT JOIN r USING (doc_id)""")
def token_reduction(spark, sf):
    """The dictionary cuts a final n from the word forms of the benchmark texts."""
    forms = table(spark, sf, "benchmark").select(F.explode(X.tokenize("text", STOPWORDS)).alias("form")).distinct()
    dictionary = forms.where(F.col("form").endswith("n")).withColumn("canonical", F.expr("left(form, length(form) - 1)"))
    out = vocabulary.reduce_tokens(_tokenized(spark, sf), "doc_id", "tokens", dictionary)
    return out.select("doc_id", F.md5(F.array_join("reduced", " ")).alias("reduced"))


def _stem_sql(steps) -> str:
    """The suffix rules as SQL, one table per step, from the words of the table ``p0`` (form, w)."""
    out = []
    for i, rules in enumerate(steps):
        cases, seen = [], {}
        for r in rules:
            seen.setdefault(r.suffix, []).append(r)
        for suffix in sorted(seen, key=len, reverse=True):
            n, inner = len(suffix), []
            for r in seen[suffix]:
                stem, form = f"w[:length(w) - {n}]", f"f[:length(w) - {n}]"
                changes = f"len(regexp_extract_all({form}, 'vc'))"
                tests = [
                    "true", *([f"{changes} >= {r.least}"] if r.least else []), *([f"{changes} = {r.exact}"] if r.exact is not None else []),
                    *([f"{form} LIKE '%v%'"] if r.vowel else []), *([f"right({stem}, 1) IN ({', '.join(repr(c) for c in r.ends)})"] if r.ends else []),
                    *([f"({'' if r.cvc else 'NOT '}({form} LIKE '%cvc' AND right({stem}, 1) NOT IN ('w', 'x', 'y')))"] if r.cvc is not None else []),
                    *([f"regexp_matches({stem}, '({'|'.join(2 * c for c in 'bcdfghjkmnpqrtvwxyz')})$') AND {form} LIKE '%c'"] if r.double else [])]
                inner.append(f"WHEN {' AND '.join(tests)} THEN w[:length(w) - {n + r.drop}] || '{r.replacement}'")
            cases.append(f"WHEN w LIKE '%{suffix}' THEN CASE {' '.join(inner)} ELSE w END")
        shown = "regexp_replace(regexp_replace(regexp_replace(w, '([^aeiou])y', '\\1i', 'g'), '[^aeiou]', 'c', 'g'), '[aeiou]', 'v', 'g')"
        out.append(f"p{i + 1} AS (SELECT form, CASE WHEN length(form) < 3 THEN w {' '.join(cases)} ELSE w END AS w FROM (SELECT *, {shown} AS f FROM p{i}))")
    return ", ".join(out)


@Q.add("stemmed_tokens", f"""
WITH t AS (SELECT doc_id, unnest(tokens) AS form, generate_subscripts(tokens, 1) AS pos FROM {_TOKENIZED}),
p0 AS (SELECT DISTINCT form, form AS w FROM t),
{_stem_sql(stemming.PORTER)},
r AS (SELECT doc_id, string_agg(w, ' ' ORDER BY pos) FILTER (length(w) >= 3) AS reduced FROM t JOIN p{len(stemming.PORTER)} USING (form) GROUP BY doc_id)
SELECT doc_id, coalesce(reduced, '') AS reduced FROM documents LEFT JOIN r USING (doc_id)""")
def stemmed_tokens(spark, sf):
    out = vocabulary.stem_tokens(_tokenized(spark, sf), "doc_id", "tokens", min_len=3)
    return out.select("doc_id", F.array_join("reduced", " ").alias("reduced"))


_LEXICON = f"""(SELECT token, round(4 * avg(quality) - 3, 3) AS valence FROM
  (SELECT DISTINCT doc_id, quality, unnest({_tokens('text')}) AS token FROM documents JOIN labels USING (doc_id))
  GROUP BY token HAVING count(*) >= 3)"""


@Q.add("lexicon_sentiment", f"""
WITH lex AS {_LEXICON},
t AS (SELECT doc_id, unnest(tokens) AS token FROM {_TOKENIZED}),
s AS (SELECT doc_id, coalesce(sum(valence), 0) AS s, coalesce(sum(valence + 1) FILTER (WHERE valence > 0), 0) AS p,
  coalesce(sum(1 - valence) FILTER (WHERE valence < 0), 0) AS n, count(*) FILTER (WHERE coalesce(valence, 0) = 0) AS z
  FROM t LEFT JOIN lex ON lex.token = t.token GROUP BY doc_id),
a AS (SELECT doc_id, coalesce(s, 0) AS s, coalesce(p, 0) AS p, coalesce(n, 0) AS n, coalesce(z, 0) AS z
  FROM documents LEFT JOIN s USING (doc_id))
SELECT doc_id, round(coalesce(n / nullif(p + n + z, 0), 0), 3) AS vader_neg, round(coalesce(z / nullif(p + n + z, 0), 0), 3) AS vader_neu,
  round(coalesce(p / nullif(p + n + z, 0), 0), 3) AS vader_pos, round(s / sqrt(s * s + 15), 4) AS vader_compound FROM a""")
def lexicon_sentiment(spark, sf):
    """Word valences are learned from the labelled documents."""
    labelled = _docs(spark, sf).join(table(spark, sf, "labels"), "doc_id")
    distinct = F.array_distinct(X.tokenize("text", STOPWORDS))
    lexicon = (
        labelled.select("quality", F.explode_outer(distinct).alias("token")).where("token IS NOT NULL")
        .groupBy("token").agg(F.round(4 * F.avg("quality") - 3, 3).alias("valence"), F.count(F.lit(1)).alias("n"))
        .where("n >= 3")
    )
    return sentiment.lexicon_sentiment(_tokenized(spark, sf), "doc_id", "tokens", settle(lexicon))


_PUNCT = sentiment.PUNCTUATION.replace("'", "''")
_SPLIT = rf"""(SELECT doc_id, text, list_transform(list_filter(string_split_regex(coalesce(text, ''), '[ \t\n\r\f\x0B]+'), lambda w: w <> ''),
  lambda w: CASE WHEN length(regexp_replace(w, '^{_PUNCT}|{_PUNCT}$', '', 'g')) > 2 THEN regexp_replace(w, '^{_PUNCT}|{_PUNCT}$', '', 'g') ELSE w END) AS words FROM documents)"""


def _bend(step: int, weight: float, source: str) -> str:
    """SQL of one word before: ``v`` under the influence of the word ``step`` places back."""
    boost = f"""CASE WHEN b{step} IS NULL THEN 0 ELSE (b{step} * CASE WHEN v < 0 THEN -1 ELSE 1 END
      + CASE WHEN c{step} AND mixed THEN CASE WHEN v > 0 THEN 0.733::DOUBLE ELSE -0.733::DOUBLE END ELSE 0 END) * {weight}::DOUBLE END"""
    return f"""SELECT * REPLACE (CASE WHEN c{step} IS NULL OR k{step} THEN v WHEN g{step} THEN (v + {boost}) * -0.74::DOUBLE ELSE v + {boost} END AS v) FROM {source}"""


@Q.add("rule_sentiment", f"""
WITH docs AS {_SPLIT},
lexicon AS (SELECT token, round(4 * avg(quality) - 3, 3) AS valence FROM
  (SELECT DISTINCT doc_id, quality, lower(unnest(words)) AS token FROM docs JOIN labels USING (doc_id)) GROUP BY token HAVING count(*) >= 3),
other AS (SELECT DISTINCT lower(unnest(list_transform(string_split_regex(text, '[ \t\n\r\f\x0B]+'), lambda w: regexp_replace(w, '[^A-Za-z]', '', 'g')))) AS token FROM benchmark),
w AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM docs),
x AS (SELECT doc_id, pos, word, lower(word) AS low, upper(word) = word AND lower(word) <> word AS c, valence,
    CASE WHEN o.token LIKE '%t' THEN 0.293::DOUBLE WHEN o.token LIKE '%s' THEN -0.293::DOUBLE END AS b, coalesce(o.token LIKE '%r', false) AS g
  FROM w LEFT JOIN lexicon l ON l.token = lower(word) LEFT JOIN other o ON o.token = lower(word)),
y AS (SELECT *, valence IS NOT NULL AS k, count(*) FILTER (c) OVER d BETWEEN 1 AND count(*) OVER d - 1 AS mixed, min(pos) FILTER (low = 'und') OVER d AS turn
  FROM x WINDOW d AS (PARTITION BY doc_id)),
z AS (SELECT *, {', '.join(f'lag({c}, {i}) OVER o AS {c}{i}' for c in 'bgkc' for i in (1, 2, 3))} FROM y WINDOW o AS (PARTITION BY doc_id ORDER BY pos)),
v0 AS (SELECT *, valence + CASE WHEN c AND mixed THEN sign(valence) * 0.733::DOUBLE ELSE 0 END AS v FROM z),
v1 AS ({_bend(1, 1.0, 'v0')}),
v2 AS ({_bend(2, 0.95, 'v1')}),
v3 AS ({_bend(3, 0.9, 'v2')}),
s AS (SELECT doc_id, pos, CASE WHEN valence IS NULL OR b IS NOT NULL THEN 0::DOUBLE ELSE v END
  * CASE WHEN turn IS NULL OR pos = turn THEN 1::DOUBLE WHEN pos < turn THEN 0.5 ELSE 1.5 END AS s FROM v3),
sums AS (SELECT doc_id, list_reduce(list_prepend(0::DOUBLE, list(s ORDER BY pos)), lambda a, b: a + b) AS total,
    list_reduce(list_prepend(0::DOUBLE, list(CASE WHEN s > 0 THEN s + 1 ELSE 0 END ORDER BY pos)), lambda a, b: a + b) AS pos,
    list_reduce(list_prepend(0::DOUBLE, list(CASE WHEN s < 0 THEN s - 1 ELSE 0 END ORDER BY pos)), lambda a, b: a + b) AS neg,
    count(*) FILTER (s = 0)::DOUBLE AS neu FROM s GROUP BY doc_id),
marks AS (SELECT doc_id, coalesce(total, 0) AS total, coalesce(pos, 0) AS pos, abs(coalesce(neg, 0)) AS neg, coalesce(neu, 0) AS neu,
    least(length(text) - length(replace(text, '!', '')), 4) * 0.292::DOUBLE AS bangs, length(text) - length(replace(text, '?', '')) AS asked
  FROM documents LEFT JOIN sums USING (doc_id)),
m AS (SELECT *, coalesce(bangs, 0) + CASE WHEN coalesce(asked, 0) <= 1 THEN 0 WHEN asked <= 3 THEN asked * 0.18::DOUBLE ELSE 0.96 END AS mark FROM marks),
e AS (SELECT doc_id, neu, total + sign(total) * mark AS total, pos + CASE WHEN pos > neg THEN mark ELSE 0 END AS pos, neg + CASE WHEN pos < neg THEN mark ELSE 0 END AS neg FROM m)
SELECT doc_id, round(coalesce(neg / nullif(pos + neg + neu, 0), 0), 3) AS vader_neg, round(coalesce(neu / nullif(pos + neg + neu, 0), 0), 3) AS vader_neu,
  round(coalesce(pos / nullif(pos + neg + neu, 0), 0), 3) AS vader_pos, round(total / sqrt(total * total + 15), 4) AS vader_compound FROM e""")
def rule_sentiment(spark, sf):
    """Valences are learned from the labelled documents; the endings of benchmark words make boosters and negations."""
    words = F.transform(sentiment.sentiment_words("text"), F.lower)
    labelled = _docs(spark, sf).join(table(spark, sf, "labels"), "doc_id").select("quality", F.explode_outer(F.array_distinct(words)).alias("token")).where("token IS NOT NULL")
    lexicon = labelled.groupBy("token").agg(F.round(4 * F.avg("quality") - 3, 3).alias("valence"), F.count(F.lit(1)).alias("n")).where("n >= 3")
    bare = F.transform(F.split("text", r"[ \t\n\r\f\x0B]+"), lambda w: F.lower(F.regexp_replace(w, "[^A-Za-z]", "")))
    other = table(spark, sf, "benchmark").select(F.explode(bare).alias("token")).distinct()
    end = F.right("token", F.lit(1))
    boosters = other.where(end.isin("t", "s")).select("token", F.when(end == "t", 0.293).otherwise(-0.293).alias("scalar"))
    return sentiment.rule_sentiment(_docs(spark, sf), "doc_id", "text", settle(lexicon), boosters, other.where(end == "r"), "und")


@Q.add("sentiment_by_entity", f"""
WITH w AS (SELECT source, list_filter(tokens, lambda t: t LIKE '%n') AS neg, tokens FROM {_TOKENIZED})
SELECT source, round(avg((len(tokens) - 2 * len(neg)) / sqrt((len(tokens) - 2 * len(neg)) * (len(tokens) - 2 * len(neg)) + 15.0)), 5) AS compound
FROM w GROUP BY source""")
def sentiment_by_entity(spark, sf):
    """Mean compound score per source, words ending in n counting -1, others 1."""
    docs = _tokenized(spark, sf).withColumn(
        "s", F.aggregate("tokens", F.lit(0), lambda a, t: a + F.when(t.endswith("n"), -1).otherwise(1))
    )
    compound = F.col("s") / F.sqrt(F.col("s") * F.col("s") + sentiment.ALPHA)
    return docs.groupBy("source").agg(F.round(F.avg(compound), 5).alias("compound"))


@Q.add("sentence_summary", f"""
WITH p AS (SELECT source, doc_id, regexp_split_to_array(text, '[.\\n]+') AS parts FROM documents),
raw AS (SELECT source, doc_id, unnest(parts) AS raw, generate_subscripts(parts, 1) AS i FROM p),
s AS (SELECT source, doc_id, regexp_replace(raw, '^{_BLANK}+|{_BLANK}+$', '', 'g') AS s, i FROM raw),
l AS (SELECT source, doc_id, s, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS pos FROM s WHERE s <> ''),
c AS (SELECT source, token, count(*) AS n_group FROM (SELECT source, unnest({_tokens('s', 1)}) AS token FROM l) GROUP BY ALL),
d AS (SELECT source, s, min((doc_id, pos)) AS seen FROM l GROUP BY ALL),
w AS (SELECT source, s, seen, unnest({_tokens('s', 1)}) AS token FROM d),
g AS (SELECT source, s, seen, sum(n_group) AS score FROM w JOIN c USING (source, token) GROUP BY ALL),
k AS (SELECT d.source, d.s, row_number() OVER (PARTITION BY d.source ORDER BY coalesce(score, 0) DESC, d.seen) AS r
      FROM d LEFT JOIN g ON g.source = d.source AND g.s = d.s)
SELECT source, count(*) AS n_parts, string_agg(s, chr(10) ORDER BY r) AS summary FROM k WHERE r <= 2 GROUP BY source""")
def sentence_summary(spark, sf):
    return summaries.sentence_summary(_docs(spark, sf), "source", "doc_id", "text", 2, STOPWORDS)


@Q.add("score_summary", rf"""
WITH d AS (SELECT *, len(regexp_extract_all(text, '{_NOT_BLANK}+')) / nullif(n_chars, 0) AS sen FROM documents),
r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS a,
  row_number() OVER (PARTITION BY source, lang ORDER BY n_chars DESC, doc_id) AS b,
  row_number() OVER (PARTITION BY source ORDER BY sen DESC NULLS LAST, n_chars DESC, doc_id) AS c,
  row_number() OVER (PARTITION BY source ORDER BY sen ASC NULLS LAST, n_chars DESC, doc_id) AS e FROM d)
SELECT source, count(*) AS n_parts, md5(string_agg(text, chr(10) ORDER BY doc_id)) AS summary
FROM r WHERE a = 1 OR b = 1 OR c = 1 OR e = 1 GROUP BY source""")
def score_summary(spark, sf):
    docs = _docs(spark, sf).withColumn("sen", F.try_divide(X.word_count("text"), F.col("n_chars")))
    out = summaries.score_summary(docs, "source", "doc_id", "text", "n_chars", "lang", "sen")
    return out.withColumn("summary", F.md5("summary"))


@Q.add("entity_document", f"""
WITH n AS (SELECT *, (sum(strlen(text)) OVER (PARTITION BY source ORDER BY doc_id) - strlen(text)) // 30000 AS part FROM documents)
SELECT source, part::BIGINT AS part, count(*) AS n_rows, md5(string_agg(text, chr(10) ORDER BY doc_id)) AS text_sum,
  md5(coalesce(string_agg(array_to_string({_tokens('text')}, ' '), ' ' ORDER BY doc_id) FILTER (WHERE len({_tokens('text')}) > 0), '')) AS tokens_sum
FROM n GROUP BY source, part""")
def entity_document(spark, sf):
    docs = _docs(spark, sf).withColumn("tokens", X.tokenize("text", STOPWORDS))
    out = profile.entity_document(docs, ["source"], ["doc_id"], {"text_sum": "text"}, {"tokens_sum": "tokens"}, part_bytes=30_000)
    return out.select("source", "part", "n_rows", F.md5("text_sum").alias("text_sum"), F.md5(F.array_join("tokens_sum", " ")).alias("tokens_sum"))


@Q.add("entity_totals", "SELECT source, count(*) AS n_rows, count(*) FILTER (WHERE lang = 'en') AS n_english, sum(n_chars)::BIGINT AS chars FROM documents GROUP BY source")
def entity_totals(spark, sf):
    counts = {"n_english": (F.col("lang") == "en").cast("int"), "chars": F.col("n_chars")}
    return profile.entity_totals(table(spark, sf, "documents"), ["source"], counts)


@Q.add("conversation_document", """
SELECT conv_id, 0::BIGINT AS part, count(*) AS n_rows, string_agg(text, chr(10) ORDER BY turn) AS text_sum,
  string_agg(role, chr(10) ORDER BY turn) AS roles FROM conversations GROUP BY conv_id""")
def conversation_document(spark, sf):
    return profile.entity_document(table(spark, sf, "conversations"), ["conv_id"], ["turn"], {"text_sum": "text", "roles": "role"})


def _turn_pairs(spark, sf):
    """Every turn with the one that follows it."""
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "text")
    following = turns.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("reply"))
    return turns.join(following, ["conv_id", "turn"]).withColumn("pair", F.concat_ws("-", "conv_id", "turn"))


_PAIRS = """(SELECT a.conv_id || '-' || a.turn AS pair, a.conv_id, a.turn, a.text, b.text AS reply
  FROM conversations a JOIN conversations b ON b.conv_id = a.conv_id AND b.turn = a.turn + 1)"""


def _grams(source: str, key: str, tokens: str, orders: int) -> str:
    return " UNION ALL ".join(
        f"SELECT {key}, {n} AS n, unnest(list_transform(range(1, len({tokens}) - {n - 2}), "
        f"lambda i: array_to_string(list_slice({tokens}, i, i + {n - 1}), ' '))) AS gram FROM {source}"
        for n in range(1, orders + 1)
    )


@Q.add("rouge", f"""
WITH t AS (SELECT pair, regexp_extract_all(lower(text), '[a-z0-9]+') AS r, regexp_extract_all(lower(reply), '[a-z0-9]+') AS h FROM {_PAIRS}),
gr AS (SELECT pair, n, gram, count(*) AS c FROM ({_grams('t', 'pair', 'r', 3)}) GROUP BY ALL),
gh AS (SELECT pair, n, gram, count(*) AS c FROM ({_grams('t', 'pair', 'h', 3)}) GROUP BY ALL),
m AS (SELECT pair, n, sum(least(gr.c, gh.c)) AS m FROM gr JOIN gh USING (pair, n, gram) GROUP BY ALL),
sr AS (SELECT pair, n, sum(c) AS r FROM gr GROUP BY ALL), sh AS (SELECT pair, n, sum(c) AS h FROM gh GROUP BY ALL),
x AS (SELECT pair, k.n::INT AS n, coalesce(m / sh.h, 0) AS p, coalesce(m / sr.r, 0) AS q FROM t CROSS JOIN range(1, 4) k(n)
  LEFT JOIN m USING (pair, n) LEFT JOIN sr USING (pair, n) LEFT JOIN sh USING (pair, n))
SELECT pair, n, round(p, 6) AS precision, round(q, 6) AS recall, round(coalesce(2 * p * q / nullif(p + q, 0), 0), 6) AS fmeasure FROM x""")
def rouge(spark, sf):
    out = overlap.rouge(_turn_pairs(spark, sf), "pair", "text", "reply")
    return out.select("pair", "n", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "fmeasure")])


_BLEU = r"[\p{L}\p{N}_]+|[^\s\p{L}\p{N}_]"


@Q.add("bleu", f"""
WITH t AS (SELECT pair, turn % 2 AS side, regexp_extract_all(reply, '{_BLEU}') AS h, regexp_extract_all(text, '{_BLEU}') AS r1,
  regexp_extract_all(lower(text), '{_BLEU}') AS r2 FROM {_PAIRS}),
gh AS (SELECT pair, side, n, gram, count(*) AS c FROM ({_grams('t', 'pair, side', 'h', 4)}) GROUP BY ALL),
ga AS (SELECT pair, n, gram, count(*) AS c FROM ({_grams('t', 'pair', 'r1', 4)}) GROUP BY ALL),
gb AS (SELECT pair, n, gram, count(*) AS c FROM ({_grams('t', 'pair', 'r2', 4)}) GROUP BY ALL),
gr AS (SELECT pair, n, gram, max(c) AS c FROM (FROM ga UNION ALL FROM gb) GROUP BY ALL),
m AS (SELECT side, n, sum(least(gh.c, gr.c)) AS m FROM gh JOIN gr USING (pair, n, gram) GROUP BY ALL),
p AS (SELECT side, n, sum(c) AS p FROM gh GROUP BY ALL),
l AS (SELECT side, sum(len(h)) AS hl, sum(least(len(r1), len(r2))) AS rl FROM t GROUP BY side),
b AS (SELECT l.side, hl, rl, n, coalesce(m / p.p, 0) AS pr, CASE WHEN hl / rl > 1 THEN 1.0::DOUBLE ELSE exp(1 - rl / hl) END AS bp
  FROM l JOIN p USING (side) LEFT JOIN m USING (side, n))
SELECT side, hl::BIGINT AS translation_length, rl::BIGINT AS reference_length, round(bp, 6) AS brevity_penalty,
  round(max(pr) FILTER (WHERE n = 1), 6) AS precision_1, round(max(pr) FILTER (WHERE n = 2), 6) AS precision_2,
  round(max(pr) FILTER (WHERE n = 3), 6) AS precision_3, round(max(pr) FILTER (WHERE n = 4), 6) AS precision_4,
  round(CASE WHEN min(pr) > 0 THEN bp * exp(sum(CASE WHEN pr > 0 THEN ln(pr) END) / 4) ELSE 0 END, 6) AS bleu
FROM b GROUP BY side, hl, rl, bp""")
def bleu(spark, sf):
    """Replies against the turn before them, as written and in lower case."""
    pairs = _turn_pairs(spark, sf).select(
        "pair", (F.col("turn") % 2).alias("side"), F.array("text", F.lower("text")).alias("refs"), "reply"
    )
    out = overlap.bleu(pairs, "pair", "refs", "reply", by=["side"])
    rounded = ("brevity_penalty", "precision_1", "precision_2", "precision_3", "precision_4", "bleu")
    return out.select("side", "translation_length", "reference_length", *[F.round(c, 6).alias(c) for c in rounded])


@Q.add("chunks", rf"""
WITH t AS (SELECT doc_id, regexp_extract_all(text, '{_NOT_BLANK}+') AS t FROM documents),
c AS (SELECT doc_id, t, unnest(range(0, (len(t) + 63) // 64)) AS chunk_no FROM t)
SELECT doc_id, chunk_no::INT AS chunk_no, len(list_slice(t, chunk_no * 64 + 1, chunk_no * 64 + 64))::INT AS n_tokens,
  md5(array_to_string(list_slice(t, chunk_no * 64 + 1, chunk_no * 64 + 64), ' ')) AS chunk FROM c""")
def chunk_table(spark, sf):
    return chunks.chunk(_docs(spark, sf), "doc_id", "text", 64).withColumn("chunk", F.md5("chunk"))


@Q.add("packed_texts", rf"""
WITH RECURSIVE d AS (SELECT source, doc_id, text, greatest(len(regexp_extract_all(text, '{_NOT_BLANK}+')), 1) AS n,
  row_number() OVER (PARTITION BY source ORDER BY doc_id) AS i FROM documents),
f AS (SELECT source, doc_id, i, n AS open, 0 AS pack_no, n FROM d WHERE i = 1
  UNION ALL SELECT d.source, d.doc_id, d.i, CASE WHEN f.open + d.n > 4000 THEN d.n ELSE f.open + d.n END,
    CASE WHEN f.open + d.n > 4000 THEN f.pack_no + 1 ELSE f.pack_no END, d.n
  FROM f JOIN d ON d.source = f.source AND d.i = f.i + 1)
SELECT f.source, pack_no::BIGINT AS pack_no, count(*) AS n_rows, sum(f.n)::BIGINT AS n_tokens,
  md5(string_agg(text, chr(10) || chr(10) ORDER BY f.doc_id)) AS packed
FROM f JOIN d ON d.doc_id = f.doc_id GROUP BY ALL""")
def packed_texts(spark, sf):
    return chunks.pack_texts(_docs(spark, sf), ["source"], ["doc_id"], "text", 4000).withColumn("packed", F.md5("packed"))


_CLEAN = f"regexp_replace(regexp_replace(text, '{_BLANK}+', ' ', 'g'), '[.]+', '.', 'g')"
_NORMAL = f"lower(strip_accents(replace({_CLEAN}, 'ß', 'ss')))"


def _spaced(c: str) -> str:
    return f"regexp_replace(regexp_replace({c}, '\\n+', ' ' || chr(10) || ' ', 'g'), '[.]+', ' . ', 'g')"


_HOTELS = f"(SELECT *, {_CLEAN} AS c, {_NORMAL} AS m FROM documents)"


@Q.add("hotel_documents", f"""
SELECT source AS name, 0::BIGINT AS part, count(*) AS n_rows, md5({_spaced("string_agg(c, chr(10) ORDER BY doc_id)")}) AS text_sum,
  md5({_spaced("string_agg(m, chr(10) ORDER BY doc_id)")}) AS text_normalized_sum,
  string_agg('a, ' || lang, ' ' || chr(10) || ' ' ORDER BY doc_id) AS highlights_sum, sum(len(string_split(m, '.')))::INT AS n_sentences
FROM {_HOTELS} GROUP BY source""")
def hotel_documents(spark, sf):
    """Documents as the reviews of their source, prepared and joined per source."""
    docs = prepare.hotel_documents(_hotel_texts(spark, sf), order=("review_id",))
    return docs.select(
        "name", "part", "n_rows", F.md5("text_sum").alias("text_sum"), F.md5("text_normalized_sum").alias("text_normalized_sum"),
        "highlights_sum", F.size("text_tokens_sum").alias("n_sentences"),
    )


def _hotel_texts(spark, sf):
    reviews = _docs(spark, sf).select(
        F.col("source").alias("name"), F.col("doc_id").alias("review_id"), "text",
        F.when(F.col("lang") != "en", "Obrigado.").alias("response_text"), F.array(F.lit("a"), F.col("lang")).alias("highlights"),
    )
    return prepare.text_table(reviews, stopwords=STOPWORDS)


@Q.add("hotel_counts", """
SELECT source AS name, count(*) AS n_rows, count(*) AS review_count, count(text) AS text_count,
  count(*) FILTER (WHERE lang <> 'en') AS response_text_count FROM documents GROUP BY source""")
def hotel_counts(spark, sf):
    return prepare.hotel_counts(_hotel_texts(spark, sf))


@Q.add("text_report", rf"""
WITH w AS (SELECT *, len(regexp_extract_all(text, '{_NOT_BLANK}+')) AS n, len({_tokens('text')}) AS t FROM documents)
SELECT source AS name, min_by('P' || doc_id, doc_id) AS place_name, count(*) AS review_id, count(text) AS text,
  count(*) FILTER (WHERE lang <> 'en') AS response_text, sum(n)::BIGINT AS words_len, sum(t)::BIGINT AS tokens_len FROM w GROUP BY source""")
def text_report(spark, sf):
    reviews = _docs(spark, sf).select(
        F.col("source").alias("name"), F.col("doc_id").alias("review_id"), "text", F.concat(F.lit("P"), F.col("doc_id").cast("string")).alias("place_name"),
        F.when(F.col("lang") != "en", "Obrigado.").alias("response_text"), X.word_count("text").alias("words_len"),
        F.size(X.tokenize("text", STOPWORDS)).alias("tokens_len"),
    )
    return prepare.text_report(reviews, ("review_id",))
