from datetime import datetime

import pytest
from pyspark.sql import functions as F

from voxspark.functions import parsers as P, text as X


def one(spark, value, make, type_="string"):
    df = spark.createDataFrame([(value,)], f"v {type_}")
    return df.select(make(F.col("v")).alias("r")).head().r


@pytest.mark.parametrize(
    "phrase, seen, expected",
    [
        ("um mês atrás", "2023-03-31 10:00:00", datetime(2023, 2, 28, 10)),
        ("2 semanas atrás", "2023-03-31 10:00:00", datetime(2023, 3, 17, 10)),
        ("uma hora atrás", "2023-03-31 10:00:00", datetime(2023, 3, 31, 9)),
        (" 3 ANOS ATRÁS ", "2024-02-29 00:00:00", datetime(2021, 2, 28)),
        ("2.5 dias atrás", "2024-03-10 00:00:00", datetime(2024, 3, 7, 12)),
        ("1.5 meses atrás", "2024-03-10 00:00:00", None),
        ("45 segundos atrás", "2024-03-10 00:00:00", datetime(2024, 3, 9, 23, 59, 15)),
        ("", "2023-03-31 10:00:00", None),
        (None, "2023-03-31 10:00:00", None),
        ("Editado ontem", "2023-03-31 10:00:00", None),
        ("5 séculos atrás", "2023-03-31 10:00:00", None),
    ],
)
def test_relative_date(spark, phrase, seen, expected):
    at = F.lit(seen).cast("timestamp_ntz")
    assert one(spark, phrase, lambda c: P.relative_date(c, at)) == expected


def test_relative_date_english_article_and_language_column(spark):
    rows = spark.createDataFrame(
        [("an hour ago", "en"), ("a year ago", "en"), ("um ano atrás", "pt-br"), ("a year ago", "fr")],
        "p string, hl string",
    )
    at = F.lit("2023-03-31 10:00:00").cast("timestamp_ntz")
    got = [r.d for r in rows.select(P.relative_date("p", at, F.col("hl")).alias("d")).collect()]
    assert got == [datetime(2023, 3, 31, 9), datetime(2022, 3, 31, 10), datetime(2022, 3, 31, 10), None]


def test_translated_text(spark):
    got = one(spark, "(Tradução do Google) Topo (Original) Top", P.translated_text)
    assert (got.is_other_language, got.text) == (True, "Topo")
    got = one(spark, " como veio ", P.translated_text)
    assert (got.is_other_language, got.text) == (False, " como veio ")
    got = one(spark, None, P.translated_text)
    assert (got.is_other_language, got.text) == (None, None)
    got = one(spark, "(Translated by Google) Top\n(Original)\nTopo", lambda c: P.translated_text(c, "en"))
    # the cut runs to the end of the text's last line and does not cross lines
    assert got.text == "Top\n(Original)\nTopo"


def test_other_ratings(spark):
    line = "Quartos : 4/5 Local : 5/5 Serviço : 3/5 Destaques do hotel Luxo, Vista e Silencioso"
    got = one(spark, line, P.other_ratings)
    assert tuple(got) == (4.0, 5.0, 3.0, ["Luxo", "Vista", "Silencioso"])
    assert tuple(one(spark, "Local : 2/5", P.other_ratings)) == (None, 2.0, None, None)
    assert tuple(one(spark, None, P.other_ratings)) == (None, None, None, None)


def test_topics(spark):
    got = one(spark, "Todas 0 recepção 33 check-in 17", P.topics)
    assert (got.names, got.counts) == (["recepção", "check-in"], [33, 17])


def test_identifiers(spark):
    url = (
        "https://www.site/maps/place/Pousada+Itarar%C3%A9/@-23.9,15z/data=!4m2!3m1!"
        "1s0x0:0x6825759cc04b2504?sa=X"
    )
    assert one(spark, url, P.feature_id) == "0x0:0x6825759cc04b2504"
    assert one(spark, url, P.place_name) == "Pousada Itararé"
    assert one(spark, "nothing here", P.feature_id) is None
    digits = "1" * 21
    assert one(spark, f"https://x/contrib/{digits}?hl=pt", P.user_id) == digits
    assert one(spark, f"https://x/contrib/{digits}1?hl=pt", P.user_id) is None


def test_numbers(spark):
    assert one(spark, "4 estrelas", P.stars) == 4.0
    assert one(spark, "$$", P.stars) == 0.0
    assert one(spark, None, P.stars) == 0.0
    assert one(spark, "1.057 comentários", P.count_text) == 1057
    assert tuple(one(spark, "Classificado como 4,0 de 5,0", P.label_ratings)) == (4.0, 5.0)
    assert tuple(one(spark, "34 comentários 1.012 fotos", P.user_counts)) == ("34", "1.012")
    assert one(spark, "-1", P.likes) == 0.0
    assert one(spark, None, P.likes) == 0.0
    assert one(spark, "7", P.likes) == 7.0
    assert [one(spark, v, P.flag_number) for v in ("True", "False", None)] == [1.0, 0.0, 0.0]
    assert [one(spark, v, P.page_count, "int") for v in (1, 10, 11)] == [1, 1, 2]


def test_replies(spark):
    assert [one(spark, v, P.reply_score) for v in ("4", "Nota: 5", "sem nota", None)] == [4, 5, None, None]
    asked = F.lit("Q?")
    got = one(spark, '```json {"estrelas": {"$gte": 3}} ``` Qual? ', lambda c: P.filter_reply(c, asked))
    assert tuple(got) == ('{"estrelas": {"$gte": 3}}', "Qual?")
    got = one(spark, "```json {'a': ``` Qual?", lambda c: P.filter_reply(c, asked))
    assert tuple(got) == (None, "Qual?")
    assert tuple(one(spark, "não sei", lambda c: P.filter_reply(c, asked))) == (None, "Q?")


def test_defaults(spark):
    assert one(spark, "highest_rating", P.sort_order) == "ratingHigh"
    assert one(spark, "x", P.sort_order) == "newestFirst"
    assert one(spark, " Hotel Bom Dia ", lambda c: P.slug(c, "-gm-reviews")) == "hotel-bom-dia-gm-reviews"
    assert one(spark, None, P.is_recent, "timestamp_ntz") == 0.0
    assert one(spark, datetime(2024, 8, 2), P.is_recent, "timestamp_ntz") == 1.0


def test_text_forms(spark):
    assert one(spark, "a  b... c", X.clean) == "a b. c"
    assert one(spark, "Ótimo ÀÉÎõü Straße", X.normalize) == "otimo aeiou strasse"
    assert one(spark, " a . b ,c\n", X.clean_full) == "a. b, c"
    assert one(spark, "a.b\nc", X.newline_sentences) == "a;b.c"
    assert one(spark, "a\n\nb.c", X.space_marks) == "a \n b . c"
    assert one(spark, " um  dois três ", X.word_count) == 3
    assert one(spark, None, X.word_count) == 0


def test_tokens(spark):
    text = "Olá, não é o HOTEL 5_estrelas muito bom! bom."
    assert one(spark, text, lambda c: X.tokenize(c)) == ["olá", "hotel", "bom", "bom"]
    assert one(spark, "a.bom dia..", lambda c: X.sentence_tokens(c)) == [[], ["bom", "dia"], [], []]
    pairs = one(spark, ["b", "a", "b"], X.token_counts, "array<string>")
    assert [tuple(p) for p in pairs] == [("a", 1), ("b", 2)]
    assert one(spark, [], X.token_counts, "array<string>") is None
