"""Record layouts of the review domain."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "INT": T.IntegerType(), "BIGINT": T.LongType(), "DOUBLE": T.DoubleType(),
    "STRING": T.StringType(), "TIMESTAMP_NTZ": T.TimestampNTZType(),
}


def _struct(spec: str) -> T.StructType:
    """``"name TYPE, ..."`` without needing a running session."""
    pairs = [p.split() for p in spec.split(",")]
    return T.StructType([T.StructField(n, _TYPES[t]) for n, t in pairs])


# Column names and order of the files users already have.
PLACE_INPUT = _struct(
    "done INT, name STRING, n_reviews INT, sort_by STRING, hl STRING, url STRING, "
    "google_id STRING, n_reviews_max BIGINT, dt_selection INT, stars DOUBLE, city STRING, "
    "sigla STRING, estado STRING, capital STRING, regiao STRING, category STRING, subtypes STRING"
)

PLACE_META = _struct(
    "name STRING, feature_id STRING, retrieval_date TIMESTAMP_NTZ, place_name STRING, "
    "address STRING, overall_rating DOUBLE, n_reviews BIGINT, topics STRING, url STRING"
)

REVIEW_FIELDS = (
    "token", "review_id", "retrieval_date", "rating", "rating_max", "relative_date", "likes",
    "other_ratings", "trip_type_travel_group", "user_name", "user_is_local_guide",
    "user_reviews", "user_photos", "user_url", "text", "response_text",
    "response_relative_date", "errors",
)

RAW_REVIEW = T.StructType([T.StructField(f, T.StringType()) for f in REVIEW_FIELDS])

REVIEW_TYPES = {
    "retrieval_date": "timestamp_ntz",
    "rating": "double",
    "rating_max": "double",
    "likes": "double",
}

# Prepared name -> index name (22 columns).
INDEX_COLUMNS = {
    "stars": "estrelas",
    "city": "cidade",
    "sigla": "sigla_estado",
    "estado": "estado",
    "capital": "capital_estado",
    "regiao": "regiao",
    "category": "categoria",
    "subtypes": "subcategoria",
    "place_name": "nome",
    "address": "endereco",
    "overall_rating": "classificacao_geral",
    "n_reviews": "quantidade_avaliacoes",
    "rating": "nota_avaliacao",
    "likes": "curtidas_avaliacao",
    "user_is_local_guide": "usuario_guia_local",
    "text": "text",
    "review_date": "data_avaliacao",
    "rooms": "nota_quartos",
    "locale": "nota_localizacao",
    "service": "nota_servico",
    "avaliacao_recente": "avaliacao_recente",
    "text_n_words": "numero_palavras_avaliacao",
}

STATE_MAP = _struct("sigla STRING, estado STRING, capital STRING, regiao STRING, region STRING")

LAT_LONG = _struct("name STRING, latitude DOUBLE, longitude DOUBLE")
