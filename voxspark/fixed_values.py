"""Phrases, maps and text formats that decide results.

They describe the review site's Portuguese and English wording and the layout
of the context blocks handed to a language model, so they have to be exactly
these strings.
"""

from __future__ import annotations

# --- relative dates ------------------------------------------------------------
# Every word of a span of time as (months, seconds), the word for one, and the ending.
_SPANS = {"year": (12, 0), "month": (1, 0), "week": (0, 604800), "day": (0, 86400), "hour": (0, 3600), "minute": (0, 60), "second": (0, 1)}
_PORTUGUESE = {
    "year": ("ano", "anos"), "month": ("mes", "meses"), "week": ("semana", "semanas"), "day": ("dia", "dias"),
    "hour": ("hora", "horas"), "minute": ("minuto", "minutos"), "second": ("segundo", "segundos"),
}
DATE_WORDS = {
    "pt-br": {word: _SPANS[span] for span, words in _PORTUGUESE.items() for word in words},
    "en": {span + ending: step for span, step in _SPANS.items() for ending in ("", "s")},
}
DATE_ONE = {"pt-br": r"^uma?\b", "en": r"^an?\b"}
DATE_AGO = {"pt-br": r"\satras$", "en": r"\sago$"}

# --- machine translation marks ---------------------------------------------------
TRANSLATION_FLAG = {"pt-br": "Tradução do Google", "en": "Translated by Google"}
ORIGINAL_MARK = "(Original)"

# --- sub-ratings -------------------------------------------------------------------
SUB_RATING_LABELS = {"rooms": "Quartos", "locale": "Local", "service": "Serviço"}
HIGHLIGHTS_LABEL = "Destaques do hotel "
HIGHLIGHTS_SPLIT = ", | e "

# --- topic strip and counts ----------------------------------------------------------
TOPICS_PREFIX = r"Todas 0 |[+]6 "

# --- request sort order ---------------------------------------------------------------
SORT_ORDER = {
    "most_relevant": "qualityScore",
    "newest": "newestFirst",
    "highest_rating": "ratingHigh",
    "lowest_rating": "ratingLow",
}
SORT_ORDER_DEFAULT = "newestFirst"

# --- identifiers inside URLs --------------------------------------------------------------
FEATURE_ID = r"0[xX][0-9a-fA-F]+:0[xX][0-9a-fA-F]+"
USER_ID = r"(?<=/)\d{21}(?=\?)"
STARS_WORDS = r" estrelas|[$]*"
COUNT_WORDS = r"[.]|,| reviews| comentários"
USER_COUNT = r"[Uuma0-9.,]+"

# --- recency limit of the index table --------------------------------------------------------
RECENT_AFTER = "2024-08-01"

# --- page markup (element classes of the review pages) ---------------------------------------
PLACE_CLASSES = {
    "address": "ffUfxe",
    "place_name": "Lhccdd",
    "overall_rating": "Aq14fc",
    "n_reviews": "z5jxId",
}
REVIEW_CLASSES = {
    "text": "review-full-text",
    "rating": "lTi8oc z3HNkc",
    "other_ratings": "k8MTF",
    "relative_date": "dehysf lTi8oc",
    "user_name": "TSUbDb",
    "user": "Msppse",
    "local_guide": "QV3IV",
    "review_id": "RvU3D",
    "response_text": "d6SCIc",
    "response_relative_date": "pi8uOe",
    "trip_type_travel_group": "PV7e7",
}
LIKES_NAME = "CMh1ye"
SHORT_TEXT = "data-expandable-section"

# --- context blocks -----------------------------------------------------------------------
OTHER_NOTES = {
    "nota_quartos": "Quartos",
    "nota_localizacao": "Localização",
    "nota_servico": "Serviço",
}
# own value: what stands in a context for something not known
UNKNOWN = "não informado"
LOCAL_GUIDE = "; Usuário é guia local"
NOT_LOCAL_GUIDE = "; Usuário não é guia local"
SUMMARY_CONTEXT_INTRO = "Informações gerais sobre o hotel:"
SUMMARY_CONTEXT_TOP = "\nTop {n} avaliações do hotel mais semelhantes à pergunta:\n"

# --- summary questions ------------------------------------------------------------
ASK_FULL_HEAD = 'Faça um resumo do hotel "{hotel}" com base nos seguintes tópicos:\n'
ASK_FULL_TAIL = (
    "Para cada tópico, escreva um parágrafo com os principais aspectos positivos e "
    "negativos do hotel com base em suas avaliações."
)
ASK_TOPIC = {
    True: 'Quais os aspectos positivos do hotel "{hotel}" no quesito "{topic}"?',
    False: 'Quais os aspectos negativos do hotel "{hotel}" no quesito "{topic}"?',
}
FINAL_INTRO = 'A seguir, uma lista de resumos do hotel "{hotel}" por tópico e aspecto:'
FINAL_TITLE = {
    True: 'Aspectos positivos do hotel no quesito "{topic}":\n',
    False: 'Aspectos negativos do hotel no quesito "{topic}":\n',
}
MIN_POSITIVE_NOTE = 3
MAX_NEGATIVE_NOTE = 3

# --- index names -----------------------------------------------------------------------------
INDEX_SHARD_ROWS = 10_000
