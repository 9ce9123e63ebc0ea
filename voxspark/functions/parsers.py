"""Parsers for the free-form fields of places and reviews, as Columns.

A value that does not fit its format becomes NULL; nothing raises mid-job.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from voxspark import fixed_values as V
from voxspark.functions.text import col, fold_accents, once, strip


def _found(c: Column, pattern: str, group: int = 0) -> Column:
    """First match of ``pattern`` or NULL (Spark itself gives an empty text)."""
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))


def _looked_up(c: Column, mapping: dict[str, str]) -> Column:
    table = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.element_at(table, c)


def relative_date(c: Column | str, retrieved: Column | str, hl: str | Column = "pt-br") -> Column:
    """``"2 semanas atrás"`` seen at ``retrieved`` -> the moment it points to.

    Months and years keep the calendar day where it exists and clamp to the end
    of the month where it does not.
    """
    if isinstance(hl, Column):
        out = F.lit(None)
        for lang in V.DATE_WORDS:
            out = F.when(hl == lang, relative_date(c, retrieved, lang)).otherwise(out)
        return out
    shape = r"^(\d{1,6}(?:\.\d+)?) (\S+)$"
    step = F.create_map(*[
        x for word, (months, seconds) in V.DATE_WORDS[hl].items()
        for x in (F.lit(word), F.struct(F.lit(months).alias("m"), F.lit(seconds).alias("s")))
    ])
    phrase = strip(F.lower(fold_accents(c)))
    phrase = F.regexp_replace(F.regexp_replace(phrase, V.DATE_ONE[hl], "1"), V.DATE_AGO[hl], "")
    at = col(retrieved).cast("timestamp_ntz")

    def parsed(p: Column) -> Column:
        return F.struct(
            _found(p, shape, 1).try_cast("double").alias("n"),
            F.element_at(step, _found(p, shape, 2)).alias("step"),
        )

    def moved(p: Column) -> Column:
        n, months, seconds = p["n"], p["step"]["m"], p["step"]["s"]
        whole = (months == 0) | (n == F.floor(n))
        return F.when(
            whole,
            at
            - F.make_ym_interval(F.lit(0), (n * months).cast("int"))
            - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (n * seconds).cast("decimal(18,6)")),
        )

    return once(phrase, lambda p: once(parsed(p), moved))


def translated_text(c: Column | str, hl: str = "pt-br") -> Column:
    """Struct (is_other_language, text): the translation without its marks.

    The translated part is kept; the original after its mark is cut up to the
    end of the last line.
    """
    text = col(c)
    flag = V.TRANSLATION_FLAG[hl]
    pattern = rf"(?d)\(\Q{flag}\E\)|\Q{V.ORIGINAL_MARK}\E.*?$"
    found = text.contains(flag)
    return F.struct(
        found.alias("is_other_language"),
        F.when(found, strip(F.regexp_replace(text, pattern, ""))).otherwise(text).alias("text"),
    )


def other_ratings(c: Column | str) -> Column:
    """Struct (rooms, locale, service, highlights) out of the sub-rating line."""
    text = col(c)
    notes = [
        _found(text, rf"{label} : (\d)/", 1).try_cast("double").alias(name)
        for name, label in V.SUB_RATING_LABELS.items()
    ]
    rest = F.when(
        text.contains(V.HIGHLIGHTS_LABEL),
        F.split(F.regexp_extract(text, rf"(?d){V.HIGHLIGHTS_LABEL}(.*)", 1), V.HIGHLIGHTS_SPLIT),
    )
    return F.struct(*notes, rest.alias("highlights"))


def topics(c: Column | str) -> Column:
    """Struct (names, counts) out of ``"recepção 33 check-in 17"``."""
    text = F.replace(F.regexp_replace(col(c), V.TOPICS_PREFIX, ""), F.lit("2016"), F.lit("'2016"))
    shape = r"(.+?) (\d+)(?: |$)"
    return F.struct(
        F.regexp_extract_all(text, F.lit(shape), 1).alias("names"),
        F.transform(
            F.regexp_extract_all(text, F.lit(shape), 2), lambda n: n.try_cast("int")
        ).alias("counts"),
    )


def user_id(c: Column | str) -> Column:
    """Exactly 21 digits between a slash and the query part of the profile URL."""
    return _found(col(c), V.USER_ID)


def trip_types(c: Column | str) -> Column:
    return F.split(col(c), r" \| ")


def likes(c: Column | str) -> Column:
    """-1 (not collected) and missing both mean no likes."""
    n = col(c).try_cast("double")
    return F.when(n == -1, F.lit(0.0)).otherwise(F.coalesce(n, F.lit(0.0)))


def flag_number(c: Column | str) -> Column:
    """``True``/``False`` text to 1.0/0.0; missing counts as false."""
    return F.coalesce(col(c).try_cast("boolean"), F.lit(False)).cast("double")


def stars(c: Column | str) -> Column:
    """``"4 estrelas"`` -> 4.0; price signs, empty and missing -> 0.0."""
    left = F.regexp_replace(col(c), V.STARS_WORDS, "")
    return F.when(F.coalesce(left, F.lit("")) == "", F.lit(0.0)).otherwise(left.try_cast("double"))


def feature_id(c: Column | str) -> Column:
    return _found(col(c), V.FEATURE_ID)


def place_name(c: Column | str) -> Column:
    """Decoded name between ``place/`` and the next slash of a place URL."""
    return F.try_url_decode(_found(col(c), r"(?d)place/(.*?)/", 1))


def slug(c: Column | str, suffix: str = "") -> Column:
    return F.concat(F.replace(F.lower(strip(c)), F.lit(" "), F.lit("-")), F.lit(suffix))


def sort_order(c: Column | str) -> Column:
    return F.coalesce(_looked_up(col(c), V.SORT_ORDER), F.lit(V.SORT_ORDER_DEFAULT))


def page_count(c: Column | str, per_page: int = 10) -> Column:
    return F.ceil(col(c) / per_page).cast("bigint")


def localized_number(c: Column | str) -> Column:
    """Decimal comma to dot."""
    return F.replace(col(c), F.lit(","), F.lit(".")).try_cast("double")


def label_ratings(c: Column | str) -> Column:
    """Struct (rating, rating_max) out of ``"Classificado como 4,0 de 5,0"``."""
    found = F.regexp_extract_all(
        F.replace(col(c), F.lit(","), F.lit(".")), F.lit(r"([0-9]+[.][0-9]*)"), 1
    )
    return F.struct(
        F.get(found, F.lit(0)).try_cast("double").alias("rating"),
        F.get(found, F.lit(1)).try_cast("double").alias("rating_max"),
    )


def count_text(c: Column | str) -> Column:
    """``"1.057 comentários"`` -> 1057."""
    return F.regexp_replace(col(c), V.COUNT_WORDS, "").try_cast("bigint")


def user_counts(c: Column | str) -> Column:
    """Struct (reviews, photos) as written in the user line."""
    return F.struct(
        _found(col(c), rf"({V.USER_COUNT})(?: comentário| review)", 1).alias("reviews"),
        _found(col(c), rf"({V.USER_COUNT})(?: foto| photo)", 1).alias("photos"),
    )


def day_text(c: Column | str) -> Column:
    return F.date_format(col(c), "yyyy-MM-dd")


def is_recent(c: Column | str, after: str = V.RECENT_AFTER) -> Column:
    """1.0 after the limit; a missing date is not recent."""
    return F.coalesce(col(c) > F.lit(after).cast("timestamp_ntz"), F.lit(False)).cast("double")


def reply_score(c: Column | str) -> Column:
    """First integer of a model reply."""
    return _found(col(c), r"(\d+)", 1).try_cast("int")


def filter_reply(reply: Column | str, question: Column | str) -> Column:
    """Struct (filter_json, question) out of a model reply in a JSON code fence.

    ``filter_json`` is NULL unless it parses; a reply without a closing fence
    leaves the question as it was asked.
    """
    parts = F.split(F.replace(col(reply), F.lit("```json"), F.lit("")), "```")
    body = F.replace(F.get(parts, F.lit(0)), F.lit("'"), F.lit('"'))
    asked = F.get(parts, F.lit(1))
    valid = F.try_parse_json(body).isNotNull() & asked.isNotNull()
    return F.struct(
        F.when(valid, strip(body)).alias("filter_json"),
        F.coalesce(F.when(asked.isNotNull(), strip(asked)), col(question)).alias("question"),
    )


def truncated(c: Column | str, n: int) -> Column:
    return F.left(col(c), F.lit(n))


def state_code(state: Column | str, mapped: Column | str) -> Column:
    """Two-letter states are codes already, all others come from the map."""
    return F.when(F.length(col(state)) == 2, col(state)).otherwise(col(mapped))


def blank_to_null(c: Column | str, na_values: tuple[str, ...] = ()) -> Column:
    text = col(c)
    return F.when((text != "") & ~text.isin(*na_values) if na_values else text != "", text)

