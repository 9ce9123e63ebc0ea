"""Records out of HTML pages: regular expressions in the JVM, and elements cut in Arrow batches."""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from voxspark import fixed_values as V
from voxspark.functions import parsers as P, text as X

# Entities and their signs; the ampersand comes last.
ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&nbsp;": " ", "&amp;": "&"}


def plain_text(c: Column | str) -> Column:
    """Tags become blanks, entities signs, runs of blanks one space."""
    out = F.regexp_replace(X.col(c), "(?s)<!--.*?-->|<[^>]*>", " ")
    for entity, sign in ENTITIES.items():
        out = F.replace(out, F.lit(entity), F.lit(sign))
    return X.strip(F.regexp_replace(out, f"{X.BLANK}+", " "))


def cut_body(c: Column | str) -> Column:
    """From the first ``<div`` to the last ``</div>``; all of it without one."""
    html = X.col(c)
    return F.coalesce(F.nullif(F.regexp_extract(html, "(?s)<div.*</div>?", 0), F.lit("")), html)


def _attribute(name: str, value: str) -> str:
    if name == "class" and " " not in value:
        return rf'class="(?:[^"]* )?{re.escape(value)}(?: [^"]*)?"'
    return rf'{name}="{re.escape(value)}"'


# Tags that have no end.
_VOID = r"(?i)^<(?:area|base|br|col|embed|hr|img|input|link|meta|source|track|wbr)\b"
_NO_END = frozenset("area base br col embed hr img input link meta source track wbr script style".split())
# Scripts, styles and comments are one piece each; then tags, and text between them.
_PIECES = r"(?is)(<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->|<[^>]*>|[^<]+|<)"
_NAME = r"<(/?)(\w+)"


def by_attribute(value: str, attribute: str = "class") -> str:
    """Pattern of an opening tag with that attribute."""
    return rf"(?s)^<\w+\b[^>]*{_attribute(attribute, value)}[^>]*>$"


def elements(c: Column | str, wanted: Mapping[str, str]) -> Column:
    """Struct of the inner HTML of the first element per pattern of an opening tag, each cut at its own end.

    One pass over the tags of the page keeps a stack of open elements. A
    closing tag ends the nearest open element of its name and all that stand
    open within it; one without such an element is passed over. What is never
    closed ends with the page. NULL for a missing and for an empty element.
    Tags inside scripts, styles and comments do not count. The pages are read
    in Arrow batches, whose patterns are those of ``re`` with ASCII classes.
    """
    names, patterns, no_end = list(wanted), list(wanted.values()), _NO_END
    kind = T.StructType([T.StructField(n, T.StringType()) for n in names])
    pieces_of, name_of = _PIECES, _NAME

    def cut(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        pieces, name = re.compile(pieces_of, re.ASCII), re.compile(name_of, re.ASCII)
        opens = [re.compile(p, re.ASCII) for p in patterns]

        def inner(page: str) -> dict:
            stack, out, missing, within = [], dict.fromkeys(names), list(zip(names, opens)), []
            for m in pieces.finditer(page):
                piece = m.group()
                tag = name.match(piece)
                if tag is None:
                    continue
                word = tag[2].lower()
                if not tag[1]:
                    alone = word in no_end or piece.endswith("/>")
                    begun = [x for x in missing if x[1].search(piece)]
                    if begun:
                        missing = [x for x in missing if x not in begun]
                        within += [] if alone else [(n, len(stack), m.end()) for n, _ in begun]
                    if not alone:
                        stack.append(word)
                elif word in stack:
                    while stack.pop() != word:
                        pass
                    for n, depth, begin in within:
                        if depth >= len(stack):
                            out[n] = page[begin : m.start()] or None
                    within = [x for x in within if x[1] < len(stack)]
            for n, _, begin in within:
                out[n] = page[begin:] or None
            return out

        for batch in batches:
            yield pa.array((None if x is None else inner(x) for x in batch.to_pylist()), pa.struct([(n, pa.string()) for n in names]))

    return F.arrow_udf(cut, kind)(X.col(c))


def element_html(c: Column | str, value: str, attribute: str = "class") -> Column:
    """Inner HTML of the first element with that attribute; see ``elements``."""
    return elements(c, {"one": by_attribute(value, attribute)})["one"]


def leading_text(c: Column | str, opening: str) -> Column:
    """Text of the element that the ``opening`` tag begins, up to its first child with a class.

    Nested elements are counted, so an element of the same name inside does not
    end it. NULL without such an element.
    """
    rest = F.regexp_extract(X.col(c), rf"(?s){opening}(.*)", 1)
    pieces = F.regexp_extract_all(rest, F.lit(r"(?s)(<[^>]*>|[^<]+)"), 1)
    start = F.struct(F.lit(0).alias("depth"), F.lit(False).alias("over"), F.lit("").alias("text"))

    def read(state: Column, piece: Column) -> Column:
        depth, text = state["depth"], state["text"]
        tag, ends = piece.startswith("<"), piece.startswith("</")
        closed = piece.rlike(_VOID) | piece.endswith("/>") | piece.startswith("<!")
        named = tag & ~ends & (depth == 0) & piece.rlike(r"\bclass\s*=")
        over = state["over"] | (ends & (depth == 0)) | named
        moved = F.when(over | ~tag, depth).when(ends, depth - 1).when(closed, depth).otherwise(depth + 1)
        return F.struct(
            moved.alias("depth"), over.alias("over"), F.when(over | tag, text).otherwise(F.concat(text, F.lit(" "), piece)).alias("text"),
        )

    found = F.aggregate(pieces, start, read, lambda state: state["text"])
    return F.when(X.col(c).rlike(rf"(?s){opening}"), plain_text(found))


def review_text(c: Column | str) -> Column:
    """A review's full text; a short review has it in its expandable section."""
    full = rf"<\w+\b[^>]*{_attribute('class', V.REVIEW_CLASSES['text'])}[^>]*>"
    short = rf"<\w+\b[^>]*\b{V.SHORT_TEXT}\b[^>]*>"
    return F.coalesce(leading_text(c, full), leading_text(c, short))


def element_attribute(c: Column | str, value: str, wanted: str) -> Column:
    """An attribute of the first element of that class."""
    tag = F.regexp_extract(X.col(c), rf"<\w+\b[^>]*{_attribute('class', value)}[^>]*>", 0)
    return F.nullif(F.regexp_extract(tag, rf'\b{wanted}="([^"]*)"', 1), F.lit(""))


def html_fields(df: DataFrame, html: str, spec: Mapping[str, str]) -> DataFrame:
    """One column per pattern: its first group as plain text, NULL without a match."""
    return df.withColumns({
        name: F.when(F.col(html).rlike(p), plain_text(F.regexp_extract(F.col(html), p, 1)))
        for name, p in spec.items()
    })


def html_lists(df: DataFrame, html: str, spec: Mapping[str, str]) -> DataFrame:
    """One array column per pattern: the first group of every match."""
    return df.withColumns({
        name: F.regexp_extract_all(F.col(html), F.lit(p), 1) for name, p in spec.items()
    })


def html_blocks(df: DataFrame, html: str, start: str, keep: list[str]) -> DataFrame:
    """(keep, block_no, block): the page from each match of ``start`` to the next."""
    pieces = F.split(F.col(html), f"(?={start})")
    opened = F.filter(pieces, lambda p: p.rlike(f"^(?:{start})"))
    return df.select(*keep, F.posexplode(opened).alias("block_no", "block"))


def paging(df: DataFrame, html: str) -> DataFrame:
    """Add the next page token and the page's review count."""
    return df.withColumns({
        "next_token": F.nullif(
            F.regexp_extract(html, r'data-next-page-token\s*=\s*"([\w=]*)', 1), F.lit("")
        ),
        "review_count": F.regexp_extract(
            html, r'data-google-review-count\s*=\s*"(\d+)"', 1
        ).try_cast("int"),
    })


def parse_places(df: DataFrame, html: str) -> DataFrame:
    """Add address, place_name (without the address), overall_rating and n_reviews."""
    kept = df.withColumn("_cut", elements(html, {n: by_attribute(c) for n, c in V.PLACE_CLASSES.items()}))
    field = {n: plain_text(F.col(f"_cut.{n}")) for n in V.PLACE_CLASSES}
    address = F.coalesce(field["address"], F.lit(""))
    return kept.withColumns({
        "address": field["address"],
        "place_name": X.strip(F.replace(field["place_name"], address, F.lit(""))),
        "overall_rating": P.localized_number(field["overall_rating"]),
        "n_reviews": P.count_text(field["n_reviews"]),
    }).drop("_cut")


def parse_reviews(df: DataFrame, block: str) -> DataFrame:
    """Add the review fields of one block, and ``errors`` naming the missing ones."""
    cls = V.REVIEW_CLASSES
    html = F.col(block)

    named = ("other_ratings", "relative_date", "user_name", "user", "response_text", "response_relative_date", "trip_type_travel_group")
    wanted = {n: by_attribute(cls[n]) for n in named} | {"likes": by_attribute(V.LIKES_NAME, "jsname")}
    df = df.withColumn("_cut", elements(html, wanted))

    def words(name: str) -> Column:
        return plain_text(F.col(f"_cut.{name}"))

    ratings = P.label_ratings(element_attribute(html, cls["rating"], "aria-label"))
    user = F.coalesce(F.col("_cut.user"), F.lit(""))
    counts = P.user_counts(plain_text(user))
    has_user = element_attribute(html, cls["user"], "href").isNotNull()
    fields = {
        "text": X.one_line(review_text(html)),
        "rating": ratings["rating"],
        "rating_max": ratings["rating_max"],
        "other_ratings": words("other_ratings"),
        "relative_date": words("relative_date"),
        "user_name": words("user_name"),
        "user_url": element_attribute(html, cls["user"], "href"),
        "user_is_local_guide": F.when(has_user, user.contains(cls["local_guide"])),
        "user_reviews": counts["reviews"],
        "user_photos": counts["photos"],
        "review_id": F.nullif(
            F.regexp_extract(element_attribute(html, cls["review_id"], "href"), "postId=(.*?)&", 1),
            F.lit(""),
        ),
        "likes": P.likes(words("likes")),
        "response_text": X.one_line(words("response_text")),
        "response_relative_date": words("response_relative_date"),
        "trip_type_travel_group": words("trip_type_travel_group"),
    }
    out = df.withColumns(fields)
    needed = ("rating", "relative_date", "user_name", "review_id")
    missing = F.array(*[
        F.when(F.col(n).isNull(), F.lit(f"review {n}: not found")) for n in needed
    ])
    return out.withColumn("errors", F.array_compact(missing)).drop("_cut")
