"""Text expressions. All are plain Columns and stay inside code generation.

Java's ``\\s`` and ``\\w`` are ASCII only, so the classes are spelled out with
Unicode properties.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Sequence

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column, functions as F

BLANK = r"[\s\p{Z}\x{0b}\x{1c}-\x{1f}\x{85}]"
NOT_BLANK = r"[^\s\p{Z}\x{0b}\x{1c}-\x{1f}\x{85}]"
WORD = r"[\p{L}\p{N}_]+"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Remove Unicode blanks on both ends."""
    return F.regexp_replace(col(c), f"^{BLANK}+|{BLANK}+$", "")


def _latin_folding() -> tuple[str, str, dict[str, str]]:
    """Accent folding by rule: canonical decomposition of the Latin blocks."""
    src, dst, longer = [], [], {}
    for code in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00)):
        ch = chr(code)
        base = "".join(x for x in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(x))
        if base == ch or not base.isascii():
            continue
        if len(base) == 1:
            src.append(ch)
            dst.append(base)
        else:
            longer[ch] = base
    # Letters without a decomposition.
    for ch, base in {"Ø": "O", "ø": "o", "Đ": "D", "đ": "d", "Ð": "D", "ð": "d", "Ł": "L",
                     "ł": "l", "Ħ": "H", "ħ": "h", "ı": "i"}.items():
        src.append(ch)
        dst.append(base)
    longer |= {"ß": "ss", "Æ": "AE", "æ": "ae", "Œ": "OE", "œ": "oe", "Þ": "Th", "þ": "th"}
    return "".join(src), "".join(dst), longer


_FOLD_FROM, _FOLD_TO, _FOLD_LONGER = _latin_folding()
# Typographic signs and their ASCII forms.
_SIGNS = {"‘": "'", "’": "'", "“": '"', "”": '"', "–": "-", "ª": "a", "º": "o", " ": " "}


def fold_accents(c: Column | str) -> Column:
    """Latin letters to ASCII; other scripts are left as they are."""
    out = F.translate(
        col(c), _FOLD_FROM + "".join(_SIGNS), _FOLD_TO + "".join(_SIGNS.values())
    )
    for ch, base in _FOLD_LONGER.items():
        if len(base) > 1 and ch in "ßÆæŒœÞþ":
            out = F.replace(out, F.lit(ch), F.lit(base))
    return F.regexp_replace(out, r"\p{Mn}+", "")


def normalize(c: Column | str) -> Column:
    """Unaccented lower case, the form tokens are compared in."""
    return F.lower(fold_accents(c))


def clean(c: Column | str) -> Column:
    """Runs of blanks become one space, runs of dots one dot."""
    return F.regexp_replace(F.regexp_replace(col(c), f"{BLANK}+", " "), "[.]+", ".")


def clean_full(c: Column | str) -> Column:
    """Blanks to spaces, no space before full stops and commas, trimmed."""
    out = F.regexp_replace(col(c), BLANK, " ")
    out = F.regexp_replace(out, " +[.] *", ". ")
    out = F.regexp_replace(out, " +[,] *", ", ")
    return strip(out)


def space_marks(c: Column | str) -> Column:
    """Set newlines and dots apart from the words around them."""
    return F.regexp_replace(F.regexp_replace(col(c), "\n+", " \n "), "[.]+", " . ")


def newline_sentences(c: Column | str) -> Column:
    """Dots become semicolons and newlines dots, so that a line is a sentence."""
    return F.translate(col(c), ".\n", ";.")


def one_line(c: Column | str) -> Column:
    """Blanks to spaces, quotes removed, trimmed: stored review text."""
    return strip(F.regexp_replace(F.regexp_replace(col(c), BLANK, " "), "['\"]", ""))


def error_line(c: Column | str) -> Column:
    """Blanks and quotes to spaces: stored error text."""
    return F.regexp_replace(col(c), f"{BLANK}|['\"]", " ")


def word_count(c: Column | str) -> Column:
    """Number of blank-separated words; a missing text has none."""
    return F.coalesce(F.regexp_count(col(c), F.lit(f"{NOT_BLANK}+")), F.lit(0)).cast("int")


def words(c: Column | str) -> Column:
    """Blank-separated words, in order."""
    return F.regexp_extract_all(col(c), F.lit(f"({NOT_BLANK}+)"), 1)


def portuguese_stopwords() -> list[str]:
    return StopWordsRemover.loadDefaultStopWords("portuguese")


def tokenize(
    c: Column | str, stopwords: Sequence[str] | None = None, min_len: int = 3, lower: bool = True
) -> Column:
    """Letter-only tokens, stop words and short ones removed, order and repeats kept.

    A word that mixes letters with digits or underscores is dropped whole.
    """
    stop = list(portuguese_stopwords() if stopwords is None else stopwords)
    # whole words of letters in one pattern, so that no second one is run per word
    found = F.regexp_extract_all(col(c), F.lit(rf"(?<!{WORD[:-1]})(\p{{L}}{{{max(min_len, 1)},}}+)(?!{WORD[:-1]})"), 1)
    if lower:
        low = F.transform(found, lambda t: F.lower(t))
        return F.filter(low, lambda t: ~t.isin(stop)) if stop else low
    return F.filter(found, lambda t: ~F.lower(t).isin(stop)) if stop else found


def sentence_tokens(
    c: Column | str, stopwords: Sequence[str] | None = None, min_len: int = 3
) -> Column:
    """One token list per dot-separated piece; empty pieces give empty lists."""
    return F.transform(F.split(col(c), r"\."), lambda s: tokenize(s, stopwords, min_len))


def sentences(c: Column | str, separators: str = r"[.\n]+") -> Column:
    """Trimmed, non-empty sentences in order."""
    parts = F.transform(F.split(col(c), separators), lambda s: strip(s))
    return F.filter(parts, lambda s: s != "")


def joined(c: Column | str, sep: str = ", ") -> Column:
    """Array to text, a missing array to the empty text."""
    return F.coalesce(F.array_join(col(c), sep), F.lit(""))


def ngrams(tokens: Column, n: int) -> Column:
    """Blank-joined n-grams of a token array; empty when it is shorter than n."""
    last = F.size(tokens) - (n - 1)
    return F.when(
        last >= 1,
        F.transform(F.sequence(F.lit(1), last), lambda i: F.array_join(F.slice(tokens, i, n), " ")),
    ).otherwise(F.array().cast("array<string>"))


def once(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed a single time per row.

    An expression named inside a lambda is evaluated again for every element;
    bound as the lambda's variable it is not.
    """
    return F.transform(F.array(value), use)[0]


def token_counts(tokens: Column | str) -> Column:
    """Array of (token, n) of one row: equal neighbours of the sorted tokens.

    Counting inside the row needs no shuffle.
    """

    def runs(s: Column) -> Column:
        starts = F.filter(
            F.sequence(F.lit(1), F.size(s)),
            lambda i: (i == 1) | (F.get(s, i - 1) != F.get(s, i - 2)),
        )

        def counted(at: Column) -> Column:
            ends = F.concat(F.slice(at, F.lit(2), F.size(at)), F.array(F.size(s) + 1))
            return F.zip_with(
                at, ends, lambda a, b: F.struct(F.get(s, a - 1).alias("token"), (b - a).alias("n"))
            )

        return F.when(F.size(s) > 0, once(starts, counted))

    return once(F.sort_array(col(tokens)), runs)
