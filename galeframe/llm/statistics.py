"""Statistics of a text as one native struct column; no Python runs on the executors.

A null or empty text has no words and no lines: every count is 0. Texts are taken whole. Rows are independent, so
repeated rows get equal statistics. Whether two 3-word windows of one text are equal is decided on 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The white space that parts words, other than the space itself.
OTHER_SPACE = ("\t", "\n", "\x0b", "\x0c", "\r")
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
EXTRA = ("n_chars", "n_lines", "n_distinct", "n_upper", "n_digits", "n_bangs", "n_stops", "n_short")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def spaced(text: Column) -> Column:
    for c in OTHER_SPACE:
        text = F.replace(text, F.lit(c), F.lit(" "))
    return text


def _lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))


def _covered(hashes: Column) -> Column:
    """How many words stand in 3-word windows whose hash occurs twice or more."""

    def of(s: Column) -> Column:
        def twice(x: Column, i: Column) -> Column:
            before, after = F.get(s, i - 1)["h"], F.get(s, i + 1)["h"]
            return F.coalesce(before == x["h"], F.lit(False)) | F.coalesce(after == x["h"], F.lit(False))

        places = F.sort_array(F.transform(F.filter(s, twice), lambda x: x["p"]))
        start = F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n"))
        step = lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(3), p - a["last"])).alias("n"))
        return F.aggregate(places, start, step, lambda a: a["n"])

    pairs = F.transform(hashes, lambda x, i: F.struct(x.alias("h"), i.alias("p")))
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(let(F.sort_array(pairs), of))


def _repeats(words: Column) -> Column:
    heads = F.slice(words, F.lit(1), F.greatest(F.size(words) - 2, F.lit(0)))
    return let(F.transform(heads, lambda x, i: F.xxhash64(x, F.get(words, i + 1), F.get(words, i + 2))), _covered)


def statistics(text: Column, extra: bool = False) -> Column:
    """A struct of COUNTS as longs, and of EXTRA if asked for."""
    whole = F.coalesce(text, F.lit(""))
    gone = lambda x, pattern: F.length(x) - F.length(F.regexp_replace(x, pattern, ""))

    def of(norm: Column) -> Column:
        return let(F.array_remove(F.split(norm, " "), ""), lambda words: let(_lines(whole), lambda lines: fields(norm, words, lines)))

    def fields(norm: Column, words: Column, lines: Column) -> Column:
        out = {
            "n_words": F.size(words),
            "word_chars": F.length(F.replace(norm, F.lit(" "), F.lit(""))),
            "n_symbols": gone(norm, r"[#*$%&|<>]+"),
            "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
            "n_repeat_words": _repeats(words),
        }
        if extra:
            out |= {
                "n_chars": F.length(norm),
                "n_lines": F.size(lines),
                "n_distinct": F.size(F.array_distinct(words)),
                "n_upper": gone(norm, r"[A-Z]+"),
                "n_digits": gone(norm, r"[0-9]+"),
                "n_bangs": gone(norm, r"[!?]+"),
                "n_stops": gone(norm, r"[.,;:]+"),
                "n_short": F.size(F.filter(words, lambda w: F.length(w) <= 3)),
            }
        return F.struct(*(v.cast("long").alias(k) for k, v in out.items()))

    return let(spaced(whole), of)
