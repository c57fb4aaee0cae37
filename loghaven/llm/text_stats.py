"""Statistics of whole texts as built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loghaven.functions.once import evaluate_once
from loghaven.llm.common import SPACES, text_or_empty, words_of

SYMBOLS = "#*$%&|<>"
WINDOW = 8
BASE_STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SHARES = (
    "symbol_share",
    "upper_share",
    "digit_share",
    "mark_share",
    "distinct_share",
    "repeat_share",
    "dup_line_share",
    "word_length",
    "line_words",
    "log_words",
)


def _low_bits(n: Column) -> Column:
    """Least power of two above n."""
    return F.shiftleft(F.lit(1).cast("long"), 1) * F.pow(F.lit(2.0), F.floor(F.log2(n.cast("double")))).cast("long")


def repeated_words(words: Column, windows: Column) -> Column:
    """Words that lie in windows of 8 words found twice or more.

    ``windows`` has the 64-bit hash of the window at each place. Most texts repeat none, which
    the set of hashes shows. Else the hashes, with the place in their low bits, are sorted as
    plain numbers, equal ones become neighbours, and the places covered by any of them are
    counted: n log n steps whatever is repeated.
    """
    low = _low_bits(F.size(windows))
    packed = F.sort_array(F.transform(windows, lambda h, i: h - F.pmod(h, low) + i))

    def equal(a: Column, b: Column) -> Column:
        same = (a - F.pmod(a, low)) == (b - F.pmod(b, low))
        hash_at = lambda x: F.get(windows, F.pmod(x, low).cast("int"))
        return F.coalesce(same & (hash_at(a) == hash_at(b)), F.lit(False))

    def places(rows: Column) -> Column:
        repeated = F.filter(rows, lambda x, i: equal(x, F.get(rows, i + 1)) | equal(F.get(rows, i - 1), x))
        return F.sort_array(F.transform(repeated, lambda x: F.pmod(x, low)))

    def covered(at: Column) -> Column:
        step = F.transform(at, lambda x, i: F.coalesce(F.least(F.lit(WINDOW), F.get(at, i + 1) - x), F.lit(WINDOW)))
        return F.aggregate(step, F.lit(0).cast("long"), lambda total, x: total + x)

    bound = lambda value, use: F.element_at(F.transform(F.array(value), use), 1)
    found = bound(packed, lambda rows: bound(places(rows), covered))
    return F.when(F.size(F.array_distinct(windows)) < F.size(windows), found).otherwise(F.lit(0).cast("long"))


def with_text_stats(docs: DataFrame, text: str = "text", shares: bool = True, prefix: str = "") -> DataFrame:
    """Add the base counts and, if asked, shares of them; a null text counts as empty.

    The words are bound once, so they are split once per text. Columns of the same names are
    replaced.
    """
    whole = text_or_empty(F.col(text))
    names = [prefix + n for n in BASE_STATS] + [prefix + n for n in SHARES if shares]
    rows = docs.drop(*names)
    rows = evaluate_once(rows, {"__words": words_of(whole)})
    # Slices of hashes are cheaper to hash than slices of words.
    rows = evaluate_once(rows, {"__hashes": F.transform("__words", lambda w: F.xxhash64(w)), "__n": F.size("__words").cast("long")})
    starts = F.sequence(F.lit(1), (F.col("__n") - (WINDOW - 1)).cast("int"))
    windows = F.when(F.col("__n") > WINDOW, F.transform(starts, lambda i: F.xxhash64(F.slice("__hashes", i, WINDOW)))).otherwise(
        F.array().cast("array<bigint>")
    )
    lines = F.filter(F.split(whole, "\n"), lambda line: F.length(F.regexp_replace(line, SPACES, "")) > 0)
    columns = {"__windows": windows, "__lines": lines, "__chars": F.length(F.regexp_replace(whole, SPACES, "")).cast("long")}
    if shares:
        columns["__upper"] = F.length(F.regexp_replace(whole, r"[^\p{Lu}]+", "")).cast("double")
        columns["__digits"] = F.length(F.regexp_replace(whole, r"[^0-9]+", "")).cast("double")
        columns["__marks"] = F.length(F.regexp_replace(whole, r"[^!?:;.,|]+", "")).cast("double")
        columns["__distinct"] = F.size(F.array_distinct("__hashes")).cast("double")
    rows = evaluate_once(rows, columns)
    base = {
        "n_words": F.col("__n"),
        "word_chars": F.col("__chars"),
        "n_symbols": (F.length(whole) - F.length(F.translate(whole, SYMBOLS, ""))).cast("long"),
        "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
        "n_repeat_words": repeated_words(F.col("__words"), F.col("__windows")),
    }
    rows = evaluate_once(rows, {prefix + n: c for n, c in base.items()})
    stat = {n: F.col(prefix + n) for n in BASE_STATS}
    if shares:
        per_word = F.greatest(stat["n_words"], F.lit(1)).cast("double")
        per_char = F.greatest(stat["word_chars"], F.lit(1)).cast("double")
        n_lines = F.greatest(F.size("__lines"), F.lit(1)).cast("double")
        rows = rows.withColumns(
            {
                prefix + "symbol_share": stat["n_symbols"] / per_word,
                prefix + "upper_share": F.col("__upper") / per_char,
                prefix + "digit_share": F.col("__digits") / per_char,
                prefix + "mark_share": F.col("__marks") / per_word,
                prefix + "distinct_share": F.col("__distinct") / per_word,
                prefix + "repeat_share": stat["n_repeat_words"] / per_word,
                prefix + "dup_line_share": stat["n_dup_lines"] / n_lines,
                prefix + "word_length": stat["word_chars"] / per_word,
                prefix + "line_words": stat["n_words"] / n_lines,
                prefix + "log_words": F.log1p(stat["n_words"].cast("double")),
            }
        )
    return rows.drop("__words", "__hashes", "__n", "__windows", "__lines", "__chars", "__upper", "__digits", "__marks", "__distinct")


def base_failed(prefix: str = "") -> Column:
    """Under 20 words, or over 30 % of the words in repeated windows."""
    n, repeated = F.col(prefix + "n_words"), F.col(prefix + "n_repeat_words")
    return (n < 20) | (100 * repeated > 30 * n)
