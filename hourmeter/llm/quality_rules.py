"""Quality rules: a threshold table compiled into one Spark projection, without user functions.

Counts are built-in expressions over the whole text: words, their code points, symbols, stop words, lines,
repeated lines, and words inside repeated three-word windows.  ``THRESHOLDS`` is the table of the verdict; each
row bounds one ratio, and a document is kept if it fails neither the base rules nor a row.  Three-word windows
are compared by a 64-bit and a 32-bit hash of their words within one document.

Nulls: a null text counts as empty; every count is then 0 and the document fails the base rules (too few
words).  A null doc_id keeps its row.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"
#: Frequent function words of English, French, German and Spanish.
STOP_WORDS = (
    "the of and to in is was that for it as with on be by this are at from have or an not which "
    "le la les de des du et un une est que qui dans pour par sur pas plus avec ce "
    "der die das und ist von den mit zu ein eine nicht auf sich auch des dem als für "
    "el los las y en una por con para no su al lo como más pero se del"
).split()

#: ratio, least, most (None: no bound)
THRESHOLDS: list[tuple[str, float | None, float | None]] = [
    ("mean_word_chars", 1.5, 25.0),
    ("symbols_per_word", None, 0.1),
    ("stop_words_per_word", 0.005, None),
    ("dup_lines_per_line", None, 0.5),
]
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def measures(docs: DataFrame) -> DataFrame:
    """``docs`` with the counts (_qr_ columns) of each whole text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    out = docs.withColumn("_qr_text", text)
    out = out.withColumn("_qr_words", F.regexp_extract_all("_qr_text", F.lit(WORD), F.lit(0)))
    out = out.withColumn("_qr_lines", F.filter(F.split("_qr_text", "\n"), lambda x: x.rlike(WORD)))
    n = F.size("_qr_words")
    w = F.col("_qr_words")
    window = F.transform(
        F.when(n >= 3, F.sequence(F.lit(0), n - 3)).otherwise(F.array().cast("array<int>")),
        lambda i: F.struct(
            F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"),
            F.hash(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("g"),
            i.alias("i"),
        ),
    )
    out = out.withColumns(
        {
            "_qr_n_words": n.cast("long"),
            "_qr_word_chars": F.length(F.array_join("_qr_words", "")).cast("long"),
            "_qr_n_symbols": F.regexp_count("_qr_text", F.lit(SYMBOL)).cast("long"),
            "_qr_n_stop": F.size(F.filter("_qr_words", lambda x: x.isin(STOP_WORDS))).cast("long"),
            "_qr_n_lines": F.size("_qr_lines").cast("long"),
            "_qr_n_dup_lines": (F.size("_qr_lines") - F.size(F.array_distinct("_qr_lines"))).cast("long"),
            "_qr_windows": F.sort_array(window),
        }
    ).drop("_qr_text", "_qr_words", "_qr_lines")
    # sorted windows: equal ones are neighbours, and their places in the text are the repeats
    s = F.col("_qr_windows")

    def same(x: Column, y: Column) -> Column:
        return F.coalesce((x["h"] == y["h"]) & (x["g"] == y["g"]), F.lit(False))

    found = F.filter(s, lambda x, k: same(x, F.get(s, k - 1)) | same(x, F.get(s, k + 1)))
    out = out.withColumn("_qr_places", F.sort_array(F.transform(found, lambda x: x["i"])))
    p = F.col("_qr_places")
    covered = F.transform(p, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - x, F.lit(3))))
    out = out.withColumn("_qr_n_repeat_words", F.aggregate(covered, F.lit(0).cast("long"), lambda a, x: a + x))
    return out.drop("_qr_windows", "_qr_places")


def ratios() -> dict[str, Column]:
    """The ratios that the threshold table may name."""
    n = F.col("_qr_n_words")
    return {
        "mean_word_chars": _ratio(F.col("_qr_word_chars"), n),
        "symbols_per_word": _ratio(F.col("_qr_n_symbols"), n),
        "stop_words_per_word": _ratio(F.col("_qr_n_stop"), n),
        "dup_lines_per_line": _ratio(F.col("_qr_n_dup_lines"), F.col("_qr_n_lines")),
    }


def compiled(thresholds: list[tuple[str, float | None, float | None]]) -> Column:
    """One boolean expression: every row of the table holds."""
    known, verdict = ratios(), F.lit(True)
    for name, least, most in thresholds:
        if least is not None:
            verdict = verdict & (known[name] >= F.lit(least))
        if most is not None:
            verdict = verdict & (known[name] <= F.lit(most))
    return verdict


def judge(docs: DataFrame, thresholds: list[tuple[str, float | None, float | None]] | None = None) -> DataFrame:
    """``docs`` with the counts, _qr_base_failed and _qr_kept."""
    n = F.col("_qr_n_words")
    failed = (n < MIN_WORDS) | (100 * F.col("_qr_n_repeat_words") > MAX_REPEAT_PERCENT * n)
    out = measures(docs).withColumn("_qr_base_failed", failed)
    return out.withColumn("_qr_kept", ~F.col("_qr_base_failed") & compiled(THRESHOLDS if thresholds is None else thresholds))
