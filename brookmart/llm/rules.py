"""Line-first quality rules, in DataFrame functions only.

Each line of a text is judged by itself: for punctuation, for navigation and for
boilerplate. Lines that fail are taken out, and a document that loses too much of
its text that way is rejected. Counts over the whole text (words, symbols,
repeated lines and windows) are computed in the same pass; no row is shuffled.

Null and empty texts have no words, so they fail the base rules. Copies and ties
are judged alike, since a verdict depends on the row's own text only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brookmart.llm.common import SPACE, SPACE_RUN, column

WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
#: A document goes if it loses more than this share of its characters.
MAX_LOST = 0.5
#: A line of so many words has to hold a sentence mark.
LONG_LINE = 25
SYMBOLS = "#*$%&|<>"

# Phrases of pages rather than of their texts.
BOILERPLATE = (
    "all rights reserved", "licensed under", "released under the", "terms of use",
    "terms of service", "privacy policy", "cookie policy", "use of cookies",
    "enable javascript", "lorem ipsum", "sign up for our newsletter",
)


def words_of(text: Column) -> Column:
    """The runs of other characters than a space and 0x09 to 0x0D."""
    trimmed = F.trim(text, F.lit(SPACE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_RUN))


def line_fault(line: Column) -> Column:
    """Which rule a line fails: punctuation, navigation, boilerplate, or null.

    Lines without a word fail none.
    """
    spaces = F.length(line) - F.length(F.translate(line, " \t", ""))
    bars = F.length(line) - F.length(F.translate(line, "|»›·", ""))
    marks = F.length(line) - F.length(F.translate(line, "#*$%&<>{}", ""))
    bangs = (F.length(line) - F.length(F.replace(line, F.lit("!!"), F.lit("")))) / 2
    low = F.lower(line)
    boiler = F.lit(False)
    for phrase in BOILERPLATE:
        boiler = boiler | low.contains(phrase)
    return (
        F.when(boiler & (F.length(line) <= 200), "boilerplate")
        .when((bars >= 3) & (bars * 4 >= spaces), "navigation")
        .when((bangs >= 3) & (bangs * 4 >= spaces), "punctuation")
        .when((marks >= 6) & (marks * 2 >= spaces), "punctuation")
        .when((spaces >= LONG_LINE) & ~line.rlike("[.!?…。！？]"), "punctuation")
    )


def _repeated(df: DataFrame, words: str, out: str) -> DataFrame:
    """Adds the number of words in windows that come twice or more in the text.

    Windows are told apart by a 64-bit hash of their words' 64-bit hashes.
    """
    low, win, order, at = (f"__{k}" for k in ("h", "w", "s", "p"))
    keep = df.columns
    df = df.withColumn(low, F.transform(words, lambda w: F.xxhash64(w)))
    n = F.size(low)
    df = df.withColumn(win, F.when(n >= WINDOW, F.transform(
        F.sequence(F.lit(0), n - WINDOW),
        lambda i: F.xxhash64(*[F.get(F.col(low), i + k) for k in range(WINDOW)]),
    )).otherwise(F.array().cast("array<bigint>")))
    # hashes with their places in order, so that equal ones are neighbours; most
    # texts repeat nothing and need no sorting
    df = df.withColumn(order, F.when(
        F.size(F.array_distinct(win)) < F.size(win),
        F.sort_array(F.transform(win, lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
    ))
    same = F.filter(order, lambda x, i: (
        F.coalesce(x["h"] == F.get(F.col(order), i - 1)["h"], F.lit(False))
        | F.coalesce(x["h"] == F.get(F.col(order), i + 1)["h"], F.lit(False))
    ))
    df = df.withColumn(at, F.sort_array(F.transform(same, lambda x: x["i"])))
    # each start covers its window or up to the next start
    covered = F.transform(at, lambda p, i: F.least(
        F.lit(WINDOW), F.coalesce(F.get(F.col(at), i + 1) - p, F.lit(WINDOW))))
    return df.select(*keep, F.coalesce(
        F.aggregate(covered, F.lit(0).cast("bigint"), lambda a, x: a + x), F.lit(0).cast("bigint"),
    ).alias(out))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          max_lost: float = MAX_LOST, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of ``docs``: counts, verdicts and the cleaned text.

    ``keep`` names columns of ``docs`` that are carried along, as in_0, in_1 and so on.
    """
    text = F.coalesce(column(docs, text_col).cast("string"), F.lit(""))
    carried = [f"in_{k}" for k in range(len(keep))]
    df = docs.select(
        column(docs, id_col).alias("doc_id"), text.alias("__text"),
        *[column(docs, c).alias(k) for c, k in zip(keep, carried)],
    )
    df = df.withColumns({
        "__words": words_of(F.col("__text")),
        "__lines": F.split("__text", "\n"),
    })
    worded = F.filter("__lines", lambda x: F.trim(x, F.lit(SPACE)) != "")
    judged = F.transform("__lines", lambda x: F.struct(x.alias("line"), line_fault(x).alias("fault")))
    df = df.withColumns({"__worded": worded, "__judged": judged})
    df = _repeated(df, "__words", "n_repeat_words")
    clean = F.array_join(F.transform(
        F.filter("__judged", lambda x: x["fault"].isNull()), lambda x: x["line"]), "\n")
    bare = F.length(F.translate("__text", SPACE, ""))
    df = df.select(
        "doc_id", *carried, "__text", "__worded", "__judged", "n_repeat_words",
        F.size("__words").cast("bigint").alias("n_words"), bare.cast("bigint").alias("word_chars"),
        clean.alias("clean_text"),
    )
    failing = F.aggregate(
        "__judged", F.lit(0).cast("bigint"),
        lambda a, x: a + F.when(x["fault"].isNull(), 0).otherwise(F.length(F.translate(x["line"], SPACE, ""))))
    def faults(kind: str) -> Column:
        return F.size(F.filter("__judged", lambda x: x["fault"] == kind)).cast("bigint")
    df = df.withColumn("lost_chars", failing)
    # a filter on computed columns would be pushed below them, with all their
    # expressions repeated in it; it stays above a column that has no fixed value
    df = df.withColumn("__row", F.monotonically_increasing_id()).filter("__row >= 0")
    base_failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return df.select(
        "doc_id", *carried, "n_words", "word_chars",
        (F.length("__text") - F.length(F.translate("__text", SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        (F.size("__worded") - F.size(F.array_distinct("__worded"))).cast("bigint").alias("n_dup_lines"),
        "n_repeat_words", base_failed.alias("base_failed"),
        (~base_failed & (F.col("lost_chars") <= max_lost * F.col("word_chars"))).alias("kept"),
        faults("punctuation").alias("n_punctuation"), faults("navigation").alias("n_navigation"),
        faults("boilerplate").alias("n_boilerplate"), "lost_chars", "clean_text",
    )


def clean(docs: DataFrame, text_col: str = "text", chars_col: str = "n_chars",
          max_lost: float = MAX_LOST) -> DataFrame:
    """The rows of ``docs`` that are kept, without their failing lines.

    All columns stay; the length column, where there is one, follows the text.
    """
    names = docs.columns
    judged = judge(docs, names[0], text_col, max_lost, keep=tuple(names))
    # a filter on computed columns would be pushed below them, with all their
    # expressions repeated in it; it stays above a column that has no fixed value
    judged = judged.withColumn("__row", F.monotonically_increasing_id()).filter("kept AND __row >= 0")
    kind = dict(docs.dtypes)
    new = {text_col: F.col("clean_text")}
    if chars_col in kind:
        new[chars_col] = F.length("clean_text").cast(kind[chars_col])
    return judged.select(*[
        new[c].alias(c) if c in new else F.col(f"in_{k}").alias(c) for k, c in enumerate(names)
    ])
