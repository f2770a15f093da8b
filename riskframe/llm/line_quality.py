"""Line-first quality rules, in DataFrame functions only: no shuffle, one row at a time.

Every line with a word is tried against line rules; failing lines are removed, and a
document that loses too much of its text, or fails the base rules, is rejected.

Line rules (a line fails by any of them):
  symbols      over a tenth of its characters are ``# * $ % & | < >`` or similar marks
  navigation   three or more separators (``| » › · •``) between short items
  boilerplate  a known notice (rights, cookies, scripts, log-in, sharing, placeholder text)
  punctuation  no letter or digit, or runs of ``!!`` / ``??`` after a third of its words

Base counts, per contract: words, their code points, symbols, lines with a word that equal
an earlier line, and words in 3-word windows that the text has twice or more.  Windows are
compared by sorting their 64-bit hashes with positions inside the row: n log n in the
number of words, for any length of text.

Cases: null or wordless text has no words and no lines and fails the base rules; repeated
rows are judged alike; empty tables give empty results; input columns named like a result
column are replaced by it; other columns pass through.
"""
from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import without

MIN_WORDS = 50
MAX_REPEAT_PCT = 50
#: A document is rejected if failing lines hold more than this share of its characters.
MAX_LOST = 0.5
RESULTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
           "n_lines", "n_bad_lines", "clean_chars", "lost", "clean_text", "kept")

# White space of words, counted symbols, notices.
SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
NOTICES = ("all rights reserved", "cookies", "cookie policy", "privacy policy", "terms of use", "terms of service",
           "enable javascript", "lorem ipsum", "sign in", "log in", "subscribe now", "subscribe to", "share on",
           "share this", "skip to content", "back to top", "click here")
# every notice holds one of these
NOTICE_PARTS = ("reserved", "cookie", "privacy", "terms of", "javascript", "ipsum", "sign in", "log in", "subscribe",
                "share ", "skip to", "to top", "click here")
BOILERPLATE = r"(?i)(?<![\p{L}\p{N}])(" + "|".join(NOTICES) + r")(?![\p{L}\p{N}])"
MARKED = r"[#*$%&|<>{}\[\]\\^~=_@+»›·•]|[!?]{2}"
NAVIGATION = r"([|»›·•>][^|»›·•>]{0,40}){3}"
LETTER = r"[\p{L}\p{N}]"
MARKS = r"[#*$%&|<>{}\[\]\\^~=_@+]"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def words(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(" \t\n\x0b\x0c\r"))
    return F.when(F.coalesce(trimmed, F.lit("")) == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE))


def repeat_words(ws: Column) -> Column:
    """Words in 3-word windows found twice or more.

    Up to 2**16 windows, hash and position are packed into one long (the position takes the
    low bits), which sorts fast; equal neighbours are then compared by their whole hashes.
    Beyond, structs are sorted.
    """
    none = F.lit(0).cast("long")

    def cover(places: Column) -> Column:
        return F.aggregate(
            F.array_sort(places), F.struct(F.lit(0).alias("end"), none.alias("n")),
            lambda a, p: F.struct((p + 3).alias("end"), (a["n"] + p + 3 - F.greatest(p, a["end"])).cast("long").alias("n")),
            lambda a: a["n"])

    def packed(hashes: Column) -> Column:
        low = F.lit(0xFFFF).cast("long")
        place = lambda x: x.bitwiseAND(low).cast("int")
        same = lambda s, x, j: F.coalesce(F.get(hashes, place(F.get(s, j))) == F.get(hashes, place(x)), F.lit(False))
        pairs = F.sort_array(F.transform(hashes, lambda h, i: h.bitwiseAND(F.lit(~0xFFFF).cast("long")).bitwiseOR(i.cast("long"))))
        return let(pairs, lambda s: cover(F.transform(
            F.filter(s, lambda x, i: same(s, x, i - 1) | same(s, x, i + 1)), place)))

    def structs(hashes: Column) -> Column:
        pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))
        return let(pairs, lambda s: cover(F.transform(
            F.filter(s, lambda x, i: (F.get(s, i - 1)["h"] == x["h"]) | (F.get(s, i + 1)["h"] == x["h"])), lambda x: x["p"])))

    def covered(hashes: Column) -> Column:
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), none) \
            .when(F.size(hashes) <= 1 << 16, packed(hashes)).otherwise(structs(hashes))

    def of(w: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(w) - 3)
        return F.when(F.size(w) < 3, none).otherwise(
            let(F.transform(at, lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))), covered))
    return let(ws, of)


def line_fails(line: Column, marked: Column, noticed: Column) -> Column:
    """``marked``: whether the document has any of the marks, separators or doubled ``!``
    and ``?`` that three of the rules look for; ``noticed``: whether it has a notice."""
    size = F.length(line)
    marks = size - F.length(F.regexp_replace(line, MARKS, ""))
    shouts = F.regexp_count(line, F.lit(r"[!?]{2,}(?=\s|$)"))
    words_in = F.size(F.split(line, SPACE))
    by_marks = F.when(marked, (marks * 10 > size) | line.rlike(NAVIGATION) | (shouts * 3 > words_in)).otherwise(F.lit(False))
    return by_marks | F.when(noticed, line.rlike(BOILERPLATE)).otherwise(F.lit(False)) | ~line.rlike(LETTER)


def judge(docs: DataFrame, text_col: str = "text", min_words: int = MIN_WORDS, max_lost: float = MAX_LOST,
          with_text: bool = True) -> DataFrame:
    """``docs`` with the base counts, the lines that fail, the text without them and ``kept``."""
    base = without(docs, *RESULTS)
    text = F.col(text_col)
    empty = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(empty, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    # both are looked for once a document, so that clean ones skip the rules of a line
    marked, noticed = empty.rlike(MARKED), let(F.lower(empty), lambda t: reduce(or_, [t.contains(x) for x in NOTICE_PARTS]))
    counted = base.withColumn("_w", let(words(text), lambda w: F.struct(
        F.size(w).cast("long").alias("n"), F.length(F.array_join(w, "")).cast("long").alias("chars"),
        repeat_words(w).alias("r"))))
    counted = counted.withColumn("_l", let(F.struct(lines.alias("x"), marked.alias("m"), noticed.alias("b")), lambda ls: F.struct(
        F.size(ls["x"]).cast("long").alias("n"),
        (F.size(ls["x"]) - F.size(F.array_distinct(ls["x"]))).cast("long").alias("dup"),
        F.when(ls["m"] | ls["b"], F.filter(ls["x"], lambda x: ~line_fails(x, ls["m"], ls["b"])))
        .otherwise(F.filter(ls["x"], lambda x: x.rlike(LETTER))).alias("good"),
        F.length(F.array_join(ls["x"], "")).cast("long").alias("chars"))))
    out = counted.select(
        *base.columns, F.col("_w.n").alias("n_words"),
        F.col("_w.chars").alias("word_chars"),
        F.length(F.regexp_replace(empty, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        F.col("_l.dup").alias("n_dup_lines"), F.col("_w.r").alias("n_repeat_words"),
        F.col("_l.n").alias("n_lines"), (F.col("_l.n") - F.size("_l.good")).alias("n_bad_lines"),
        F.length(F.array_join("_l.good", "")).cast("long").alias("clean_chars"),
        F.col("_l.chars").alias("_chars"), *([F.array_join("_l.good", "\n").alias("clean_text")] if with_text else []))
    out = out.withColumn("base_failed", (F.col("n_words") < min_words)
                         | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PCT))
    out = out.withColumn("lost", F.when(F.col("_chars") > 0, 1 - F.col("clean_chars") / F.col("_chars")).otherwise(F.lit(0.0)))
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("lost") <= max_lost)).drop("_chars")


def keep_documents(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents that pass, as they came."""
    return judge(docs, text_col, with_text=False).where("kept").select(*docs.columns)
