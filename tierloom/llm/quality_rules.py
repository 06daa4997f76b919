"""Quality rules, line first: clean each document's lines, then judge what is left.

A line that breaks a rule goes: punctuation (symbol-laden, shouted, or a long
run of words without any sentence mark), navigation (separators between the
words, or nothing but menu words), boilerplate (fixed phrases of cookie bars,
sign-up prompts and legal footers). A document that so loses more than half
of its words is rejected, as is one that fails the base rules: fewer than ten
words, or over a fifth of them inside five-word windows that the text repeats.

All of it is column expressions on one row: one scan, no shuffle. Windows are
compared by their 64-bit hash.

Defined cases: a null text has no lines and no words and is rejected; lines
without a word are neither judged nor counted; extra columns are left alone;
repeated rows are judged each for itself; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierloom.llm.common import SPACE, fresh, words

WINDOW = 5
LEAST_WORDS = 10
#: Most words in repeated windows, percent of all words.
MOST_REPEATED = 20
#: Most words that line cleaning may remove, percent of all words.
MOST_LOST = 50
SYMBOLS = r"[#*$%&|<>]"
#: Words of a line that has no sentence mark at all before it counts as a list or a repeated filler.
UNMARKED = 25
#: Words of a line per word of a boilerplate phrase, at most, for the line to be boilerplate by its share.
PHRASE_SHARE = 8

NAVIGATION_WORDS = (
    "home menu login logout register next previous prev back top share print search contact about sitemap help faq "
    "blog news archive categories tags"
).split()
BOILERPLATE = (
    "cookie", "javascript", "privacy policy", "terms of use", "terms of service", "all rights reserved", "copyright",
    "©", "sign up", "subscribe", "newsletter", "click here", "read more", "log in to", "login to", "powered by",
    "lorem ipsum", "licensed under",
)


def _has_phrase(lower: Column) -> Column:
    return reduce(or_, [lower.contains(phrase) for phrase in BOILERPLATE])


def _matches(text: Column, pattern: str) -> Column:
    """Matches of a one-character pattern."""
    return F.length(F.regexp_replace(text, f"[^{pattern.strip('[]')}]+", ""))


def _phrase_words(lower: Column) -> Column:
    """Words of the phrases in a text, each phrase as often as it occurs."""
    return reduce(
        add,
        [
            F.floor((F.length(lower) - F.length(F.replace(lower, F.lit(phrase), F.lit("")))) / len(phrase)) * len(phrase.split())
            for phrase in BOILERPLATE
        ],
    )


def line_fails(line: Column, n_words: Column, phrases: Column, by_share: bool = False) -> Column:
    """Whether a line with words breaks a rule; counts are compared with its number of words.

    ``phrases`` tells whether its document has a boilerplate phrase at all; if not, no line is searched for one.
    ``by_share`` lets a line fail as boilerplate only if phrases make up one in PHRASE_SHARE of its words.
    """
    punctuation = (
        (_matches(line, SYMBOLS) * 4 > n_words)
        | ((n_words >= 4) & (_matches(line, "[!]") * 2 > n_words))
        | ((n_words >= UNMARKED) & ~line.rlike(r"[.,;:!?…。，！？]"))
    )
    separators = F.length(F.regexp_replace(line, r"[^|»›•·]+", ""))
    menu = "|".join(NAVIGATION_WORDS)
    navigation = ((separators >= 2) & (separators * 5 >= n_words)) | (
        (n_words <= 6) & line.rlike(rf"(?i)^\W*(({menu})\W*)+$")
    )
    boilerplate = phrases & _has_phrase(F.lower(line))
    if by_share:
        boilerplate &= _phrase_words(F.lower(line)) * PHRASE_SHARE >= n_words
    return punctuation | navigation | boilerplate


def _sorted_windows(window: Column) -> Column:
    """Windows as (hash, position), equal hashes side by side."""
    return F.sort_array(F.transform(window, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))


def _repeated_starts(sorted_windows: Column) -> Column:
    """Positions, in text order, of the windows that occur twice or more."""
    repeated = F.filter(
        sorted_windows,
        lambda x, k: x.h.eqNullSafe(F.get(sorted_windows, k - 1).h) | x.h.eqNullSafe(F.get(sorted_windows, k + 1).h),
    )
    return F.sort_array(F.transform(repeated, lambda x: x.i))


def _covered_words(starts: Column) -> Column:
    """Words inside the windows at ``starts``: each covers up to the next one, WINDOW at most."""
    steps = F.transform(starts, lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, k + 1) - p, F.lit(WINDOW))))
    return F.aggregate(steps, F.lit(0), lambda total, covered: total + covered)


def judge(docs: DataFrame, text: str = "text", by_share: bool = False) -> DataFrame:
    """The documents with a struct ``verdict`` (named not to clash) of every figure and decision."""
    taken = list(docs.columns)

    def name(x: str) -> str:
        taken.append(fresh(taken, x))
        return taken[-1]

    whole, lower, lines, word, phrases, window, sorted_, starts, verdict = map(
        name, ("whole", "lower", "lines", "word", "phrases", "window", "sorted", "starts", "verdict")
    )
    c = F.col
    step = docs.withColumn(whole, F.coalesce(c(text), F.lit("")))
    step = step.withColumn(word, words(c(whole))).withColumn(
        lines, F.filter(F.split(c(whole), "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    )
    step = step.withColumn(lower, F.lower(c(whole))).withColumn(phrases, _has_phrase(c(lower)))
    n_words = F.size(c(word))
    step = step.withColumn(
        window,
        F.when(
            n_words >= WINDOW,
            F.transform(
                F.slice(c(word), F.lit(1), F.greatest(n_words - (WINDOW - 1), F.lit(0))),
                lambda first, i: F.xxhash64(first, *[F.get(c(word), i + k) for k in range(1, WINDOW)]),
            ),
        ).otherwise(F.array().cast("array<bigint>")),
    )
    step = step.withColumn(
        sorted_,
        F.when(F.size(F.array_distinct(c(window))) < F.size(c(window)), _sorted_windows(c(window))).otherwise(
            F.array().cast("array<struct<h:bigint,i:int>>")
        ),
    ).withColumn(starts, _repeated_starts(c(sorted_)))
    judged = F.transform(
        c(lines),
        lambda line: F.struct(line.alias("line"), F.size(words(line)).alias("n")),
    )
    failing = F.aggregate(
        judged,
        F.lit(0),
        lambda total, x: total + F.when(line_fails(x.line, x.n, c(phrases), by_share), x.n).otherwise(0),
    )
    step = step.withColumn(
        verdict,
        F.struct(
            n_words.cast("long").alias("n_words"),
            F.length(F.regexp_replace(c(whole), f"{SPACE}+", "")).cast("long").alias("word_chars"),
            _matches(c(whole), SYMBOLS).cast("long").alias("n_symbols"),
            (F.size(c(lines)) - F.size(F.array_distinct(c(lines)))).cast("long").alias("n_dup_lines"),
            _covered_words(c(starts)).cast("long").alias("n_repeat_words"),
            failing.cast("long").alias("n_lost_words"),
        ),
    )
    v = c(verdict)
    failed = (v.n_words < LEAST_WORDS) | (v.n_repeat_words * 100 > v.n_words * MOST_REPEATED)
    step = step.withColumn(verdict, v.withField("base_failed", failed))
    kept = ~v.base_failed & (v.n_lost_words * 100 <= v.n_words * MOST_LOST)
    return step.withColumn(verdict, v.withField("kept", kept)).select(*docs.columns, verdict)


def measure(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, the figures, base_failed, kept."""
    judged = judge(docs.select("doc_id", "text"))
    return judged.select("doc_id", f"{judged.columns[-1]}.*")


def clean(docs: DataFrame) -> DataFrame:
    """The documents that stay, their failing lines removed and ``n_chars`` set anew if there is one.

    Boilerplate is judged by its share of a line, so that one phrase does not cost a long line; ``measure`` has the
    rule of its SQL, by which any line with a phrase fails.
    """
    judged = judge(docs, by_share=True)
    verdict = F.col(judged.columns[-1])
    kept_lines = F.filter(
        F.split("text", "\n"),
        lambda line: ~line.rlike(r"[^\x20\x09-\x0D]") | ~line_fails(line, F.size(words(line)), F.lit(True), by_share=True),
    )
    text = F.when(verdict.n_lost_words == 0, F.col("text")).otherwise(F.array_join(kept_lines, "\n"))
    # The row number keeps the filter above the projections that compute the verdict. Below them, each column that
    # the verdict is made of would be written out anew wherever it is used, which multiplies from step to step.
    row = fresh(judged.columns, "row")
    numbered = judged.withColumn(row, F.monotonically_increasing_id())
    out = numbered.where(verdict.kept & (F.col(row) >= 0)).withColumn("text", text)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(docs.columns)
