"""Line-first quality cleaning (operator 3). DataFrame functions only, one map over the input: no shuffle.

Each line that has a word is judged by itself:

* punctuation: it ends with no closing mark and has few words, or too many of its characters are symbols, or too many
  of its words end with two or more exclamation or question marks;
* navigation: bars or arrows between words make up a large share of it;
* boilerplate: it is short and holds a phrase of site furniture.

Failing lines are removed. A document whose removed lines hold more than ``max_lost`` of its word characters is
rejected, as is one that fails the base rules (too few words, or too many words in repeated five-word windows).

Defined results: a null text has no words, fails the base rules and keeps a null text; empty texts likewise; repeated
rows are judged each; an empty table gives no rows; all other columns are kept as they are, but for those that have a
result's name, which the result replaces.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

WORD_GAP = r"[\x20\x09-\x0D]+"
HAS_WORD = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
CLOSING = r"[.!?:;,…\"'”»)\]][\x20\x09-\x0D]*$"
SHOUTS = r"[!?]{2,}([\x20\x09-\x0D]|$)"
BARS = r"(^|[\x20\x09-\x0D])([|>»›•]|->|::)($|[\x20\x09-\x0D])"
#: Phrases of site furniture.
BOILERPLATE = ("accept cookies", "cookie policy", "enable javascript", "privacy policy", "terms of use",
               "terms of service", "sign up for", "subscribe to our", "log in to", "click here", "skip to content",
               "share this", "back to top", "powered by", "lorem ipsum")
BOILERPLATE_RE = "(?i)(" + "|".join(BOILERPLATE) + ")"

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
FEW_WORDS = 4
MAX_LOST = 0.5


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, WORD_GAP), "")


def line_fails(line: Column) -> Column:
    """True for a line with a word that one of the line rules refuses."""
    n = F.size(words(line))
    symbols = F.regexp_count(line, F.lit(SYMBOLS))
    return (
        (~line.rlike(CLOSING) & (n < FEW_WORDS))
        | (symbols * 10 > F.length(line))
        | (F.regexp_count(line, F.lit(SHOUTS)) * 2 > n)
        | (F.regexp_count(line, F.lit(BARS)) * 4 > n)
        | ((n <= 20) & line.rlike(BOILERPLATE_RE))
    )


def judge(docs: DataFrame, text_col: str = "text", max_lost: float = MAX_LOST) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, n_lines_removed, cleaned, kept."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    p = "_q_"  # prefix of working columns, dropped at the end
    df = docs.withColumn(p + "w", words(text))
    df = df.withColumn(p + "l", F.filter(F.split(text, "\n"), lambda x: x.rlike(HAS_WORD)))
    w, n = F.col(p + "w"), F.size(p + "w")
    five = F.transform(F.sequence(F.lit(0), n - 5), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(5)]))
    df = df.withColumn(p + "h", F.when(n > 5, five))
    # Only a text with equal windows pays for the sort that finds their places.
    h = F.col(p + "h")
    repeats = F.size(F.array_distinct(h)) < F.size(h)
    df = df.withColumn(p + "s", F.when(repeats, F.sort_array(
        F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))))
    s = F.col(p + "s")
    found = F.filter(s, lambda x, k: (F.get(s, k - 1)["h"] == x["h"]) | (F.get(s, k + 1)["h"] == x["h"]))
    df = df.withColumn(p + "p", F.sort_array(F.transform(found, lambda x: x["i"])))
    at = F.col(p + "p")
    covered = F.transform(at, lambda x, k: F.least(F.lit(5), F.coalesce(F.get(at, k + 1) - x, F.lit(5))))
    df = df.withColumn("n_repeat_words", F.coalesce(
        F.aggregate(covered, F.lit(0).cast("long"), lambda a, x: a + x), F.lit(0).cast("long")))
    lines = F.col(p + "l")
    df = (df.withColumn("n_words", n.cast("long"))
          .withColumn("word_chars", F.length(F.array_join(w, "")).cast("long"))
          .withColumn("n_symbols", F.regexp_count(text, F.lit(SYMBOLS)).cast("long"))
          .withColumn("n_dup_lines", (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"))
          .withColumn(p + "b", F.transform(lines, line_fails)))
    bad = F.col(p + "b")
    lost = F.filter(lines, lambda x, k: F.get(bad, k))
    df = df.withColumn(p + "lost", F.when(F.exists(bad, lambda b: b), lost))
    gone = F.col(p + "lost")
    lost_chars = F.coalesce(F.length(F.regexp_replace(F.array_join(gone, ""), WORD_GAP, "")), F.lit(0))
    df = df.withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                       | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))
    df = df.withColumn("kept", ~F.col("base_failed") & (lost_chars <= F.lit(max_lost) * F.col("word_chars")))
    df = df.withColumn("n_lines_removed", F.coalesce(F.size(gone), F.lit(0)).cast("long"))
    rest = F.array_join(F.filter(F.split(text, "\n"), lambda x: ~(x.rlike(HAS_WORD) & line_fails(x))), "\n")
    df = df.withColumn("cleaned", F.when(F.col("n_lines_removed") > 0, rest).otherwise(F.col(text_col)))
    return df.drop(*[p + c for c in ("w", "l", "h", "s", "p", "b", "lost")])


COLUMNS = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
           "n_lines_removed")

#: The same result as SQL over the table ``documents``.
SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, list_filter(string_split_regex(t, '{WORD_GAP}'), lambda x: x <> '') AS w FROM d),
g AS (SELECT r, w, unnest(generate_series(1, len(w) - 4)) AS i FROM w),
k AS (SELECT r, i, count(*) OVER (PARTITION BY r, w[i:i + 4]) AS c FROM g),
rep AS (SELECT r, count(DISTINCT i + j) AS n FROM k, (SELECT unnest(generate_series(0, 4)) AS j) WHERE c > 1 GROUP BY r),
l AS (SELECT r, line FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d)
      WHERE regexp_matches(line, '{HAS_WORD}')),
m AS (SELECT r, line, len(list_filter(string_split_regex(line, '{WORD_GAP}'), lambda x: x <> '')) AS n FROM l),
f AS (SELECT r, line,
        (NOT regexp_matches(line, '{CLOSING.replace("'", "''")}') AND n < {FEW_WORDS})
        OR len(regexp_extract_all(line, '{SYMBOLS}')) * 10 > length(line)
        OR len(regexp_extract_all(line, '{SHOUTS}')) * 2 > n
        OR len(regexp_extract_all(line, '{BARS}')) * 4 > n
        OR (n <= 20 AND regexp_matches(line, '{BOILERPLATE_RE}')) AS bad FROM m),
s AS (SELECT r, count(*) - count(DISTINCT line) AS dup, count(*) FILTER (bad) AS removed,
        coalesce(sum(length(regexp_replace(line, '{WORD_GAP}', '', 'g'))) FILTER (bad), 0) AS lost FROM f GROUP BY r),
a AS (SELECT doc_id, len(w.w)::BIGINT AS n_words, length(array_to_string(w.w, ''))::BIGINT AS word_chars,
        len(regexp_extract_all(t, '{SYMBOLS}'))::BIGINT AS n_symbols, coalesce(dup, 0)::BIGINT AS n_dup_lines,
        coalesce(rep.n, 0)::BIGINT AS n_repeat_words, coalesce(removed, 0)::BIGINT AS n_lines_removed,
        coalesce(lost, 0) AS lost
      FROM d JOIN w USING (r) LEFT JOIN rep USING (r) LEFT JOIN s USING (r)),
b AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM a)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND lost <= {MAX_LOST} * word_chars AS kept, n_lines_removed
FROM b
"""
