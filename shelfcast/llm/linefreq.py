"""Quality rules with cross-document line frequency, in DataFrame expressions only.

A line's normal form is lower case with digits as 0 and white space as one
blank. A line that stands in more documents of its host than the limit allows is
page furniture: it is removed, and a document that loses too much of its text
is rejected. Exact copies of a text count as one document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[^#*$%&|<>]"


def words(text: Column) -> Column:
    """The words of a text; the split leaves an empty first part where a text starts with white space."""
    parts = F.split(text, GAP)
    return F.filter(parts, lambda w: w != "")


def let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once per row."""
    return F.element_at(F.transform(F.array(value), use), 1)


def word_chars(text: Column) -> Column:
    return F.length(F.regexp_replace(text, GAP, "")).cast("long")


def symbol_count(text: Column) -> Column:
    return F.length(F.regexp_replace(text, SYMBOLS, "")).cast("long")


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    real = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    return let(real, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))


def repeated_words(items: Column, n: int = 5) -> Column:
    """Words inside windows of ``n`` words that occur twice or more in the list.

    Windows are compared by a 64-bit hash. Sorted hashes tell whether any occurs
    twice; only then are places sorted along, and each place of a repeated window
    covers up to ``n`` words, fewer if the next such place is closer.
    """
    starts = F.when(F.size(items) >= n, F.sequence(F.lit(0), F.size(items) - n)).otherwise(F.array().cast("array<int>"))
    windows = F.transform(starts, lambda i: F.xxhash64(*[F.get(items, i + j) for j in range(n)]))

    def covered(hashes: Column) -> Column:
        pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def count(s: Column) -> Column:
            twice = F.filter(s, lambda x, k: (F.get(s, k - 1)["h"] == x["h"]) | (F.get(s, k + 1)["h"] == x["h"]))
            places = F.array_sort(F.transform(twice, lambda x: x["i"]))
            gaps = lambda p: F.transform(p, lambda x, k: F.least(F.lit(n), F.coalesce(F.get(p, k + 1) - x, F.lit(n))))
            return let(places, lambda p: F.aggregate(gaps(p), F.lit(0).cast("long"), lambda a, x: a + x))

        return let(pairs, count)

    def of(hashes: Column) -> Column:
        once = F.size(F.array_distinct(hashes)) == F.size(hashes)
        return F.when(once, F.lit(0).cast("long")).otherwise(covered(hashes))

    return let(windows, of)


def line_key(line: Column) -> Column:
    """A hash of the line's normal form."""
    plain = F.regexp_replace(F.regexp_replace(F.lower(line), "[0-9]", "0"), GAP, " ")
    return F.xxhash64(F.trim(plain))


def keyed(docs: DataFrame, columns: list[str]) -> DataFrame:
    """``whole``, the wanted columns of a row, beside its host, its text and a key; identical rows share the key."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("whole"), F.col("source").alias("host"), text.alias("words_of"), F.xxhash64("doc_id", text, "source").alias("key"))


def counted(rows: DataFrame) -> DataFrame:
    """``rows`` with the counts of the base rules."""
    text = F.col("words_of")
    both = let(words(text), lambda w: F.struct(F.size(w).cast("long").alias("n"), repeated_words(w).alias("r")))
    rows = rows.withColumn("both", both).select("*", F.col("both.n").alias("n_words"), F.col("both.r").alias("n_repeat_words")).drop("both")
    return rows.select(
        "*",
        word_chars(text).alias("word_chars"),
        symbol_count(text).alias("n_symbols"),
        duplicate_lines(text).alias("n_dup_lines"),
        F.expr("n_words < 10 OR 100 * n_repeat_words > 20 * n_words").alias("base_failed"),
    )


def frequent_places(rows: DataFrame, share: float, least: int) -> DataFrame:
    """``key, lost, places``: per document the words in frequent lines and those lines' numbers.

    A line is frequent if more documents of the host hold it than
    ``max(least, share * documents of the host)``.
    """
    text_key = F.xxhash64("words_of").alias("text_key")
    lines = rows.select("key", "host", text_key, F.posexplode(F.split("words_of", "\n")).alias("place", "line"))
    lines = lines.where(F.col("line").rlike(WORD))
    lines = lines.select("key", "host", "text_key", "place", line_key(F.col("line")).alias("line_key"), F.size(words(F.col("line"))).alias("n"))
    sizes = rows.select("host", text_key).distinct().groupBy("host").agg(F.count(F.lit(1)).alias("host_docs"))
    counts = lines.select("host", "line_key", "text_key").distinct().groupBy("host", "line_key").agg(F.count(F.lit(1)).alias("line_docs"))
    often = counts.where(F.col("line_docs") > least).alias("c").join(sizes.alias("s"), F.col("c.host").eqNullSafe(F.col("s.host")))
    often = often.where(F.col("line_docs") > F.col("host_docs") * share).select("c.host", "line_key")
    same = F.col("l.host").eqNullSafe(F.col("f.host")) & (F.col("l.line_key") == F.col("f.line_key"))
    hits = lines.alias("l").join(often.alias("f"), same, "left_semi").select("key", "place", "n").distinct()
    return hits.groupBy("key").agg(F.sum("n").alias("lost"), F.collect_list("place").alias("places"))


def _judged(docs: DataFrame, columns: list[str], share: float, least: int, max_lost: float) -> DataFrame:
    """Rows with their counts and verdict; of the text, only what ``columns`` name goes through the join."""
    rows = keyed(docs, columns)
    judged = counted(rows).drop("words_of", "host").join(frequent_places(rows, share, least), "key", "left").withColumn("lost", F.coalesce("lost", F.lit(0)))
    depleted = (F.col("lost") > F.col("n_words") * max_lost) | (F.col("n_words") - F.col("lost") < 10)
    return judged.withColumn("kept", ~F.col("base_failed") & ~depleted)


def line_verdicts(docs: DataFrame, share: float = 0.05, least: int = 20, max_lost: float = 0.5) -> DataFrame:
    """Base counts, words in frequent lines and the verdict, one row per row of ``docs(doc_id, text, source)``.

    A document is rejected if a base rule fails, or if frequent lines hold more
    than ``max_lost`` of its words or leave fewer than ten. A null text counts
    as empty and fails; a null source is a host like any other; repeated rows
    get equal results. Other columns are not read.
    """
    return _judged(docs, ["doc_id"], share, least, max_lost).select(
        F.col("whole.doc_id").alias("doc_id"),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        F.col("lost").alias("n_removed_words"),
        "base_failed",
        "kept",
    )


def clean_documents(docs: DataFrame, share: float = 0.05, least: int = 20, max_lost: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that the rules keep, without their frequent lines; all columns stay.

    ``n_chars``, where there is one, is counted anew for a text that lost lines.
    """
    kept = _judged(docs, docs.columns, share, least, max_lost).where("kept")
    lines = F.split("whole.text", "\n")
    rest = let(lines, lambda x: F.array_join(F.transform(F.array_except(F.sequence(F.lit(0), F.size(x) - 1), F.col("places")), lambda i: F.get(x, i)), "\n"))
    kept = kept.withColumn("cut", F.when(F.col("places").isNotNull(), rest))
    new = {"text": F.col("cut"), "n_chars": F.length("cut").cast("long")}
    whole = [F.col(f"whole.`{c}`") for c in docs.columns]
    return kept.select(*[F.when(F.col("cut").isNull(), w).otherwise(new[c]).alias(c) if c in new else w for c, w in zip(docs.columns, whole)])


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, source FROM documents),
w AS (SELECT doc_id, regexp_extract_all(t, '[^ 	-
]+') AS ws FROM d),
p AS (SELECT doc_id, i, array_to_string(ws[i:i + 4], ' ') AS g
      FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 4)) AS i FROM w WHERE len(ws) >= 5)),
r AS (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS j
      FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM p) WHERE c > 1),
rep AS (SELECT doc_id, sum(least(5, coalesce(j - i, 5))) AS n FROM r GROUP BY doc_id),
l AS (SELECT doc_id, source, t, unnest(string_split(t, chr(10))) AS line FROM d),
k AS (SELECT doc_id, source, t, line, len(regexp_extract_all(line, '[^ 	-
]+')) AS n,
             trim(regexp_replace(regexp_replace(lower(line), '[0-9]', '0', 'g'), '[ 	-
]+', ' ', 'g')) AS norm
      FROM l WHERE regexp_matches(line, '[^ 	-
]')),
often AS (SELECT source, norm FROM (SELECT source, norm, count(DISTINCT t) AS c FROM k GROUP BY source, norm)
          JOIN (SELECT source, count(DISTINCT t) AS h FROM d GROUP BY source) USING (source)
          WHERE c > 20 AND c > h * CAST(0.05 AS DOUBLE)),
lost AS (SELECT doc_id, sum(n) AS n FROM k SEMI JOIN often USING (source, norm) GROUP BY doc_id),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM k GROUP BY doc_id),
a AS (SELECT d.doc_id, len(ws) AS n_words, length(regexp_replace(t, '[ 	-
]+', '', 'g')) AS word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(dup.n, 0) AS n_dup_lines,
             coalesce(rep.n, 0) AS n_repeat_words, coalesce(lost.n, 0) AS n_removed_words
      FROM d JOIN w USING (doc_id) LEFT JOIN dup USING (doc_id) LEFT JOIN rep USING (doc_id) LEFT JOIN lost USING (doc_id)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM a)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
       n_removed_words::BIGINT AS n_removed_words, base_failed,
       NOT base_failed AND NOT (n_removed_words > n_words * 0.5 OR n_words - n_removed_words < 10) AS kept
FROM b
"""
