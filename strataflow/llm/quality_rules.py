"""Quality rules with cross-document line frequency, in DataFrame functions alone."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

#: Word, and the characters that count as symbols: fixed values.
GAP = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
#: Words of a window; least words of a document; most percent of words in repeated windows.
WINDOW, LEAST_WORDS, MOST_REPEATED = 5, 10, 20
#: Documents of a host from which on a line is taken for boilerplate; least percent of a document's words that must be left.
LINE_DOCUMENTS, LEAST_LEFT = 100, 50


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once however often it is used."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _words(text: Column) -> Column:
    return F.filter(F.split(text, GAP), lambda w: w != "")


def normal_line(line: Column) -> Column:
    """ASCII letters lower-cased, digits as 0, white space as one space, trimmed."""
    low = F.translate(line, "ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789", "abcdefghijklmnopqrstuvwxyz000000000")
    return F.trim(F.regexp_replace(low, GAP, " "))


def _repeat_words(words: Column) -> Column:
    """Words that stand in a window of ``WINDOW`` words found twice or more in the text.

    Windows are digests. If all differ the answer is 0; else (digest, place) pairs are sorted, the
    places of repeated digests are sorted again, and each adds the words up to the next one's.
    """

    def windows(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(w) - (WINDOW - 1)), lambda i: F.xxhash64(*[F.element_at(w, i + k) for k in range(WINDOW)]))

    def covered(h: Column) -> Column:
        pairs = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return _let(pairs, lambda s: _let(F.array_sort(F.transform(F.filter(s, lambda p, i: ((i > 0) & (F.get(s, i - 1)["h"] == p["h"])) | (F.get(s, i + 1)["h"] == p["h"])), lambda p: p["i"])), lambda at: F.aggregate(F.transform(at, lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(at, i + 1) - p, F.lit(WINDOW)))), F.lit(0).cast("long"), lambda a, x: a + x)))

    w = words
    return (F.when(F.size(w) < WINDOW + 1, F.lit(0).cast("long")).otherwise(_let(windows(w), lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(covered(h)))))


def base_counts(text: Column) -> dict[str, Column]:
    """Columns of the rules that look at one document; a null text counts as empty."""
    t = F.coalesce(text, F.lit(""))
    bare = F.regexp_replace(t, GAP, "")
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    counted = _let(_words(t), lambda w: F.struct(F.size(w).cast("long").alias("n_words"), _repeat_words(w).alias("n_repeat_words")))
    return {
        "counted": counted,
        "word_chars": F.char_length(bare).cast("long"),
        "n_symbols": (F.char_length(t) - F.char_length(F.translate(t, SYMBOLS, ""))).cast("long"),
        "n_dup_lines": _let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")),
    }


def _normal_lines(text_col: str) -> Column:
    return F.transform(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n"), normal_line)


def frequent_lines(df: DataFrame, id_col: str = "doc_id", host_col: str = "source", text_col: str = "text", line_documents: int = LINE_DOCUMENTS) -> DataFrame:
    """``host`` and ``line`` (digest) of the normalised lines in more than ``line_documents`` distinct documents of a host.

    A document is an id, or the text of a row without one. Rows are made distinct ahead of the count, which
    deals a line that fills a third of the corpus to all tasks; it then arrives as a row for each.
    """
    lines = F.array_distinct(F.filter(_normal_lines(text_col), lambda x: x != ""))
    document = F.struct(F.col(id_col).alias("id"), F.when(F.col(id_col).isNull(), F.xxhash64(text_col)).alias("text"))
    rows = df.select(F.coalesce(F.col(host_col).cast("string"), F.lit("")).alias("host"), document.alias("document"), F.explode(F.transform(lines, lambda x: F.xxhash64(x))).alias("line"))
    return rows.groupBy("host", "line").agg(F.countDistinct("document").alias("documents")).filter(F.col("documents") > line_documents).select("host", "line")


def quality_rules(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", line_documents: int = LINE_DOCUMENTS, least_left: int = LEAST_LEFT) -> DataFrame:
    """Judge each row by its own counts and by the lines that its host repeats.

    A normalised line found in more than ``line_documents`` distinct documents of the same host is removed from
    each; a row whose remaining words are less than ``least_left`` percent of its words, or fewer
    than ten, is depleted and rejected. Returns ``id_col``, ``text`` (without the frequent lines),
    the base counts, ``base_failed``, ``n_words_left`` and ``kept``, one row per input row.

    A null text counts as empty (0 words: base_failed), a null host as the empty one, a null
    id stays null, repeated rows are judged alike and count as one document, an empty table gives an empty result. No
    Python on the executors. Three shuffles, none of texts: counts of (host, line), lines against
    the frequent ones (a skewed key of that join can be split), and what was found against the
    rows, which are known by id, host and a digest of the text.
    """
    rows = df.select(F.col(id_col), F.col(text_col).alias("text"), F.coalesce(F.col(host_col).cast("string"), F.lit("")).alias("host"), F.xxhash64(text_col).alias("digest"))
    bad = frequent_lines(df, id_col, host_col, text_col, line_documents)
    found = rows.select(F.col(id_col).alias("i"), "host", "digest", F.posexplode(_normal_lines("text")).alias("at", "said")).filter("said != ''").select("i", "host", "digest", "at", F.xxhash64("said").alias("line"), (F.char_length("said") - F.char_length(F.translate("said", " ", "")) + 1).cast("long").alias("words"))
    hits = found.join(bad, ["host", "line"]).groupBy("i", "host", "digest").agg(F.collect_set(F.struct("at", "words")).alias("gone"))  # a set: equal rows say the same
    base = base_counts(F.col("text"))
    judged = rows.select(id_col, "text", F.col("host").alias("h"), F.col("digest").alias("d"), *[c.alias(k) for k, c in base.items()]).select("*", "counted.n_words", "counted.n_repeat_words").drop("counted")
    joined = judged.join(hits, (F.col("h") == F.col("host")) & (F.col("d") == F.col("digest")) & F.col(id_col).eqNullSafe(F.col("i")), "left")
    left = F.col("n_words") - F.coalesce(F.aggregate("gone", F.lit(0).cast("long"), lambda a, x: a + x["words"]), F.lit(0).cast("long"))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    # Lines between two removed places are kept as slices.
    cuts = F.concat(F.array(F.lit(-1)), F.array_sort(F.transform("gone", lambda x: x["at"])))
    kept_lines = _let(F.split(F.coalesce("text", F.lit("")), "\n"), lambda ls: _let(cuts, lambda c: F.flatten(F.transform(c, lambda p, k: F.slice(ls, p + 2, F.greatest(F.lit(0), F.coalesce(F.get(c, k + 1), F.size(ls)) - p - 1))))))
    cleaned = F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(kept_lines, "\n"))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    out = joined.select(id_col, cleaned.alias("text"), *counts, failed.alias("base_failed"), left.alias("n_words_left"))
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("n_words_left") >= LEAST_WORDS) & (100 * F.col("n_words_left") >= least_left * F.col("n_words")))


#: The same for documents with a source, without the cleaned text, as DuckDB SQL.
ORACLE_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS t FROM documents),
r AS (SELECT row_number() OVER () AS r, * FROM d),
w AS (SELECT *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM r),
win AS (SELECT r, i, concat_ws(' ', ws[i], ws[i+1], ws[i+2], ws[i+3], ws[i+4]) AS g FROM w, unnest(range(1, len(ws) - 3)) AS u(i)),
dup AS (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM win),
cov AS (SELECT r, count(DISTINCT i + k) AS n_repeat_words FROM dup, unnest(range(0, 5)) AS u(k) WHERE n > 1 GROUP BY r),
ln AS (SELECT r, host, CASE WHEN doc_id IS NULL THEN 'n' || t ELSE 'i' || doc_id END AS document, trim(regexp_replace(translate(l, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789', 'abcdefghijklmnopqrstuvwxyz000000000'), '[\x20\x09-\x0D]+', ' ', 'g')) AS l FROM r, unnest(string_split(t, chr(10))) AS u(l)),
bad AS (SELECT host, l FROM ln WHERE l <> '' GROUP BY host, l HAVING count(DISTINCT document) > {LINE_DOCUMENTS}),
gone AS (SELECT r, sum(length(l) - length(replace(l, ' ', '')) + 1) AS n FROM ln JOIN bad USING (host, l) GROUP BY r),
c AS (SELECT w.doc_id, len(ws)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
  (length(t) - length(translate(t, '{SYMBOLS}', '')))::BIGINT AS n_symbols,
  (len(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]'))) - len(list_distinct(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))))::BIGINT AS n_dup_lines,
  coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, (len(ws) - coalesce(gone.n, 0))::BIGINT AS n_words_left
  FROM w LEFT JOIN cov USING (r) LEFT JOIN gone USING (r)),
f AS (SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed FROM c)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, n_words_left,
  NOT base_failed AND n_words_left >= {LEAST_WORDS} AND 100 * n_words_left >= {LEAST_LEFT} * n_words AS kept FROM f
"""
