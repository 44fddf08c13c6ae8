"""Quality rules whose limits come from the data of each language and source.

Counts of a document become features (whole numbers: tenths of characters for the
mean word length, thousandths for shares). A sketch of a feature is its table of
(bin, count), at most 1,001 bins; sketches merge by adding counts, so those of sources
add up to those of languages and of everything, and quantiles are read off the running
counts. The limits of a group lie as far beyond its outer quantiles (the twentieth parts
at both ends) as these lie from its median, and at least a small guard beyond them; a
group with few documents takes those of its language, then of everything. Documents
that pass the base rules feed the sketches, and the limits are joined back to them.

Everything is DataFrame functions. Null and empty texts have no words and fail the
base rules; a null language or source counts as ''; repeated rows count each.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from marketlake.llm.storage import stored

BLANKS = " \t\n\x0b\x0c\r"
MIN_WORDS = 50
#: documents that a group needs for limits of its own
MIN_DOCS = 200
#: hundredths of the documents below the inner ends of the lower and the upper limit
LOWER, UPPER = 5, 95
#: least distance of a limit from its quantile, by feature, in units of the feature
GUARD = {"symbols": 50, "dup_lines": 200, "repeats": 100, "word_len": 10}
FEATURES = list(GUARD)
#: languages and sources whose limits are broadcast, some hundred bytes each
GROUPS = 100_000


def _let(value: Column, body) -> Column:
    """`body` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _covered(windows: Column) -> Column:
    """Words in windows of three (given by hash) that occur twice or more."""

    def by_position(found: Column) -> Column:
        twice = F.filter(
            found,
            lambda x, i: (F.coalesce(F.get(found, i - 1)["h"] == x["h"], F.lit(False)))
            | (F.coalesce(F.get(found, i + 1)["h"] == x["h"], F.lit(False))),
        )
        return F.sort_array(F.transform(twice, lambda x: x["i"]))

    def count(at: Column) -> Column:
        new = F.transform(at, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(at, i + 1) - x, F.lit(3))))
        return F.aggregate(new, F.lit(0), lambda a, b: a + b)

    pairs = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return _let(_let(pairs, by_position), count)


def _from_words(words: Column) -> Column:
    n = F.size(words)
    windows = F.when(
        n >= 3,
        F.transform(
            F.sequence(F.lit(0), n - 3),
            lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    repeats = _let(
        windows,
        lambda t: F.when(F.size(F.array_distinct(t)) == F.size(t), F.lit(0)).otherwise(_covered(t)),
    )
    return F.struct(
        n.cast("long").alias("n_words"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        repeats.cast("long").alias("n_repeat_words"),
    )


def with_counts(docs: DataFrame) -> DataFrame:
    """Add the counts as one struct column `q` (replacing one of that name)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.filter(F.split(text, f"[{BLANKS}]+"), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    by_line = _let(
        lines,
        lambda x: F.struct(
            F.size(x).cast("long").alias("n_lines"),
            (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        ),
    )
    symbols = F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long")
    made = docs.withColumn("q", F.struct(_let(words, _from_words).alias("w"), by_line.alias("x"),
                                         symbols.alias("n_symbols")))
    w, x, n_symbols = F.col("q.w"), F.col("q.x"), F.col("q.n_symbols")
    share = lambda a, b: F.expr(f"{a} * 1000 div greatest({b}, 1)")
    return made.withColumn(
        "q",
        F.struct(
            w["n_words"].alias("n_words"),
            w["word_chars"].alias("word_chars"),
            n_symbols.alias("n_symbols"),
            x["n_dup_lines"].alias("n_dup_lines"),
            w["n_repeat_words"].alias("n_repeat_words"),
            ((w["n_words"] < MIN_WORDS) | (100 * w["n_repeat_words"] > 50 * w["n_words"])).alias("base_failed"),
            share("q.n_symbols", "q.w.word_chars").alias("symbols"),
            share("q.x.n_dup_lines", "q.x.n_lines").alias("dup_lines"),
            share("q.w.n_repeat_words", "q.w.n_words").alias("repeats"),
            F.least(F.expr("q.w.word_chars * 10 div greatest(q.w.n_words, 1)"), F.lit(1000)).alias("word_len"),
        ),
    )


def sketches(counted: DataFrame) -> DataFrame:
    """(lang, source, feature, bin, n) of the documents that pass the base rules."""
    each = F.array(*(F.struct(F.lit(f).alias("feature"), F.col(f"q.{f}").alias("bin")) for f in FEATURES))
    return (
        counted.where(~F.col("q.base_failed"))
        .select(*_group(), F.inline(each))
        .groupBy("lang", "source", "feature", "bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _group() -> list[Column]:
    return [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]


def _limits(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """Merged sketches of `keys`: number of documents, lower and upper limit by feature."""
    merged = sketch.groupBy(*keys, "feature", "bin").agg(F.sum("n").alias("n"))
    by = W.partitionBy(*keys, "feature")
    run = merged.select(
        *keys, "feature", "bin", F.sum("n").over(by).alias("docs"),
        F.sum("n").over(by.orderBy("bin").rowsBetween(W.unboundedPreceding, 0)).alias("upto"),
    )
    at = lambda k: F.min(F.when(100 * F.col("upto") >= k * F.col("docs"), F.col("bin")))
    quantiles = run.groupBy(*keys, "feature").agg(
        F.max("docs").alias("docs"), at(LOWER).alias("lower"), at(50).alias("middle"), at(UPPER).alias("upper")
    )
    guard = F.create_map(*(F.lit(x) for pair in GUARD.items() for x in pair))[F.col("feature")]
    beyond = lambda a, b: F.greatest(F.col(b) - F.col(a), guard)
    return quantiles.select(*keys, "feature", "docs",
                            (F.col("lower") - beyond("lower", "middle")).alias("low"),
                            (F.col("upper") + beyond("middle", "upper")).alias("high"))


def limits(sketch: DataFrame) -> DataFrame:
    """One row per (lang, source): for each feature a struct of its limits."""
    overall = _limits(sketch, []).select("feature", F.struct("low", "high").alias("o"))
    language = _limits(sketch, ["lang"]).select("lang", "feature", F.struct("docs", "low", "high").alias("l"))
    group = _limits(sketch, ["lang", "source"])
    own = group.select("lang", "source", "feature", F.struct("docs", "low", "high").alias("g"))
    chosen = own.join(language, ["lang", "feature"]).join(overall, "feature").select(
        "lang", "source", "feature",
        F.when(F.col("g.docs") >= MIN_DOCS, F.struct("g.low", "g.high"))
        .when(F.col("l.docs") >= MIN_DOCS, F.struct("l.low", "l.high"))
        .otherwise(F.col("o")).alias("limit"),
    )
    per = [F.max(F.when(F.col("feature") == f, F.col("limit"))).alias(f"limit_{f}") for f in FEATURES]
    return chosen.groupBy("lang", "source").agg(*per)


def _verdict() -> Column:
    """Symbols, repeated lines and words must not exceed the upper limit; the length of
    words must keep both."""
    rules = [F.col(f"q.{f}") <= F.col(f"limit_{f}.high") for f in FEATURES]
    rules.append(F.col("q.word_len") >= F.col("limit_word_len.low"))
    return ~F.col("q.base_failed") & reduce(lambda a, b: a & b, rules)


def judged(counted: DataFrame, found: DataFrame) -> DataFrame:
    """Add `kept`. The limits have one row for each language and source: they are stored
    and counted, and up to `GROUPS` of them are broadcast, so that documents stay where
    they are; more are joined by a shuffle."""
    limit = stored(found, "limits").withColumnsRenamed({"lang": "limit_lang", "source": "limit_source"})
    if limit.count() <= GROUPS:
        limit = F.broadcast(limit)
    lang, source = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("lang", "source"))
    on = (lang == F.col("limit_lang")) & (source == F.col("limit_source"))
    return counted.join(limit, on, "left").withColumn("kept", F.coalesce(_verdict(), F.lit(False)))


def report(docs: DataFrame) -> DataFrame:
    """One row per document: its counts and the verdicts."""
    counted = stored(with_counts(docs.select("doc_id", "lang", "source", "text")).drop("text"), "counts")
    fields = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    return judged(counted, limits(sketches(counted))).select(
        "doc_id", *(f"q.{f}" for f in fields), "kept"
    )


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that are kept, with their own columns, whatever their names. Texts
    are counted once for the sketches and once where they are judged, beside limits that
    come to them: no text is shuffled or stored for it."""
    whole = F.struct(*(docs[c] for c in docs.columns)).alias("doc")
    counted = with_counts(docs.select(whole, "lang", "source", "text"))
    return judged(counted, limits(sketches(counted))).where("kept").select("doc.*")


def report_sql() -> str:
    def quantiles(keys: str, name: str) -> str:
        comma = f"{keys}, " if keys else ""
        guard = " ".join(f"WHEN '{f}' THEN {v}" for f, v in GUARD.items())
        return f"""{name} AS (
      SELECT {comma}feature, docs, lower - greatest(middle - lower, guard) AS low,
             upper + greatest(upper - middle, guard) AS high
      FROM (SELECT {comma}feature, count(*) AS docs, quantile_disc(bin, {LOWER / 100}) AS lower,
                   quantile_disc(bin, 0.5) AS middle, quantile_disc(bin, {UPPER / 100}) AS upper,
                   CASE feature {guard} END AS guard
            FROM long GROUP BY {comma}feature))"""

    picks = ", ".join(
        f"max(CASE WHEN feature = '{f}' THEN {side} END) AS {f}_{side}"
        for f in FEATURES for side in ("low", "high")
    )
    good = " AND ".join(f"{f} <= {f}_high" for f in FEATURES)
    return rf"""
    WITH w AS (
      SELECT row_number() OVER () AS r, doc_id, coalesce(lang, '') AS lang,
             coalesce(source, '') AS source, coalesce(text, '') AS text,
             regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
    t AS (SELECT r, i, ws[i:i + 2] AS g
          FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
    rep AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM t) WHERE c > 1),
    cov AS (SELECT r, count(DISTINCT j) AS n
            FROM (SELECT r, unnest([i, i + 1, i + 2]) AS j FROM rep) GROUP BY r),
    c AS (
      SELECT w.r, doc_id, lang, source, len(ws) AS n_words,
             length(array_to_string(ws, '')) AS word_chars,
             len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls,
             coalesce(cov.n, 0) AS n_repeat_words
      FROM w LEFT JOIN cov ON cov.r = w.r),
    d AS (SELECT *, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
                 n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM c),
    f AS (SELECT *, n_symbols * 1000 // greatest(word_chars, 1) AS symbols,
                 n_dup_lines * 1000 // greatest(len(ls), 1) AS dup_lines,
                 n_repeat_words * 1000 // greatest(n_words, 1) AS repeats,
                 least(word_chars * 10 // greatest(n_words, 1), 1000) AS word_len FROM d),
    long AS (UNPIVOT (SELECT r, lang, source, symbols, dup_lines, repeats, word_len
                      FROM f WHERE NOT base_failed)
             ON symbols, dup_lines, repeats, word_len INTO NAME feature VALUE bin),
    {quantiles('', 'o')}, {quantiles('lang', 'l')}, {quantiles('lang, source', 'g')},
    chosen AS (
      SELECT g.lang, g.source, g.feature,
             CASE WHEN g.docs >= {MIN_DOCS} THEN g.low WHEN l.docs >= {MIN_DOCS} THEN l.low ELSE o.low END AS low,
             CASE WHEN g.docs >= {MIN_DOCS} THEN g.high WHEN l.docs >= {MIN_DOCS} THEN l.high ELSE o.high END AS high
      FROM g JOIN l ON l.lang = g.lang AND l.feature = g.feature JOIN o ON o.feature = g.feature),
    lim AS (SELECT lang, source, {picks} FROM chosen GROUP BY lang, source)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           coalesce(NOT base_failed AND {good} AND word_len >= word_len_low, FALSE) AS kept
    FROM f LEFT JOIN lim ON lim.lang = f.lang AND lim.source = f.source"""
