"""Keyword mining: TF-IDF, distinctive words, word and pair counts, themes."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from echolens import constants as C
from echolens.functions.numbers import pct, round_exact
from echolens.functions.text import (
    bigrams, drop_words, explode_pairs, explode_terms, mentions, stopwords_without_negations,
)
from echolens.operators.postings import terms_and_lengths
from echolens.operators.skew import first_rows, lookup_join
from echolens.session import durable

TOKENS = "tokens_stemmed"
# Terms in more than this share of the documents are scored first.
FREQUENT_SHARE = 1e-3
# More than an array can have entries.
PLACES_PER_ROW = 10_000_000_000


# --- TF-IDF ------------------------------------------------------------------
def tfidf_keywords(
    df: DataFrame, by: Sequence[str] = (), k: int = 20, doc: str = "seq",
    tokens: str = TOKENS, hot_share: float = FREQUENT_SHARE,
) -> DataFrame:
    """Top unigrams and bigrams by summed, length-normalised TF-IDF.

    Smooth idf ``ln((1+N)/(1+df)) + 1`` and unit-length documents; each ``by``
    group is a corpus of its own. ``count`` is the raw term frequency. Ties in
    the score are alphabetical.

    Words are written once, ``df`` is read once. ``postings`` counts every term's
    documents and sums every document's length. A document adds at most 1 to a
    term's score, which so never exceeds its number of documents: terms in more than
    ``hot_share`` of the documents are scored first, and where the ``k``-th best of
    them is not above all that were left out, every term of the group is scored.
    """
    joined = F.array_join(F.col(tokens), " ")
    groups = list(by) or ["_all"]
    # rows are filtered after the write: before it, the optimizer would run the text
    # stages a second time, below the shuffle that they follow
    docs = durable(df.withColumn("_all", F.lit(0)).select(
        *groups, F.col(doc).alias("_doc"),
        F.regexp_extract_all(joined, F.lit(f"{C.WORD}+"), 0).alias("_words"),
        (F.trim(joined) != "").alias("_some"),
    )).filter("_some").drop("_some")
    repeats = docs.groupBy(*groups, "_doc").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    if not repeats.isEmpty():
        # one document; an empty word keeps its texts apart
        texts = F.flatten(F.collect_list(F.concat(F.array(F.lit("")), "_words")))
        docs = durable(docs.groupBy(*groups, "_doc").agg(texts.alias("_words")))
    corpus = durable(docs.groupBy(*groups).agg(F.count(F.lit(1)).alias("_docs")))
    sized = docs.join(corpus, groups)
    best = durable(_best_terms(sized, groups, k, hot_share))
    bound = F.col("_docs") * hot_share
    sure = best.filter(F.col("rank") == k).join(corpus, groups).filter(F.col("_score") > bound + 1e-6)
    open_groups = corpus.filter(bound >= 1).join(sure, groups, "left_anti").select(*groups)
    if not open_groups.isEmpty():
        every = _best_terms(sized.join(open_groups, groups, "left_semi"), groups, k, 0.0)
        best = best.join(open_groups, groups, "left_anti").unionByName(every)
    return best.select(
        *by, "rank", "keyword", round_exact(F.col("_score"), 4).alias("score"), "count"
    )


def _best_terms(docs: DataFrame, by: Sequence[str], k: int, least: float) -> DataFrame:
    """Best terms of those in more than ``least`` of a group's documents."""
    stats = durable(terms_and_lengths(docs, by, least))
    lengths = stats.filter("keyword IS NULL").select(
        *[F.col(c).alias(f"_of_{c}") for c in by], F.col("_doc").alias("_of_doc"),
        (1 / F.sqrt("_value")).alias("_unit"),
    )
    same = F.col("_doc").eqNullSafe(F.col("_of_doc"))
    for c in by:
        same = same & (F.col(c) == F.col(f"_of_{c}"))
    words = F.col("_words")
    rows = explode_terms(
        docs.join(lengths, same), [*by, "_unit"], F.concat(words, bigrams(words)), "keyword"
    )
    idf = stats.filter("keyword IS NOT NULL").select(*by, "keyword", _idf("_value").alias("_idf"))
    totals = [F.sum("_unit").alias("_sum"), F.count(F.lit(1)).alias("count")]
    if least > 0:
        # no more than 1 / least times the terms of a mean document
        sums = rows.join(F.broadcast(idf), [*by, "keyword"]).groupBy(*by, "keyword", "_idf").agg(*totals)
    else:
        sums = rows.groupBy(*by, "keyword").agg(*totals).join(idf, [*by, "keyword"])
    scores = sums.select(*by, "keyword", "count", (F.col("_sum") * F.col("_idf")).alias("_score"))
    # the sum of doubles depends on row order in its last digits only
    return first_rows(scores, by, [F.round("_score", 9).desc(), F.col("keyword")], k)


def _idf(frequency: str) -> Column:
    return F.log((F.col("_docs") + 1) / (F.col(frequency) + 1)) + 1.0


# --- distinctive words -------------------------------------------------------
def distinctive_keywords(
    df: DataFrame, group: str, groups: Sequence[str], by: Sequence[str] = (),
    k: int = C.KEYWORDS_PER_GROUP, minimum: int = C.MIN_KEYWORD_DOCS,
    tokens: str = TOKENS, stopwords: Iterable[str] | None = None,
) -> DataFrame:
    """Words that set one group apart from the pool, by weighted log-odds.

    A word counts once per comment. The pool is every row of ``df``; pass only
    classified rows when comparing labels, all rows when comparing tiers. Group
    names are a fixed short list, so one aggregate per word holds all groups.
    """
    listed = stopwords_without_negations(stopwords)
    words = F.array_distinct(
        F.filter(
            drop_words(F.col(tokens), listed), lambda t: F.length(t) > C.KEYWORD_MIN_LENGTH
        )
    )
    rows = explode_terms(
        df.withColumn("_g", F.col(group)), [*by, "_g"], words, "keyword"
    )
    # written once: it is read for the group sizes and for the scores
    per_word = durable(rows.groupBy(*by, "keyword").agg(
        F.count(F.lit(1)).alias("_all"),
        *[F.count_if(F.col("_g") == g).alias(f"_c{i}") for i, g in enumerate(groups)],
    ))
    totals = per_word.groupBy(*by).agg(
        F.sum("_all").alias("_n_all"),
        *[F.sum(f"_c{i}").alias(f"_n{i}") for i in range(len(groups))],
    )
    per_group = F.explode(F.array(*[
        F.struct(F.lit(g).alias(group), F.col(f"_c{i}").alias("count"), F.lit(i).alias("_i"))
        for i, g in enumerate(groups)
    ]))
    # no group counts a word more often than all do: most words end here, before the explode
    counted = per_word.filter(F.col("_all") >= minimum).select(
        *by, "keyword", "_all", per_group.alias("_x")
    ).select(
        *by, "keyword", "_all", "_x.*"
    ).filter(F.col("count") >= minimum)
    sizes = totals.select(*by, F.struct(
        "_n_all", F.array(*[F.col(f"_n{i}") for i in range(len(groups))]).alias("n")
    ).alias("_sizes"))
    if by:
        sized = lookup_join(counted, sizes, by, "inner", spread=["keyword"], probe=True)
    else:
        sized = counted.withColumn("_sizes", sizes.scalar())
    n_target = F.element_at(F.col("_sizes.n"), F.col("_i") + 1)
    n_other = F.greatest(F.col("_sizes._n_all") - n_target, F.lit(0))
    c, other = F.col("count"), F.greatest(F.col("_all") - F.col("count"), F.lit(0))
    score = log_odds(c, n_target, other, n_other)
    scored = sized.select(
        *by, group, "keyword", round_exact(score, 2).alias("score"), "count",
        pct(c, c + other).alias("share_pct"),
    )
    order = [F.col("score").desc(), F.col("keyword")]
    return first_rows(scored, [*by, group], order, k)


def log_odds(c: Column, n: Column, c_other: Column, n_other: Column) -> Column:
    p, q = (c + 0.5) / (n + 1), (c_other + 0.5) / (n_other + 1)
    difference = F.log(p / (1 - p)) - F.log(q / (1 - q))
    return difference / F.sqrt(1 / (c + 0.5) + 1 / (c_other + 0.5))


def keywords_by_label(df: DataFrame, by: Sequence[str] = (), **options) -> DataFrame:
    classified = df.filter(F.col("sentiment_label").isin(*C.CLASSIFIED))
    return distinctive_keywords(classified, "sentiment_label", C.CLASSIFIED, by, **options)


def keywords_by_tier(df: DataFrame, by: Sequence[str] = (), **options) -> DataFrame:
    return distinctive_keywords(df, "tier", C.TIERS, by, **options)


# --- counts ------------------------------------------------------------------
def top_words(
    df: DataFrame, by: Sequence[str] = ("tier",), k: int = C.TOP_WORDS_PER_TIER,
    tokens: str = TOKENS,
) -> DataFrame:
    """Most used words; ties keep first appearance, by row and place in it."""
    placed = df.select(*by, "seq", F.posexplode_outer(F.col(tokens)).alias("_pos", "keyword"))
    return _top_terms(placed.filter(F.col("keyword").isNotNull()), "keyword", by, k)


def top_pairs(
    df: DataFrame, by: Sequence[str] = ("tier",), k: int = C.TOP_PAIRS_PER_TIER,
    minimum: int = C.MIN_PAIR_COUNT, tokens: str = TOKENS,
) -> DataFrame:
    """Most used adjacent pairs: the top ``k`` of those that are not rare."""
    placed = explode_pairs(df, [*by, "seq"], F.col(tokens), "_pos", "theme")
    return _top_terms(placed, "theme", by, k, minimum)


def _top_terms(placed: DataFrame, name: str, by: Sequence[str], k: int, minimum: int = 1) -> DataFrame:
    """First ``k`` terms by count and first appearance, of placed terms.

    Counts come first in the order, so rare terms are dropped before they are ranked
    and the ranks stay. Row and place are one number: a bigint where the row's number
    has 32 bits, which costs next to nothing for every term, else a decimal of 32
    digits, wide enough for any bigint and int. Both are combined by hash before the
    shuffle, which a struct is not.
    """
    seq, pos = F.col("seq").cast("bigint"), F.col("_pos")
    short = seq.between(-(2**31), 2**31 - 1)
    per_row = F.lit(PLACES_PER_ROW).cast("decimal(11,0)")
    near = F.when(short, F.shiftleft(seq, 31).bitwiseOR(pos.cast("bigint")))
    far = F.when(~short, seq.cast("decimal(19,0)") * per_row + pos.cast("decimal(10,0)"))
    counts = (
        placed.groupBy(*by, name)
        .agg(F.count(F.lit(1)).alias("count"), F.min(near).alias("_near"), F.min(far).alias("_far"))
        .filter(F.col("count") >= minimum)
    )
    # rows far below come before the near ones, rows far above behind them
    below = F.when(F.col("_far") < 0, F.col("_far"))
    within = F.when(below.isNull(), F.col("_near"))
    above = F.when(F.coalesce(below, F.col("_near")).isNull(), F.col("_far"))
    nowhere = F.col("_near").isNull() & F.col("_far").isNull()
    order = [
        F.col("count").desc(), nowhere.desc(), below.asc_nulls_last(), within.asc_nulls_last(), above, F.col(name),
    ]
    return first_rows(counts, by, order, k).drop("_near", "_far")


# --- themes ------------------------------------------------------------------
def theme_matches(
    df: DataFrame, by: Sequence[str] = (), themes: Mapping[str, Sequence[str]] = C.THEMES,
    titles: Mapping[str, str] = C.THEME_TITLES, tokens: str = TOKENS,
) -> DataFrame:
    """Rows mentioning each theme; a row may match several.

    All patterns are counted in one pass over the rows, without a join.
    """
    text = F.array_join(F.col(tokens), " ")
    rows = df.select(*by, F.coalesce(text, F.lit("")).alias("_t"))
    counts = rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("_total"),
        *[
            F.count_if(mentions(F.col("_t"), words)).alias(f"_m{i}")
            for i, words in enumerate(themes.values())
        ],
    )
    listed = F.explode(F.array(*[
        F.struct(
            F.lit(i).alias("_i"), F.lit(name).alias("theme"),
            F.lit(titles.get(name, name)).alias("label"), F.col(f"_m{i}").alias("count"),
        )
        for i, name in enumerate(themes)
    ]))
    rows = counts.select(*by, "_total", listed.alias("_x")).select(*by, "_total", "_x.*")
    order = Window.partitionBy(*by).orderBy(F.col("count").desc(), "_i")
    return rows.select(
        *by, F.row_number().over(order).alias("rank"), "theme", "label", "count",
        pct(F.col("count"), F.col("_total")).alias("share_pct"),
    )
