"""Text, token and privacy column functions. All stay on the JVM side."""

from __future__ import annotations

import sys
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from echolens import constants as C
from echolens.functions.numbers import round_exact


def strip(text: Column) -> Column:
    """Trim every kind of Unicode whitespace, not only blanks."""
    return F.regexp_replace(text, rf"^{C.SPACE}+|{C.SPACE}+$", "")


def blank_to(text: Column, default: str) -> Column:
    """Trimmed text, or the default when nothing is left."""
    return F.coalesce(F.nullif(strip(text), F.lit("")), F.lit(default))


# --- cleaning stages ---------------------------------------------------------
# A pattern costs some 50 to 100 ns per character, a look for a few bytes about 1: a stage
# asks first whether its pattern can match at all.
def _may_hold_emoji(text: Column) -> Column:
    """Whether a character of U+2000 to U+2FFF or U+1F000 to U+1FFFF, as all emoji are, occurs."""
    raw = text.cast("binary")
    return F.contains(raw, F.unhex(F.lit("E2"))) | F.contains(raw, F.unhex(F.lit("F09F")))


def emoji_found(text: Column) -> Column:
    whole = F.coalesce(text, F.lit(""))
    found = F.regexp_extract_all(whole, F.lit(C.EMOJI_PATTERN), 0)
    return F.when(_may_hold_emoji(whole), found).otherwise(F.array().cast("array<string>"))


def without_emoji(text: Column) -> Column:
    whole = F.coalesce(text, F.lit(""))
    return F.when(_may_hold_emoji(whole), F.regexp_replace(whole, C.EMOJI_PATTERN, "")).otherwise(whole)


def _folding_exceptions() -> dict[str, str]:
    """Characters whose full case folding differs from lower-casing."""
    table = {}
    for point in range(sys.maxunicode + 1):
        lowered, folded = chr(point).lower(), chr(point).casefold()
        if lowered != folded and len(lowered) == 1:
            table[lowered] = folded
    return table


_FOLDS = _folding_exceptions()
_FOLD_ONE = {k: v for k, v in _FOLDS.items() if len(v) == 1}
_FOLD_MANY = {k: v for k, v in _FOLDS.items() if len(v) > 1}
_RARE = "".join(k for k in _FOLDS if k != "ß")
# Neither ASCII nor a letter of Latin-1, none of which folds otherwise once ß is expanded.
_UNCOMMON = r"[^\x00-\x7f\xc0-\xff]"


def lower_text(text: Column) -> Column:
    """Lower case with the common sharp s already expanded."""
    return F.replace(F.lower(F.coalesce(text, F.lit(""))), F.lit("ß"), F.lit("ss"))


def fold_exceptions(lowered: Column) -> Column:
    """Turn lower-cased into fully case-folded text.

    A text without characters beyond Latin-1 letters has none; else one pass of
    ``translate`` tells whether an exception occurs at all, and only such rows are
    taken apart.
    """
    many, expansions = sorted(_FOLD_MANY), literal_map(_FOLD_MANY)
    single = F.translate(lowered, "".join(_FOLD_ONE), "".join(_FOLD_ONE.values()))
    expanded = F.array_join(
        F.transform(
            F.split(single, ""),
            lambda ch: F.when(ch.isin(many), F.element_at(expansions, ch)).otherwise(ch),
        ),
        "",
    )
    ascii_only = F.octet_length(lowered) == F.char_length(lowered)
    common = ascii_only | ~lowered.rlike(_UNCOMMON)
    is_rare = F.translate(lowered, _RARE, "") != lowered
    return F.when(common, lowered).when(is_rare, expanded).otherwise(lowered)


def case_fold(text: Column) -> Column:
    """Full Unicode case folding."""
    return fold_exceptions(lower_text(text))


def clean(text: Column) -> Column:
    """Drop links and mentions, collapse whitespace."""
    whole = F.coalesce(text, F.lit(""))
    linked = F.contains(whole, F.lit("http")) | F.contains(whole, F.lit("www."))
    no_links = F.when(linked, F.regexp_replace(whole, C.URL_PATTERN, " ")).otherwise(whole)
    # no link's replacement brings a mention
    mentioned = F.contains(whole, F.lit("@"))
    no_mentions = F.when(mentioned, F.regexp_replace(no_links, C.MENTION_PATTERN, " ")).otherwise(no_links)
    return F.trim(F.regexp_replace(no_mentions, rf"{C.SPACE}+", " "))


def shorten_runs(text: Column, cleaned: bool = False) -> Column:
    """Runs of three or more equal characters become two.

    ``cleaned`` text comes from ``clean``: its words stand between single blanks, which
    shortening leaves as they are.
    """
    short = F.regexp_replace(F.coalesce(text, F.lit("")), r"(?d)(.)\1{2,}", "$1$1")
    return short if cleaned else F.trim(F.regexp_replace(short, rf"{C.SPACE}+", " "))


def map_words(text: Column, slang: Mapping[str, str] = C.SLANG) -> Column:
    """Words between blanks, replaced where ``slang`` has them.

    Only a text with one of them between its blanks is taken apart.
    """
    if not slang:
        return text
    lookup = literal_map(slang)
    keys = sorted(slang)
    # the hash-set test comes first: the map is only searched on a hit
    mapped = F.transform(
        F.split(text, " "), lambda w: F.when(w.isin(keys), F.element_at(lookup, w)).otherwise(w)
    )
    framed = F.concat(F.lit(" "), text, F.lit(" "))
    found = reduce(or_, [F.contains(framed, F.lit(f" {k} ")) for k in keys])
    return F.when(found, F.array_join(mapped, " ")).otherwise(text)


def normalize(
    text: Column, slang: Mapping[str, str] = C.SLANG, cleaned: bool = False
) -> Column:
    """Shorten runs of three or more equal characters, then map slang words.

    Over many rows, ``classify.preprocess`` gives each step a column of its own.
    """
    return map_words(shorten_runs(text, cleaned), slang)


def tokenize(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(C.TOKEN_PATTERN), 0)


def drop_words(tokens: Column, words: Iterable[str]) -> Column:
    """Remove listed words, keeping order and repeats."""
    listed = sorted(set(words))
    if not listed:
        return tokens
    return F.filter(tokens, lambda t: ~t.isin(listed))


def stopwords_without_negations(words: Iterable[str] | None = None) -> list[str]:
    """Negation words are never stopwords, whatever a list says."""
    chosen = C.DEFAULT_STOPWORDS if words is None else words
    return sorted(set(chosen) - set(C.NEGATIONS))


def literal_map(values: Mapping[str, object]) -> Column:
    pairs = [F.lit(x) for kv in sorted(values.items()) for x in kv]
    return F.create_map(*pairs)


def explode_terms(df: DataFrame, keep: Iterable[str], terms: Column, name: str) -> DataFrame:
    """One row per term.

    A plain ``explode`` makes the optimizer test the array for emptiness first,
    below the projection that computes it, so the text stages would run twice.
    """
    rows = df.select(*keep, F.explode_outer(terms).alias(name))
    return rows.filter(F.col(name).isNotNull())


# --- n-grams -----------------------------------------------------------------
def bigrams(tokens: Column) -> Column:
    """Adjacent pairs joined by a blank."""
    size = F.size(tokens)
    pairs = F.zip_with(
        F.slice(tokens, F.lit(1), size - 1),
        F.slice(tokens, F.lit(2), size - 1),
        lambda a, b: F.concat_ws(" ", a, b),
    )
    return F.when(size >= 2, pairs).otherwise(F.array().cast("array<string>"))


def explode_pairs(df: DataFrame, keep: Iterable[str], tokens: Column, place: str, name: str) -> DataFrame:
    """One row per adjacent pair with its 0-based place: the pairs of ``bigrams``, put
    together behind the explode, where they are compiled and not interpreted."""
    ahead = F.greatest(F.size(tokens) - 1, F.lit(0))
    both = F.arrays_zip(
        F.slice(tokens, F.lit(1), ahead).alias("a"), F.slice(tokens, F.lit(2), ahead).alias("b")
    )
    rows = df.select(*keep, F.posexplode_outer(both).alias(place, "_pair"))
    return rows.filter("_pair IS NOT NULL").select(
        *keep, place, F.concat_ws(" ", "_pair.a", "_pair.b").alias(name)
    )


# --- lexicon -----------------------------------------------------------------
def known_tokens(tokens: Column, lexicon: Mapping[str, float]) -> Column:
    """The tokens that the lexicon has, in order."""
    words = sorted(lexicon)
    return F.filter(tokens, lambda t: t.isin(words))


def known_total(known: Column, lexicon: Mapping[str, float]) -> Column:
    """Sum of the scores of known tokens, in their order."""
    lookup = literal_map({w: float(s) for w, s in lexicon.items()})
    return F.aggregate(known, F.lit(0.0), lambda acc, t: acc + F.element_at(lookup, t))


def lexicon_score(tokens: Column, lexicon: Mapping[str, float]) -> tuple[Column, Column]:
    """Mean score of the known tokens and share of unknown ones, four decimals.

    Rounding names its argument many times; over many rows, ``classify.lexicon_classify``
    gives each costly step a column of its own.
    """
    known = known_tokens(tokens, lexicon)
    return score_from_totals(known_total(known, lexicon), F.size(known), F.size(tokens))


def score_from_totals(total: Column, known: Column, size: Column) -> tuple[Column, Column]:
    score = F.coalesce(round_exact(total / F.nullif(known, F.lit(0)), 4), F.lit(0.0))
    oov = F.when(size > 0, round_exact(1.0 - known / F.nullif(size, F.lit(0)), 4)).otherwise(0.0)
    return score, oov


def lexicon_label(score: Column, band: float = C.NEUTRAL_BAND) -> Column:
    return (
        F.when(score > band, C.POSITIVE).when(score < -band, C.NEGATIVE).otherwise(C.NEUTRAL)
    )


def lexicon_confidence(score: Column, band: float = C.NEUTRAL_BAND) -> Column:
    strong = F.least(F.abs(score) / max(band, 0.01), F.lit(1.0))
    raw = F.when(F.abs(score) > band, strong).otherwise(1.0 - F.abs(score))
    return round_exact(raw, 4)


# --- single-value rules ------------------------------------------------------
def mask_username(name: Column) -> Column:
    """``budisan`` -> ``bu***an``; four characters or fewer keep only the first."""
    size = F.length(name)
    short = F.concat(F.substring(name, 1, 1), F.repeat(F.lit("*"), size - 1))
    long = F.concat(
        F.substring(name, 1, 2), F.repeat(F.lit("*"), size - 4), F.substring(name, -2, 2)
    )
    return F.when(size > 4, long).when(size > 0, short).otherwise("")


def safe_cell(value: Column) -> Column:
    """Neutralise text a spreadsheet would run as a formula."""
    return F.when(value.rlike(C.FORMULA_PATTERN), F.concat(F.lit("'"), value)).otherwise(value)


def video_id(value: Column) -> Column:
    """The numeric id in a bare id or a permalink, else null."""
    return F.nullif(F.regexp_extract(strip(value), C.VIDEO_ID_PATTERN, 1), F.lit(""))


def video_key(value: Column) -> Column:
    """Like ``video_id``; a short link, whose id is hidden, is its own key."""
    text = strip(value)
    return F.coalesce(video_id(value), F.when(text.rlike(C.SHORT_LINK_PATTERN), text))


def classify_tier(account_type: Column) -> Column:
    """First tier, in priority order, whose keyword occurs in the free text."""
    text = F.lower(F.coalesce(account_type, F.lit("")))
    rule = None
    for tier, keyword in C.TIER_KEYWORDS.items():
        hit = text.contains(keyword)
        rule = F.when(hit, tier) if rule is None else rule.when(hit, tier)
    return rule.otherwise("unknown")


def tier_rank(tier: Column) -> Column:
    return F.array_position(F.array(*[F.lit(t) for t in C.TIERS]), tier).cast("int")


def label_rank(label: Column) -> Column:
    return F.array_position(F.array(*[F.lit(t) for t in C.LABELS]), label).cast("int")


def short_date(create_time: Column) -> Column:
    return F.substring(F.coalesce(create_time, F.lit("")), 1, 10)


def short_text(text: Column, size: int = 400) -> Column:
    """Report excerpt; analysis itself always reads the whole text."""
    return F.substring(F.coalesce(text, F.lit("")), 1, size)


def likes(column: str = "digg_count") -> Column:
    return F.coalesce(F.col(column), F.lit(0)).cast("bigint")


def theme_pattern(words: Iterable[str]) -> str:
    """Whole-word alternation; words are literals."""
    specials = set(r"\.^$|?*+()[]{}")
    quoted = ["".join("\\" + ch if ch in specials else ch for ch in w) for w in words]
    return r"\b(?:%s)\b" % "|".join(quoted)


def mentions(text: Column, words: Sequence[str]) -> Column:
    """Whether one of the words stands in the text; the pattern is only tried where their letters do."""
    listed = list(words)
    pattern = theme_pattern(listed)
    if not listed:
        return text.rlike(pattern)
    return reduce(or_, [F.contains(text, F.lit(w)) for w in listed]) & text.rlike(pattern)
