"""Personal data by fixed forms and by bootstrapped contextual extraction.

Built-in functions only. The fixed forms (mail addresses, IP addresses, card
numbers, phone numbers) are the seeds. Every other word with a digit or an at sign
is a candidate, except those that a fixed form matched and its check refused
(a number that fails the Luhn test, say): these are known not to be identifiers.

Patterns are lexical: the two words before an occurrence, the word before and the
word after it, or the two words after it. A word is a whole run of letters, however far
away; it is empty where the text ends, another number stands or another match of its kind. The instance's own form is no part of
a pattern but a loose check: patterns for words with an at sign and for words without
one are told apart. The graph of patterns and instances is scored in rounds. A
pattern's confidence is the share of its distinct instances that are identifiers so
far, refused ones counting against it and unknown ones half as much; it is trusted
from MIN_CONFIDENCE on and with MIN_SUPPORT identifiers. An occurrence has the
confidence of its best trusted pattern, or none. A candidate becomes an identifier
when the mean over its occurrences reaches MIN_CONFIDENCE. It is then a seed of the
next round, until a round accepts nothing new. Occurrences of accepted candidates are spans of the kind ``context``;
a candidate that overlaps a fixed form is part of it and never one.

Every pattern enters a run of letters or digits once, and overlaps are counted in sorted
lists, so the work on a very long text grows with its length.

Results in edge cases: a null or empty text has no spans; every row of the input
gives one row, repeated ones too; an empty table gives an empty result; columns
other than ``doc_id`` and ``text`` are never read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from echolens.llm.common import durable, hot_join, texts
from echolens.llm.spans import CLOSE, OPEN, count_of, let, listed, marked, meets, ordered, spans

# loops over groups are possessive: nothing follows them, and the others recurse once per turn in Java
# a run of letters or digits is entered once, at its start or where a match ended: a later start would fail alike
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?+[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone", "context")
# a word with a digit or an at sign, without the punctuation around it: from its first letter, digit, plus or number
# sign to its last letter or digit, if a digit or an at sign stands between them
BREAKS = r"\s\"'<>,;|()\[\]{}"
FRONT = rf"(?<![^{BREAKS}])[^{BREAKS}A-Za-z0-9+#]*+"
CANDIDATE = (
    rf"(?=[A-Za-z0-9+#][^{BREAKS}0-9@]*+[0-9@][^{BREAKS}A-Za-z0-9]*+[A-Za-z0-9])"
    rf"[A-Za-z0-9+#](?:[^{BREAKS}A-Za-z0-9]*+[A-Za-z0-9]++)++"
)
MIN_CONFIDENCE, MIN_SUPPORT = 0.8, 5
# rounds end when nothing new is accepted; so many are an error
ROUNDS = 500
UNKNOWN, ROUNDING = 0.5, 1e-9
# the nearest two words, from the match outwards
WORDS = r"^[^\p{L}0-9@]*+(\p{L}++)(?:[^\p{L}0-9@]++(\p{L}++))?"


def _digits(body: Column) -> Column:
    return F.regexp_replace(body, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether every second digit from the right, doubled, brings the sum to a multiple of 10."""
    # a doubled digit counts the sum of its own digits
    doubled = F.translate(digits, "0123456789", "0246813579")
    place = lambda text, i: F.substring(text, i, F.lit(1)).cast("int")
    total = F.aggregate(
        F.sequence(F.lit(1), F.length(digits)), F.lit(0),
        lambda s, i: s + F.when((F.length(digits) - i) % 2 == 1, place(doubled, i)).otherwise(place(digits, i)),
    )
    return total % 10 == 0


def _ip_ok(body: Column) -> Column:
    part = lambda p: F.regexp_replace(p, "^0+(?=.)", "")
    return F.forall(F.split(body, r"\."), lambda p: (F.length(part(p)) <= 3) & (part(p).try_cast("int") <= 255))


def _card_ok(body: Column) -> Column:
    return let(_digits(body), lambda d: F.when(F.length(d).between(14, 19), _luhn(d)).otherwise(F.lit(False)))


def _phone_ok(body: Column) -> Column:
    return F.length(_digits(body)).between(10, 15)


def _in_context(kind: str, marks: Column) -> Column:
    """Spans of marked text with the two words before and after each."""

    def of(pieces: Column) -> Column:
        # the words before a match end the piece before its own, those after it end its own
        before = lambda i: F.reverse(F.substring_index(F.get(pieces, i), CLOSE, -1))
        after = lambda i: F.substring_index(F.get(pieces, i + 1), CLOSE, -1)
        word = lambda side, n: F.lower(F.regexp_extract(side, WORDS, n))
        return F.transform(spans(kind, marks), lambda s, i: F.struct(
            s["kind"].alias("kind"), s["first"].alias("first"), s["last"].alias("last"), s["body"].alias("body"),
            F.reverse(word(before(i), 2)).alias("b2"), F.reverse(word(before(i), 1)).alias("b1"),
            word(after(i), 1).alias("a1"), word(after(i), 2).alias("a2"),
        ))

    kind_of = "array<struct<kind:string,first:bigint,last:bigint,body:string,b2:string,b1:string,a1:string,a2:string>>"
    return F.when(F.contains(marks, F.lit(OPEN)), let(F.split(marks, OPEN), of)).otherwise(F.array().cast(kind_of))


def _with_status(found: Column, status: Callable[[Column], Column]) -> Column:
    """Spans with the status of their place in the list."""
    names = ("first", "last", "body", "b2", "b1", "a1", "a2")
    return F.transform(found, lambda s, i: F.struct(*[s[n].alias(n) for n in names], status(i).alias("status")))


def patterns_of(s: Column) -> Column:
    """The patterns of an occurrence: at most three, each with at least one word next to it."""
    loose = F.when(F.contains(s["body"], F.lit("@")), "@").otherwise("9")
    b2, b1, a1, a2 = (s[n] for n in ("b2", "b1", "a1", "a2"))
    return F.array_compact(F.array(
        F.when(b1 != "", F.concat_ws(" ", loose, b2, b1, F.lit("_"))),
        F.when((b1 != "") | (a1 != ""), F.concat_ws(" ", loose, b1, F.lit("_"), a1)),
        F.when(a1 != "", F.concat_ws(" ", loose, F.lit("_"), a1, a2)),
    ))


def found_spans(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, ``base`` spans, and ``near``: base spans and candidates in their contexts.

    status: 1 a base span, -1 a candidate overlapping a refused match, 0 any other candidate.
    """
    text = F.col("text")
    marks = texts(docs).select(
        "doc_id",
        _in_context("email", marked(text, EMAIL)).alias("email"),
        _in_context("ip", marked(text, IP)).alias("ips"),
        _in_context("card", marked(text, CARD)).alias("cards"),
        _in_context("phone", marked(text, PHONE)).alias("phones"),
        _in_context("context", marked(text, CANDIDATE, FRONT)).alias("others"),
    )
    good = [
        F.filter("ips", lambda s: _ip_ok(s["body"])),
        F.filter("cards", lambda s: _card_ok(s["body"])),
        F.filter("phones", lambda s: _phone_ok(s["body"])),
    ]
    # a number too short or long for its form is no refusal, only one that fails the check
    long_enough = F.filter("cards", lambda s: F.length(_digits(s["body"])).between(14, 19) & ~_card_ok(s["body"]))
    refused = F.concat(F.filter("ips", lambda s: ~_ip_ok(s["body"])), long_enough)
    parts = marks.select("doc_id", "others", F.concat("email", *good).alias("seeds"), refused.alias("refused"))
    others = let(meets(F.col("others"), F.col("seeds")), lambda m: F.filter("others", lambda s, i: ~F.get(m, i)))
    parts = parts.withColumn("others", others)
    against = meets(F.col("others"), F.col("refused"))
    return parts.select(
        "doc_id",
        F.transform("seeds", lambda s: F.struct(*[s[n].alias(n) for n in ("kind", "first", "last", "body")])).alias("base"),
        F.concat(
            _with_status(F.col("seeds"), lambda s: F.lit(1)),
            let(against, lambda m: _with_status(F.col("others"), lambda i: F.when(F.get(m, i), -1).otherwise(0))),
        ).alias("near"),
    )


def bootstrap(occurrences: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(instance, score) of the candidates accepted, from all occurrences.

    ``occurrences`` has instance, patterns and status. A pattern is scored from one
    row per pair of pattern and instance, so a passage that a third of all documents
    share counts once. Runs to the fixpoint; ``rounds`` only guards against no end.
    """
    graph = durable(
        occurrences.groupBy("instance", "patterns").agg(
            F.count(F.lit(1)).alias("n"), F.max("status").alias("best"), F.min("status").alias("worst")
        )
    )
    known = durable(graph.groupBy("instance").agg(
        F.when(F.max("best") == 1, 1).when(F.min("worst") == -1, -1).otherwise(0).alias("status"),
        F.sum("n").alias("total"),
    ))
    pairs = durable(graph.select("instance", F.explode("patterns").alias("pattern")).distinct())
    open_ones = durable(
        graph.select("instance", "patterns", "n").join(known.filter("status = 0").select("instance", "total"), "instance")
        .withColumn("pattern", F.explode("patterns"))
    )
    accepted = None
    for _ in range(rounds):
        state = known.select("instance", "status") if accepted is None else known.join(
            accepted.select("instance", F.lit(1).alias("new")), "instance", "left"
        ).select("instance", F.coalesce("new", "status").alias("status"))
        count = lambda status: F.sum((F.col("status") == status).cast("long"))
        trusted = durable(
            pairs.join(state, "instance").groupBy("pattern").agg(
                count(1).alias("hits"), count(-1).alias("refused"), count(0).alias("unknown"), F.count(F.lit(1)).alias("all")
            ).withColumn("confidence", F.col("hits") / (F.col("hits") + F.col("refused") + F.col("unknown") * UNKNOWN))
            .filter((F.col("hits") >= MIN_SUPPORT) & (F.col("confidence") >= MIN_CONFIDENCE))
            .select("pattern", "all", "confidence")
        )
        best = hot_join(open_ones, trusted, "pattern", "all", ["confidence"]).groupBy(
            "instance", "patterns", "n", "total"
        ).agg(F.max("confidence").alias("confidence"))
        score = F.sum(F.col("confidence") * F.col("n")) / F.first("total")
        fresh = best.groupBy("instance").agg(score.alias("score")).filter(F.col("score") >= MIN_CONFIDENCE - ROUNDING)
        before = 0 if accepted is None else accepted.count()
        # confidences only grow, so what was accepted is again
        accepted = durable(fresh)
        if accepted.count() == before:
            return accepted
    raise RuntimeError(f"the bootstrap still accepts new instances after {rounds} rounds")


def personal_spans(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """Every row's doc_id, ``base`` and ``spans`` (kind, first, last, body)."""
    rows = durable(found_spans(docs).withColumn("row", F.monotonically_increasing_id()))
    occurrences = durable(
        rows.select("row", F.explode("near").alias("s")).select(
            "row", "s.first", "s.last", "s.body", F.lower("s.body").alias("instance"),
            patterns_of(F.col("s")).alias("patterns"), "s.status",
        )
    )
    accepted = bootstrap(occurrences.select("instance", "patterns", "status"), rounds)
    more = (
        occurrences.filter("status = 0").join(accepted.select("instance"), "instance", "left_semi")
        .groupBy("row").agg(F.collect_list(F.struct(F.lit("context").alias("kind"), "first", "last", "body")).alias("more"))
    )
    kind = "array<struct<kind:string,first:bigint,last:bigint,body:string>>"
    return rows.select("row", "doc_id", "base").join(more, "row", "left").select(
        "doc_id", ordered(F.col("base"), KINDS).alias("base"),
        ordered(F.concat("base", F.coalesce("more", F.array().cast(kind))), KINDS).alias("spans"),
    )


def personal_data(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, counts and digest of the fixed forms, and all spans, of every row."""
    return personal_spans(docs, rounds).select(
        "doc_id",
        *[count_of(F.col("base"), k).alias(f"n_{k}") for k in KINDS[:4]],
        F.sha2(listed(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
        count_of(F.col("spans"), "context").alias("n_context"),
    )
