"""Spans of pattern matches as columns, with built-in functions only."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Private-use characters that mark a match; where a text holds them they are read
# as OTHER, which no pattern names either.
OPEN, CLOSE, OTHER = "", "", ""
CHUNK = 128
SPAN = "struct<kind:string,first:bigint,last:bigint,body:string>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, also where lambdas read it often."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _slice(array: Column, n: Column) -> Column:
    return F.slice(array, n * CHUNK + 1, F.lit(CHUNK))


def running_starts(lengths: Column) -> Column:
    """Sum of all earlier lengths, for each place of an array of bigint.

    Sums run inside chunks of CHUNK places that begin at the chunks' own sums, so
    the arrays built on the way stay short in texts with very many matches.
    """
    zero = F.lit(0).cast("bigint")
    total = lambda a: F.aggregate(a, zero, lambda s, x: s + x)

    def all_chunks(array: Column) -> Column:
        numbers = F.sequence(F.lit(0), ((F.size(array) - 1) / CHUNK).cast("int"))

        def with_sums(sums: Column) -> Column:
            begin = F.aggregate(
                sums, F.array(zero), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x))
            )
            return let(begin, lambda at: F.flatten(F.transform(numbers, lambda c: F.slice(
                F.aggregate(
                    _slice(array, c), F.array(F.get(at, c)),
                    lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)),
                ),
                F.lit(1), F.size(_slice(array, c)),
            ))))

        return let(F.transform(numbers, lambda c: total(_slice(array, c))), with_sums)

    return F.when(F.size(lengths) == 0, F.array().cast("array<bigint>")).otherwise(let(lengths, all_chunks))


def marked(text: Column, pattern: str, front: str | None = None) -> Column:
    """The text with every leftmost non-overlapping match between OPEN and CLOSE.

    ``front`` is matched before each match and is no part of it.
    """
    plain = F.translate(text, OPEN + CLOSE, OTHER * 2)
    if front is None:
        return F.regexp_replace(plain, f"(?:{pattern})", f"{OPEN}$0{CLOSE}")
    return F.regexp_replace(plain, f"({front})({pattern})", f"$1{OPEN}$2{CLOSE}")


def spans(kind: str, marks: Column) -> Column:
    """Matches of marked text: kind, first and last (exclusive) in code points, and body."""

    def of(pieces: Column) -> Column:
        lengths = F.transform(
            pieces, lambda p: (F.length(p) - F.when(F.contains(p, F.lit(CLOSE)), 1).otherwise(0)).cast("bigint")
        )
        return let(running_starts(lengths), lambda starts: F.slice(
            F.transform(pieces, lambda p, i: let(
                F.substring_index(p, CLOSE, 1),
                lambda body: F.struct(
                    F.lit(kind).alias("kind"), F.get(starts, i).alias("first"),
                    (F.get(starts, i) + F.length(body)).alias("last"), body.alias("body"),
                ),
            )),
            F.lit(2), F.size(pieces),
        ))

    return F.when(
        F.contains(marks, F.lit(OPEN)), let(F.split(marks, OPEN), of)
    ).otherwise(F.array().cast(f"array<{SPAN}>"))


def _before(points: Column, places: Column) -> Column:
    """For each of ``places`` (ascending), how many of ``points`` sort before it; both are structs of place and rank."""
    event = lambda e, n: F.struct(e["place"].alias("place"), e["rank"].alias("rank"), F.lit(n).cast("bigint").alias("n"))
    events = F.array_sort(F.concat(F.transform(points, lambda e: event(e, 1)), F.transform(places, lambda e: event(e, 0))))

    def counted(all_events: Column) -> Column:
        return let(running_starts(F.transform(all_events, lambda e: e["n"])), lambda sums: F.array_compact(
            F.transform(all_events, lambda e, i: F.when(e["n"] == 0, F.get(sums, i)))
        ))

    return let(events, counted)


def meets(found: Column, others: Column) -> Column:
    """For each span of ``found`` (by place, none overlapping the next), whether it overlaps one of ``others``.

    It does if more of the others begin before its end than end up to its start. All
    are counted in two sorted lists, so the work grows with their sum, not product.
    """
    at = lambda place, rank: F.struct(place.alias("place"), F.lit(rank).alias("rank"))
    begun = _before(F.transform(others, lambda o: at(o["first"], 1)), F.transform(found, lambda s: at(s["last"], 0)))
    ended = _before(F.transform(others, lambda o: at(o["last"], 0)), F.transform(found, lambda s: at(s["first"], 1)))
    none = F.transform(found, lambda s: F.lit(False))
    return F.when(F.size(others) == 0, none).otherwise(F.zip_with(begun, ended, lambda b, e: b > e))


def ordered(all_spans: Column, kinds: Sequence[str]) -> Column:
    """Spans by start, then in the order of ``kinds``, then by end."""
    rank = lambda k: F.array_position(F.array(*[F.lit(x) for x in kinds]), k)
    keyed = F.transform(all_spans, lambda s: F.struct(s["first"], rank(s["kind"]).alias("rank"), s["last"], s["kind"], s["body"]))
    return F.array_sort(keyed)


def listed(all_spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(
        F.transform(all_spans, lambda s: F.concat_ws(":", s["kind"], s["first"].cast("string"), s["last"].cast("string"))),
        ",",
    )


def count_of(all_spans: Column, kind: str) -> Column:
    return F.size(F.filter(all_spans, lambda s: s["kind"] == kind)).cast("bigint")
