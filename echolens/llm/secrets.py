"""Secrets in texts: fixed forms, and strings that pass a battery of randomness tests.

Built-in functions only. The fixed forms are assignments, access keys and long hex
strings. Beyond them, runs of MIN_RUN or more characters of the base64 alphabets
are candidates. Each gets an inferred encoding (hex, base32, base36, base62 or
base64, by its classes of characters) and three tests of the hypothesis that its
characters are drawn at random from that alphabet:

- chi-squared uniformity over the alphabet, one-sided;
- Wald-Wolfowitz runs of the lower and upper half of the alphabet;
- serial correlation of neighbouring codes.

Fisher's sum of the three log p-values gives one p-value per candidate; below
MIN_RANDOM the string is not random and no secret.

What passes is held against the null hypothesis that it is written language: words,
names in camel case or capitals, paths, numbers and dates. That model is fixed: a
chain over the classes of characters (small, capital, digit, sign) and the letters'
frequencies in English, with small and capital letters in either role. The
likelihood ratio of the random alphabet and that model has a mean of at most 1 under
the null, so its inverse, times the number of alphabets, is a p-value; it shrinks
with every character that language would not choose, so it is aware of the length.
Within each stratum of encoding and length the Benjamini-Hochberg procedure at FDR
rejects language; the strata's thresholds come from counts over all documents. The
rate bounds the false secrets among those reported. No length beyond MIN_RUN decides.
Rejected candidates are spans of the kind ``random``. Strings of one case without
digits have no encoding and are never taken.

Results in edge cases: a null or empty text has no spans; every row of the input
gives one row, repeated ones too; an empty table gives an empty result; columns
other than ``doc_id`` and ``text`` are never read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from echolens.llm.common import durable, free_name, texts
from echolens.llm.spans import count_of, let, listed, marked, ordered, spans

ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
MIN_RUN = 16
RUN = rf"[A-Za-z0-9+/_-]{{{MIN_RUN},}}={{0,2}}"
KINDS = ("assign", "access", "hex", "random")
FDR, MIN_RANDOM = 0.01, 0.001
# fixed values: symbols of each encoding in the order of their codes
ALPHABETS = {
    "hex": "0123456789abcdef",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base36": "0123456789abcdefghijklmnopqrstuvwxyz",
    "base62": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
}
# hex and base36 in small and in capital letters count as two
CHOICES = len(ALPHABETS) + 2
# fixed values: percent of each letter from a to z in English
LETTERS = (
    8.17, 1.49, 2.78, 4.25, 12.70, 2.23, 2.02, 6.09, 6.97, 0.15, 0.77, 4.03, 2.41,
    6.75, 7.51, 1.93, 0.10, 5.99, 6.33, 9.06, 2.76, 0.98, 2.36, 0.15, 1.97, 0.07,
)
# a part of the letters is drawn evenly, for names and other languages
EVEN = 0.1
# chances of a small letter, capital, digit or sign after each of these and at the start
AFTER = (
    (0.86, 0.07, 0.03, 0.04), (0.50, 0.42, 0.03, 0.05), (0.10, 0.10, 0.62, 0.18), (0.60, 0.20, 0.18, 0.02),
    (0.50, 0.30, 0.15, 0.05),
)
CAPITALS = (1, 0, 2, 3, 4)
SYMBOLS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/-_"


def _encoding(body: Column) -> Column:
    """The narrowest alphabet that holds the string, or null for numbers and words of one case."""
    has = lambda p: body.rlike(p)
    digit, lower, upper = has("[0-9]"), has("[a-z]"), has("[A-Z]")
    return (
        F.when(has("^[0-9a-f]+$") & digit & lower, "hex")
        .when(has("^[0-9A-F]+$") & digit & upper, "hex")
        .when(has("^[A-Z2-7]+$") & digit, "base32")
        .when(has("^[0-9a-z]+$") & digit & lower, "base36")
        .when(has("^[0-9A-Z]+$") & digit & upper, "base36")
        .when(has("^[0-9A-Za-z]+$") & lower & upper, "base62")
        .when(has("^[0-9A-Za-z+/_-]+$") & lower & upper, "base64")
    )


def _codes(body: Column, encoding: Column) -> Column:
    """Codes of the characters, from 0, in the inferred alphabet."""
    plain = F.when(encoding == "base32", body).when(
        encoding.isin("hex", "base36"), F.lower(body)
    ).otherwise(F.translate(body, "-_", "+/"))
    letters = F.split(plain, "")
    alphabet = F.coalesce(*[F.when(encoding == e, F.lit(a)) for e, a in ALPHABETS.items()])
    return let(alphabet, lambda a: F.transform(letters, lambda c: F.call_function("instr", a, c).cast("double") - 1))


def _normal_tail(z: Column) -> Column:
    """P(Z > z), by the logistic form of Bowling et al., absolute error below 2e-4."""
    return 1 / (1 + F.exp(z * z * z * 0.07056 + z * 1.5976))


def _battery(codes: Column, size: Column) -> Column:
    """Combined p-value of the three tests, from an array of codes below ``size``."""
    zero = F.lit(0.0)

    def tests(c: Column) -> Column:
        n = F.size(c).cast("double")
        # squares of the counts, from the runs of equal codes in sorted order
        counted = F.aggregate(
            F.array_sort(c),
            F.struct(F.lit(-1.0).alias("code"), zero.alias("run"), zero.alias("squares")),
            lambda s, x: F.struct(
                x.alias("code"),
                F.when(x == s["code"], s["run"] + 1).otherwise(F.lit(1.0)).alias("run"),
                # (r + 1)² - r² = 2r + 1
                (s["squares"] + F.when(x == s["code"], s["run"] * 2 + 1).otherwise(F.lit(1.0))).alias("squares"),
            ),
            lambda s: s["squares"],
        )
        chi = counted * size / n - n
        z_chi = (chi - (size - 1)) / F.sqrt((size - 1) * 2)
        one = F.struct(
            F.lit(-1.0).alias("before"), zero.alias("upper"), zero.alias("runs"),
            zero.alias("sum"), zero.alias("square"), zero.alias("product"), F.lit(-1.0).alias("first"),
        )

        def step(s: Column, x: Column) -> Column:
            begin = s["before"] < 0
            turn = begin | ((s["before"] >= size / 2) != (x >= size / 2))
            return F.struct(
                x.alias("before"), (s["upper"] + (x >= size / 2).cast("double")).alias("upper"),
                (s["runs"] + turn.cast("double")).alias("runs"), (s["sum"] + x).alias("sum"),
                (s["square"] + x * x).alias("square"),
                (s["product"] + F.when(begin, 0.0).otherwise(s["before"] * x)).alias("product"),
                F.when(begin, x).otherwise(s["first"]).alias("first"),
            )

        def combine(s: Column) -> Column:
            up, down = s["upper"], n - s["upper"]
            mean = up * down * 2 / n + 1
            variance = up * down * 2 * (up * down * 2 - n) / (n * n * (n - 1))
            z_runs = F.when(variance > 0, (s["runs"] - mean) / F.sqrt(variance)).otherwise(F.lit(9.0))
            # circular serial correlation
            spread = s["square"] - s["sum"] * s["sum"] / n
            r = (s["product"] + s["before"] * s["first"] - s["sum"] * s["sum"] / n) / spread
            z_serial = F.when(spread > 0, (r + 1 / (n - 1)) * F.sqrt(n)).otherwise(F.lit(9.0))
            p = lambda z, sides: F.greatest(_normal_tail(z) * sides, F.lit(1e-12))
            x = -F.log(p(z_chi, 1)) - F.log(p(F.abs(z_runs), 2)) - F.log(p(F.abs(z_serial), 2))
            # upper tail of chi-squared with 6 degrees of freedom at 2x
            return F.exp(-x) * (1 + x + x * x / 2)

        return F.aggregate(c, one, step, combine)

    return F.when(F.size(codes) >= 2, let(codes, tests))


def _numbers(values) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def _language(body: Column) -> Column:
    """Log-likelihood of a string under the model of written language, of the better of its two roles."""
    total = sum(LETTERS)
    letters = [math.log((1 - EVEN) * f / total + EVEN / 26) for f in LETTERS]
    symbols = _numbers(letters * 2 + [math.log(0.1)] * 10 + [math.log(0.25)] * 4)
    small = _numbers(math.log(x) for row in AFTER for x in row)
    capital = _numbers(math.log(AFTER[CAPITALS[i]][CAPITALS[j]]) for i in range(5) for j in range(4))
    at = F.transform(F.split(body, ""), lambda c: F.call_function("instr", F.lit(SYMBOLS), c) - 1)
    zero = F.lit(0.0)

    def step(s: Column, x: Column) -> Column:
        own = F.when(x < 26, 0).when(x < 52, 1).when(x < 62, 2).otherwise(3)
        return let(F.struct(own.alias("own"), F.get(symbols, x).alias("p")), lambda v: F.struct(
            v["own"].alias("before"),
            (s["small"] + v["p"] + F.get(small, s["before"] * 4 + v["own"])).alias("small"),
            (s["capital"] + v["p"] + F.get(capital, s["before"] * 4 + v["own"])).alias("capital"),
        ))

    begin = F.struct(F.lit(4).alias("before"), zero.alias("small"), zero.alias("capital"))
    return F.aggregate(at, begin, step, lambda s: F.greatest(s["small"], s["capital"]))


def candidates(found: DataFrame) -> DataFrame:
    """Rows of runs with ``body``: encoding, length, the battery's p-value and that of written language."""
    body = F.regexp_replace("body", "=+$", "")
    per_encoding = lambda of: F.coalesce(*[F.when(F.col("encoding") == e, F.lit(float(of(a)))) for e, a in ALPHABETS.items()])
    # both forms of base64 count, so its strings are drawn from two more signs
    drawn = per_encoding(lambda a: math.log(len(a) + (2 if "+" in a else 0)))
    log_ratio = _language(F.col("plain")) + drawn * F.col("length") + math.log(CHOICES)
    return (
        found.withColumn("plain", body).withColumn("encoding", _encoding(F.col("plain")))
        .filter("encoding is not null")
        .withColumn("length", F.length("plain"))
        .withColumn("p_random", _battery(_codes(F.col("plain"), F.col("encoding")), per_encoding(len)))
        .withColumn("p", F.exp(F.least(log_ratio, F.lit(0.0))))
    )


def _stratum() -> list[Column]:
    """Encoding, and length on a scale of half powers of two."""
    return [F.col("encoding"), F.floor(F.log2("length") * 2).alias("size_class")]


def thresholds(tested: DataFrame, fdr: float = FDR) -> DataFrame:
    """Per stratum, the largest p-value of written language that Benjamini-Hochberg rejects.

    Equal p-values are counted first, on a scale of 400 steps of the logarithm, so a
    stratum is a short list however many candidates it has. A step is rejected as
    a whole, by its upper end.
    """
    step = F.ceil(F.log10(F.greatest("p", F.lit(1e-20))) * 20)
    counts = tested.groupBy(*_stratum(), step.alias("step")).agg(F.count(F.lit(1)).alias("n"))
    of = Window.partitionBy("encoding", "size_class")
    upto = of.orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    ranked = counts.select(
        "encoding", "size_class", "step", F.sum("n").over(upto).alias("rank"), F.sum("n").over(of).alias("m")
    )
    passed = F.pow(F.lit(10.0), F.col("step") / 20) <= F.col("rank") / F.col("m") * fdr
    return ranked.filter(passed).groupBy("encoding", "size_class").agg(F.max("step").alias("cut"))


def base_spans(text: Column) -> list[Column]:
    """Spans of the three fixed forms."""
    assign = F.filter(
        spans("assign", marked(text, ASSIGN)),
        lambda s: F.length(F.regexp_extract(s["body"], ASSIGN, 1)) >= 6,
    )
    return [assign, spans("access", marked(text, ACCESS)), spans("hex", marked(text, HEX))]


def row_key(docs: DataFrame) -> Column:
    """Digest of a row's doc_id and text: rows with equal digests have equal spans."""
    number = F.coalesce(docs["doc_id"].cast("string"), F.lit("-"))
    return F.sha2(F.concat(number, F.lit(":"), F.coalesce(docs["text"], F.lit(""))).cast("binary"), 256)


def secret_spans(docs: DataFrame, fdr: float = FDR) -> DataFrame:
    """Every row's doc_id, ``key``, ``base`` and ``spans`` (arrays of kind, first, last, body).

    The fixed forms and the candidates are found in one pass over the texts; only
    what was found is written.
    """
    read = texts(docs)
    text = F.col("text")
    assign, access, hexes = base_spans(text)
    rows = durable(
        read.select(
            "doc_id", row_key(read).alias("key"),
            ordered(F.concat(assign, access, hexes), KINDS).alias("base"),
            spans("random", marked(text, RUN)).alias("runs"),
        ).withColumn("row", F.monotonically_increasing_id())
    )
    tested = durable(
        candidates(rows.select("row", F.explode("runs").alias("s")).select("row", "s.*"))
    )
    cut = thresholds(tested, fdr)
    step = F.ceil(F.log10(F.greatest("p", F.lit(1e-20))) * 20)
    kept = (
        tested.filter(F.col("p_random") >= MIN_RANDOM).withColumn("size_class", _stratum()[1])
        .join(F.broadcast(cut), ["encoding", "size_class"])  # one row per stratum
        .filter(step <= F.col("cut"))
        .groupBy("row").agg(F.collect_list(F.struct("kind", "first", "last", "body")).alias("more"))
    )
    more = F.coalesce("more", F.array().cast("array<struct<kind:string,first:bigint,last:bigint,body:string>>"))
    plain = F.transform("base", lambda s: F.struct(s["kind"], s["first"], s["last"], s["body"]))
    return rows.join(kept, "row", "left").select(
        "doc_id", "key", "base", ordered(F.concat(plain, more), KINDS).alias("spans")
    )


def secret_scan(docs: DataFrame, fdr: float = FDR) -> DataFrame:
    """doc_id, counts and digest of the fixed forms, and all spans, of every row."""
    return secret_spans(docs, fdr).select(
        "doc_id",
        *[count_of(F.col("base"), k).alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(listed(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
        count_of(F.col("spans"), "random").alias("n_random"),
    )


def redact(docs: DataFrame, fdr: float = FDR, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every string that is a span replaced by ``mark``; no row is dropped.

    The longest strings go first, wherever they occur in the text. A column n_chars
    is set to the length of a text that changed.
    """
    found = secret_spans(docs, fdr).filter(F.size("spans") > 0).groupBy("key").agg(
        F.max(F.array_distinct(F.transform("spans", lambda s: s["body"]))).alias("bodies")
    )
    key, bodies = free_name(docs, "row_key"), free_name(docs, "bodies")
    keyed = docs.withColumn(key, row_key(docs))
    joined = keyed.join(found.select(F.col("key").alias(key), F.col("bodies").alias(bodies)), key, "left")
    longest_first = F.array_sort(
        F.col(bodies), lambda a, b: F.length(b) - F.length(a)
    )
    clean = F.aggregate(longest_first, docs["text"], lambda t, b: F.replace(t, b, F.lit(mark)))
    out = joined.withColumn("text", F.when(F.col(bodies).isNull(), docs["text"]).otherwise(clean))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        size = F.when(F.col(bodies).isNull(), F.col("n_chars")).otherwise(F.length("text").cast(kind))
        out = out.withColumn("n_chars", size)
    return out.select(*docs.columns)
