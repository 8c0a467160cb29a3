"""Claim audit: numbers and causal words in narrative text against the metrics.

All checks of one claim happen inside its row, with higher-order functions over
the run's short fact list. No claim-by-fact pairs are produced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from echolens import constants as C
from echolens.functions.text import strip
from echolens.operators.narrative import SECTIONS
from echolens.operators.skew import lookup_join
from echolens.session import durable

RUN = "run_id"

# Fixed reject reasons (printf templates).
UNKNOWN_NUMBER = 'angka "%s" tidak ditemukan di metrics dict manapun'
OTHER_ENTITY = (
    'angka "%s" ada di data tapi milik "%s", bukan "%s" yang disebut di kalimat ini'
)
UNSUPPORTED_CAUSE = (
    'kalimat memakai kata penghubung sebab-akibat ("%s") tapi hubungan itu '
    "tidak ada di data tema/keyword yang dikirim ke LLM"
)
REJECTED = 'klaim narasi ditolak guardrail [%s] "%s": %s'
NOT_AN_OBJECT = "respons LLM bukan objek JSON"
MISSING_SECTION = 'field "%s" hilang atau bukan list berisi minimal 1 item'
ITEM_NOT_OBJECT = "%s[%d] bukan objek (dict)"
ITEM_INCOMPLETE = '%s[%d] harus punya "title" dan "body" bertipe string tidak kosong'

STATUS_ACCEPTED = "llm-accepted"
STATUS_FALLBACK = "llm-retried-then-fallback"
STATUS_NOT_CONFIGURED = "no-llm-configured"
STATUS_DISABLED = "narrative-disabled"
STATUS_BELOW_VOLUME = "below-narrative-volume-floor"


# Characters before a number in which a month makes it a date.
MONTH_REACH = 6


# --- numbers in prose --------------------------------------------------------
# The numbers of C.NUMBER_PATTERN without a second alternative, which would be tried at
# every other character as well.
NUMBER = r"[+-]?[0-9](?:[0-9.,]*[0-9])?"


def number_pieces(body: Column) -> Column:
    """array<struct<before, raw>>: every number and the text since the one before it."""
    return F.zip_with(
        F.split(body, NUMBER, -1),
        F.regexp_extract_all(body, F.lit(NUMBER), 0),
        lambda before, raw: F.struct(before.alias("before"), raw.alias("raw")),
    )


def _numbers_only(pieces: Column) -> Column:
    """Without the text behind the last number."""
    return F.filter(pieces, lambda p: p["raw"].isNotNull())


def number_spans(body: Column) -> Column:
    """array<struct<raw, start>>: every number and its 0-based offset.

    Spark finds matches without positions; the lengths of the pieces between
    them are summed once along the body.
    """
    pieces = _numbers_only(number_pieces(body))
    ends = F.aggregate(
        pieces,
        F.array(F.lit(0)),
        lambda ends, p: F.array_append(
            ends, F.element_at(ends, -1) + F.length(p["before"]) + F.length(p["raw"])
        ),
    )
    return F.zip_with(
        pieces,
        F.slice(ends, F.lit(2), F.size(pieces)),
        lambda p, end: F.struct(
            p["raw"].alias("raw"), (end - F.length(p["raw"])).alias("start")
        ),
    )


def number_candidates(raw: Column) -> Column:
    """The number read as a decimal and as thousands-separated."""
    as_decimal = F.replace(raw, F.lit(","), F.lit(".")).try_cast("double")
    plain = F.replace(F.replace(raw, F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    return F.array_distinct(F.array_compact(F.array(as_decimal, plain.try_cast("double"))))


def is_incidental(raw: Column, before: Column) -> Column:
    """Prose furniture, not a citation: small counts, years, month suffixes.

    ``before`` is the text that precedes the number, its last characters at least.
    """
    marked = raw.rlike(r"^[+-]") | raw.contains(".") | raw.contains(",")
    value = raw.try_cast("bigint")
    month = F.lower(F.right(before, F.lit(MONTH_REACH))).rlike("|".join(C.MONTH_TOKENS))
    small = F.coalesce(F.abs(value) <= 10, F.lit(False))
    year = F.coalesce(value.between(1900, 2099) & (F.length(raw) == 4), F.lit(False))
    return F.when(marked, False).otherwise(small | year | month)


def last_entity(low: Column, base: Column, entities: Column) -> Column:
    """struct<at, size, name> of the entity mentioned last in ``low``, a part of the
    lower-case body that starts at ``base``; the longer name wins a tie."""
    mirrored = F.reverse(low)

    def place(name: Column) -> Column:
        wanted = F.lower(name)
        back = F.instr(mirrored, F.reverse(wanted))
        at = F.when(back > 0, base + F.length(low) - back - F.length(wanted) + 1)
        return F.struct(at.alias("at"), F.length(wanted).alias("size"), name.alias("name"))

    return F.array_max(
        F.filter(F.transform(entities, place), lambda p: p["at"].isNotNull())
    )


def tolerance(value: Column) -> Column:
    return F.greatest(F.lit(0.15), F.abs(value) * 0.001)


WALK = (
    "struct<base:int, low:string, near:string, "
    "owner:struct<at:int, size:int, name:string>, reason:string>"
)


def numeric_reason(body: Column, facts: Column, entities: Column) -> Column:
    """Reason of the first number that no fact, or another entity's fact, backs.

    One walk along the body. It carries the end of the text so far, as long as
    the longest entity name, the entity mentioned last, and the first reason, so
    the work per number does not depend on the length of the body.
    """
    reach = F.coalesce(
        F.array_max(F.transform(entities, lambda e: F.length(F.lower(e)))), F.lit(0)
    )

    def check(raw: Column, near: Column, owner: Column) -> Column:
        values = number_candidates(raw)
        backing = F.filter(
            facts,
            lambda f: F.exists(values, lambda v: F.abs(v - f["value"]) <= tolerance(f["value"])),
        )
        own = F.exists(backing, lambda f: f["entity"] == owner)
        return (
            F.when(is_incidental(raw, near) | (F.size(values) == 0), None)
            .when(F.size(backing) == 0, F.format_string(UNKNOWN_NUMBER, raw))
            .when(
                owner.isNotNull() & ~own,
                F.format_string(OTHER_ENTITY, raw, F.get(backing, F.lit(0))["entity"], owner),
            )
        )

    def step(state: Column, piece: Column) -> Column:
        low = F.concat(state["low"], F.lower(piece["before"]))
        near = F.concat(state["near"], piece["before"])
        mentioned = last_entity(low, state["base"] - F.length(state["low"]), entities)
        owner = F.coalesce(mentioned, state["owner"])
        raw = piece["raw"]
        walked = F.struct(
            (state["base"] + F.length(F.lower(piece["before"])) + F.length(raw)).alias("base"),
            # a name may end inside the number
            F.concat(F.right(low, reach), F.lower(raw)).alias("low"),
            F.right(F.concat(near, raw), F.lit(MONTH_REACH)).alias("near"),
            owner.alias("owner"),
            F.coalesce(state["reason"], check(raw, near, owner["name"])).alias("reason"),
        )
        return F.when(state["reason"].isNotNull(), state).otherwise(walked)

    begin = F.struct(
        F.lit(0).alias("base"), F.lit("").alias("low"), F.lit("").alias("near"),
        F.lit(None).alias("owner"), F.lit(None).alias("reason"),
    ).cast(WALK)
    found = F.aggregate(
        _numbers_only(number_pieces(body)), begin,
        lambda state, piece: step(state, piece).cast(WALK), lambda state: state["reason"],
    )
    return F.when(F.size(facts) > 0, found)


def causal_reason(body: Column, terms: Column) -> Column:
    low = F.lower(body)
    used = F.filter(
        F.array(*[F.lit(c) for c in C.CAUSAL_CONNECTORS]), lambda c: F.contains(low, c)
    )
    backed = F.exists(terms, lambda t: F.contains(low, t))
    return F.when(
        (F.size(used) > 0) & ~backed, F.format_string(UNSUPPORTED_CAUSE, F.get(used, F.lit(0)))
    )


# --- audit -------------------------------------------------------------------
def run_evidence(facts: DataFrame, terms: DataFrame) -> DataFrame:
    """Per run: its facts, entity names and causal terms as short lists.

    The metric tables fix how many facts and terms a run has (tiers times
    themes plus a few dozen), independent of the number of comments.
    """
    fact_lists = facts.groupBy(RUN).agg(
        F.array_sort(F.collect_list(F.struct("ord", "entity", "field", "value"))).alias("facts"),
        F.collect_set(F.when(F.col("entity") != "overall", F.col("entity"))).alias("entities"),
    )
    term_lists = terms.groupBy(RUN).agg(F.collect_set("term").alias("terms"))
    return durable(fact_lists.join(term_lists, RUN, "left").withColumn(
        "terms", F.coalesce("terms", F.array().cast("array<string>"))
    ))


def audit_claims(claims: DataFrame, evidence: DataFrame) -> DataFrame:
    """Claims with a reject reason, null when the claim passes.

    ``claims(run_id, attempt, section, idx, title, body)``. Only bodies are
    checked. A run with very many claims is spread by ``lookup_join``.
    """
    rows = lookup_join(claims, evidence, RUN, spread=["section", "idx", "title"], probe=True)
    none = F.array().cast("array<string>")
    no_facts = F.array().cast(
        "array<struct<ord:int,entity:string,field:string,value:double>>"
    )
    ready = (
        rows.withColumn("_facts", F.coalesce("facts", no_facts))
        .withColumn("_entities", F.coalesce("entities", none))
        .withColumn("_terms", F.coalesce("terms", none))
    )
    reason = F.coalesce(
        numeric_reason(F.col("body"), F.col("_facts"), F.col("_entities")),
        causal_reason(F.col("body"), F.col("_terms")),
    )
    return ready.withColumn("reason", reason).select(*claims.columns, "reason")


def section_rank(section: Column) -> Column:
    return F.array_position(F.array(*[F.lit(s) for s in SECTIONS]), section).cast("int")


def verdicts(audited: DataFrame, by: Sequence[str] = (RUN, "attempt")) -> DataFrame:
    """One verdict per narrative: the first failing claim rejects all of it."""
    place = F.when(
        F.col("reason").isNotNull(), F.struct(section_rank(F.col("section")), F.col("idx"))
    )
    text = F.format_string(
        REJECTED, F.col("section"), F.coalesce("title", F.lit("")), F.col("reason")
    )
    return audited.groupBy(*by).agg(
        F.min_by(text, place).alias("reject_reason"),
        F.count(F.lit(1)).alias("claims"),
        F.count("reason").alias("failed_claims"),
    ).withColumn("accepted", F.col("failed_claims") == 0)


# --- shape check -------------------------------------------------------------
def _item_reason(section: str):
    """Why an item of a section is no finding; null when it is one."""

    def reason(item: Column, position: Column) -> Column:
        is_object = F.schema_of_variant(item).startswith("OBJECT")
        title = F.schema_of_variant(F.try_variant_get(item, "$.title", "variant"))
        body = F.schema_of_variant(F.try_variant_get(item, "$.body", "variant"))
        filled = strip(F.try_variant_get(item, "$.body", "string")) != ""
        whole = (title == "STRING") & (body == "STRING") & filled
        none = F.lit(False)
        return (
            F.when(
                ~F.coalesce(is_object, none),
                F.format_string(ITEM_NOT_OBJECT, F.lit(section), position),
            )
            .when(
                ~F.coalesce(whole, none),
                F.format_string(ITEM_INCOMPLETE, F.lit(section), position),
            )
        )

    return reason


def shape_reason(text: Column) -> Column:
    """Why a candidate's JSON text is not a narrative; null when it is one."""
    doc = F.try_parse_json(text)
    reasons = [F.when(F.json_object_keys(text).isNull(), NOT_AN_OBJECT)]
    for name in SECTIONS:
        items = F.try_variant_get(doc, f"$.{name}", "array<variant>")
        missing = F.coalesce(F.size(items), F.lit(0)) <= 0
        found = F.filter(F.transform(items, _item_reason(name)), lambda r: r.isNotNull())
        reasons.append(F.when(missing, MISSING_SECTION % name).otherwise(F.get(found, F.lit(0))))
    return F.coalesce(*reasons)


def candidate_claims(candidates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(run_id, attempt, body JSON) -> (claims of well-formed ones, rejects)."""
    checked = candidates.withColumn("reject_reason", shape_reason(F.col("narrative")))
    item = "array<struct<title:string,body:string>>"
    parsed = F.from_json(
        "narrative", ", ".join(f"{s} {item}" for s in SECTIONS)
    )
    listed = F.array(*[
        F.struct(F.lit(s).alias("section"), parsed[s].alias("items")) for s in SECTIONS
    ])
    claims = (
        checked.filter("reject_reason IS NULL")
        .select(RUN, "attempt", F.explode(listed).alias("s"))
        .select(RUN, "attempt", "s.section", F.posexplode("s.items").alias("idx", "c"))
        .select(RUN, "attempt", "section", "idx", "c.title", "c.body")
    )
    rejects = checked.filter("reject_reason IS NOT NULL").select(RUN, "attempt", "reject_reason")
    return claims, rejects


# --- selection ---------------------------------------------------------------
def closed_reason() -> Column:
    """Why a run takes no candidate at all; null when it may."""
    return (
        F.when(F.col("disabled"), STATUS_DISABLED)
        .when(~F.col("configured"), STATUS_NOT_CONFIGURED)
        .when(F.col("classified_total") <= C.MIN_NARRATIVE_VOLUME, STATUS_BELOW_VOLUME)
    )


def select_narratives(
    runs: DataFrame, claims: DataFrame, judged: DataFrame, fallback: DataFrame,
) -> tuple[DataFrame, DataFrame]:
    """Accepted candidate, else the next one, else the deterministic narrative.

    ``runs(run_id, classified_total, configured, disabled)``; ``judged`` is
    verdicts plus shape rejects. Returns (status per run, narrative rows).
    """
    best = judged.groupBy(RUN).agg(
        F.min(F.when(F.col("accepted"), F.col("attempt"))).alias("attempt"),
        F.max_by("reject_reason", F.when(~F.col("accepted"), F.col("attempt"))).alias(
            "last_reason"
        ),
    )
    rows = runs.join(best, RUN, "left")
    status = (
        F.when(closed_reason().isNotNull(), closed_reason())
        .when(F.col("attempt").isNotNull(), STATUS_ACCEPTED)
        .otherwise(STATUS_FALLBACK)
    )
    chosen = rows.withColumn("status", status)
    accepted = F.col("status") == STATUS_ACCEPTED
    states = chosen.select(
        RUN, "status", F.when(accepted, "llm").otherwise("fallback").alias("source"),
        F.when(accepted, F.col("attempt")).alias("attempt"),
        F.when(F.col("status") == STATUS_FALLBACK, F.col("last_reason")).alias("reject_reason"),
    )
    told = claims.join(
        states.filter("attempt IS NOT NULL").select(RUN, "attempt"), [RUN, "attempt"], "left_semi"
    ).drop("attempt")
    told_runs = states.filter("source = 'fallback'").select(RUN)
    own = fallback.join(told_runs, RUN, "left_semi")
    columns = [RUN, "section", "idx", "title", "body"]
    return states, told.select(*columns).unionByName(own.select(*columns))
