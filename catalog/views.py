"""The driver tables, read as the inputs of the engine.

Each view is a projection of whole tables; ``catalog.sql`` holds the same views
in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from echolens import constants as C
from echolens.operators import classify, tiers
from echolens.operators.narrative import SECTIONS
from echolens.session import durable, spread

# Frequent words of the test prose, standing in for the real lists.
STOPWORDS = ("the", "and", "of", "in", "la", "le", "de", "der", "die", "el", "tidak")
LEXICON = {
    "with": 0.6, "that": 0.3, "is": -0.2, "not": -0.8, "on": 0.1, "from": -0.5,
    "un": 0.4, "une": -0.4, "que": 0.2, "und": -0.3, "das": 0.5, "con": -0.6, "los": 0.7,
}
SLANG = {"thth": "the", "oring": "ring", "entre": "inter", "ein": "eins", "pa": "para"}
THEMES = {
    "joining": ("and", "with", "und", "con"),
    "place": ("in", "on", "at", "sur", "dans"),
    "negation": ("not", "pas", "nicht", "no"),
    "origin": ("from", "of", "von", "del"),
    "unused": ("zzyzx", "a.b"),
}
THEME_TITLES = {name: name.title() for name in THEMES}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text_id(prefix: str, value: Column) -> Column:
    return F.concat(F.lit(prefix), value.cast("string"))


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents + labels as analyzed comments."""
    docs = spread(table(spark, sf_dir, "documents"), "doc_id")
    labels = table(spark, sf_dir, "labels")
    n = F.col("doc_id")
    label = (
        F.when(F.col("toxic") == 1, C.NEGATIVE).when(F.col("quality") == 1, C.POSITIVE)
        .when(F.col("quality") == 0, C.NEUTRAL).otherwise(C.UNCLASSIFIED)
    )
    third = n % 3 == 0
    method = (
        F.when(label == C.UNCLASSIFIED, F.when(third, "model_failed").otherwise("llm_failed"))
        .when(third, "llm").otherwise("model")
    )
    day = F.timestamp_seconds(F.lit(1704067200) + (n * 7919 % 730) * 86400)
    is_reply = n % 4 == 3
    return docs.join(labels, "doc_id", "left").select(
        n.alias("seq"),
        _text_id("c", n).alias("comment_id"),
        F.concat_ws("-", "lang", "source").alias("video_id"),
        F.when(n % 5 == 0, "").otherwise(F.concat(F.lit("Caption "), "source")).alias(
            "video_caption"
        ),
        F.replace("source", F.lit("src"), F.lit("user")).alias("video_author_username"),
        _text_id("user", n * 7 % 211).alias("username"),
        is_reply.alias("is_reply"),
        F.when(is_reply, _text_id("c", n - 1 - n % 3)).alias("parent_comment_id"),
        F.col("text").alias("text_raw"),
        F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss").alias("create_time"),
        (F.col("n_chars") % 500).alias("digg_count"),
        F.lit(False).alias("excluded"),
        F.lit(None).cast("string").alias("exclude_reason"),
        label.alias("sentiment_label"),
        method.alias("sentiment_method"),
        _text_id("run-", n % 3).alias("run_id"),
    )


def tokenized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts after the text stages."""
    return classify.preprocess(posts(spark, sf_dir), STOPWORDS, SLANG)


def _narrow(rows: DataFrame, text: bool) -> DataFrame:
    """Without the texts between the stages, and the raw one unless it is asked for.

    What is written is not pruned by what its readers want.
    """
    return rows.drop("emoji_found", "text_clean", *([] if text else ["text_raw"]))


def durable_tokens(spark: SparkSession, sf_dir: str, text: bool = False) -> DataFrame:
    """Tokens written once, for operators that read them several times."""
    return durable(_narrow(tokenized(spark, sf_dir), text))


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One account type per video, derived from the language."""
    kind = (
        F.when(F.col("lang") == "en", "KOL Account").when(F.col("lang") == "fr", "official store")
        .when(F.col("lang") == "de", "affiliate account").otherwise("")
    )
    return (
        table(spark, sf_dir, "documents").select("lang", "source").distinct()
        .select(F.concat_ws("-", "lang", "source").alias("video_id"), kind.alias("account_type"))
    )


def run_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The account table of each of the three runs."""
    runs = posts(spark, sf_dir).select("run_id", "video_id").distinct()
    return runs.join(accounts(spark, sf_dir), "video_id").select(
        "run_id", "video_id", "account_type"
    )


def tiered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiers.attach_tier(tokenized(spark, sf_dir), accounts(spark, sf_dir))


def whole_run(df: DataFrame) -> DataFrame:
    """All rows as one run."""
    return df.withColumn("run_id", F.lit("all"))


def claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as narrative bodies, each opening with an entity and a number."""
    docs = spread(table(spark, sf_dir, "documents"), "doc_id")
    n = F.col("doc_id")
    entity = F.get(
        F.array(*[F.lit(x) for x in ("KOL", "Overall", "Official", "tidak diketahui", "AFFILIATE")]),
        (n % 5).cast("int"),
    )
    number = F.when(n % 2 == 0, (F.col("n_chars") % 60).cast("string")).otherwise(
        F.concat(F.lit("+"), (F.col("n_chars") % 60).cast("string"), F.lit(",5"))
    )
    section = F.get(F.array(*[F.lit(x) for x in SECTIONS]), (n % 3).cast("int"))
    return docs.select(
        F.when(F.col("lang").isNotNull(), "all").alias("run_id"), (n % 50).alias("attempt"), section.alias("section"),
        n.alias("idx"), F.col("source").alias("title"),
        F.concat_ws(
            " ", entity, number,
            F.when(n % 7 == 0, "karena"), F.lit("pada Agu 26, 2024:"), "text",
        ).alias("body"),
    )


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conversations as candidate narratives, some of them malformed."""
    talk = table(spark, sf_dir, "conversations")
    n = F.col("conv_id") + F.col("turn")
    item = F.struct(
        F.col("role").alias("title"), F.when(n % 7 == 3, "  ").otherwise(F.col("text")).alias("body")
    )
    good = F.array(F.struct(F.lit("t").alias("title"), F.lit("b").alias("body")))
    whole = F.to_json(F.struct(
        good.alias("headline"), F.array(item, item).alias("risk"), good.alias("actions")
    ))
    text = (
        F.when(n % 7 == 0, F.to_json(F.struct(good.alias("headline"), good.alias("actions"))))
        .when(n % 7 == 1, "[1, 2]").when(n % 7 == 2, "not json")
        .when(n % 7 == 4, '{"headline": [{"title": "t", "body": "b"}, "x"], "risk": [], "actions": {}}')
        .when(n % 7 == 5, '{"headline": [{"title": 3, "body": "b"}]}')
        .otherwise(whole)
    )
    return talk.select(
        F.col("conv_id").cast("string").alias("run_id"), F.col("turn").alias("attempt"),
        text.alias("narrative"),
    )


def durable_tiers(spark: SparkSession, sf_dir: str, text: bool = False) -> DataFrame:
    return durable(_narrow(tiered(spark, sf_dir), text))


def order_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as analyzed comments spread over years."""
    rows = table(spark, sf_dir, "orders")
    kind = F.col("o_orderpriority")
    label = (
        F.when(kind.isin("1-URGENT", "5-LOW"), C.POSITIVE).when(kind == "2-HIGH", C.NEGATIVE)
        .when(kind == "3-MEDIUM", C.NEUTRAL).otherwise(C.UNCLASSIFIED)
    )
    return rows.select(
        F.col("o_orderkey").alias("seq"),
        _text_id("o", F.col("o_orderkey")).alias("comment_id"),
        _text_id("v", F.col("o_custkey") % 300).alias("video_id"),
        F.when(F.col("o_custkey") % 7 == 0, "").otherwise(
            _text_id("Caption ", F.col("o_custkey") % 300)
        ).alias("video_caption"),
        _text_id("cust", F.col("o_custkey") % 97).alias("username"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("create_time"),
        F.floor(F.col("o_totalprice") / 1000).alias("digg_count"),
        label.alias("sentiment_label"),
        F.when(F.col("o_orderstatus") == "P", "llm").otherwise("model").alias("sentiment_method"),
        F.concat(F.lit("Order text "), "o_orderpriority").alias("text_raw"),
        F.concat(F.lit("run-"), "o_orderstatus").alias("run_id"),
        (F.col("o_orderkey") % 3 == 1).alias("is_reply"),
    )


def line_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as a large table of dated, labeled rows."""
    rows = table(spark, sf_dir, "lineitem")
    flag = F.col("l_returnflag")
    return rows.select(
        F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss").alias("create_time"),
        F.when(flag == "A", C.POSITIVE).when(flag == "R", C.NEGATIVE).when(flag == "N", C.NEUTRAL)
        .alias("sentiment_label"),
        F.concat(F.lit("run-"), "l_linestatus").alias("run_id"),
        _text_id("p", F.col("l_partkey")).alias("video_id"),
        F.lit("model").alias("sentiment_method"),
    )


def event_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as comments of few videos."""
    rows = table(spark, sf_dir, "events")
    kind = F.col("event_type")
    label = (
        F.when(kind == "purchase", C.POSITIVE).when(kind == "error", C.NEGATIVE)
        .when(kind.isin("click", "view"), C.NEUTRAL).otherwise(C.UNCLASSIFIED)
    )
    return rows.select(
        F.col("event_id").alias("seq"),
        _text_id("e", F.col("event_id")).alias("comment_id"),
        _text_id("v", F.col("user_id")).alias("video_id"),
        _text_id("Video ", F.col("user_id")).alias("video_caption"),
        _text_id("u", F.col("user_id") * 3 % 40).alias("username"),
        _text_id("u", F.col("user_id") % 40).alias("video_author_username"),
        F.col("props").alias("text_raw"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("create_time"),
        F.floor("value").alias("digg_count"),
        label.alias("sentiment_label"),
        F.when(kind == "signup", "llm_failed").when(kind == "view", "llm").otherwise("model")
        .alias("sentiment_method"),
        F.lit(False).alias("excluded"),
        F.lit(None).cast("string").alias("exclude_reason"),
        _text_id("run-", F.col("event_id") % 2).alias("run_id"),
    )


def mirror(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as the order mirror: many lines per video, several id spellings."""
    rows = table(spark, sf_dir, "orders")
    cust = F.col("o_custkey")
    video = (cust + 7000000).cast("string")
    value = (
        F.when(cust % 6 == 0, video)
        .when(cust % 6 == 1, F.concat(F.lit("https://site.example/@u/video/"), video, F.lit("?x=1")))
        .when(cust % 6 == 2, F.concat(F.lit("  "), video, F.lit(" ")))
        .when(cust % 6 == 3, F.concat(F.lit("https://vm.tiktok.com/Z"), cust.cast("string")))
        .when(cust % 6 == 4, F.concat(F.lit("https://site.example/@u/photo/"), video))
        .when(F.col("o_orderstatus") == "P", "  ").otherwise("no id here")
    )
    kind = F.col("o_orderpriority")
    account = (
        F.when(kind == "1-URGENT", "KOL Account").when(kind == "2-HIGH", "official shop")
        .when(kind == "3-MEDIUM", " affiliate account ").when(kind == "5-LOW", "kol official")
        .otherwise("")
    )
    return rows.select(
        F.col("o_orderkey").alias("line"), value.alias("value"), account.alias("account_type"),
        F.when(cust % 4 == 0, "").otherwise(_text_id("maker", cust % 50)).alias(
            "creator_username"
        ),
    )


def collected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Videos of earlier runs."""
    rows = table(spark, sf_dir, "customer").filter("c_acctbal < 0")
    return rows.select((F.col("c_custkey") + 7000000).cast("string").alias("video_id"))


def _turn(col: Column) -> Column:
    return col.cast("string")


def landed_pages(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """conversations as landed response pages of comments and of replies.

    First turns are comments, five to a page, ten to a video; the other turns
    are replies, three to a page.
    """
    talk = table(spark, sf_dir, "conversations")
    conv, turn = F.col("conv_id"), F.col("turn")
    video = _text_id("v", F.floor(conv / 10))
    raw = F.struct(
        F.concat_ws("-", _turn(conv), _turn(turn)).alias("cid"),
        F.when((conv + turn) % 7 == 0, "  ").otherwise(F.col("text")).alias("text"),
        F.when(conv % 97 == 96, "soon").otherwise(_turn(conv * 3600 + turn * 60 + 1700000000))
        .alias("create_time"),
        F.struct(
            F.concat(F.col("role"), _turn(conv % 9)).alias("unique_id"),
            F.lit(None).cast("string").alias("nickname"),
        ).alias("user"),
        F.length("text").cast("bigint").alias("digg_count"),
        F.when(turn == 0, 1).otherwise(0).cast("bigint").alias("reply_comment_total"),
        F.struct(
            F.when(conv % 10 == 1, F.concat(F.lit("Title "), video)).alias("title"),
            F.lit(None).cast("string").alias("url"),
        ).alias("share_info"),
    )
    rows = talk.select(
        "conv_id", "turn", video.alias("video_id"), raw.alias("raw"),
        _turn(conv).alias("_conv"),
    )
    listed = F.transform(
        F.array_sort(F.collect_list(F.struct("conv_id", "turn", "raw"))), lambda r: r["raw"]
    )
    body = F.to_json(F.struct(listed.alias("comments"), F.lit(1).alias("has_more"))).alias("body")
    pages = (
        rows.filter("turn = 0")
        .groupBy("video_id", F.floor((conv % 10) / 5).alias("page_no")).agg(body)
    )
    replies = (
        rows.filter("turn > 0")
        .groupBy(
            "video_id", F.concat("_conv", F.lit("-0")).alias("comment_id"),
            F.floor((turn - 1) / 3).alias("page_no"),
        ).agg(body)
    )
    return pages, replies


def talk_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conversations as flat collector rows, ready to nest."""
    talk = table(spark, sf_dir, "conversations")
    conv, turn = F.col("conv_id"), F.col("turn")
    return talk.select(
        _text_id("v", F.floor(conv / 10)).alias("aweme_id"),
        F.concat_ws("-", _turn(conv), _turn(turn)).alias("comment_id"),
        (turn > 0).alias("is_reply"),
        F.when(turn > 0, F.concat(_turn(conv), F.lit("-0"))).alias("parent_comment_id"),
        F.concat(F.col("role"), _turn(conv % 9)).alias("username"),
        F.when(turn % 2 == 1, F.col("role")).alias("nickname"),
        F.when(conv % 5 == 0, F.concat(F.lit("="), "text")).otherwise(F.col("text")).alias(
            "comment"
        ),
        F.date_format(
            F.timestamp_seconds(conv * 3600 + turn * 60 + 1700000000), "yyyy-MM-dd'T'HH:mm:ss"
        ).alias("create_time"),
        F.lit(None).cast("string").alias("avatar"),
        F.when(turn % 3 == 2, None).otherwise(F.length("text")).cast("bigint").alias("digg_count"),
        F.lit(None).cast("bigint").alias("total_reply"),
        (conv * 1000 + turn).alias("seq"),
    )


def nested_talk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows as nested video records."""
    from echolens.operators.ingest import nest_comments

    videos = nest_comments(talk_rows(spark, sf_dir))
    number = F.replace("aweme_id", F.lit("v"), F.lit("")).cast("bigint")
    return videos.select(
        number.alias("video_no"), "aweme_id",
        F.when(number % 2 == 0, F.concat(F.lit("+Caption "), "aweme_id")).alias("caption"),
        F.lit(None).cast("string").alias("video_url"),
        F.when(number % 3 == 0, "kol account").alias("account_type"),
        F.when(number % 2 == 1, "user3").alias("video_author_username"),
        "comments", "total_collected",
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw model output per labeled document: two models with differing errors."""
    labels = table(spark, sf_dir, "labels")
    n = F.col("doc_id")
    truth = F.when(F.col("toxic") == 1, 2).when(F.col("quality") == 1, 0).otherwise(1)
    models = F.explode(F.array(F.lit(0), F.lit(1))).alias("m")
    rows = labels.select("doc_id", truth.alias("truth"), models)
    wrong = (n * 31 + F.col("m") * 17) % 10 < 3 - F.col("m")
    confidence = 0.40 + (n * 37 + F.col("m") * 11) % 60 / 100.0
    return rows.select(
        _text_id("c", n).alias("comment_id"),
        _text_id("model-", F.col("m")).alias("model"),
        _text_id("LABEL_", F.when(wrong, (F.col("truth") + 1) % 3).otherwise(F.col("truth"))).alias(
            "raw_label"
        ),
        confidence.alias("confidence"),
        n.alias("doc_id"), "truth",
    )


def labeled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Human labels as a spreadsheet export: quoted ids, untidy label text."""
    labels = table(spark, sf_dir, "labels")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    truth = (
        F.when(F.col("toxic") == 1, " Negatif").when(F.col("quality") == 1, "POSITIF ")
        .otherwise("netral")
    )
    return labels.join(docs, "doc_id").select(
        _text_id("'c", F.col("doc_id")).alias("comment_id"),
        F.when(F.col("doc_id") % 11 == 0, " ").otherwise(F.col("text")).alias("comment"),
        truth.alias("label"),
        F.when(F.col("doc_id") % 2 == 0, _text_id("note ", F.col("doc_id"))).alias("notes"),
    )
