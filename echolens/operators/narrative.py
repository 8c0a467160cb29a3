"""Deterministic narrative rows built from the metric tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from echolens import constants as C
from echolens.functions.numbers import id_number, round_exact, signed
from echolens.functions.text import tier_rank

# Fixed report sentences (printf templates).
HEAD_TITLE = "Sentimen bersih %s"
HEAD_BODY = (
    "Dari %s komentar terklasifikasi: %s positif (%s%%), %s negatif (%s%%), "
    "%s netral (%s%%). Basis perhitungan untuk seluruh angka net sentimen di "
    "laporan ini: total komentar dikurangi yang tidak terklasifikasi."
)
ONE_MONTH_TITLE = "Tren belum bisa dibandingkan"
ONE_MONTH_BODY = (
    "Baru %d bulan yang melewati ambang minimum %d komentar - "
    "dibutuhkan setidaknya dua bulan untuk membandingkan arah."
)
LIKES_TITLE = "Net sentimen tertimbang like: %s"
LIKES_BODY = (
    "Sepuluh komentar teratas menyerap %s%% dari %s like yang terkumpul. "
    "Tanpa sepuluh komentar itu, net sentimen tertimbang like menjadi "
    "%s (dibanding %s per komentar apa adanya)."
)
UNCLASSIFIED_TITLE = "%s komentar tidak terklasifikasi (%s%%)"
UNCLASSIFIED_BODY = (
    "Semua angka net sentimen di laporan ini dihitung atas %s komentar "
    "terklasifikasi, bukan %s komentar total."
)
TREND_TITLE = (
    "Perbandingan bulan-ke-bulan: %s %s dibanding %s (%s poin) "
    "— belum diverifikasi terhadap populasi penuh"
)
TREND_BODY_KNOWN = (
    "Sampel video di laporan ini adalah sebagian kecil dari total video akun "
    "(~%s dari ~%s). Angka ini adalah sinyal awal dari sampel yang ada, bukan "
    "kesimpulan yang divalidasi terhadap seluruh populasi video — gunakan "
    "dengan hati-hati untuk keputusan besar."
)
TREND_BODY_UNKNOWN = (
    "Sampel video di laporan ini adalah sebagian dari total video akun; jumlah "
    "populasi penuh tidak disediakan pada run ini. Angka ini adalah sinyal awal "
    "dari sampel yang ada, bukan kesimpulan yang divalidasi terhadap seluruh "
    "populasi video — gunakan dengan hati-hati untuk keputusan besar."
)
FAILURE_TITLE = "Eskalasi LLM gagal %s%% dari trafik LLM"
FAILURE_BODY = "Kegagalan jalur LLM adalah sumber utama komentar tidak terklasifikasi di atas."
WORST_TITLE = "Audit video dengan net sentimen terendah"
WORST_BODY = (
    "Video terburuk berada di %s, median video %s dari %d video "
    "yang memenuhi ambang minimum %d komentar terklasifikasi."
)
MORE_DATA_TITLE = "Kumpulkan lebih banyak data sebelum mengambil keputusan"
MORE_DATA_BODY = (
    "Belum ada video yang memenuhi ambang minimum %d komentar "
    "terklasifikasi untuk diperingkat."
)
TIER_ONLY_TITLE = "%s adalah satu-satunya tipe akun dengan data"
TIER_ONLY_BODY = (
    "%s komentar dari %d video pada tipe akun %s - tidak ada tipe akun lain pada "
    "dataset ini untuk dibandingkan."
)
TIER_NET_TITLE = "Net sentimen %s: %s"
TIER_NET_BODY = (
    "%s poin %s dibanding rata-rata tipe akun lain (%s), dari %s komentar "
    "(%s%% dari seluruh komentar) di %d video."
)
TIER_THEME_TITLE = "Tema paling banyak disebut: %s"
TIER_THEME_BODY = "Muncul di %s komentar (%s%% dari komentar tipe akun ini)."

SECTIONS = ("headline", "risk", "actions")


def _finding(title: Column | str, body: Column | str) -> Column:
    as_column = lambda v: F.lit(v) if isinstance(v, str) else v
    return F.struct(as_column(title).alias("title"), as_column(body).alias("body"))


def _text(value: Column) -> Column:
    return value.cast("string")


def build_narrative(
    overall: DataFrame, engagement: DataFrame, quality: DataFrame, trend: DataFrame,
    delta: DataFrame, leaderboard: DataFrame, board_summary: DataFrame,
    by: Sequence[str], population_videos: int | None = None,
) -> DataFrame:
    """(by, section, idx, title, body): sentences that only cite metric values.

    Works on one row per run, so any number of runs is narrated in one job.
    """
    if not by:
        raise ValueError("narratives need a run key")
    months = trend.groupBy(*by).agg(F.count(F.lit(1)).alias("months"))
    worst = leaderboard.filter("board = 'worst' AND rank = 1").select(
        *by, F.col("net").alias("worst_net")
    )
    changes = delta.select(
        *by, "from_label", "to_label", F.col("delta").alias("change"), "word"
    )
    rows = overall
    for part in (engagement, quality.drop("unclassified_pct"), months, changes, worst, board_summary):
        rows = rows.join(part, list(by), "left")
    c = F.col
    has_delta = c("change").isNotNull()
    headline = [
        _finding(
            F.format_string(HEAD_TITLE, signed(c("net_overall"))),
            F.format_string(
                HEAD_BODY, id_number(c("classified_total")),
                id_number(c("pos")), _text(c("pos_pct")),
                id_number(c("neg")), _text(c("neg_pct")),
                id_number(c("neu")), _text(c("neu_pct")),
            ),
        ),
        F.when((F.coalesce(c("months"), F.lit(0)) > 0) & ~has_delta, _finding(
            ONE_MONTH_TITLE,
            F.format_string(ONE_MONTH_BODY, c("months"), F.lit(C.MIN_MONTH_VOLUME)),
        )),
        F.when(c("total_likes") > 0, _finding(
            F.format_string(LIKES_TITLE, signed(c("net_by_likes"))),
            F.format_string(
                LIKES_BODY, _text(c("top10_like_share_pct")), id_number(c("total_likes")),
                signed(c("net_by_likes_trimmed")), signed(c("net_overall")),
            ),
        )),
    ]
    if population_videos:
        trend_body = F.format_string(
            TREND_BODY_KNOWN, id_number(c("sample_video_count")),
            id_number(F.lit(population_videos)),
        )
    else:
        trend_body = F.lit(TREND_BODY_UNKNOWN)
    risk = [
        _finding(
            F.format_string(
                UNCLASSIFIED_TITLE, id_number(c("unclassified_count")), _text(c("unk_pct"))
            ),
            F.format_string(
                UNCLASSIFIED_BODY, id_number(c("classified_total")), id_number(c("total_comments"))
            ),
        ),
        F.when(has_delta, _finding(
            F.format_string(
                TREND_TITLE, c("to_label"), c("word"), c("from_label"), signed(c("change"))
            ),
            trend_body,
        )),
        F.when(c("llm_failure_pct") != 0, _finding(
            F.format_string(FAILURE_TITLE, _text(c("llm_failure_pct"))), FAILURE_BODY
        )),
    ]
    actions = [
        F.when(c("worst_net").isNotNull(), _finding(
            WORST_TITLE,
            F.format_string(
                WORST_BODY, signed(c("worst_net"), 0), signed(c("median_net"), 0),
                c("eligible_count"), F.lit(C.MIN_VIDEO_COMMENTS),
            ),
        )).otherwise(_finding(
            MORE_DATA_TITLE, F.format_string(MORE_DATA_BODY, F.lit(C.MIN_VIDEO_COMMENTS))
        )),
    ]
    sections = F.array(*[
        F.struct(F.lit(name).alias("section"), F.array_compact(F.array(*items)).alias("items"))
        for name, items in zip(SECTIONS, (headline, risk, actions))
    ])
    listed = rows.select(*by, F.explode(sections).alias("s"))
    return listed.select(
        *by, F.col("s.section").alias("section"), F.posexplode("s.items").alias("idx", "f")
    ).select(*by, "section", "idx", "f.title", "f.body")


def tier_narrative(totals: DataFrame, themes: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One or two sentences per tier against the mean net of its peers."""
    top = themes.filter("rank = 1").select(
        *by, "tier", F.col("label").alias("theme_label"),
        F.col("count").alias("theme_count"), F.col("share_pct").alias("theme_pct"),
    )
    rows = totals.join(top, [*by, "tier"], "left")
    c = F.col
    gap = round_exact(c("net") - c("peer_net"), 1)
    direction = (
        F.when(gap > 0, "lebih tinggi").when(gap < 0, "lebih rendah").otherwise("setara")
    )
    alone = _finding(
        F.format_string(TIER_ONLY_TITLE, c("label")),
        F.format_string(
            TIER_ONLY_BODY, id_number(c("comment_count")), c("video_count"), c("label")
        ),
    )
    compared = _finding(
        F.format_string(TIER_NET_TITLE, c("label"), signed(c("net"))),
        F.format_string(
            TIER_NET_BODY, F.format_string("%.1f", F.abs(gap)), direction,
            signed(c("peer_net")), id_number(c("comment_count")), _text(c("pct_of_total")),
            c("video_count"),
        ),
    )
    theme = F.when((c("peers") > 0) & (c("theme_count") > 0), _finding(
        F.format_string(TIER_THEME_TITLE, c("theme_label")),
        F.format_string(TIER_THEME_BODY, id_number(c("theme_count")), _text(c("theme_pct"))),
    ))
    first = F.when(c("peers") > 0, compared).otherwise(alone)
    found = F.posexplode(F.array_compact(F.array(first, theme))).alias("idx", "f")
    return rows.select(*by, "tier", found).select(*by, "tier", "idx", "f.title", "f.body")


# --- metric facts ------------------------------------------------------------
def metric_facts(
    overall: DataFrame, quality: DataFrame, tiers: DataFrame, themes: DataFrame,
    by: Sequence[str],
) -> DataFrame:
    """Long table (by, ord, entity, field, value) of every citable number.

    ``tiers`` carries tier, label, net, video_count, comment_count and
    optionally pct_of_total; ``themes`` carries tier, label, count, rank.
    """

    def facts(df: DataFrame, entity: Column, pairs: Sequence[tuple[str, str]], first: Column):
        items = F.array(*[
            F.struct(
                (first + i).alias("ord"), entity.alias("entity"), F.lit(field).alias("field"),
                F.col(column).cast("double").alias("value"),
            )
            for i, (field, column) in enumerate(pairs)
        ])
        return df.select(*by, F.inline(items)).filter("value IS NOT NULL")

    whole = F.lit("overall")
    long_names = dict(zip(("pos", "neg", "neu", "unk"), C.LABELS))
    share_names = {
        "pos_pct": "positif_pct", "neg_pct": "negatif_pct",
        "neu_pct": "netral_pct", "unk_pct": "unclassified_pct",
    }
    general = [(c, c) for c in ("net_overall", "classified_total", "total_comments")]
    general += [(f"sentiment_counts.{n}", c) for c, n in long_names.items()]
    general += [(f"sentiment_pct.{n}", c) for c, n in share_names.items()]
    checks = [
        (f"data_quality.{c}", c)
        for c in ("unclassified_count", "unclassified_pct", "llm_escalation_pct", "llm_failure_pct")
    ]
    per_tier = [
        (c, c) for c in ("net", "video_count", "comment_count", "pct_of_total")
        if c in tiers.columns
    ]
    base = tier_rank(F.col("tier")) * 1000
    labeled = themes.join(
        tiers.select(*by, "tier", F.col("label").alias("entity")), [*by, "tier"]
    )
    theme_facts = labeled.select(
        *by, (base + 100 + F.col("rank")).alias("ord"), "entity",
        F.concat(F.lit("theme."), F.col("label")).alias("field"),
        F.col("count").cast("double").alias("value"),
    )
    return (
        facts(overall, whole, general, F.lit(0))
        .unionByName(facts(quality, whole, checks, F.lit(len(general))))
        .unionByName(facts(tiers, F.col("label"), per_tier, base))
        .unionByName(theme_facts)
    )


def causal_terms(themes: DataFrame, keywords: DataFrame, by: Sequence[str]) -> DataFrame:
    """Theme and keyword labels a causal sentence may refer to, lower case."""
    names = themes.select(*by, F.lower("label").alias("term")).unionByName(
        keywords.select(*by, F.lower("keyword").alias("term"))
    )
    return names.filter("term IS NOT NULL AND term <> ''").distinct()


def fingerprint(facts: DataFrame, by: Sequence[str]) -> DataFrame:
    """Stable hash of a run's metrics: tells whether a run has to be redone.

    A run has a fixed, small number of facts.
    """
    line = F.concat_ws(
        "|", "entity", "field", F.format_string("%.4f", round_exact(F.col("value"), 4))
    )
    text = F.array_join(F.array_sort(F.collect_list(line)), "\n")
    return facts.groupBy(*by).agg(F.sha2(text, 256).alias("fingerprint"))
