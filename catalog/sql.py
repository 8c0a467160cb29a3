"""SQL building blocks for the oracles: rounding, shares, and the views."""

from __future__ import annotations

from catalog import views as V
from echolens import constants as C


def rnd(value: str, digits: int = 1) -> str:
    """Round the binary value, ties to even, like the column helper."""
    scale = f"{float(10 ** digits)}::DOUBLE"
    split = "134217729::DOUBLE"
    parts = (
        f"list_transform([CAST({value} AS DOUBLE)], lambda v: "
        f"{{'v': v, 'a': abs(v), 'h': abs(v) * {split} - (abs(v) * {split} - abs(v)), "
        f"'k': floor(abs(v) * {scale})}})"
    )
    over = f"((r.h * {scale} - (r.k + 0.5::DOUBLE)) + (r.a - r.h) * {scale})"
    step = f"CASE WHEN {over} > 0 OR ({over} = 0 AND r.k % 2 = 1) THEN 1 ELSE 0 END"
    return (
        f"list_transform({parts}, lambda r: CAST(sign(r.v) AS DOUBLE) * (r.k + {step}) / {scale})[1]"
    )


def pct(part: str, total: str, digits: int = 1) -> str:
    ratio = f"100.0::DOUBLE * ({part}) / nullif({total}, 0)"
    return f"coalesce({rnd(ratio, digits)}, 0.0::DOUBLE)"


def net(pos: str = "pos", neg: str = "neg", neu: str = "neu") -> str:
    return pct(f"{pos} - {neg}", f"{pos} + {neg} + {neu}")


def signed(value: str, digits: int = 1) -> str:
    return f"format('{{:+.{digits}f}}', {rnd(value, digits)})"


def id_number(value: str) -> str:
    return f"replace(format('{{:,}}', CAST({value} AS BIGINT)), ',', '.')"


LABEL = f"coalesce(sentiment_label, '{C.UNCLASSIFIED}')"
COUNTS = ", ".join(
    f"count(*) FILTER (WHERE {LABEL} = '{lab}') AS {n}"
    for lab, n in zip(C.LABELS, ("pos", "neg", "neu", "unk"))
)
ISO = "'%Y-%m-%dT%H:%M:%S'"


def case(pairs: dict[str, str], column: str, otherwise: str = "NULL") -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in pairs.items())
    return f"CASE {column} {whens} ELSE {otherwise} END"


def quoted(words) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


def mapping(values) -> str:
    body = ", ".join(
        f"'{k}': {v!r}" if isinstance(v, str) else f"'{k}': {v}::DOUBLE" for k, v in values.items()
    )
    return f"MAP {{{body}}}"


TIER_OF = (
    "CASE WHEN contains(lower({0}), 'kol') THEN 'kol' WHEN contains(lower({0}), 'official') "
    "THEN 'official' WHEN contains(lower({0}), 'affiliate') THEN 'affiliate' ELSE 'unknown' END"
)
SPACE, WORD = C.SPACE, C.WORD


def strip(text: str) -> str:
    return f"regexp_replace({text}, '^{SPACE}+|{SPACE}+$', '', 'g')"


def cleaned(text: str) -> str:
    no_emoji = f"regexp_replace({text}, '{C.EMOJI_PATTERN}', '', 'g')"
    folded = f"replace(lower({no_emoji}), 'ß', 'ss')"
    links = f"regexp_replace({folded}, '{C.URL_PATTERN}', ' ', 'g')"
    mentions = f"regexp_replace({links}, '{C.MENTION_PATTERN}', ' ', 'g')"
    return f"trim(regexp_replace({mentions}, '{SPACE}+', ' ', 'g'))"


VIEWS: dict[str, str] = {}

VIEWS["posts"] = f"""
SELECT d.doc_id AS seq, 'c' || d.doc_id AS comment_id, d.lang || '-' || d.source AS video_id,
  CASE WHEN d.doc_id % 5 = 0 THEN '' ELSE 'Caption ' || d.source END AS video_caption,
  replace(d.source, 'src', 'user') AS video_author_username,
  'user' || (d.doc_id * 7 % 211) AS username,
  d.doc_id % 4 = 3 AS is_reply,
  CASE WHEN d.doc_id % 4 = 3 THEN 'c' || (d.doc_id - 1 - d.doc_id % 3) END AS parent_comment_id,
  d.text AS text_raw,
  strftime(make_timestamp((1704067200 + (d.doc_id * 7919 % 730) * 86400) * 1000000), {ISO})
    AS create_time,
  d.n_chars % 500 AS digg_count,
  CASE WHEN l.toxic = 1 THEN 'negatif' WHEN l.quality = 1 THEN 'positif'
    WHEN l.quality = 0 THEN 'netral' ELSE 'tidak_terklasifikasi' END AS sentiment_label,
  CASE WHEN l.doc_id IS NULL THEN CASE WHEN d.doc_id % 3 = 0 THEN 'model_failed' ELSE 'llm_failed' END
    WHEN d.doc_id % 3 = 0 THEN 'llm' ELSE 'model' END AS sentiment_method,
  'run-' || (d.doc_id % 3) AS run_id
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""

_STOP = [w for w in sorted(set(V.STOPWORDS)) if w not in C.NEGATIONS]
VIEWS["cleaned"] = f"""
SELECT *, {cleaned('text_raw')} AS text_clean FROM posts"""
VIEWS["short_runs"] = """
SELECT seq AS short_seq, array_to_string(list_transform(list_filter(
    list_zip(ch, list_concat([NULL], ch), list_concat([NULL, NULL], ch)),
    lambda z: z[1] IS NOT NULL AND NOT coalesce(z[1] = z[2] AND z[1] = z[3], false)),
    lambda z: z[1]), '') AS short_text
FROM (SELECT seq, regexp_extract_all(text_clean, '(?s).') AS ch FROM cleaned)"""
VIEWS["normalized"] = f"""
SELECT c.*, array_to_string(list_transform(string_split(trim(s.short_text), ' '),
    lambda w: coalesce({mapping(V.SLANG)}[w], w)), ' ') AS text_normalized
FROM cleaned c JOIN short_runs s ON c.seq = s.short_seq"""
VIEWS["tokenized"] = f"""
SELECT *, list_filter(regexp_extract_all(text_normalized, '[a-z0-9'']+'),
    lambda t: NOT list_contains({quoted(_STOP)}, t)) AS tokens
FROM normalized"""
VIEWS["accounts"] = """
SELECT DISTINCT lang || '-' || source AS video_id, CASE lang WHEN 'en' THEN 'KOL Account'
  WHEN 'fr' THEN 'official store' WHEN 'de' THEN 'affiliate account' ELSE '' END AS account_type
FROM documents"""
VIEWS["tiered"] = f"""
SELECT t.*, {TIER_OF.format("coalesce(a.account_type, '')")} AS tier
FROM tokenized t LEFT JOIN accounts a USING (video_id)"""
VIEWS["tier_posts"] = f"""
SELECT t.*, {TIER_OF.format("coalesce(a.account_type, '')")} AS tier
FROM posts t LEFT JOIN accounts a USING (video_id)"""
VIEWS["tier_spine"] = """
SELECT unnest(['kol', 'official', 'affiliate', 'unknown']) AS tier, unnest([1, 2, 3, 4]) AS priority"""
VIEWS["order_comments"] = f"""
SELECT o_orderkey AS seq, 'o' || o_orderkey AS comment_id, 'v' || (o_custkey % 300) AS video_id,
  CASE WHEN o_custkey % 7 = 0 THEN '' ELSE 'Caption ' || (o_custkey % 300) END AS video_caption,
  'cust' || (o_custkey % 97) AS username, strftime(o_orderdate, {ISO}) AS create_time,
  CAST(floor(o_totalprice / 1000) AS BIGINT) AS digg_count,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'positif' WHEN '5-LOW' THEN 'positif'
    WHEN '2-HIGH' THEN 'negatif' WHEN '3-MEDIUM' THEN 'netral' ELSE 'tidak_terklasifikasi' END
    AS sentiment_label,
  CASE WHEN o_orderstatus = 'P' THEN 'llm' ELSE 'model' END AS sentiment_method,
  'Order text ' || o_orderpriority AS text_raw, 'run-' || o_orderstatus AS run_id,
  o_orderkey % 3 = 1 AS is_reply
FROM orders"""
VIEWS["line_comments"] = f"""
SELECT strftime(l_shipdate, {ISO}) AS create_time, CASE l_returnflag WHEN 'A' THEN 'positif'
  WHEN 'R' THEN 'negatif' WHEN 'N' THEN 'netral' END AS sentiment_label,
  'run-' || l_linestatus AS run_id, 'p' || l_partkey AS video_id, 'model' AS sentiment_method
FROM lineitem"""
VIEWS["event_comments"] = f"""
SELECT event_id AS seq, 'e' || event_id AS comment_id, 'v' || user_id AS video_id,
  'Video ' || user_id AS video_caption,
  'u' || (user_id * 3 % 40) AS username, 'u' || (user_id % 40) AS video_author_username,
  props AS text_raw, strftime(ts, {ISO}) AS create_time,
  CAST(floor(value) AS BIGINT) AS digg_count,
  CASE event_type WHEN 'purchase' THEN 'positif' WHEN 'error' THEN 'negatif'
    WHEN 'click' THEN 'netral' WHEN 'view' THEN 'netral' ELSE 'tidak_terklasifikasi' END
    AS sentiment_label,
  CASE event_type WHEN 'signup' THEN 'llm_failed' WHEN 'view' THEN 'llm' ELSE 'model' END
    AS sentiment_method, 'run-' || (event_id % 2) AS run_id
FROM events"""
EXCLUDED_USERS = ("u7", "u21", "u39", "nobody")
VIEWS["marked"] = f"""
SELECT *, CASE WHEN username <> '' AND username = video_author_username THEN 'video_uploader'
  WHEN username IN ({", ".join(repr(u) for u in EXCLUDED_USERS)}) THEN 'internal_account' END
  AS exclude_reason
FROM event_comments"""
VIEWS["mirror"] = """
SELECT o_orderkey AS line, CASE o_custkey % 6 WHEN 0 THEN '' || (o_custkey + 7000000)
  WHEN 1 THEN 'https://site.example/@u/video/' || (o_custkey + 7000000) || '?x=1'
  WHEN 2 THEN '  ' || (o_custkey + 7000000) || ' '
  WHEN 3 THEN 'https://vm.tiktok.com/Z' || o_custkey
  WHEN 4 THEN 'https://site.example/@u/photo/' || (o_custkey + 7000000)
  ELSE CASE WHEN o_orderstatus = 'P' THEN '  ' ELSE 'no id here' END END AS value,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'KOL Account' WHEN '2-HIGH' THEN 'official shop'
    WHEN '3-MEDIUM' THEN ' affiliate account ' WHEN '5-LOW' THEN 'kol official' ELSE '' END
    AS account_type,
  CASE WHEN o_custkey % 4 = 0 THEN '' ELSE 'maker' || (o_custkey % 50) END AS creator_username
FROM orders"""
VIEWS["keyed"] = f"""
SELECT line, value, coalesce(nullif({strip('account_type')}, ''), 'unknown') AS account_type,
  creator_username,
  coalesce(nullif(regexp_extract({strip('value')}, '(?:/(?:video|photo)/|^)(\\d{{6,}})', 1), ''),
    CASE WHEN regexp_matches({strip('value')}, '(?i)^https?://(?:vt|vm)\\.tiktok\\.com/{C.NON_SPACE}+$')
      THEN {strip('value')} END) AS video_id
FROM mirror"""
VIEWS["firsts"] = """
SELECT video_id, min(line) AS line, arg_min(account_type, line) AS account_type,
  arg_min(creator_username, line) AS creator_username, count(*) AS lines
FROM keyed WHERE video_id IS NOT NULL GROUP BY video_id"""
VIEWS["collected"] = """
SELECT '' || (c_custkey + 7000000) AS video_id FROM customer WHERE c_acctbal < 0"""
VIEWS["talk"] = f"""
SELECT 'v' || (conv_id // 10) AS aweme_id, conv_id || '-' || turn AS comment_id,
  turn > 0 AS is_reply, CASE WHEN turn > 0 THEN conv_id || '-0' END AS parent_comment_id,
  role || (conv_id % 9) AS username, CASE WHEN turn % 2 = 1 THEN role END AS nickname,
  CASE WHEN conv_id % 5 = 0 THEN '=' || text ELSE text END AS comment,
  strftime(make_timestamp((conv_id * 3600 + turn * 60 + 1700000000) * 1000000), {ISO})
    AS create_time,
  CASE WHEN turn % 3 <> 2 THEN length(text) END AS digg_count,
  conv_id * 1000 + turn AS seq, conv_id, turn, conv_id // 10 AS video_no
FROM conversations"""
VIEWS["landed"] = """
SELECT 'v' || (conv_id // 10) AS video_id, conv_id, turn, conv_id || '-' || turn AS comment_id,
  role || (conv_id % 9) AS username,
  CASE WHEN (conv_id + turn) % 7 = 0 THEN '  ' ELSE text END AS comment,
  CASE WHEN conv_id % 97 = 96 THEN NULL ELSE conv_id * 3600 + turn * 60 + 1700000000 END AS epoch,
  length(text) AS digg_count, CASE WHEN turn = 0 THEN 1 ELSE 0 END AS total_reply
FROM conversations"""
VIEWS["preds"] = """
SELECT 'c' || doc_id AS comment_id, 'model-' || m AS model, doc_id, truth,
  'LABEL_' || CASE WHEN (doc_id * 31 + m * 17) % 10 < 3 - m THEN (truth + 1) % 3 ELSE truth END
    AS raw_label,
  0.40::DOUBLE + ((doc_id * 37 + m * 11) % 60)::DOUBLE / 100.0::DOUBLE AS confidence
FROM (SELECT doc_id, CASE WHEN toxic = 1 THEN 2 WHEN quality = 1 THEN 0 ELSE 1 END AS truth,
  unnest([0, 1]) AS m FROM labels)"""
VIEWS["base"] = f"""
SELECT p.*, d.text, CASE WHEN {strip('d.text')} = '' THEN 'netral' ELSE
  CASE lower(raw_label) WHEN 'label_0' THEN 'positif' WHEN 'label_1' THEN 'netral'
  WHEN 'label_2' THEN 'negatif' END END AS base_label,
  CASE WHEN {strip('d.text')} = '' THEN 1.0::DOUBLE ELSE {rnd('p.confidence', 4)} END
    AS base_confidence
FROM preds p JOIN documents d ON p.doc_id = d.doc_id"""
VIEWS["pairs"] = """
SELECT p.model, p.comment_id, p.confidence,
  CASE WHEN p.doc_id % 11 = 0 THEN 'netral' ELSE
    CASE lower(raw_label) WHEN 'label_0' THEN 'positif' WHEN 'label_1' THEN 'netral'
    WHEN 'label_2' THEN 'negatif' END END AS label,
  CASE truth WHEN 2 THEN 'negatif' WHEN 0 THEN 'positif' ELSE 'netral' END AS truth
FROM preds p JOIN documents d ON p.doc_id = d.doc_id"""

NEEDS = {
    "cleaned": ["posts"],
    "short_runs": ["cleaned"],
    "normalized": ["cleaned", "short_runs"],
    "tokenized": ["normalized"],
    "tiered": ["tokenized", "accounts"],
    "tier_posts": ["posts", "accounts"],
    "marked": ["event_comments"],
    "keyed": ["mirror"],
    "firsts": ["keyed"],
    "base": ["preds"],
    "pairs": ["preds"],
}


def query(views: str, body: str, **extra: str) -> str:
    """A statement with the named views and extra CTEs in front."""
    order: list[str] = []

    def need(name: str) -> None:
        for other in NEEDS.get(name, []):
            need(other)
        if name not in order:
            order.append(name)

    for name in views.split():
        need(name)
    parts = [f"{n} AS ({VIEWS[n]})" for n in order]
    parts += [f"{n} AS ({text})" for n, text in extra.items()]
    return f"WITH {', '.join(parts)} {body}" if parts else body
