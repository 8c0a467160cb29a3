"""Schemas of the nested inputs and of the flat comment table."""

from __future__ import annotations

REPLY_FIELDS = (
    "comment_id string, username string, nickname string, comment string, "
    "create_time string, avatar string, digg_count bigint, total_reply bigint"
)
REPLY = f"struct<{REPLY_FIELDS.replace(' string', ':string').replace(' bigint', ':bigint')}>"
COMMENT = REPLY[:-1] + f", replies:array<{REPLY}>>"
VIDEO = (
    "aweme_id string, caption string, video_url string, account_type string, "
    "video_author_username string, scraped_at string, total_collected bigint, "
    f"has_more bigint, comments array<{COMMENT}>"
)

# One raw comment of a landed page. create_time stays text: a bad value has to
# be seen, not nulled unnoticed.
RAW_COMMENT = (
    "struct<cid:string, text:string, create_time:string, "
    "user:struct<unique_id:string, nickname:string, "
    "avatar_thumb:struct<url_list:array<string>>>, "
    "digg_count:bigint, reply_comment_total:bigint, "
    "share_info:struct<title:string, url:string>>"
)
PAGE = f"struct<comments:array<{RAW_COMMENT}>, has_more:bigint>"

FLAT_COLUMNS = (
    "comment_id", "video_id", "video_caption", "video_author_username", "is_reply",
    "parent_comment_id", "username", "text_raw", "create_time", "digg_count",
    "excluded", "exclude_reason", "seq",
)

# The month file of the collector, one line per comment or reply.
MONTH_COLUMNS = (
    "account_type", "aweme_id", "caption", "video_url", "video_author_username",
    "comment_id", "parent_comment_id", "is_reply", "username", "nickname",
    "comment", "create_time", "digg_count", "total_reply",
)

ANALYZED_COLUMNS = (
    "emoji_found", "text_clean", "tokens_stemmed",
    "sentiment_label", "sentiment_confidence", "sentiment_method",
)
LOG_SCHEMA = (
    "comment_id string, hybrid_enabled boolean, emoji_found array<string>, "
    "text_clean string, tokens_stemmed array<string>, sentiment_label string, "
    "sentiment_confidence double, sentiment_method string"
)
