"""Staging-layer operators (P1-P16, F2/F3, W1, S2) applied to a raw table: typed and
safe casts, blank normalisation, ordered classification, epoch and multi-format date
parsing, bands, surrogate keys, NULL-preserving exclusion and latest-row de-dup."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators.windows import dedup_latest
from ..sources import union_sources
from .common import finalize, load, sql_date, sql_ts

# Event classification rules (first match wins) and value bands.
CLASS_RULES = [("purchase", "conversion"), ("signup", "acquisition"), ("error", "error")]
VALUE_EDGES = [10, 50, 100]
VALUE_LABELS = ["low", "medium", "high", "very high"]


def staged_events(spark, d):
    e = load(spark, d, "events")
    # Two "accounts" of the same stream, labelled, then W1 keeps one row per event id
    tagged = union_sources({"primary": e, "replica": e}, tag="source_account")
    latest = dedup_latest(tagged, ["event_id"], ["source_account"])
    band_label, band_order = C.band(F.col("value"), VALUE_EDGES, VALUE_LABELS)
    # Typed projection; a value that can't be read as its type is NULL, not an error
    latest = latest.withColumn("_k", F.get_json_object("props", "$.k"))
    latest = C.typed(latest, {**{c: (c, t) for c, t in latest.drop("_k").dtypes}, "k": ("_k", "int")}, safe=True)
    typed = latest.select(
        "event_id", "user_id", "ts", "source_account", "k",
        C.clean_text(F.col("event_type"), "upper").alias("event_name"),
        C.classify([(F.col("event_type") == k, v) for k, v in CLASS_RULES], "engagement").alias("event_class"),
        C.from_epoch(F.unix_millis(F.col("ts").cast("timestamp")), "ms").alias("ts_ms"),
        C.parse_date_any(F.date_format("ts", "dd/MM/yyyy"), ["yyyy-MM-dd", "dd/MM/yyyy"]).alias("event_date"),
        band_label.alias("value_band"), band_order.alias("value_band_order"),
        C.make_key("user_id", "event_id").alias("event_key"),
        C.exclude(F.col("event_type"), ["error"]).alias("is_not_error"),
        C.parse_hhmm(F.date_format("ts", "H:mm")).alias("minute_of_day"))
    return finalize(typed.drop("ts"))


# URL and HTML patterns of the page staging model.
DOMAIN_PATTERN = r"^https?://([^/?#]+)"
LANG_PATTERN = r"/(en|de|fr|es)/"
TITLE_PATTERN = r"<title>(.*?)</title>"
HREF_PATTERN = 'href="([^"]+)"'


def staged_pages(spark, d):
    p = load(spark, d, "pages")
    path = F.regexp_replace(F.regexp_replace(F.col("url"), r"^https?://[^/?#]+", ""), r"[?#].*$", "")
    return p.select(
        "page_id",
        F.lower(F.regexp_extract("url", DOMAIN_PATTERN, 1)).alias("domain"),
        C.clean_text(F.regexp_extract("url", LANG_PATTERN, 1)).alias("url_lang"),
        F.startswith(F.col("url"), F.lit("https")).alias("is_https"),
        F.size(F.filter(F.split(path, "/"), lambda x: x != "")).alias("path_depth"),
        C.clean_text(F.regexp_extract("html", TITLE_PATTERN, 1)).alias("title"),
        F.size(C.extract_all("html", HREF_PATTERN)).alias("link_count"),
        F.length("html").alias("html_chars"))


QUERIES = {"staged_events": staged_events, "staged_pages": staged_pages}

ORACLE = {
    "staged_pages": r"""
SELECT page_id, lower(regexp_extract(url, '^https?://([^/?#]+)', 1)) AS domain,
       NULLIF(trim(regexp_extract(url, '/(en|de|fr|es)/', 1)), '') AS url_lang,
       starts_with(url, 'https') AS is_https,
       CAST(len(list_filter(string_split(regexp_replace(regexp_replace(url, '^https?://[^/?#]+', ''), '[?#].*$', ''), '/'),
                            lambda x: x <> '')) AS INTEGER) AS path_depth,
       NULLIF(trim(regexp_extract(html, '<title>(.*?)</title>', 1)), '') AS title,
       CAST(len(regexp_extract_all(html, 'href="([^"]+)"', 1)) AS INTEGER) AS link_count,
       CAST(length(html) AS INTEGER) AS html_chars
FROM pages
""",
    "staged_events": f"""
SELECT event_id, user_id, 'replica' AS source_account,
       NULLIF(upper(trim(event_type)), '') AS event_name,
       CASE {" ".join(f"WHEN event_type = '{k}' THEN '{v}'" for k, v in CLASS_RULES)} ELSE 'engagement' END AS event_class,
       TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
       {sql_ts("make_timestamp((epoch_us(ts) // 1000) * 1000)")} AS ts_ms,
       {sql_date('CAST(ts AS DATE)')} AS event_date,
       CASE WHEN value IS NULL THEN NULL WHEN value <= 10 THEN 'low' WHEN value <= 50 THEN 'medium' WHEN value <= 100 THEN 'high'
            ELSE 'very high' END AS value_band,
       CASE WHEN value IS NULL THEN 5 WHEN value <= 10 THEN 1 WHEN value <= 50 THEN 2 WHEN value <= 100 THEN 3 ELSE 4 END
         AS value_band_order,
       CAST(user_id AS VARCHAR) || ':' || CAST(event_id AS VARCHAR) AS event_key,
       event_type IS NULL OR event_type NOT IN ('error') AS is_not_error,
       CAST(hour(ts) * 60 + minute(ts) AS INTEGER) AS minute_of_day
FROM events
""",
}
