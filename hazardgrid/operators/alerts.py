"""Weather alerts: feed links, CAP documents, province mapping, daily roll-up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardgrid import constants as C
from hazardgrid import schemas
from hazardgrid.functions import lookups, times
from hazardgrid.functions.staging import evaluate_once
from hazardgrid.functions.text import (
    alert_identifier,
    closes_root,
    fold_texts,
    namespace_of,
    resolve_link,
    root_tag,
    strip_ws,
    text_or_null,
    xml_text,
)

_XML = {"ignoreNamespace": "true"}

PARSED, MALFORMED, NO_INFO, NO_DATE = "PARSED", "MALFORMED_XML", "NO_INFO", "NO_INGESTION_DATE"


# What a whole document consists of: plain text, tags, comments, literal text, instructions.
_QUOTED = r"""[^"'>]*+(?:"[^"]*+"[^"'>]*+|'[^']*+'[^"'>]*+)*+>"""
_TOKEN = rf"""(?s)[^<]++|<(?:[^!?"'>]{_QUOTED}|!--.*?-->|!\[CDATA\[.*?\]\]>|\?.*?\?>|!{_QUOTED})"""

# A token is a comment or instruction (0), text (1), literal text (2), an end tag (3), or
# the start of an item (5), a link (6) or another element (4).
#
# Tokens are read with the open elements on a stack of 10 characters each: the number of
# an item, or dashes for all else, an item whose first link child has begun among it. That
# link's text goes straight out, behind the item's number and a character XML cannot hold.
_OTHER = "'----------'"
_TOP = f"right(s.open, 10) not in ('', {_OTHER})"
_READ = f"""aggregate(
  transform(regexp_extract_all(_text, _token, 0), t -> struct(t as text,
    case when t not like '<%' then 1 when t like '</%' then 3 when t like '<![CDATA[%' then 2 when t like '<!%' or t like '<?%' then 0
      when t rlike '^<[^\\\\s/>]*item[\\\\s/>]' then 5 when t rlike '^<[^\\\\s/>]*link[\\\\s/>]' then 6 else 4 end as kind)),
  named_struct('open', '', 'taking', false, 'items', 0, 'out', ''),
  (s, t) -> case
    when t.kind = 0 or (t.kind < 3 and not s.taking) then s
    when t.kind = 3 then
      named_struct('open', left(s.open, length(s.open) - 10), 'taking', false, 'items', s.items, 'out', s.out)
    when t.kind < 3 then named_struct('open', s.open, 'taking', true, 'items', s.items, 'out',
      s.out || if(t.kind = 1, t.text, replace(replace(substring(t.text, 10, length(t.text) - 12), '&', '&amp;'), '<', '&lt;')))
    when t.kind = 6 and {_TOP} then
      named_struct('open', left(s.open, length(s.open) - 10) || if(t.text like '%/>', {_OTHER}, {_OTHER} || {_OTHER}),
        'taking', t.text not like '%/>', 'items', s.items, 'out', s.out || '\\u0001' || right(s.open, 10))
    else
      named_struct('open', s.open || case when t.text like '%/>' then '' when t.kind = 5 then lpad(s.items, 10, '0') else {_OTHER} end,
        'taking', false, 'items', s.items + if(t.kind = 5, 1, 0), 'out', s.out)
  end,
  s -> transform(split(s.out, '\\u0001'), e -> struct(cast(nullif(left(e, 10), '') as int) as item, substring(e, 11) as link)))"""


def _read_feeds(feeds: DataFrame, content: str) -> DataFrame:
    """Feeds with their text (null without), and whether it is one whole document."""
    keep = [c for c in feeds.columns if c != content]
    text = F.col("_text")
    read = feeds.select(*keep, F.explode(F.array(xml_text(F.col(content)))).alias("_text")).withColumn(
        "_tag", root_tag(text)
    )
    # A document that is cut off or not well formed has no elements under its root.
    parsed = F.from_xml(text, "_any STRING", {**_XML, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_any"})
    whole = F.coalesce(closes_root(text, F.col("_tag")) & parsed["_any"].isNull(), F.lit(False))
    return read.select(*keep, "_text", F.explode(F.array(whole)).alias("_whole"))


def feed_links(feeds: DataFrame, feed_url: str, content: str = "content") -> DataFrame:
    """One row per feed item, at any depth and in any namespace, that links to an alert document.

    Items may hold items; each counts for itself, numbered in the order they begin. The
    first link child of an item counts, up to the first tag inside it; an item whose
    first link is empty is dropped, one of white space alone links to the feed. Links
    are resolved against the feed's own address. Feeds that are no whole document yield
    no rows; ``feed_rejects`` has them.
    """
    keep = [c for c in feeds.columns if c != content]
    text = F.col("_done.link")
    options = {**_XML, "ignoreSurroundingSpaces": "false"}
    # The reader is only for what it would change or refuse: references, line ends, ends of literal text.
    marked = text.contains("&") | text.contains("\r") | text.contains("]]>")
    read = F.from_xml(F.concat(F.lit("<item><link>"), text, F.lit("</link></item>")), schemas.FEED_ITEM, options)
    link = F.when(marked, F.get(read["link"], F.lit(0))).otherwise(text)
    return (
        _read_feeds(feeds, content)
        .filter("_whole")
        .withColumn("_token", F.lit(_TOKEN))
        # On its own first: for a generator Spark infers filters that read the text again.
        .select(*keep, F.explode(F.array(F.expr(_READ))).alias("_links"))
        .select(*keep, F.explode("_links").alias("_done"))
        .filter("_done.link <> ''")
        .select(*keep, F.col("_done.item").alias("item_pos"), strip_ws(F.coalesce(link, F.lit(""))).alias("_link"))
        .withColumn("url", resolve_link(feed_url, F.col("_link")))
        .withColumn("identifier", alert_identifier(F.col("url")))
        .select(*keep, "item_pos", "url", "identifier")
    )


def feed_rejects(feeds: DataFrame, content: str = "content") -> DataFrame:
    """Feeds that are no whole document, with the reason."""
    keep = [c for c in feeds.columns if c != content]
    reason = F.when(F.col("_text").isNull(), "UNDECODABLE").otherwise(MALFORMED)
    return _read_feeds(feeds, content).filter("NOT _whole").select(*keep, reason.alias("parse_status"))


def parse_alerts(objects: DataFrame) -> DataFrame:
    """Landed CAP objects (``path``, ``content``) to one row per object.

    ``parse_status`` tells good documents from the ones to set aside; nothing
    about a bad document stops the job. The analytic date is the ingestion
    date found in the path, whatever validity period the alert states.
    """
    stamp = F.nullif(F.regexp_extract("path", C.INGESTION_DATE_PATTERN, 1), F.lit(""))
    # The document is taken apart once: later filters on parsed fields are not
    # pushed down together with a copy of the parser.
    text = F.col("_text")
    document = F.when(F.col("_closed"), F.from_xml(text, schemas.CAP_DOCUMENT, _XML))
    info = F.get("_cap.info", F.lit(0))
    area = F.get(info["area"], F.lit(0))
    status = (
        F.when(F.col("ingestion_date").isNull(), NO_DATE)
        .when(F.col("_cap.identifier").isNull() & F.col("_cap.info").isNull(), MALFORMED)
        .when(info.isNull() | ~F.col("_in_namespace"), NO_INFO)
        .otherwise(PARSED)
    )
    read = evaluate_once(objects, "_text", xml_text(F.col("content"))).select("path", "_text")
    opened = (
        read.withColumn("_tag", root_tag(text))
        .withColumn("_closed", closes_root(text, F.col("_tag")))
        .withColumn("ingestion_date", stamp.try_cast("date"))
        .withColumn("_in_namespace", namespace_of(F.col("_tag")) == C.CAP_NAMESPACE)
    )
    return (
        evaluate_once(opened, "_cap", document)
        .select(
            "path",
            "ingestion_date",
            status.alias("parse_status"),
            text_or_null(F.col("_cap.identifier")).alias("identifier"),
            *[
                text_or_null(info[name]).alias(name)
                for name in (
                    "event", "urgency", "severity", "certainty",
                    "effective", "expires", "headline", "description",
                )
            ],
            lookups.normalize_area(area["areaDesc"]).alias("area_desc"),
            text_or_null(area["polygon"]).alias("polygon"),
        )
    )


def rejected_alerts(parsed: DataFrame) -> DataFrame:
    """Objects that yielded no alert, with the reason."""
    return parsed.filter(F.col("parse_status") != PARSED).select("path", "ingestion_date", "parse_status")


def map_alerts(parsed: DataFrame, provinces: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """Alerts in provinces with an operating city, as weather-risk records.

    ``provinces`` is left without a join hint: the fixed table is a literal
    relation Catalyst broadcasts by its known size, and a larger table read
    from storage is broadcast or shuffled depending on its statistics.
    """
    return (
        parsed.filter(F.col("parse_status") == PARSED)
        .join(provinces, "area_desc", "inner")
        .select(
            F.col("ingestion_date").alias("event_date"),
            "city",
            lookups.severity_risk(F.col("severity")).alias("weather_risk"),
            F.lit(1).cast("bigint").alias("active_weather_alerts"),
            F.col("identifier").alias("bmkg_alert_id"),
            F.col("event").alias("weather_event"),
            "severity",
            "urgency",
            "certainty",
            "area_desc",
            "effective",
            "expires",
            "headline",
            (F.current_timestamp() if processed_at is None else processed_at).alias("processed_at"),
            "path",
        )
    )


def unmapped_alerts(parsed: DataFrame, provinces: DataFrame) -> DataFrame:
    """Parsed alerts whose province has no operating city."""
    return (
        parsed.filter(F.col("parse_status") == PARSED)
        .join(provinces, "area_desc", "left_anti")
        .select("path", "ingestion_date", "identifier", "area_desc")
    )


_FIRST_RECORD = [
    "bmkg_alert_id", "severity", "urgency", "certainty", "area_desc",
    "effective", "expires", "headline", "processed_at",
]


def weather_events_daily(mapped: DataFrame) -> DataFrame:
    """One row per date, city and event: highest risk, alert count, path and details of the first alert.

    A city with very many alerts is spread over its events and map-side combined.
    """
    first = F.struct("path", *_FIRST_RECORD)
    return (
        mapped.groupBy("event_date", "city", "weather_event")
        .agg(
            F.max("weather_risk").alias("weather_risk"),
            F.sum("active_weather_alerts").alias("active_weather_alerts"),
            F.min(first).alias("_first"),
        )
        .select(
            "event_date",
            "city",
            "weather_event",
            "weather_risk",
            "active_weather_alerts",
            F.col("_first.path").alias("first_path"),
            *[f"_first.{c}" for c in _FIRST_RECORD],
        )
    )


def weather_signal(mapped: DataFrame) -> DataFrame:
    """(event_date, city, weather_risk, active_weather_alerts): what the risk mart needs, in one shuffle.

    Takes alerts or events of days alike.
    """
    return mapped.groupBy("event_date", "city").agg(
        F.max("weather_risk").alias("weather_risk"),
        F.sum("active_weather_alerts").alias("active_weather_alerts"),
    )


def weather_daily(mapped: DataFrame) -> DataFrame:
    """One row per date and city: highest risk, alert count, first alert's details."""
    return fold_events(weather_events_daily(mapped))


def fold_events(events: DataFrame) -> DataFrame:
    """Events of days as one row per date and city, the form of the hand-over.

    ``weather_event`` lists the events in the order of their first paths, leaving out
    any that the list already contains as text. A repeated event can never add to that
    list, so one row per event is enough and only distinct texts meet here.
    """
    first = F.struct(F.col("first_path").alias("path"), *_FIRST_RECORD)
    texts = F.sort_array(F.collect_list(F.struct("first_path", "weather_event")))
    return (
        events.groupBy("event_date", "city")
        .agg(
            F.max("weather_risk").alias("weather_risk"),
            F.sum("active_weather_alerts").alias("active_weather_alerts"),
            F.min(first).alias("_first"),
            fold_texts(F.transform(texts, lambda e: e["weather_event"])).alias("weather_event"),
        )
        .select(
            "event_date",
            "city",
            "weather_risk",
            "active_weather_alerts",
            "_first.bmkg_alert_id",
            "weather_event",
            *[f"_first.{c}" for c in _FIRST_RECORD if c != "bmkg_alert_id"],
        )
    )


def weather_load_rows(daily: DataFrame) -> DataFrame:
    """Daily records in the shape of the environment-risk table.

    The headline is not kept, timestamps become instants, and the table's
    air-quality column belongs to another signal and is loaded empty.
    """
    as_instant = {
        c: (times.parse_iso(strip_ws(F.col(c))) if dict(daily.dtypes)[c] == "string" else F.col(c))
        for c in ("effective", "expires", "processed_at")
    }
    columns = {"air_quality_risk": F.lit(None).cast("double"), **as_instant}
    return daily.select(
        *[
            columns.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name)
            for f in schemas.ENVIRONMENT_RISK_DAILY
        ]
    )
