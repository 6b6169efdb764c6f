"""Events enriched with the articles that report them.

Two ways lead from an event to articles: lists of event ids packed into a column
(direct), and a bridge of mentions (two hops).  Both keep the many-to-many structure.
Nothing is collected: small samples are broadcast by Spark's own measure, large ones
are joined by sorting, with runtime filters on the large side.
"""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.specs import spec

log = logging.getLogger(__name__)

#: Where a row stood in the raw files, as the ingest writes it.
PLACE = ("_src_file", "_src_row")
RECORD_MODES = ("all", "latest", "earliest")
#: Optional columns of mentions that come along.
MENTION_EXTRA = ("MentionTimeDate", "Confidence")
#: First days, yyyymmdd, on which either kind of article table has rows.
DIRECT_SINCE, BRIDGE_SINCE = spec("gkg_v1").coverage_start, spec("gkg_v2").coverage_start


def require(df: DataFrame, *columns: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")


def _chosen(df: DataFrame, columns: list[str] | None, always: str) -> list[str]:
    if columns is None:
        return [c for c in df.columns if c not in PLACE]
    unknown = set(columns) - set(df.columns)
    if unknown:
        raise ValueError(f"unknown columns: {sorted(unknown)}")
    return [c for c in df.columns if c in columns or c == always]


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def id_text(c: Column) -> Column:
    """Ids are compared as text: "01001" is not 1001."""
    return c.cast("bigint").cast("string")


def explode_ids(articles: DataFrame, ids_col: str = "EventIds", delimiter: str = ",") -> DataFrame:
    """A row for each id in the packed column, as `_event_id`; repeats stay, null lists give none."""
    return articles.withColumn("_event_id", F.explode(F.split(_q(ids_col), delimiter))).withColumn("_event_id", F.btrim("_event_id", F.lit(" \t\r\n")))


def direct(events: DataFrame, articles: DataFrame, columns: list[str] | None = None, event_id: str = "GlobalEventID", ids_col: str = "EventIds", prefix: str = "GKG_") -> DataFrame:
    """A row for each event, article and occurrence of the event's id in the article's list.

    Event columns, then the chosen article columns with a prefix, the list always among them.
    """
    require(events, event_id)
    require(articles, ids_col)
    chosen = _chosen(articles, columns, ids_col)
    keyed = events.withColumn("_event_id", id_text(_q(event_id)))
    out = [*(_q(c) for c in events.columns), *(_q(prefix + c) for c in chosen)]
    payload = [_q(c).alias(prefix + c) for c in chosen]
    if (placed := _addressed(articles)) is None:  # no files behind it: a small table of the caller's
        return keyed.join(explode_ids(articles, ids_col).select("_event_id", *payload), "_event_id").select(*out)
    # only (place, id) is exploded; an article's payload moves once, and only if one of its ids is wanted
    ids = explode_ids(placed.select(*ADDRESS, _q(ids_col)), ids_col).select(*ADDRESS, "_event_id")
    hits = ids.join(keyed.select("_event_id").distinct(), "_event_id", "left_semi")
    wanted = placed.select(*ADDRESS, *payload).join(hits.select(*ADDRESS).distinct(), list(ADDRESS), "left_semi")
    return keyed.join(hits, "_event_id").join(wanted, list(ADDRESS)).select(*out)


#: A row's place in the Parquet files read: unique, and cheap to read.
ADDRESS = ("_at_file", "_at_row")


def _addressed(df: DataFrame) -> DataFrame | None:
    """The table with each row's place in its files; None if it isn't read straight from files."""
    hidden = df._jdf.queryExecution().analyzed().metadataOutput()  # asked, since a failed selection is logged as an error
    if "_metadata" not in (hidden.apply(i).name() for i in range(hidden.size())):
        return None
    return df.select("*", F.col("_metadata.file_path").alias(ADDRESS[0]), F.col("_metadata.row_index").alias(ADDRESS[1]))


def collapse_mentions(mentions: DataFrame, keys: tuple[str, str], best: str | None, ties: list[Column], count_as: str = "Mention_Count") -> DataFrame:
    """One mention of each (event, document): of highest `best`, nulls last, ties by the given order; and how many there were.

    Both come from one window, so mentions are shuffled once.  Null keys go.
    """
    order = [*([_q(best).desc_nulls_last()] if best else []), *ties]
    pair = Window.partitionBy(*map(_q, keys))
    rows = mentions.where(_q(keys[0]).isNotNull() & _q(keys[1]).isNotNull())
    ranked = rows.withColumn(count_as, F.count("*").over(pair)).withColumn("_rank", F.row_number().over(pair.orderBy(*order)))
    return ranked.where("_rank = 1").drop("_rank")


def one_record(articles: DataFrame, key: str, mode: str, order: list[Column]) -> DataFrame:
    """All records of a document, or the last or first in an order (columns, ascending)."""
    if mode not in RECORD_MODES:
        raise ValueError(f"records are chosen by one of {RECORD_MODES}")
    if mode == "all":
        return articles
    by = [c.desc() if mode == "latest" else c.asc() for c in order]
    w = Window.partitionBy(_q(key)).orderBy(*by)
    return articles.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def file_order() -> list[Column]:
    """Order of records by file name, then by row; for tables just read from Parquet."""
    return [F.col("_metadata.file_name"), F.col("_metadata.row_index")]


def with_file_order(df: DataFrame) -> DataFrame:
    """Carry a row's place through later shuffles, as _src_file and _src_row; a table that has these from its ingest keeps them."""
    if set(PLACE) <= set(df.columns):
        return df
    name, row = file_order()
    return df.select("*", name.alias("_src_file"), row.alias("_src_row"))


def two_hop(
    events: DataFrame, mentions: DataFrame, articles: DataFrame, columns: list[str] | None = None, on_duplicate_document: str = "all", dedupe_mentions: bool = False,
    event_id: str = "GlobalEventID", mention_event: str = "GLOBALEVENTID", mention_doc: str = "MentionIdentifier", article_doc: str = "V2DOCUMENTIDENTIFIER",
    best: str = "Confidence", extra: tuple[str, ...] = MENTION_EXTRA, mention_ties: list[Column] | None = None, record_order: list[Column] | None = None, prefix: str = "GKG_",
) -> DataFrame:
    """Events to mentions to articles, inner at both hops.

    Event columns, Mention_<c> for those extras that there are, Mention_Count if
    mentions are collapsed, then the article columns with a prefix.  Without given
    orders, ties and records go by the place in the files read.
    """
    require(events, event_id)
    require(mentions, mention_event, mention_doc)
    require(articles, article_doc)
    if on_duplicate_document not in RECORD_MODES:
        raise ValueError(f"records are chosen by one of {RECORD_MODES}")
    chosen = _chosen(articles, columns, article_doc)
    extras = [c for c in extra if c in mentions.columns]
    if dedupe_mentions and mention_ties is None:
        mentions, mention_ties = with_file_order(mentions), list(map(_q, PLACE))
    bridge = mentions_of(mentions, events, event_id, mention_event)
    if dedupe_mentions:
        bridge = collapse_mentions(bridge, (mention_event, mention_doc), best if best in mentions.columns else None, mention_ties)
    counted = ["Mention_Count"] if dedupe_mentions else []
    bridge = bridge.select(_q(mention_event).alias("_m_event"), _q(mention_doc).alias("_m_doc"), *(_q(c).alias(f"Mention_{c}") for c in extras), *counted)
    if on_duplicate_document != "all":
        if record_order is None:
            articles, record_order = with_file_order(articles), list(map(_q, PLACE))
        # only documents that the sample's mentions name are ranked
        articles = articles.join(bridge.select("_m_doc").distinct(), _q(article_doc) == _q("_m_doc"), "left_semi")
        articles = one_record(articles, article_doc, on_duplicate_document, record_order)
    right = articles.select(*(_q(c).alias(prefix + c) for c in chosen))
    joined = events.join(bridge, _q(event_id) == _q("_m_event")).join(right, _q("_m_doc") == _q(prefix + article_doc))
    return joined.select(*(_q(c) for c in events.columns), *(_q(f"Mention_{c}") for c in extras), *counted, *(_q(prefix + c) for c in chosen))


def mentions_of(mentions: DataFrame, events: DataFrame, event_id: str = "GlobalEventID", mention_event: str = "GLOBALEVENTID") -> DataFrame:
    """The mentions of the given events, each as it was."""
    ids = events.select(_q(event_id).alias("_wanted")).distinct()
    return mentions.join(ids, _q(mention_event) == _q("_wanted"), "left_semi")


def pair_counts(mentions: DataFrame, event: str = "GLOBALEVENTID", doc: str = "MentionIdentifier") -> DataFrame:
    """(event, document, n): how often each pair is mentioned; null keys go."""
    return mentions.where(_q(event).isNotNull() & _q(doc).isNotNull()).groupBy(_q(event), _q(doc)).agg(F.count("*").alias("n"))


def distinct_keys(df: DataFrame, column: str) -> DataFrame:
    """The different values of a column, without null."""
    return df.where(_q(column).isNotNull()).select(_q(column)).distinct()


def fan_out(pairs: DataFrame, key: str, other: str) -> DataFrame:
    """(key, n): how many different values of `other` stand beside each key."""
    return pairs.where(_q(key).isNotNull()).groupBy(_q(key)).agg(F.count_distinct(_q(other)).alias("n"))


def eligible(events: DataFrame, added: str = "DATEADDED", since: int | None = DIRECT_SINCE) -> DataFrame:
    """Events added since a day; a null day is not eligible."""
    return events.where(_q(added) >= since)


def both(direct_rows: DataFrame, two_hop_rows: DataFrame, source_col: str = "CrossrefSource") -> DataFrame:
    """Rows of both ways, tagged v1 and v2; columns of one alone are null in the other's rows."""
    return direct_rows.withColumn(source_col, F.lit("v1")).unionByName(two_hop_rows.withColumn(source_col, F.lit("v2")), allowMissingColumns=True)


def auto(events: DataFrame, articles_v1: DataFrame, mentions: DataFrame, articles_v2: DataFrame, v1_columns: list[str] | None = None, v2_columns: list[str] | None = None, added: str = "DATEADDED", **options) -> DataFrame:
    """Both ways for the events that either can know; an event may match by both."""
    rows = eligible(events, added) if added in events.columns else events
    return both(direct(rows, articles_v1, v1_columns), two_hop(rows, mentions, articles_v2, v2_columns, **options))


def unmatched(events: DataFrame, mentions: DataFrame, event_id: str, mention_event: str) -> DataFrame:
    """Events that no mention names."""
    keys = mentions.select(_q(mention_event).alias("_k"))
    return events.join(keys, _q(event_id) == _q("_k"), "left_anti")


def coverage(events: DataFrame, added: str, since: int) -> DataFrame:
    """One row: events with a day, and those from before the coverage."""
    return events.agg(F.count(_q(added)).alias("n_dated"), F.count_if(_q(added) < since).alias("n_too_old"))


def warn_coverage(events: DataFrame, added: str, since: int) -> str | None:
    """Asks for a count, so only on request: a warning if all or some events predate the coverage."""
    n, old = coverage(events, added, since).first()
    if not n or not old:
        return None
    message = f"{'all' if old == n else old} of {n} events were added before {since}, when coverage begins"
    log.warning(message)
    return message


def warn_events_input(events: DataFrame, limit: int = 1_000_000) -> str | None:
    """A warning if very many events are to be joined: a sample is meant."""
    if not is_large(events, limit):
        return None
    message = f"more than {limit} events are to be joined with their articles; a sample makes the result smaller"
    log.warning(message)
    return message


#: Raw files of a table from which on listing them is slow.
LARGE_FOLDER = 50_000


def warn_folder(n_files: int, name: str, windowed: bool, limit: int = LARGE_FOLDER) -> str | None:
    """A warning if a table of very many raw files is read without a window of days."""
    if windowed or n_files <= limit:
        return None
    message = f"{name} comes from {n_files} files; a window of days makes the join read fewer"
    log.warning(message)
    return message


def is_large(df: DataFrame, limit: int = 1_000_000) -> bool:
    """Are there more rows than this?  Stops counting there."""
    return df.limit(limit + 1).count() > limit


def pruned_keys(dataset: str, output_columns: list[str] | None) -> list[str]:
    """Join keys of a dataset that a choice of columns would lose."""
    return [c for c in spec(dataset).required if output_columns and c not in output_columns]
