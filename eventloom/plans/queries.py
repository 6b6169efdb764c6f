"""Registered queries: the operators applied to the given tables, with the SQL that says the same.

The tables stand in for the archive's: orders for events, lineitem for mentions, part for
articles; lineitem summed by part, with its order keys packed into a string, for the
articles with packed ids.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import coerce, tags
from ..operators import clean, codes, crossref, measures, predicate, sampling
from ..sources import ingest, listing, periods
from ..sources.specs import DatasetSpec
from . import manifest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    def register(f: Query) -> Query:
        QUERIES[name or f.__name__] = f
        if sql:
            ORACLES[name or f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def given(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def values(rows: list[tuple], name: str, columns: str) -> str:
    """The rows as an inline SQL table."""
    lit = lambda v: "NULL" if v is None else str(v) if isinstance(v, int) else "'" + v.replace("'", "''").replace("\t", "' || chr(9) || '") + "'"
    return f"(VALUES {', '.join('(' + ', '.join(map(lit, r)) + ')' for r in rows)}) AS {name}({columns})"


# Scans and ingest.


@query("SELECT l_orderkey, l_partkey, l_quantity FROM lineitem WHERE l_quantity > 45")
def scan_project(spark, d):
    return ingest.read_parquet_dir(spark, f"{d}/lineitem.parquet").where("l_quantity > 45").select("l_orderkey", "l_partkey", "l_quantity")


#: File names by orders' days, as SQL that both engines read: of all kinds, and some of no valid period.
_DATED = """(SELECT o_orderkey AS id, CAST(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) AS STRING) AS ymd,
    CAST(year(o_orderdate) * 100 + month(o_orderdate) AS STRING) AS ym, CAST(year(o_orderdate) AS STRING) AS y FROM orders) AS dated"""
_ENDINGS = (
    "ymd || '.export.CSV.zip'", "ymd || '.export.parquet'", "ymd || '.export_filtered.parquet'", "ym || '.zip'", "y || '.zip'", "ymd || '.gkg.csv.zip'", "ymd || '001500.gkg.csv.zip'",
    "ymd || '250000.mentions.CSV.zip'", "y || '13.parquet'", "y || '0230.export.parquet'", "'misc' || ymd || '.parquet'", "ymd || '120000.mentions.parquet'",
)
_NAMED = f"(SELECT id, CASE id % {len(_ENDINGS)} " + " ".join(f"WHEN {i} THEN {e}" for i, e in enumerate(_ENDINGS)) + f" END AS f FROM {_DATED}) AS named"


def both_sql(spark: SparkSession, d: str, sql: str) -> DataFrame:
    """SQL over orders that Spark and the other engine read alike; inlined, so that later expressions don't repeat it."""
    rows = spark.sql(sql.replace("FROM orders", "FROM {orders}"), orders=table(spark, d, "orders"))
    return rows.select(F.inline(F.array(F.struct(*rows.columns))))


_LIST_LINES = f"""(SELECT id, CASE id % 5 WHEN 0 THEN CAST(id AS STRING) || ' ' || upper(md5(f)) || ' http://x.org/v2/' || f WHEN 1 THEN '  ' || CAST(id AS STRING) || chr(9) || 'cc   http://x.org/v2/' || f || ' '
    WHEN 2 THEN '1x' || ' aa http://x.org/v2/' || f WHEN 3 THEN 'only ' || f ELSE '1 2 3 ' || f END AS line FROM {_NAMED}) AS lines"""


@query(
    rf"""SELECT p[3] AS url, lower(p[2]) AS md5, CASE WHEN regexp_full_match(p[1], '[0-9]{{1,18}}') THEN p[1] END AS size
    FROM (SELECT regexp_split_to_array(trim(line, ' ' || chr(9)), '\s+') AS p FROM {_LIST_LINES}) WHERE len(p) = 3 AND p[3] LIKE '%.gkg.csv.zip'"""
)
def scan_filelist(spark, d):
    lines = both_sql(spark, d, f"SELECT line AS value FROM {_LIST_LINES}")
    return listing.master_list(lines, "gkg_v2").withColumn("size", F.col("size").cast("string"))


_HTML_LINES = f"""(SELECT CASE id % 4 WHEN 0 THEN '<LI><A HREF="' || f || '">' || f || '</A> (1MB) (MD5: ' || upper(md5(f)) || ')' WHEN 1 THEN '<li><a href="https://x.org/e/' || f || '">m</a>'
    WHEN 2 THEN '<a href="/e/' || f || '">y</a> MD5: zz' ELSE 'no link to ' || f END AS line FROM {_NAMED}) AS lines"""


@query(
    rf"""WITH h AS (SELECT line, regexp_extract(line, '(?i)href=["'']?([^"'' >]+)', 1) AS href FROM {_HTML_LINES}),
    u AS (SELECT regexp_replace(CASE WHEN regexp_matches(href, '(?i)^https?://') THEN href ELSE 'http://x.org/e/' || ltrim(href, '/') END, '(?i)^https://', 'http://') AS url,
                 nullif(lower(regexp_extract(line, '(?i)MD5:?\s*([0-9a-f]{{32}})', 1)), '') AS md5 FROM h WHERE href <> '')
    SELECT * FROM u WHERE regexp_matches(regexp_extract(url, '([^/]+)$', 1), '{listing.FILE_PATTERNS["events"]}')"""
)
def html_links(spark, d):
    return listing.html_links(both_sql(spark, d, f"SELECT line AS value FROM {_HTML_LINES}"), "http://x.org/e", "events")


@query(f"SELECT 'h/' || f AS url, CASE WHEN f IN (SELECT f FROM {_NAMED} WHERE id % 7 < 3) THEN 'skip' ELSE 'fetch' END AS action FROM {_NAMED}")
def fetch_plan(spark, d):
    names = both_sql(spark, d, f"SELECT id, f FROM {_NAMED}")
    return listing.fetch_plan(names.select(F.concat(F.lit("h/"), "f").alias("url")), names.where("id % 7 < 3").select(F.col("f").alias("name")))


@query("SELECT count(*)::BIGINT AS n_files, sum(o_custkey)::BIGINT AS n_bytes, count(*) > 5000 AS large FROM orders")
def fetch_size(spark, d):
    return listing.fetch_size(table(spark, d, "orders").select(F.col("o_custkey").alias("size")))


LINE_SPEC = DatasetSpec("lines", "o_orderkey:b o_orderstatus o_custkey:b o_note", False, "daily", "", ())


@query(
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END AS o_orderstatus,
    CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_custkey::VARCHAR END AS o_custkey, CASE WHEN o_orderstatus <> 'P' THEN 'two' || chr(9) || 'parts' END AS o_note
    FROM orders WHERE o_orderpriority <> '5-LOW'"""
)
def tsv_parse(spark, d):
    o = table(spark, d, "orders")
    whole = F.concat_ws("\t", o.o_orderkey.cast("string"), o.o_orderstatus, o.o_custkey.cast("string"), F.lit('"two\tparts"'))
    line = F.when(o.o_orderpriority == "5-LOW", F.concat(whole, F.lit("\tmore"))).when(o.o_orderstatus == "P", o.o_orderkey.cast("string")).otherwise(whole)
    return ingest.parse_tsv(o.select(line.alias("value")), LINE_SPEC).withColumn("o_custkey", F.col("o_custkey").cast("string"))


_NUMBERS = """(SELECT o_orderkey, CASE o_orderkey % 12 WHEN 0 THEN k WHEN 1 THEN ' ' || k || '.5 ' WHEN 2 THEN 'n' || k WHEN 3 THEN '' WHEN 4 THEN k || 'e3' WHEN 5 THEN k || 'd' WHEN 6 THEN 'nan'
    WHEN 7 THEN '-.' || k WHEN 8 THEN '+' || k || '.' WHEN 9 THEN '0x' || k WHEN 10 THEN NULL ELSE '1,' || k END AS v FROM (SELECT o_orderkey, CAST(o_custkey AS STRING) AS k FROM orders) AS o) AS numbers"""


@query(rf"SELECT o_orderkey, CASE WHEN regexp_matches(trim(v), '{coerce.NUMBER}') THEN try_cast(rtrim(trim(v), '.') AS DOUBLE) END AS x FROM {_NUMBERS}")
def numeric_coerce(spark, d):
    return both_sql(spark, d, f"SELECT o_orderkey, v FROM {_NUMBERS}").select("o_orderkey", coerce.to_number(F.col("v")).alias("x"))


SPELLINGS = [(i, v) for i, v in enumerate([*coerce.NULL_SPELLINGS, "none", "Na", "0", "nil"])]
_SPELLED = f"(SELECT o_orderkey, i, v FROM orders JOIN {values(SPELLINGS, 't', 'i, v')} ON o_orderkey % {len(SPELLINGS)} = i) AS spelled"


@query(f"SELECT o_orderkey, CASE WHEN i < {len(coerce.NULL_SPELLINGS)} THEN NULL ELSE v END AS v FROM {_SPELLED}")
def na_strings(spark, d):
    return both_sql(spark, d, f"SELECT o_orderkey, v FROM {_SPELLED}").select("o_orderkey", coerce.null_spelled(F.col("v")).alias("v"))


_NAMES = _NAMED
_CLEAN = "regexp_replace(f, '_filtered\\.parquet$', '.parquet')"
_EVENTS_PERIOD = f"""SELECT f, coalesce(dd, mm, yy)::VARCHAR AS s, coalesce(dd, last_day(mm), last_day((yy + INTERVAL 11 MONTH)::DATE))::VARCHAR AS e FROM (
    SELECT f, try_strptime(nullif(regexp_extract(n, '^([0-9]{{8}})\\.export\\.(CSV\\.zip|csv\\.zip|CSV|csv|parquet)$', 1), ''), '%Y%m%d')::DATE AS dd,
    try_strptime(nullif(regexp_extract(n, '^([0-9]{{6}})\\.(zip|csv|CSV|parquet)$', 1), '') || '01', '%Y%m%d')::DATE AS mm,
    try_strptime(nullif(regexp_extract(n, '^([0-9]{{4}})\\.(zip|csv|CSV|parquet)$', 1), '') || '0101', '%Y%m%d')::DATE AS yy FROM (SELECT f, {_CLEAN} AS n FROM {_NAMES}))"""
_TYPE = "CASE " + " ".join(f"WHEN regexp_matches(f, '^[0-9]{{{n}}}[.]') THEN '{k}'" for n, k in ((14, "quarter_hourly"), (8, "daily"), (6, "monthly"), (4, "yearly"))) + " ELSE 'unknown' END"


def _files(spark: SparkSession, d: str, grammar: str = "events") -> DataFrame:
    s, e = periods.period_columns(F.col("f"), grammar)
    return both_sql(spark, d, f"SELECT f FROM {_NAMED}").select("f", s.alias("s"), e.alias("e"))


def _as_text(files: DataFrame) -> DataFrame:
    """Days as text, which every client shows alike."""
    return files.withColumns({c: F.col(c).cast("string") for c in ("s", "e") if c in files.columns})


@query(f"SELECT f, {_TYPE} AS kind FROM {_NAMES}")
def file_type(spark, d):
    return both_sql(spark, d, f"SELECT f FROM {_NAMED}").select("f", periods.file_type(F.col("f")).alias("kind"))


_HIVE = "SELECT o_orderkey, year(o_orderdate)::BIGINT AS \"Year\", (year(o_orderdate) * 100 + month(o_orderdate))::BIGINT AS \"MonthYear\" FROM orders WHERE o_orderstatus <> 'P'"


def _hive(spark, d):
    o, known = table(spark, d, "orders"), F.col("o_orderstatus") != "P"
    rows = o.select("o_orderkey", F.when(known, F.year("o_orderdate")).cast("bigint").alias("Year"), (F.year("o_orderdate") * 100 + F.month("o_orderdate")).cast("bigint").alias("MonthYear"))
    return clean.drop_nulls(rows, ["Year", "MonthYear"])


@query(_HIVE)
def hive_partition(spark, d):
    """Written in folders by year and month, and read back from there."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir() or tempfile.mkdtemp(prefix="eventloom-")
    path = f"{base.rstrip('/')}/hive-{uuid.uuid4().hex}"
    ingest.write_hive(_hive(spark, d), path, ["Year", "MonthYear"])
    back = spark.read.parquet(path)
    return back.select("o_orderkey", F.col("Year").cast("bigint").alias("Year"), F.col("MonthYear").cast("bigint").alias("MonthYear"))


@query(f'SELECT "Year", "MonthYear", count(*)::BIGINT AS n FROM ({_HIVE}) GROUP BY ALL')
def hive_partition_counts(spark, d):
    return measures.group_counts(_hive(spark, d), ["Year", "MonthYear"])


@query("SELECT 'orders.parquet' AS file, count(*)::BIGINT AS n FROM orders")
def file_row_counts(spark, d):
    return table(spark, d, "orders").groupBy(F.col("_metadata.file_name").alias("file")).agg(F.count("*").alias("n"))


#: Suppliers stand for files, their line items for the rows.
_COUNTS = "(SELECT 's' || CAST(100000 + l_suppkey AS STRING) AS file, count(*) AS n FROM lineitem GROUP BY l_suppkey) AS counts"
_INDEX = f"SELECT file, (sum(n) OVER (ORDER BY file) - n)::BIGINT AS start, (sum(n) OVER (ORDER BY file))::BIGINT AS stop FROM {_COUNTS}"


def _offsets(spark, d):
    files = table(spark, d, "lineitem").groupBy(F.concat(F.lit("s"), (F.lit(100000) + F.col("l_suppkey")).cast("string")).alias("file")).agg(F.count("*").alias("n"))
    return sampling.file_offsets(files)


@query(_INDEX)
def file_index(spark, d):
    return _offsets(spark, d)


@query(f"SELECT o_orderkey::BIGINT AS g, file, o_orderkey - start AS row FROM orders JOIN ({_INDEX}) i ON o_orderkey >= start AND o_orderkey < stop")
def index_lookup(spark, d):
    return sampling.locate(table(spark, d, "orders").select(F.col("o_orderkey").cast("bigint").alias("g")), _offsets(spark, d), bucket=1000)


@query(f"SELECT DISTINCT f AS path FROM {_NAMED} WHERE f NOT IN (SELECT f FROM {_NAMED} WHERE id % 3 = 0)")
def pending_files(spark, d):
    """Names marked done under this stage and these settings; others are marked for another stage or other settings."""
    names = both_sql(spark, d, f"SELECT id, f AS path FROM {_NAMED}")
    stage = F.when(F.col("id") % 3 == 2, "filter").otherwise("convert")
    done = names.select("path", stage.alias("stage"), F.when(F.col("id") % 3 == 1, "x=2").otherwise("x=1").alias("fingerprint"))
    return manifest.pending(names.select("path").distinct(), done, "convert", "x=1")


@query("SELECT 'columns=[a,b]' || chr(10) || 'compression=<none>' || chr(10) || 'dataset=events' AS print")
def fingerprint(spark, d):
    return given(spark, [(manifest.fingerprint(dataset="events", columns=["b", "a"], compression=None),)], "print string")


@query("SELECT 'p' || page_id AS name, md5(html) AS found, md5(html || 'x') AS md5 FROM pages WHERE page_id % 5 = 0")
def md5_verify(spark, d):
    """Every fifth page is listed with the checksum of something else, every seventh of the others without one."""
    p = table(spark, d, "pages")
    files = p.select(F.concat(F.lit("file:/x/p"), F.col("page_id").cast("string")).alias("path"), F.col("html").cast("binary").alias("content"))
    md5 = F.when(F.col("page_id") % 5 == 0, F.md5(F.concat("html", F.lit("x")))).when(F.col("page_id") % 7 != 0, F.upper(F.md5("html")))
    return listing.bad_checksums(files, p.select(F.concat(F.lit("http://h/p"), F.col("page_id").cast("string")).alias("url"), md5.alias("md5")))


# The filter language.

FILTERS: dict[str, tuple[dict, str]] = {
    "f_eq": ({"o_orderstatus": "F"}, "o_orderstatus = 'F'"),
    "f_in": ({"o_orderstatus": ["F", "P"]}, "o_orderstatus IN ('F', 'P')"),
    "f_gt": ({"o_totalprice": {"op": "gt", "value": 200000}}, "o_totalprice > 200000"),
    "f_lt": ({"o_totalprice": {"op": "lt", "value": 50000}}, "o_totalprice < 50000"),
    "f_between": ({"o_totalprice": {"op": "between", "min": 50000, "max": 100000}}, "o_totalprice BETWEEN 50000 AND 100000"),
    "f_range_pair": ({"o_custkey": (100, 700)}, "o_custkey BETWEEN 100 AND 700"),
    "f_equals_op": ({"o_orderpriority": {"op": "equals", "value": "1-URGENT"}}, "o_orderpriority = '1-URGENT'"),
    "f_in_op": ({"o_orderpriority": {"op": "in_list", "values": ["1-URGENT", "2-HIGH"]}}, "o_orderpriority IN ('1-URGENT', '2-HIGH')"),
    "f_and": ({"o_orderstatus": "F", "o_orderpriority": ["1-URGENT", "5-LOW"]}, "o_orderstatus = 'F' AND o_orderpriority IN ('1-URGENT', '5-LOW')"),
    "f_or": ({"OR": {"o_orderstatus": "P", "o_totalprice": {"op": "gt", "value": 300000}}}, "o_orderstatus = 'P' OR o_totalprice > 300000"),
    "f_nested_and_in_or": ({"OR": {"o_orderstatus": "P", "AND": {"o_orderstatus": "F", "o_orderpriority": "5-LOW"}}}, "o_orderstatus = 'P' OR (o_orderstatus = 'F' AND o_orderpriority = '5-LOW')"),
    "f_nested_or_in_and": ({"AND": {"o_orderpriority": ["1-URGENT", "2-HIGH"], "OR": {"o_orderstatus": "O", "o_custkey": {"op": "lt", "value": 100}}}}, "o_orderpriority IN ('1-URGENT', '2-HIGH') AND (o_orderstatus = 'O' OR o_custkey < 100)"),
    "f_deep": (
        {"o_totalprice": {"op": "gt", "value": 1000}, "OR": {"o_orderstatus": "F", "AND": {"o_orderpriority": "3-MEDIUM", "OR": {"o_custkey": {"op": "lt", "value": 500}, "o_orderstatus": ["O"]}}}, "AND": {}},
        "o_totalprice > 1000 AND (o_orderstatus = 'F' OR (o_orderpriority = '3-MEDIUM' AND (o_custkey < 500 OR o_orderstatus = 'O')))",
    ),
}


def _filter_query(block: dict) -> Query:
    def run(spark, d):
        return sampling.FilteredSampler(table(spark, d, "orders"), block, ["o_orderkey", "o_totalprice"], id_cols=("o_orderkey",)).all().select("o_orderkey", "o_totalprice")

    return run


for _name, (_block, _where) in FILTERS.items():
    query(f"SELECT o_orderkey, o_totalprice FROM orders WHERE {_where}", _name)(_filter_query(_block))


@query("SELECT l_orderkey, l_linenumber, l_extendedprice FROM (SELECT *, nullif(l_returnflag, 'N') AS flag FROM lineitem) WHERE flag IS NULL OR flag IN ('A')")
def f_in_null(spark, d):
    rows = table(spark, d, "lineitem").withColumn("flag", F.nullif("l_returnflag", F.lit("N")))
    return rows.where(predicate.compile_filter({"flag": ["A", None]}, rows.schema)).select("l_orderkey", "l_linenumber", "l_extendedprice")


# Cleaning.

_FLAGGED = "(SELECT *, nullif(l_returnflag, 'N') AS flag, CASE WHEN l_quantity > 10 THEN l_quantity END AS many FROM lineitem)"


def _flagged(spark, d):
    return table(spark, d, "lineitem").withColumns({"flag": F.nullif("l_returnflag", F.lit("N")), "many": F.expr("case when l_quantity > 10 then l_quantity end")})


@query(f"SELECT l_orderkey, l_partkey, flag, many FROM {_FLAGGED} WHERE flag IS NOT NULL AND many IS NOT NULL")
def drop_nulls(spark, d):
    return clean.drop_nulls(_flagged(spark, d), ["flag", "many", "absent"]).select("l_orderkey", "l_partkey", "flag", "many")


@query(f"SELECT l_orderkey, l_partkey, flag FROM {_FLAGGED}")
def drop_nulls_noop(spark, d):
    return clean.drop_nulls(_flagged(spark, d), []).select("l_orderkey", "l_partkey", "flag")


@query(f"""SELECT count(*)::BIGINT AS n_before, k::BIGINT AS n_after, (count(*) - k)::BIGINT AS n_removed, round(100.0 * k / count(*), 2)::DOUBLE AS percent_kept
    FROM (SELECT count(*) FILTER (WHERE flag IS NOT NULL AND many IS NOT NULL) OVER () AS k FROM {_FLAGGED}) GROUP BY k""")  # fmt: skip
def retention(spark, d):
    return clean.retention(_flagged(spark, d), ["flag", "many", "absent"]).withColumn("percent_kept", F.col("percent_kept").cast("double"))


@query("SELECT l_partkey, l_orderkey, l_tax FROM lineitem")
def project_existing(spark, d):
    return clean.project(table(spark, d, "lineitem"), ["l_partkey", "absent", "l_orderkey", "l_tax"])


@query("SELECT l_orderkey, l_partkey, l_extendedprice::FLOAT AS l_extendedprice, l_discount FROM lineitem")
def float32_narrow(spark, d):
    return clean.narrow(table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_extendedprice", "l_discount"), ["l_extendedprice", "l_orderkey"])


@query("""SELECT count(*)::BIGINT AS n_rows, (count(*) FILTER (WHERE l_extendedprice::FLOAT::DOUBLE <> l_extendedprice))::BIGINT AS changed_l_extendedprice,
    (count(*) FILTER (WHERE l_quantity::FLOAT::DOUBLE <> l_quantity))::BIGINT AS changed_l_quantity FROM lineitem""")  # fmt: skip
def float32_changed(spark, d):
    return clean.narrowing_loss(table(spark, d, "lineitem"), ["l_extendedprice", "l_quantity"])


# Periods and windows.


@query(_EVENTS_PERIOD)
def period_events(spark, d):
    return _as_text(_files(spark, d))


@query(f"SELECT f, s, s AS e FROM (SELECT f, try_strptime(nullif(regexp_extract(f, '^([0-9]{{14}})', 1), ''), '%Y%m%d%H%M%S')::DATE::VARCHAR AS s FROM {_NAMES})")
def period_quarter(spark, d):
    return _as_text(_files(spark, d, "quarter"))


@query(f"SELECT f, s, s AS e FROM (SELECT f, try_strptime(nullif(regexp_extract(f, '^([0-9]{{8}})', 1), ''), '%Y%m%d')::DATE::VARCHAR AS s FROM {_NAMES})")
def period_daily(spark, d):
    return _as_text(_files(spark, d, "daily"))


def _overlap(keep: bool) -> Query:
    return lambda spark, d: _as_text(_files(spark, d).where(periods.overlaps(F.col("s"), F.col("e"), "1995-01-15", "1996-03-01", keep)))


_TOUCH = "e >= '1995-01-15' AND s <= '1996-03-01'"
query(f"SELECT * FROM ({_EVENTS_PERIOD}) WHERE {_TOUCH}", "date_overlap_strict")(_overlap(False))
query(f"SELECT * FROM ({_EVENTS_PERIOD}) WHERE s IS NULL OR ({_TOUCH})", "date_overlap_keep")(_overlap(True))


def _sorted(order: str) -> Query:
    def run(spark, d):
        files = periods.order_by_period(_files(spark, d), "s", "f", order)
        c = F.col("s").asc_nulls_last() if order == "asc" else F.col("s").desc_nulls_last()
        return _as_text(files.select("f", "s", F.row_number().over(Window.orderBy(c, "f")).cast("bigint").alias("pos")))

    return run


for _order in ("asc", "desc"):
    query(f"SELECT f, s, (row_number() OVER (ORDER BY s {_order} NULLS LAST, f))::BIGINT AS pos FROM ({_EVENTS_PERIOD})", f"date_sort_{_order}")(_sorted(_order))


@query("""SELECT count(*)::BIGINT AS n, (count(*) FILTER (WHERE day // 100 = month))::BIGINT AS same_month, (count(*) FILTER (WHERE day // 10000 = y))::BIGINT AS same_year FROM (
    SELECT strftime(o_orderdate, '%Y%m%d')::BIGINT AS day, year(o_orderdate) * 100 + month(o_orderdate) AS month, year(o_orderdate) AS y FROM orders)""")  # fmt: skip
def date_identities(spark, d):
    rows = table(spark, d, "orders").select(coerce.day_number(F.col("o_orderdate")).alias("day"), F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m"))
    return rows.agg(F.count("*").alias("n"), F.count_if(F.expr("day div 100 = y * 100 + m")).alias("same_month"), F.count_if(F.expr("day div 10000 = y")).alias("same_year"))


# Samples.

_KEY = "md5(concat_ws('|', '42', event_id::VARCHAR)), event_id"
_EVENT_FILTER = {"OR": {"AND": {"event_type": ["click", "view", "purchase"], "value": {"op": "gt", "value": 1}}, "value": {"op": "between", "min": 5, "max": 20}}}
_EVENT_WHERE = "(event_type IN ('click', 'view', 'purchase') AND value > 1) OR value BETWEEN 5 AND 20"
_ID = ("event_id",)


@query(f"SELECT event_id, user_id, event_type FROM events ORDER BY {_KEY} LIMIT 500")
def sample_indexed(spark, d):
    return sampling.sample_rows(table(spark, d, "events"), 500, 42, _ID).select("event_id", "user_id", "event_type")


def _top_sql(columns: str, by: str, n: int, source: str = "events", where: str = "true") -> str:
    return f"SELECT {columns} FROM (SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY {_KEY}) AS rn FROM {source} WHERE {where}) WHERE rn <= {n}"


@query(_top_sql("event_id, ts, event_type", "ts::DATE", 10))
def sample_daily(spark, d):
    return sampling.sample_daily(table(spark, d, "events"), 10, 42, F.col("ts").cast("date"), _ID).select("event_id", "ts", "event_type")


@query("SELECT o_orderkey, day FROM (SELECT *, row_number() OVER (PARTITION BY day ORDER BY md5(concat_ws('|', '7', o_orderkey::VARCHAR)), o_orderkey) AS rn FROM (SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d')::BIGINT AS day FROM orders)) WHERE rn <= 2")
def sample_daily_ts(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", coerce.day_number(F.col("o_orderdate")).alias("day"))
    return sampling.sample_daily(rows, 2, 7, "day", ("o_orderkey",))


@query(_top_sql("event_id, event_type", "ts::DATE", 5))
def sample_daily_file(spark, d):
    """One file holds the table, so a sample per file and day is one per day."""
    return sampling.sample_daily(table(spark, d, "events"), 5, 42, F.col("ts").cast("date"), _ID, "file").select("event_id", "event_type")


@query(f"SELECT event_id, event_type, value FROM events WHERE {_EVENT_WHERE} ORDER BY {_KEY} LIMIT 200")
def sample_filtered(spark, d):
    return sampling.FilteredSampler(table(spark, d, "events"), _EVENT_FILTER, ["event_id"], 42, _ID).sample(200)


@query(_top_sql("event_id, event_type", "event_type", 20))
def sample_stratified(spark, d):
    return sampling.sample_stratified(table(spark, d, "events"), "event_type", 20, 42, _ID).select("event_id", "event_type")


@query(_top_sql("event_id, kind", "kind", 5, "(SELECT event_id, nullif(event_type, 'click') AS kind FROM events)"))
def stratified_null(spark, d):
    rows = table(spark, d, "events").select("event_id", F.nullif("event_type", F.lit("click")).alias("kind"))
    return sampling.sample_stratified(rows, "kind", 5, 42, _ID)


@query(_top_sql("event_id, ts, event_type, value", "event_type", 20, where=_EVENT_WHERE))
def sample_filtered_stratified(spark, d):
    return sampling.FilteredSampler(table(spark, d, "events"), _EVENT_FILTER, ["event_id", "ts"], 42, _ID).stratified("event_type", 20)


@query()
def sample_exact_index(spark, d):
    """The rows at positions drawn by numpy; SQL has no such generator."""
    return sampling.FileIndex(spark, f"{d}/orders.parquet").sample(100, 42)


# Joins of events with articles.

_PACKED = "(SELECT l_partkey, string_agg(l_orderkey::VARCHAR, ',' ORDER BY l_orderkey) AS EventIds, count(*)::BIGINT AS NumArticles FROM lineitem GROUP BY l_partkey)"
_UNPACKED = f"(SELECT l_partkey, EventIds, NumArticles, trim(unnest(string_split(EventIds, ','))) AS e FROM {_PACKED})"


def _packed(spark, d):
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("l_orderkey")), lambda x: x.cast("string")), ",")
    return table(spark, d, "lineitem").groupBy("l_partkey").agg(ids.alias("EventIds"), F.count("*").alias("NumArticles"))


def _events(spark, d):
    return table(spark, d, "orders").select("o_orderkey", "o_custkey", coerce.day_number(F.col("o_orderdate")).alias("DATEADDED"))


_ORDERS = "(SELECT o_orderkey, o_custkey, strftime(o_orderdate, '%Y%m%d')::BIGINT AS DATEADDED FROM orders)"


@query(f"SELECT l_partkey, e AS event_id FROM {_UNPACKED}")
def explode_ids(spark, d):
    return crossref.explode_ids(_packed(spark, d)).select("l_partkey", F.col("_event_id").alias("event_id"))


@query(f"""SELECT o_orderkey, o_custkey, DATEADDED, l_partkey AS "GKG_l_partkey", md5(EventIds) AS ids, NumArticles AS "GKG_NumArticles" FROM {_ORDERS} JOIN {_UNPACKED} ON o_orderkey::VARCHAR = e""")
def xref_v1(spark, d):
    out = crossref.direct(_events(spark, d), _packed(spark, d), event_id="o_orderkey")
    return out.select("o_orderkey", "o_custkey", "DATEADDED", "GKG_l_partkey", F.md5("GKG_EventIds").alias("ids"), "GKG_NumArticles")


@query(f"""SELECT o_orderkey, o_custkey, DATEADDED, md5(EventIds) AS ids, NumArticles AS "GKG_NumArticles" FROM {_ORDERS} JOIN {_UNPACKED} ON o_orderkey::VARCHAR = e""")
def xref_v1_columns(spark, d):
    out = crossref.direct(_events(spark, d), _packed(spark, d), ["NumArticles"], event_id="o_orderkey")
    return out.select(*(c for c in out.columns if c != "GKG_EventIds"), F.md5("GKG_EventIds").alias("ids"))


@query("SELECT l_orderkey, l_partkey, l_linenumber, l_extendedprice FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')")
def xref_semi(spark, d):
    some = table(spark, d, "orders").where("o_orderstatus = 'P'")
    return crossref.mentions_of(table(spark, d, "lineitem"), some, "o_orderkey", "l_orderkey").select("l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice")


_TIES = ("l_shipdate", "l_suppkey", "l_linenumber", "l_extendedprice")
_MENTION = {"event_id": "o_orderkey", "mention_event": "l_orderkey", "best": "l_quantity", "extra": ("l_quantity", "l_shipdate")}


def _mentions(spark, d, by_brand: bool = False):
    m = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", *_TIES)
    if by_brand:
        brands = table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
        m = m.join(brands, "l_partkey").withColumnRenamed("p_brand", "doc").drop("l_partkey")
    return m


def _two_hop(mode: str = "all", dedupe: bool = False, by_brand: bool = False) -> Query:
    def run(spark, d):
        articles = table(spark, d, "part").select("p_partkey", "p_brand", "p_name")
        options = _MENTION | {"mention_doc": "doc" if by_brand else "l_partkey", "article_doc": "p_brand" if by_brand else "p_partkey"}
        ties = [F.col(c) for c in _TIES]
        return crossref.two_hop(_events(spark, d), _mentions(spark, d, by_brand), articles, None, mode, dedupe, mention_ties=ties, record_order=[F.col("p_partkey")], **options)

    return run


def _two_hop_sql(mode: str = "all", dedupe: bool = False, by_brand: bool = False) -> str:
    doc, key = ("p_brand", "p_brand") if by_brand else ("l_partkey", "p_partkey")
    m = "(SELECT l.*, p_brand FROM lineitem l JOIN part ON l_partkey = p_partkey)" if by_brand else "lineitem"
    if dedupe:
        pair = f"PARTITION BY l_orderkey, {doc}"
        m = f"(SELECT * FROM (SELECT *, (count(*) OVER ({pair}))::BIGINT AS cnt, row_number() OVER ({pair} ORDER BY l_quantity DESC NULLS LAST, {', '.join(_TIES)}) AS rn FROM {m}) WHERE rn = 1)"
    a = "part"
    if mode != "all":
        a = f"(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY p_partkey {'DESC' if mode == 'latest' else 'ASC'}) AS k FROM part) WHERE k = 1)"
    count = ', m.cnt AS "Mention_Count"' if dedupe else ""
    return f"""SELECT o_orderkey, o_custkey, DATEADDED, m.l_quantity AS "Mention_l_quantity", m.l_shipdate AS "Mention_l_shipdate"{count}, a.p_partkey AS "GKG_p_partkey", a.p_brand AS "GKG_p_brand", a.p_name AS "GKG_p_name"
    FROM {_ORDERS} o JOIN {m} m ON o_orderkey = m.l_orderkey JOIN {a} a ON m.{doc} = a.{key}"""


for _name, _args in {"xref_v2_all": (), "xref_v2_latest": ("latest", False, True), "xref_v2_earliest": ("earliest", False, True), "xref_v2_dedupe": ("all", True), "xref_v2_dedupe_latest": ("latest", True, True)}.items():
    query(_two_hop_sql(*_args), _name)(_two_hop(*_args))

_SINCE = 19950101


@query(f"""SELECT 'v1' AS "CrossrefSource", o_orderkey, l_partkey::VARCHAR AS "GKG_l_partkey", NumArticles::VARCHAR AS "GKG_NumArticles", NULL::VARCHAR AS "GKG_p_partkey", NULL::VARCHAR AS "GKG_p_name"
    FROM {_ORDERS} JOIN {_UNPACKED} ON o_orderkey::VARCHAR = e WHERE DATEADDED >= {_SINCE}
    UNION ALL SELECT 'v2', o_orderkey, NULL, NULL, p_partkey::VARCHAR, p_name FROM {_ORDERS} JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON l_partkey = p_partkey WHERE DATEADDED >= {_SINCE}""")  # fmt: skip
def xref_auto(spark, d):
    events = crossref.eligible(_events(spark, d), since=_SINCE)
    v1 = crossref.direct(events, _packed(spark, d), event_id="o_orderkey")
    v2 = crossref.two_hop(events, _mentions(spark, d), table(spark, d, "part"), ["p_name"], mention_doc="l_partkey", article_doc="p_partkey", **_MENTION)
    text = [F.col(c).cast("string").alias(c) for c in ("GKG_l_partkey", "GKG_NumArticles", "GKG_p_partkey")]
    return crossref.both(v1, v2).select("CrossrefSource", "o_orderkey", *text, "GKG_p_name")


@query(f"SELECT o_orderkey, DATEADDED FROM {_ORDERS} WHERE DATEADDED >= {_SINCE}")
def auto_eligible(spark, d):
    return crossref.eligible(_events(spark, d), since=_SINCE).select("o_orderkey", "DATEADDED")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def xref_unmatched(spark, d):
    return crossref.unmatched(table(spark, d, "orders"), table(spark, d, "lineitem"), "o_orderkey", "l_orderkey").select("o_orderkey", "o_custkey")


@query("SELECT l_orderkey, l_partkey, count(*)::BIGINT AS n FROM lineitem GROUP BY ALL")
def mention_counts(spark, d):
    return crossref.pair_counts(table(spark, d, "lineitem"), "l_orderkey", "l_partkey")


@query("SELECT DISTINCT url FROM pages WHERE url IS NOT NULL")
def distinct_urls(spark, d):
    return crossref.distinct_keys(table(spark, d, "pages"), "url")


@query(f"SELECT count(DATEADDED)::BIGINT AS n_dated, (count(*) FILTER (WHERE DATEADDED < {_SINCE}))::BIGINT AS n_too_old FROM {_ORDERS}")
def coverage_counts(spark, d):
    return crossref.coverage(_events(spark, d), "DATEADDED", _SINCE)


# Published analyses.

_BLANK = "' ' || chr(9) || chr(10) || chr(13)"
_TAGS = f"list_distinct(list_filter(list_transform(string_split({{}}, ' '), lambda x: trim(x, {_BLANK})), lambda x: x <> ''))"
_SETS = f"(SELECT doc_id, lang, {_TAGS.format('text')} AS a, {_TAGS.format('lower(text)')} AS b FROM documents)"
_LACK = f"(SELECT doc_id, lang, len(a) AS n, list_filter(a, lambda x: NOT list_contains(b, x)) AS m, len(list_filter(b, lambda x: NOT list_contains(a, x))) AS k FROM {_SETS})"


def _sets(spark, d):
    docs = table(spark, d, "documents")
    rows = docs.select("doc_id", "lang", tags.tag_set(F.col("text"), " ").alias("a"), tags.tag_set(F.lower("text"), " ").alias("b"))
    return rows.select("doc_id", "lang", F.size("a").alias("n"), tags.missing_tags(F.col("a"), F.col("b")).alias("m"), F.size(tags.missing_tags(F.col("b"), F.col("a"))).alias("k"))


@query(f"SELECT doc_id, n::BIGINT AS n_tags, len(m)::BIGINT AS n_missing, k::BIGINT AS n_extra FROM {_LACK}")
def tag_containment(spark, d):
    return _sets(spark, d).select("doc_id", F.col("n").cast("bigint").alias("n_tags"), F.size("m").cast("bigint").alias("n_missing"), F.col("k").cast("bigint").alias("n_extra"))


@query(f"SELECT tag, count(*)::BIGINT AS n FROM (SELECT unnest(m) AS tag FROM {_LACK}) GROUP BY tag")
def tag_missing(spark, d):
    return _sets(spark, d).select(F.explode("m").alias("tag")).groupBy("tag").agg(F.count("*").alias("n"))


@query(f"SELECT lang, sum(n)::BIGINT AS n_tags, sum(len(m))::BIGINT AS n_missing FROM {_LACK} GROUP BY lang")
def tag_by_group(spark, d):
    return _sets(spark, d).groupBy("lang").agg(F.sum("n").cast("bigint").alias("n_tags"), F.sum(F.size("m")).cast("bigint").alias("n_missing"))


@query("SELECT page_id, regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]+)', 1) AS host FROM pages")
def url_host(spark, d):
    return table(spark, d, "pages").select("page_id", coerce.url_host(F.col("url")).alias("host"))


@query("SELECT count(*)::BIGINT AS n, (count(*) FILTER (WHERE c_nationkey = s_nationkey))::BIGINT AS n_same FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey")
def match_rate(spark, d):
    j = table(spark, d, "lineitem").join(table(spark, d, "orders"), F.expr("l_orderkey = o_orderkey")).join(table(spark, d, "customer"), F.expr("o_custkey = c_custkey")).join(table(spark, d, "supplier"), F.expr("l_suppkey = s_suppkey"))
    return measures.equal_rate(j, "c_nationkey", "s_nationkey")


@query("SELECT l_returnflag, count(*)::BIGINT AS n, (count(*) FILTER (WHERE l_discount = l_tax))::BIGINT AS n_same, (count(*) FILTER (WHERE l_discount > 0 AND l_tax > 0))::BIGINT AS n_both FROM lineitem GROUP BY l_returnflag")
def overlap_rate(spark, d):
    return measures.overlap_rate(table(spark, d, "lineitem"), "l_discount", "l_tax", F.expr("l_discount > 0 and l_tax > 0"), ["l_returnflag"])


_CODED = "(SELECT *, CASE WHEN l_linenumber = 3 THEN l_linestatus || l_returnflag WHEN l_linenumber = 4 THEN l_returnflag ELSE l_returnflag || l_linestatus END AS code, CASE WHEN l_linenumber <> 4 THEN l_linestatus END AS second FROM lineitem)"


@query(f"SELECT count(*)::BIGINT AS n, (count(*) FILTER (WHERE code = l_returnflag || coalesce(second, '')))::BIGINT AS n_whole FROM {_CODED}")
def concat_check(spark, d):
    """Codes of two parts: those of every third line are the wrong way round, those of every fourth lack the second part."""
    rows = table(spark, d, "lineitem").withColumns({
        "code": F.expr("case when l_linenumber = 3 then l_linestatus || l_returnflag when l_linenumber = 4 then l_returnflag else l_returnflag || l_linestatus end"),
        "second": F.expr("case when l_linenumber <> 4 then l_linestatus end"),
    })
    return measures.concat_matches(rows, "code", ["l_returnflag", "second"])


@query("SELECT count(*)::BIGINT AS n_docs, (count(*) FILTER (WHERE n > 1))::BIGINT AS n_several, max(n)::BIGINT AS most FROM (SELECT l_partkey, count(DISTINCT l_orderkey) AS n FROM lineitem GROUP BY 1)")
def xref_fanin(spark, d):
    return measures.spread(crossref.fan_out(table(spark, d, "lineitem"), "l_partkey", "l_orderkey"), "n_docs")


@query("SELECT count(*)::BIGINT AS n_events, (count(*) FILTER (WHERE n > 1))::BIGINT AS n_several, max(n)::BIGINT AS most FROM (SELECT l_orderkey, count(DISTINCT l_partkey) AS n FROM lineitem GROUP BY 1)")
def xref_fanout(spark, d):
    return measures.spread(crossref.fan_out(table(spark, d, "lineitem"), "l_orderkey", "l_partkey"), "n_events")


@query("SELECT l_orderkey, l_partkey, count(*)::BIGINT AS n, min(l_quantity) <> max(l_quantity) AS differ FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def dup_pairs(spark, d):
    return measures.repeated(table(spark, d, "lineitem"), ["l_orderkey", "l_partkey"], "l_quantity")


@query("SELECT md5(text) AS key, count(*)::BIGINT AS n, min(source) <> max(source) AS differ FROM documents WHERE text IS NOT NULL GROUP BY 1 HAVING count(*) > 1")
def dup_docs(spark, d):
    """Texts of several records, and whether their sources differ."""
    keyed = table(spark, d, "documents").where("text is not null").select(F.md5("text").alias("key"), "source")
    return measures.repeated(keyed, ["key"], "source")


@query("SELECT o_orderkey, count(*)::BIGINT AS n_rows, count(DISTINCT p_brand)::BIGINT AS n_brands, min(l_quantity) AS least FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON l_partkey = p_partkey GROUP BY 1")
def xref_agg_event(spark, d):
    rows = _two_hop()(spark, d)
    return rows.groupBy("o_orderkey").agg(F.count("*").alias("n_rows"), F.count_distinct("GKG_p_brand").alias("n_brands"), F.min("Mention_l_quantity").alias("least"))


# Codes.

_CODES = values([(f, c, n) for f, own in codes.FAMILIES.items() for c, n in own.items()], "c", "family, code, name")


@query(f"SELECT family, count(*)::BIGINT AS n, string_agg(code, ',' ORDER BY code) AS codes FROM {_CODES} GROUP BY family")
def codes_families(spark, d):
    return codes.codes_table(spark).groupBy("family").agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_list("code")), ",").alias("codes"))


@query(f"SELECT code, name FROM {_CODES} WHERE family = 'actor_country'")
def codes_list(spark, d):
    return given(spark, codes.list_codes("Actor1CountryCode"), "code string, name string")


@query(f"SELECT code, name FROM {_CODES} WHERE family = 'event' AND (lower(code) LIKE '%19%' OR lower(name) LIKE '%19%')")
def codes_search(spark, d):
    return given(spark, codes.list_codes("EventCode", "19"), "code string, name string")


_ACTORS = values([(c,) for c in codes.FAMILIES["actor_country"]], "k", "code")


@query(f"SELECT upper(left(n_name, 3)) AS code, count(*)::BIGINT AS n FROM nation WHERE upper(left(n_name, 3)) NOT IN (SELECT code FROM {_ACTORS}) GROUP BY 1")
def codes_unrecognized(spark, d):
    """The first letters of nations' names, taken for their codes."""
    named = table(spark, d, "nation").select(F.lower(F.substring("n_name", 1, 3)).alias("Actor1CountryCode"))
    return codes.unrecognized_values(named, "Actor1CountryCode").select(F.upper("Actor1CountryCode").alias("code"), "n")
