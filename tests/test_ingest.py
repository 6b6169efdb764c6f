import hashlib
import json
import os
import zipfile
from datetime import date

import pytest

from eventloom.cli import build_parser, main
from eventloom.operators import clean, codes
from eventloom.plans import config, stages
from eventloom.plans.manifest import fingerprint
from eventloom.plans.store import Store
from eventloom.sources import ingest, listing, periods
from eventloom.sources.specs import DATASETS, spec
from eventloom.streaming.incremental import convert_stream


def zipped(path, text):
    with zipfile.ZipFile(path, "w") as z:
        z.writestr(os.path.basename(path).removesuffix(".zip"), text)
    return str(path)


def event_line(i, day=20200101, year=2020, extra=0):
    f = [""] * 58
    f[0], f[1], f[2], f[3] = str(i), str(day), str(day // 100), str(year)
    return "\t".join(f + ["x"] * extra)


def test_specs():
    assert {d: (len(s.columns), len(s.numeric)) for d, s in DATASETS.items()} == {"events": (58, 22), "gkg_v1": (11, 2), "gkg_v1_counts": (15, 6), "gkg_v2": (27, 2), "mentions": (16, 12)}
    with pytest.raises(ValueError):
        spec("nope")


def test_header_and_packed_ids(spark, tmp_path):
    head = "DATE\tNUMARTS\tCOUNTS\tTHEMES\tLOCATIONS\tPERSONS\tORGANIZATIONS\tTONE\tCAMEOEVENTIDS\tSOURCES\tSOURCEURLS"
    f = zipped(tmp_path / "20140228.gkg.csv.zip", head + "\n20140228\t7\t\tWATER;ROADS\t\t\t\t-0.25\t88,1213,5\tpaper\tweb\n")
    lines = ingest.read_zips(spark, f)
    row = ingest.parse_tsv(lines, "gkg_v1").collect()
    assert len(row) == 1 and row[0].EventIds == "88,1213,5" and row[0].Date == 20140228 and row[0].Counts is None


def test_rows_of_odd_length(spark):
    rows = [(event_line(1),), (event_line(2, extra=1),), ("3\t20200102",), ("",), ("x\t20200103",)]
    out = ingest.parse_tsv(spark.createDataFrame(rows, "value string"), "events").select("GlobalEventID", "Day").collect()
    assert sorted(map(tuple, out), key=str) == [(1, 20200101), (3, 20200102), (None, 20200103)]
    with pytest.raises(ValueError):
        ingest.check_arity(spark.createDataFrame([(event_line(2, extra=1),)], "value string"), "events")


def test_convert_filter_resume(spark, tmp_path):
    raw, out, kept = tmp_path / "raw", str(tmp_path / "conv"), str(tmp_path / "filt")
    raw.mkdir()
    for day in (20200101, 20200102):
        zipped(raw / f"{day}.export.CSV.zip", "\n".join(event_line(i, day) for i in range(3)) + "\n")
    assert len(stages.convert(spark, str(raw), out, "events", dry_run=True).pending) == 2
    first = stages.convert(spark, str(raw), out, "events", end_date="2020-01-01")
    assert [os.path.basename(p) for p in first.processed] == ["20200101.export.CSV.zip"]
    second = stages.convert(spark, str(raw), out, "events")
    assert len(second.processed) == 1 and len(second.skipped) == 1
    assert Store(spark, out, "events").read().count() == 6
    assert stages.convert(spark, str(raw), out, "events").processed == []
    got = stages.filter_files(spark, out, kept, "events", ["GlobalEventID", "absent"], ["Day", "GlobalEventID", "nope"])
    assert (got.rows_before, got.rows_after) == (6, 6)
    assert Store(spark, kept, "events").read().columns == ["Day", "GlobalEventID", "_src_file", "_src_row"]
    assert stages.filter_files(spark, out, kept, "events", ["GlobalEventID", "absent"], ["Day", "GlobalEventID", "nope"]).processed == []
    none = stages.filter_files(spark, out, str(tmp_path / "x"), "events", ["absent"])
    assert none.processed == [] and none.skipped and not os.path.exists(tmp_path / "x" / "table")
    # the same again by force, and a run that broke off before the manifest named it: no row is seen twice
    assert len(stages.convert(spark, str(raw), out, "events", force=True).processed) == 2
    assert Store(spark, out, "events").read().count() == 6
    Store(spark, out, "events").write(spark.createDataFrame([(1, f"{raw}/20200101.export.CSV.zip", 0)], "GlobalEventID bigint, _src_file string, _src_row bigint"), "unnamed")
    assert Store(spark, out, "events").read().count() == 6
    again = stages.filter_files(spark, out, kept, "events", ["GlobalEventID", "absent"], ["Day", "GlobalEventID", "nope"])
    assert len(again.processed) == 2 and Store(spark, kept, "events").read().count() == 6
    assert Store(spark, out, "events").read("2020-01-02", None).select("Day").distinct().collect()[0][0] == 20200102


def test_windows_open_no_other_files(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "conv")
    raw.mkdir()
    for day in range(20200101, 20200111):
        zipped(raw / f"{day}.export.CSV.zip", event_line(day, day))
    stages.convert(spark, str(raw), out, "events")
    df = Store(spark, out, "events").read("2020-01-03", "2020-01-04")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.Day for r in df.collect()) == [20200103, 20200104]
    assert "part_last" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]


def test_broken_archives_stay_pending(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "conv")
    raw.mkdir()
    zipped(raw / "20200101.export.CSV.zip", event_line(1))
    (raw / "20200102.export.CSV.zip").write_bytes(b"no archive")
    whole = open(zipped(raw / "20200103.export.CSV.zip", "\n".join(event_line(i) for i in range(2000))), "rb").read()
    (raw / "20200103.export.CSV.zip").write_bytes(whole[:200] + b"\0\0\0" + whole[203:])
    got = stages.convert(spark, str(raw), out, "events", delete_source=True)
    assert got.processed == ["20200101.export.CSV.zip"] and got.failed == ["20200102.export.CSV.zip", "20200103.export.CSV.zip"]
    assert Store(spark, out, "events").read().count() == 1 and len(list(raw.iterdir())) == 2
    (raw / "20200103.export.CSV.zip").write_bytes(whole)
    assert stages.convert(spark, str(raw), out, "events").processed == ["20200103.export.CSV.zip"]
    assert Store(spark, out, "events").read().count() == 2001


def test_historical_part(spark, tmp_path):
    raw, out, kept = tmp_path / "raw", str(tmp_path / "conv"), str(tmp_path / "filt")
    raw.mkdir()
    zipped(raw / "2004.zip", "\n".join(event_line(m, 20040000 + 100 * m + 5, 2004) for m in range(1, 13)) + "\n77\t\t\t\n")
    zipped(raw / "200602.zip", event_line(50, 20060203, 2006))
    zipped(raw / "20200101.export.CSV.zip", event_line(60))
    rules = {"yearly": ["Year", "MonthYear"], "monthly": ["Year", "MonthYear"]}
    assert len(stages.convert(spark, str(raw), out, "events", hive_by=rules).processed) == 3
    assert len(list((tmp_path / "conv" / "historical").rglob("Year=2004/MonthYear=200407"))) == 1
    df = Store(spark, out, "events").read()
    assert df.count() == 14 and dict(df.dtypes)["Year"] in ("int", "bigint")  # the row without a key is gone
    assert Store(spark, out, "events").read("2006-02-11", "2006-03-01").count() == 1
    done = stages.filter_files(spark, out, kept, "events", ["GlobalEventID"], ["GlobalEventID", "Day"], hive_by=rules)
    assert len(done.processed) == 3 and done.rows_after == 14 and Store(spark, kept, "events").read().count() == 14


def test_sources_go_last(spark, tmp_path):
    raw, out, kept = tmp_path / "raw", str(tmp_path / "conv"), str(tmp_path / "filt")
    raw.mkdir()
    for day in (20200101, 20200102):
        zipped(raw / f"{day}.export.CSV.zip", event_line(day, day))
    stages.convert(spark, str(raw), out, "events", delete_source=True)
    assert list(raw.iterdir()) == []
    stages.filter_files(spark, out, kept, "events", ["GlobalEventID"], end_date="2020-01-01", delete_source=True)
    assert Store(spark, out, "events").read().count() == 2  # half of the run is still to do
    stages.filter_files(spark, out, kept, "events", ["GlobalEventID"], delete_source=True)
    assert list((tmp_path / "conv" / "table").iterdir()) == [] and Store(spark, kept, "events").read().count() == 2


def test_narrowing_warnings():
    warn = stages.warn_narrowing("filter", "gkg_v2", ["V1THEMES"], True, ["keep"])
    assert len(warn) == 2 and "V2DOCUMENTIDENTIFIER" in warn[0] and "keep" in warn[1]
    assert stages.warn_narrowing("convert", "events", None, True, []) == [] == stages.warn_narrowing("convert", "events", ["GlobalEventID"], False, ["columns"])


def test_hive(spark, tmp_path):
    rows = ingest.parse_tsv(spark.createDataFrame([(event_line(1),), (event_line(2, 20190101, 2019),), ("3",)], "value string"), "events")
    ingest.write_hive(rows, str(tmp_path / "h"), ["Year"])
    assert {p.name for p in (tmp_path / "h").glob("Year=*")} == {"Year=2020", "Year=2019"}
    assert spark.read.parquet(str(tmp_path / "h")).count() == 2


def test_drifting_types(spark, tmp_path):
    spark.createDataFrame([(1, 2)], "a bigint, b bigint").coalesce(1).write.parquet(str(tmp_path / "x"))
    spark.createDataFrame([(1.0,)], "a double").coalesce(1).write.parquet(str(tmp_path / "y"))
    out = ingest.read_drifting(spark, [str(tmp_path / "x"), str(tmp_path / "y")], spark.createDataFrame([], "a double, b bigint").schema)
    assert sorted(map(tuple, out.collect()), key=str) == [(1.0, 2), (1.0, None)]


def test_stream_takes_each_file_once(spark, tmp_path):
    raw, out, marks = str(tmp_path / "raw"), str(tmp_path / "out"), str(tmp_path / "marks")
    os.mkdir(raw)
    for day in (20200101, 20200102):
        zipped(os.path.join(raw, f"{day}.export.CSV.zip"), event_line(day) + "\n")
        convert_stream(spark, raw, out, marks, "events", ["GlobalEventID", "Day"]).awaitTermination()
    got = spark.read.parquet(out)
    assert sorted(r.GlobalEventID for r in got.collect()) == [20200101, 20200102] and "_src_row" in got.columns


def test_cleaning(spark):
    df = spark.createDataFrame([(1, "A", 1), (2, None, 2), (3, "C", None), (4, "D", 4)], "GlobalEventID bigint, Actor1Name string, QuadClass bigint")
    assert [r.GlobalEventID for r in clean.drop_nulls(df, ["Actor1Name", "QuadClass"]).collect()] == [1, 4]
    assert clean.drop_nulls(df, []).count() == 4
    assert clean.drop_nulls(df, ["absent"]) is None
    assert tuple(clean.retention(df, ["Actor1Name", "QuadClass"]).first()) == (4, 2, 2, 50.0)
    real = spark.createDataFrame([(1, 0.1, 0.5)], "i bigint, x double, y double")
    assert dict(clean.narrow(real, ["x", "i"]).dtypes) == {"i": "bigint", "x": "float", "y": "double"}
    assert tuple(clean.narrowing_loss(real, ["x", "y"]).first()) == (1, 1, 0)


def test_periods():
    day = lambda *x: date(*x)
    p = periods.parse_event_period
    assert p("20200101.export.CSV.zip") == (day(2020, 1, 1),) * 2 == p("a/20200101.export_filtered.parquet")
    assert p("202002.zip") == (day(2020, 2, 1), day(2020, 2, 29)) and p("2019.zip") == (day(2019, 1, 1), day(2019, 12, 31))
    assert p("20200230.export.CSV.zip") == (None, None) == p("misc.parquet")
    assert periods.parse_quarter_period("20200101251500.gkg.csv.zip") == (None, None)
    names = ["20200105.export.parquet", "misc.parquet", "20200101.export.parquet"]
    assert periods.select_files(names, "2020-01-02", None, p) == names[:2]
    assert periods.select_files(names, "2020-01-02", None, p, keep_undated=False) == names[:1]
    assert periods.sort_files(names, "desc", p) == [names[0], names[2], names[1]]
    with pytest.raises(ValueError):
        periods.check_window("2020-02-01", "2020-01-01")


def test_fetch(tmp_path):
    source = tmp_path / "20200101.export.CSV.zip"
    source.write_bytes(b"data")
    good = listing.RemoteFile(f"file://{source}", hashlib.md5(b"data").hexdigest().upper())
    assert listing.scrape([good], str(tmp_path / "to"), "events", dry_run=True)["success"] == [good.url]
    assert listing.scrape([good], str(tmp_path / "to"), "events")["success"] == [good.url]
    assert listing.scrape([good], str(tmp_path / "to"), "events")["skipped"] == [good.url]
    bad = listing.RemoteFile(good.url, "0" * 32)
    assert listing.fetch_one(bad, str(tmp_path), listing.copy_local, 2) == "skipped"
    assert listing.fetch_all([bad], str(tmp_path / "other"))["failed"] == [bad.url]
    assert not list((tmp_path / "other").iterdir())


def test_scrape_takes_one_dataset(tmp_path):
    files = []
    for name in ("20200101000000.export.CSV.zip", "20200101000000.mentions.CSV.zip", "20200101001500.mentions.CSV.zip", "20200101000000.gkg.csv.zip"):
        (tmp_path / name).write_bytes(name.encode())
        files.append(listing.RemoteFile(str(tmp_path / name), hashlib.md5(name.encode()).hexdigest()))
    names = lambda got: sorted(os.path.basename(u) for u in got)
    assert names(listing.scrape(files, str(tmp_path / "m"), "mentions")["success"]) == names(f.url for f in files[1:3])
    assert names(listing.scrape(files, str(tmp_path / "g"), "gkg_v2", "2020-01-01", "2020-01-02")["success"]) == names([files[3].url])
    assert listing.scrape(files, str(tmp_path / "g"), "gkg_v2")["skipped"] and listing.scrape(files, str(tmp_path / "g"), "gkg_v2", force=True)["success"]
    assert listing.scrape(files, str(tmp_path / "g"), "gkg_v2", force=True, dry_run=True)["success"]


def test_lists(tmp_path):
    page = """<a href="20200101.export.CSV.zip">x</a> (MD5: 0123456789ABCDEF0123456789abcdef)
        <A HREF='https://else.org/d/201302.zip'>y</A>
        <a href="2004.zip">z</a> <a href="20140101.gkg.csv.zip">g</a>
        <a href="20140101.gkgcounts.csv.zip">c</a> <a href="about.html">about</a> no link"""
    got = listing.parse_html(page, "http://x.org/events/index.html", "events")
    assert [(f.url, f.md5) for f in got] == [("http://x.org/events/20200101.export.CSV.zip", "0123456789abcdef" * 2), ("http://else.org/d/201302.zip", None), ("http://x.org/events/2004.zip", None)]
    assert len(listing.parse_html(page, "http://x.org/", "gkg_v1_counts")) == 1
    text = "12 ABC http://h/20200101000000.gkg.csv.zip\nbad line\nmany def http://h/20200101001500.gkg.csv.zip\n3 a http://h/20200101000000.mentions.CSV.zip\n"
    assert [(f.md5, f.size) for f in listing.parse_master(text, "gkg_v2")] == [("abc", 12), ("def", None)]
    assert listing.warn_large([listing.RemoteFile("u", None, 10**6)] * 6000, "mentions") and listing.warn_large([], "mentions") is None


@pytest.fixture
def server(tmp_path):
    import functools
    import http.server
    import threading

    root = tmp_path / "www"
    root.mkdir()
    handler = functools.partial(http.server.SimpleHTTPRequestHandler, directory=str(root))
    with http.server.ThreadingHTTPServer(("127.0.0.1", 0), handler) as s:
        threading.Thread(target=s.serve_forever, daemon=True).start()
        yield root, f"http://127.0.0.1:{s.server_port}"
        s.shutdown()


def test_scrape_command_over_http(tmp_path, server, monkeypatch):
    root, base = server
    monkeypatch.chdir(tmp_path)
    (tmp_path / config.DEFAULT_PATH).write_text(json.dumps({"root": str(tmp_path / "data"), "retry_wait_s": 0, "lists": {"mentions": f"{base}/master.txt"}}))
    zipped(root / "20200101.export.CSV.zip", event_line(1))
    (root / "index.html").write_text('<a href="20200101.export.CSV.zip">a</a>\n<a href="20200102.export.CSV.zip">gone</a>')
    assert main(["scrape", "--list", f"{base}/index.html", "--end-date", "2020-01-01", "-q"]) == 0
    assert (tmp_path / "data/raw/20200101.export.CSV.zip").read_bytes() == (root / "20200101.export.CSV.zip").read_bytes()
    assert main(["scrape", "--list", f"{base}/index.html"]) == 1  # one file isn't there
    (root / "20200101000000.mentions.CSV.zip").write_bytes(b"m")
    (root / "master.txt").write_text(f"1 {hashlib.md5(b'm').hexdigest()} {base}/20200101000000.mentions.CSV.zip\n1 x {base}/20200101000000.gkg.csv.zip\n")
    assert main(["scrape", "--dataset", "mentions", "--verbose"]) == 0
    assert [p.name for p in (tmp_path / "data/mentions_raw").iterdir()] == ["20200101000000.mentions.CSV.zip"]
    (tmp_path / "data/mentions_raw/20200101000000.mentions.CSV.zip").write_bytes(b"old")
    assert main(["scrape", "--dataset", "mentions"]) == 0 == main(["scrape", "--dataset", "mentions", "--force"])
    assert (tmp_path / "data/mentions_raw/20200101000000.mentions.CSV.zip").read_bytes() == b"m"
    assert main(["scrape", "--dataset", "gkg_v2"]) == 1  # no list is known


def test_code_lists(tmp_path):
    assert codes.geo_country_codes()["KS"] == "Korea, South" and codes.geo_country_codes()["KN"] == "Korea, North" and codes.religion_codes()["MOS"] == "Islam"
    assert codes.event_codes()["1214"] == "Reject intelligence cooperation" and "CEMAC" in codes.known_group_codes()["CEM"] and codes.event_codes()["01"] == "MAKE PUBLIC STATEMENT"
    assert {len(c) for c in codes.actor_country_codes()} == {3} and {len(c) for c in codes.geo_country_codes()} == {2} and {len(c) for c in codes.event_codes()} == {2, 3, 4}
    assert all(c[:2] in codes.event_codes() and (len(c) < 4 or c[:3] in codes.event_codes()) for c in codes.event_codes())
    assert codes.codes_for_column("EventRootCode") == codes.event_codes() and codes.codes_for_column("Day") is None
    assert codes.is_recognized("Actor1EthnicCode", "QQQ") is None
    (tmp_path / "CAMEO.ethnic.txt").write_text("CODE\tLABEL\nQQA\tQuaqua\nKUR\tother name\n")
    before, whole = dict(codes.FAMILIES["ethnic"]), set(codes.WHOLE)
    try:
        assert codes.load_folder(str(tmp_path)) == {"ethnic": 2}
        assert codes.is_recognized("Actor2EthnicCode", "qqa") is True and codes.is_recognized("Actor1EthnicCode", "QQQ") is False and codes.ethnic_codes()["KUR"] == "Kurd"
    finally:
        codes.FAMILIES["ethnic"] = before
        codes.WHOLE.clear()
        codes.WHOLE.update(whole)


def test_codes():
    assert codes.is_recognized("Actor1CountryCode", "usa") is True and codes.is_recognized("ActionGeo_CountryCode", "USA") is False
    assert codes.is_recognized("QuadClass", "1") is None and codes.family_of("EventCode") == "event"
    assert len(codes.COLUMN_FAMILY) == 22
    assert ("190", "Use conventional military force, not specified below") in codes.list_codes("EventCode", "MILITARY")
    with pytest.raises(ValueError):
        codes.list_codes("QuadClass")


def test_fingerprint():
    assert fingerprint(a=["y", "x"], b=1) == fingerprint(b=1, a=["x", "y"])
    assert fingerprint(a=None) != fingerprint(a=[]) != fingerprint(a="")


def test_commands(tmp_path, capsys, monkeypatch):
    monkeypatch.chdir(tmp_path)
    assert main(["codes", "EventCode", "--search", "protest"]) == 0 and "Protest" in capsys.readouterr().out
    assert main(["codes", "Nope"]) == 1
    assert main(["convert", "--start-date", "2020-02-01", "--end-date", "2020-01-01"]) == 1
    assert config.load()["compression"] == "zstd" and os.path.exists(config.DEFAULT_PATH)
    args = build_parser().parse_args(["sample", "--mode", "filtered", "--filter", "{}", "-n", "5"])
    assert args.n == 5 and args.seed == 42


def test_sample_and_crossref_commands(spark, tmp_path, capsys, monkeypatch):
    """From zips to a sample and its articles by the commands alone."""
    monkeypatch.chdir(tmp_path)
    (tmp_path / config.DEFAULT_PATH).write_text(json.dumps({"root": str(tmp_path / "data")}))
    sample, joined = str(tmp_path / "s.parquet"), str(tmp_path / "x.parquet")
    for d in ("raw", "mentions_raw", "gkg_v2_raw"):
        (tmp_path / "data" / d).mkdir(parents=True)
    for day in (20200101, 20200102):
        zipped(tmp_path / "data/raw" / f"{day}.export.CSV.zip", "\n".join(event_line(day * 10 + i, day) for i in range(4)))
        zipped(tmp_path / "data/gkg_v2_raw" / f"{day}000000.gkg.csv.zip", "\t".join([f"REC{day}", str(day), "1", "x", "doc"] + [""] * 22))
    zipped(tmp_path / "data/mentions_raw/20200101000000.mentions.CSV.zip", "\t".join(["202001010", "1", "2", "1", "s", "doc", "1", "0", "0", "0", "1", "90", "5", "0.5", "", ""]))
    for d in ("events", "mentions", "gkg_v2"):
        for stage in ("convert", "filter"):
            assert main([stage, "--dataset", d, "-q"]) == 0
    assert main(["sample", "--mode", "filtered", "-n", "9", "--start-date", "2020-01-01", "--end-date", "2020-01-01", "--out", sample]) == 0
    assert spark.read.parquet(sample).count() == 4
    assert main(["crossref", "--events", sample, "--on-duplicate-document", "latest", "--collapse-duplicate-mentions", "--out", joined]) == 0
    row = spark.read.parquet(joined).collect()
    assert [(r.GlobalEventID, r.GKG_GKGRECORDID, r.Mention_Count) for r in row] == [(202001010, "REC20200102", 1)]
    assert main(["sample", "--mode", "indexed", "-n", "99"]) == 1 and "99 rows" in capsys.readouterr().err
    assert main(["sample", "--mode", "indexed", "-n", "3", "--start-date", "2020-01-02", "--columns", "Day", "--out", sample]) == 0
    assert [tuple(r) for r in spark.read.parquet(sample).collect()] == [(20200102,)] * 3
    assert main(["sample", "--mode", "daily", "--per-day", "2", "--columns", "GlobalEventID", "--out", sample]) == 0
    assert spark.read.parquet(sample).columns == ["GlobalEventID", "Day"] and spark.read.parquet(sample).count() == 4


def test_export(spark, tmp_path):
    df = spark.range(3)
    assert ingest.export(df, str(tmp_path / "a.parquet"), "csv").endswith("a.csv")
    assert spark.read.option("header", "true").csv(str(tmp_path / "a.csv")).count() == 3
