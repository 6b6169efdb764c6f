"""Joins of events with articles against naive loops, on generated tables."""

import collections
import random

import pytest

from eventloom.operators import crossref

GEN = random.Random(31)
EVENTS = [(500 + i, f"party {i}", i * i) for i in range(40)]
DOCS = [f"http://paper/{d}" for d in range(25)]


def id_list():
    ids = [GEN.randrange(490, 560) for _ in range(GEN.randrange(0, 6))]
    return GEN.choice([", ", ",", " ,"]).join(map(str, ids)) if ids else GEN.choice([None, ""])


PACKED = [(7000 + i, id_list(), f"topic {i % 9}") for i in range(60)] + [(8000, "0501,501,501", "zeros"), (8001, None, "nothing")]
MENTIONS = [(GEN.choice([None, *range(495, 550)]), GEN.choice([None, *DOCS]), 100 + i, GEN.choice([None, 10, 40, 40, 90])) for i in range(300)]
RECORDS = {f"2019{m:02d}": [(GEN.choice([*DOCS, "http://paper/other", None]), f"rec-{m}-{k}") for k in range(30)] for m in range(1, 5)}


@pytest.fixture(scope="module")
def events(spark):
    return spark.createDataFrame(EVENTS, "GlobalEventID bigint, Name string, Weight bigint")


@pytest.fixture(scope="module", params=["memory", "files"])
def packed(request, spark, tmp_path_factory):
    df = spark.createDataFrame(PACKED, "Day bigint, EventIds string, Topic string")
    if request.param == "memory":
        return df
    path = str(tmp_path_factory.mktemp("packed"))
    df.unionByName(df.where("Day = 8000")).repartition(3).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def test_direct(events, packed):
    articles = [tuple(r) for r in packed.collect()]
    want = collections.Counter((e, w, d, t) for e, _, w in EVENTS for d, ids, t in articles for x in (ids or "").split(",") if x.strip() == str(e))
    got = crossref.direct(events, packed)
    assert collections.Counter((r.GlobalEventID, r.Weight, r.GKG_Day, r.GKG_Topic) for r in got.collect()) == want and sum(want.values()) > 60
    assert got.columns == ["GlobalEventID", "Name", "Weight", "GKG_Day", "GKG_EventIds", "GKG_Topic"]
    few = crossref.direct(events, packed, ["Topic"])
    assert few.columns == ["GlobalEventID", "Name", "Weight", "GKG_EventIds", "GKG_Topic"] and few.count() == sum(want.values())
    for wrong in (lambda: crossref.direct(events, packed, ["Nope"]), lambda: crossref.direct(events.drop("GlobalEventID"), packed)):
        with pytest.raises(ValueError):
            wrong()


def test_direct_explodes_ids_alone(events, packed):
    """Article columns don't move once for each id: what is exploded has the row's place and the list."""
    if not packed.inputFiles():
        return
    plan = crossref.direct(events, packed)._jdf.queryExecution().optimizedPlan().toString()
    exploded = [line for line in plan.split("\n") if "Generate explode" in line]
    assert exploded and not any("Topic" in line for line in exploded) and "LeftSemi" in plan


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(MENTIONS, "GLOBALEVENTID bigint, MentionIdentifier string, MentionTimeDate bigint, Confidence bigint").coalesce(1).write.parquet(str(root / "m"))
    (root / "g").mkdir()
    for name, rows in RECORDS.items():
        spark.createDataFrame(rows, "V2DOCUMENTIDENTIFIER string, GKGRECORDID string").coalesce(1).write.parquet(str(root / name))
        next((root / name).glob("part-*.parquet")).rename(root / "g" / f"{name}.parquet")
    return spark.read.parquet(str(root / "m")), spark.read.parquet(str(root / "g"))


def expected(mode, collapse):
    by_doc = collections.defaultdict(list)
    for name in sorted(RECORDS):
        for doc, rec in RECORDS[name]:
            by_doc[doc].append(rec)
    chosen = {d: r if mode == "all" else r[-1:] if mode == "latest" else r[:1] for d, r in by_doc.items() if d}
    bridge = [(e, d, t, c, None) for e, d, t, c in MENTIONS if e is not None and d is not None]
    if collapse:
        pairs = collections.defaultdict(list)
        for e, d, t, c, _ in bridge:
            pairs[e, d].append((t, c))
        # of highest confidence, nulls last, ties by place, which the time follows here
        bridge = [(e, d, *min(v, key=lambda x: (x[1] is None, -(x[1] or 0), x[0])), len(v)) for (e, d), v in pairs.items()]
    ids = {e for e, *_ in EVENTS}
    return collections.Counter((e, t, c, n, d, r) for e, d, t, c, n in bridge if e in ids for r in chosen.get(d, []))


@pytest.mark.parametrize("mode", crossref.RECORD_MODES)
@pytest.mark.parametrize("collapse", [False, True])
def test_two_hop(events, tables, mode, collapse):
    out = crossref.two_hop(events, *tables, on_duplicate_document=mode, dedupe_mentions=collapse)
    count = lambda r: r.Mention_Count if collapse else None
    got = collections.Counter((r.GlobalEventID, r.Mention_MentionTimeDate, r.Mention_Confidence, count(r), r.GKG_V2DOCUMENTIDENTIFIER, r.GKG_GKGRECORDID) for r in out.collect())
    assert got == expected(mode, collapse) and len(got) > 50
    assert out.columns == ["GlobalEventID", "Name", "Weight", "Mention_MentionTimeDate", "Mention_Confidence", *["Mention_Count"] * collapse, "GKG_V2DOCUMENTIDENTIFIER", "GKG_GKGRECORDID"]


def test_only_wanted_documents_are_ranked(events, tables):
    """The semi-join with the sample's documents stands below the window that ranks records."""
    plan = crossref.two_hop(events, *tables, on_duplicate_document="latest")._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.split("\n")
    depth = lambda word: [len(line) - len(line.lstrip(" :+-")) for line in lines if word in line]
    assert depth("Window") and any(d > min(depth("Window")) for d in depth("LeftSemi"))


def test_two_hop_rejects(events, tables):
    with pytest.raises(ValueError):
        crossref.two_hop(events, *tables, on_duplicate_document="newest")


def test_auto(spark, tables):
    packed = spark.createDataFrame(PACKED, "Day bigint, EventIds string, Topic string")
    dated = spark.createDataFrame([(500 + i, GEN.choice([None, 20100101, 20130401, 20180101])) for i in range(40)], "GlobalEventID bigint, DATEADDED bigint")
    rows = crossref.auto(dated, packed, *tables, on_duplicate_document="latest").collect()
    keep = {r.GlobalEventID for r in dated.collect() if r.DATEADDED and r.DATEADDED >= 20130401}
    v1 = collections.Counter(e for e in keep for _, ids, _ in PACKED for x in (ids or "").split(",") if x.strip() == str(e))
    v2 = collections.Counter(k[0] for k, n in expected("latest", False).items() for _ in range(n) if k[0] in keep)
    for tag, want in (("v1", v1), ("v2", v2)):
        assert collections.Counter(r.GlobalEventID for r in rows if r.CrossrefSource == tag) == want
    assert all((r.GKG_GKGRECORDID is None) == (r.CrossrefSource == "v1") for r in rows)


def test_empty_results_keep_their_schema(events, tables):
    out = crossref.two_hop(events.where("Weight < 0"), *tables)
    assert out.count() == 0 and "GKG_GKGRECORDID" in out.columns


def test_counts(tables):
    mentions, _ = tables
    whole = [(e, d) for e, d, *_ in MENTIONS if e is not None and d is not None]
    assert {(r[0], r[1]): r.n for r in crossref.pair_counts(mentions).collect()} == collections.Counter(whole)
    assert {r[0] for r in crossref.distinct_keys(mentions, "MentionIdentifier").collect()} == {d for _, d, *_ in MENTIONS} - {None}
    fans = collections.defaultdict(set)
    for e, d, *_ in MENTIONS:
        if e is not None:
            fans[e] |= {d} - {None}
    assert {r[0]: r.n for r in crossref.fan_out(mentions, "GLOBALEVENTID", "MentionIdentifier").collect()} == {e: len(v) for e, v in fans.items()}


def test_warnings(spark):
    events = spark.createDataFrame([(1, 20120101), (2, 20140101), (3, None)], "GlobalEventID bigint, DATEADDED bigint")
    assert tuple(crossref.coverage(events, "DATEADDED", 20130401).first()) == (2, 1)
    assert "1 of 2" in crossref.warn_coverage(events, "DATEADDED", 20130401) and "all of 2" in crossref.warn_coverage(events, "DATEADDED", 20150101)
    assert crossref.warn_coverage(events, "DATEADDED", 20110101) is None
    assert crossref.is_large(events, 2) and not crossref.is_large(events, 3)
    assert crossref.warn_events_input(events, 2) and crossref.warn_events_input(events, 3) is None
    assert crossref.warn_folder(60_000, "mentions", False) and crossref.warn_folder(60_000, "mentions", True) is None and crossref.warn_folder(9, "mentions", False) is None
    assert crossref.pruned_keys("mentions", ["GLOBALEVENTID"]) == ["MentionIdentifier"]
