"""The stages as streams: each file once, other settings afresh, mentions whenever they come."""

from pyspark.sql import types as T

from eventloom.sources.specs import spec
from eventloom.streaming.incremental import filter_stream, mentions_of

SCHEMA = T.StructType([*spec("mentions").schema.fields, T.StructField("_src_file", T.StringType()), T.StructField("_src_row", T.LongType())])


def mention(i, event, doc, confidence):
    row = dict.fromkeys(SCHEMA.names)
    return tuple((row | {"GLOBALEVENTID": event, "MentionIdentifier": doc, "Confidence": confidence, "_src_file": "f", "_src_row": i}).values())


def arrive(spark, folder, name, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{folder}/{name}")
    part = next((folder / name).glob("part-*.parquet"))
    (folder / "in").mkdir(exist_ok=True)
    part.rename(folder / "in" / f"{name}.parquet")


def test_filter_stream(spark, tmp_path):
    def run(out, check, keep=("GLOBALEVENTID",)):
        filter_stream(spark, str(tmp_path / "in"), str(tmp_path / out), str(tmp_path / "marks"), "mentions", check, list(keep)).awaitTermination()
        return sorted(r.GLOBALEVENTID for r in spark.read.parquet(str(tmp_path / out)).collect())

    arrive(spark, tmp_path, "a", [mention(0, 1, "d", 5), mention(1, 2, None, 6)])
    assert run("one", ["MentionIdentifier"]) == [1]
    arrive(spark, tmp_path, "b", [mention(0, 3, "e", None)])
    assert run("one", ["MentionIdentifier"]) == [1, 3] == run("one", ["MentionIdentifier"])
    assert run("two", ["Confidence"]) == [1, 2]  # other settings: another checkpoint, all files anew
    assert len(list((tmp_path / "marks").iterdir())) == 2


def test_late_mentions(spark, tmp_path):
    """A mention finds its event however long ago that was; events without a mention give nothing."""
    arrive(spark, tmp_path, "a", [mention(0, 10, "d", 5), mention(1, 11, "d", 6)])
    events = spark.createDataFrame([(10, 19790101), (10, 19790101), (12, 20200101)], "GlobalEventID bigint, Day bigint")
    stream = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in"))

    def run():
        found = mentions_of(stream, events).select("GLOBALEVENTID", "MentionIdentifier", "_src_row")
        found.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
        return sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect())

    assert run() == [(10, "d", 0)]
    arrive(spark, tmp_path, "b", [mention(7, 12, "x", 1), mention(8, 10, "y", 1)])
    assert run() == [(10, "d", 0), (10, "y", 8), (12, "x", 7)]
