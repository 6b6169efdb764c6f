from collections import Counter

import numpy as np
import pytest

from eventloom.operators.sampling import FileIndex, FilteredSampler, Rng, file_offsets, locate, sample_daily, sample_rows, sample_stratified

ID = ("GlobalEventID",)


def ids(df):
    return [r.GlobalEventID for r in df.collect()]


@pytest.fixture(scope="module")
def hundred(spark):
    return spark.createDataFrame([(i, i % 4, 20200101 + (i % 3 > 0)) for i in range(100)], "GlobalEventID bigint, QuadClass bigint, Day bigint").cache()


def test_size_and_uniqueness(hundred):
    got = ids(sample_rows(hundred, 30))
    assert len(got) == len(set(got)) == 30
    assert ids(sample_rows(hundred, 0)) == []
    with pytest.raises(ValueError):
        sample_rows(hundred, 101)
    assert len(ids(FilteredSampler(hundred, {"QuadClass": 1}).sample(500))) == 25


def test_partitioning_does_not_matter(hundred):
    for f in (lambda d: sample_rows(d, 20), lambda d: sample_daily(d, 5), lambda d: sample_stratified(d, "QuadClass", 3)):
        assert set(ids(f(hundred))) == set(ids(f(hundred.repartition(7, "Day")))) == set(ids(f(hundred.orderBy("QuadClass").coalesce(1))))
    assert set(ids(sample_rows(hundred, 20, 1))) != set(ids(sample_rows(hundred, 20, 2)))


def test_uniform_over_seeds(hundred):
    """Chi-square over seeds: each row should be drawn about as often as any other."""
    seen = Counter(i for seed in range(60) for i in ids(sample_rows(hundred, 20, seed, strict=False)))
    expected = 60 * 20 / 100
    chi2 = sum((seen[i] - expected) ** 2 / expected for i in range(100))
    assert chi2 < 150  # 99 degrees of freedom, far beyond the 0.999 quantile


def test_daily(hundred, spark):
    assert Counter(r.Day for r in sample_daily(hundred, 2).collect()) == {20200101: 2, 20200102: 2}
    assert sample_daily(hundred.drop("Day"), 2).count() == 0
    short = spark.createDataFrame([(1, 5), (2, 5), (3, None)], "GlobalEventID bigint, Day bigint")
    assert sorted(ids(sample_daily(short, 10))) == [1, 2]


def test_daily_by_file(spark, tmp_path):
    for part in ("a", "b"):
        spark.createDataFrame([(ord(part) * 10 + i, 1) for i in range(5)], "GlobalEventID bigint, Day bigint").coalesce(1).write.parquet(str(tmp_path / part))
    df = spark.read.parquet(str(tmp_path / "a"), str(tmp_path / "b"))
    assert sample_daily(df, 2, scope="day").count() == 2
    assert sample_daily(df, 2, scope="file").count() == 4


def test_stratified(hundred, spark):
    assert Counter(r.QuadClass for r in sample_stratified(hundred, "QuadClass", 4).collect()) == {0: 4, 1: 4, 2: 4, 3: 4}
    some = spark.createDataFrame([(i, None if i < 3 else "a") for i in range(10)], "GlobalEventID bigint, g string")
    assert Counter(r.g for r in sample_stratified(some, "g", 2).collect()) == {None: 2, "a": 2}
    with pytest.raises(ValueError):
        sample_stratified(some, "absent", 2)


def test_file_index(spark, tmp_path):
    for name, first, n in (("a", 0, 5), ("b", 5, 3), ("c", 8, 7)):
        spark.range(first, first + n).withColumnRenamed("id", "GlobalEventID").coalesce(1).write.parquet(str(tmp_path / name))
    index = FileIndex(spark, str(tmp_path))
    assert index.total_rows == 15 and index.counts == [5, 3, 7]
    assert index.lookup(4) == (0, 4) and index.lookup(5) == (1, 0)
    assert index.group(np.array([0, 2, 4, 5, 8])) == {0: [0, 2, 4], 1: [0], 2: [0]}
    drawn = np.sort(Rng(3).choice(15, 6)).tolist()
    assert ids(index.sample(6, 3)) == drawn
    with pytest.raises(ValueError):
        index.sample(16)


def test_top_k_is_partial(hundred):
    plan = sample_stratified(hundred, "QuadClass", 2)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert "TakeOrderedAndProject" in sample_rows(hundred, 5)._jdf.queryExecution().executedPlan().toString()


def test_index_over_a_table(spark):
    """Positions count the rows that there are, by file and place, whatever was dropped before."""
    rows = [(f * 100 + r, f"f{f}", r) for f in range(5) for r in range(20) if (f + r) % 3]
    df = spark.createDataFrame(rows, "GlobalEventID bigint, _src_file string, _src_row bigint").repartition(6)
    index = FileIndex(spark, table=df)
    assert index.total_rows == len(rows)
    drawn = np.sort(Rng(9).choice(len(rows), 25))
    assert [r.GlobalEventID for r in index.sample(25, 9).collect()] == [rows[g][0] for g in drawn]
    with pytest.raises(ValueError):
        index.sample(len(rows) + 1)


def test_located_positions(spark):
    counts = [("a", 5), ("b", 0), ("c", 2500), ("d", 1), ("e", 700)]
    index = file_offsets(spark.createDataFrame(counts, "file string, n bigint"))
    starts = np.cumsum([0, *(n for _, n in counts)])
    want = sorted((g, counts[i][0], g - starts[i]) for g in range(0, 3206, 7) for i in [int(np.searchsorted(starts[1:], g, side="right"))])
    for bucket in (10, 1 << 20):
        got = locate(spark.createDataFrame([(g,) for g in range(0, 4000, 7)], "g bigint"), index, bucket)
        assert sorted(map(tuple, got.collect())) == want
    assert "NestedLoop" not in got._jdf.queryExecution().executedPlan().toString()


def test_daily_columns(hundred):
    wide = hundred.withColumns({"_src_file": hundred.QuadClass.cast("string"), "x": hundred.Day})
    assert sample_daily(wide, 2, columns=["x"]).columns == ["Day", "x"] and sample_daily(wide, 2, scope="file", columns=["GlobalEventID"]).count() == 2 * 2 * 4
    with pytest.raises(ValueError):
        sample_daily(wide, 2, columns=["nope"])
