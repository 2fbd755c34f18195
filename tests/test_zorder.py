"""Row groups that a filter on one of several columns can leave out."""

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from shelfwise.functions import zorder
from shelfwise.sources.store import Load

COLUMNS = ("Client", "City", "Brand")


@pytest.fixture
def small_row_groups(spark):
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.setInt("parquet.block.size", 16384)
    yield
    conf.unset("parquet.block.size")


def values(spark, name, n):
    return spark.range(n).select(F.format_string(f"{name} %03d", "id").alias(name))


def lines(spark, make_wide, n=16):
    """Each combination of client, city and brand six times, in no order."""
    one = make_wide(("2020-01-01", 1)).drop(*COLUMNS)
    for name in COLUMNS:
        one = one.crossJoin(values(spark, name, n))
    copies = one.crossJoin(spark.range(6).withColumnRenamed("id", "_i"))
    return copies.withColumn("ITEMCODE", F.hex(F.xxhash64(*COLUMNS, "_i"))).drop("_i").orderBy("ITEMCODE").coalesce(1)


def share_read(folder, column, value):
    """Of the row groups, how many may hold the value."""
    groups = [
        (statistics.min, statistics.max)
        for path in glob.glob(f"{folder}/**/*.parquet", recursive=True)
        for file in [pq.ParquetFile(path)]
        for number in range(file.metadata.num_row_groups)
        for statistics in [
            next(c for c in (file.metadata.row_group(number).column(i) for i in range(file.metadata.num_columns))
                 if c.path_in_schema == column).statistics
        ]
    ]
    assert len(groups) > 20
    return sum(least <= value <= most for least, most in groups) / len(groups)


def test_a_filter_on_any_of_the_columns_skips_most_row_groups(spark, make_wide, small_row_groups, tmp_path):
    wide = lines(spark, make_wide)
    cell = zorder.cell({name: values(spark, name, 16) for name in COLUMNS})
    run = Load(spark, str(tmp_path / "z"), "z")
    run.write(wide, "Sales_Wide", spread=False, cell=cell)
    assert sorted(map(str, run.table("Sales_Wide", 2).select(*COLUMNS, "ITEMCODE").collect())) == sorted(
        map(str, wide.select(*COLUMNS, "ITEMCODE").collect())
    )
    wide.sortWithinPartitions("Brand", "City").write.parquet(str(tmp_path / "linear"))
    for name in COLUMNS:
        assert share_read(tmp_path / "z", name, f"{name} 005") < 0.45
    assert share_read(tmp_path / "linear", "Client", "Client 005") > 0.9


def test_cells(spark):
    frame = spark.createDataFrame([(None, "b"), ("a", "z"), ("é", None), ("zz", "b"), ("b", "b")], "Client string, City string")
    cuts = zorder.boundaries({"Client": frame, "City": frame})
    assert cuts == {"Client": ["b", "zz", "é"], "City": ["z"]}
    cell = zorder.cell({"Client": frame, "City": frame})
    # Ranges 0 to 3 of Client are bits 0 and 2 of the cell, ranges 0 and 1 of City bit 1.
    assert {(row.Client, row.City): row.cell for row in frame.withColumn("cell", cell).collect()} == {
        (None, "b"): 0, ("a", "z"): 2, ("é", None): 5, ("zz", "b"): 4, ("b", "b"): 1,
    }
    empty = frame.where("false")
    assert zorder.boundaries({"Client": empty}) == {"Client": []}
    assert frame.select(zorder.cell({"Client": empty})).first()[0] == 0


def test_many_values_are_cut_evenly(spark):
    cuts = zorder.boundaries({"City": values(spark, "City", 5000)})["City"]
    assert len(cuts) == 2**zorder.BITS - 1 and cuts == sorted(cuts)
    cell = zorder.cell({"City": values(spark, "City", 5000)})
    counts = [row["count"] for row in values(spark, "City", 5000).groupBy(cell.alias("c")).count().collect()]
    assert len(counts) == 2**zorder.BITS and max(counts) < 3 * 5000 / len(counts)


def test_months_of_one_task_are_each_in_order(spark, make_wide, tmp_path):
    month = F.when(F.xxhash64("ITEMCODE") % 2 == 0, F.lit(1)).otherwise(F.lit(2))
    wide = lines(spark, make_wide, 8).withColumn("Month", month)
    cell = zorder.cell({name: values(spark, name, 8) for name in COLUMNS})
    run = Load(spark, str(tmp_path), "z")
    run.write(wide, "Sales_Wide", spread=False, cell=cell)
    numbers = {tuple(row[:3]): row.cell for row in wide.select(*COLUMNS, cell.alias("cell")).distinct().collect()}
    files = glob.glob(f"{tmp_path}/Sales_Wide/**/*.parquet", recursive=True)
    assert len(files) == 2  # one for each month: the writer has not sorted them again
    for path in files:
        stored = pq.ParquetFile(path).read(list(COLUMNS)).to_pydict()
        found = [numbers[key] for key in zip(*(stored[name] for name in COLUMNS))]
        assert found == sorted(found) and len(set(found)) > 400
