from __future__ import annotations

import glob

import pytest
from pyspark.sql import functions as F

from starloom.scratch import (
    CHECKPOINT_DIR,
    clear_scratch,
    materialise,
    scratch_path,
    shared_dir,
)
from starloom.sources import (
    file_inventory,
    publish,
    read_csv,
    read_many,
    read_table,
    register,
    stage,
    write_partitioned,
    write_table,
)
from starloom.sources.schemas import COUNTRY_CODES, DEMOGRAPHICS, IMMIGRATION, TEMPERATURE


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_declared_schemas_parse(spark):
    sizes = [len(spark.createDataFrame([], s).columns) for s in (IMMIGRATION, TEMPERATURE, DEMOGRAPHICS)]
    assert sizes == [28, 7, 12]


def test_csv_with_quotes_and_schema(spark, tmp_path):
    (tmp_path / "codes.csv").write_text('code,Name\n582,"MEXICO Air, Sea (I-94, no land)"\n0,\n')
    df = read_csv(spark, str(tmp_path / "codes.csv"), COUNTRY_CODES)
    assert rows(df) == [(0, None), (582, "MEXICO Air, Sea (I-94, no land)")]
    inferred = read_csv(spark, str(tmp_path / "codes.csv"))
    assert dict(inferred.dtypes) == {"code": "int", "Name": "string"}


def test_csv_header_must_fit_the_schema(spark, tmp_path):
    (tmp_path / "codes.csv").write_text("Name,code\nALBANIA,101\n")
    with pytest.raises(Exception, match="CSV header"):
        read_csv(spark, str(tmp_path / "codes.csv"), COUNTRY_CODES).collect()


def test_csv_separator_and_encoding(spark, tmp_path):
    (tmp_path / "t.csv").write_bytes("dt;City\n2016-01-01;Århus\n".encode("ISO-8859-1"))
    df = read_csv(spark, str(tmp_path / "t.csv"), "dt date, City string", ";", "ISO-8859-1")
    assert [(str(r.dt), r.City) for r in df.collect()] == [("2016-01-01", "Århus")]


def test_many_paths_and_formats(spark, tmp_path):
    paths = []
    for month in (1, 2):
        paths.append(f"{tmp_path}/m{month}")
        spark.range(month).write.json(paths[-1])
    assert read_table(spark, paths, "json", "id bigint").count() == 3


def test_months_with_different_columns(spark, tmp_path):
    spark.range(2).write.parquet(f"{tmp_path}/jan")
    spark.range(2, 3).withColumn("extra", F.lit("x")).write.parquet(f"{tmp_path}/feb")
    df = read_many(spark, [f"{tmp_path}/jan", f"{tmp_path}/feb"])
    assert rows(df) == [(0, None), (1, None), (2, "x")]


def test_inventory_lists_empty_files_and_each_months_columns(spark, tmp_path):
    spark.range(5).coalesce(1).write.parquet(f"{tmp_path}/jan")
    spark.range(0).withColumn("x", F.lit(1)).coalesce(1).write.parquet(f"{tmp_path}/feb")
    found = file_inventory(spark, [f"{tmp_path}/jan", f"{tmp_path}/feb"]).collect()
    months = {r.file_path.split("/")[-2]: (r.n_rows, r.n_columns) for r in found}
    assert months == {"jan": (5, 1), "feb": (0, 2)}
    assert all(r.n_bytes > 0 for r in found)


def test_inventory_of_very_many_small_files(spark, tmp_path, monkeypatch):
    """10,000 footers are read by tasks; the driver opens none and collects no names."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    from starloom.sources import inventory

    for month in range(1, 11):
        folder = tmp_path / "files" / "year=2016" / f"month={month}"
        folder.mkdir(parents=True)
        pq.write_table(pa.table({"a": range(month), "b c": ["x"] * month}), folder / "0.parquet")
        data = (folder / "0.parquet").read_bytes()
        for k in range(1, 1000):
            (folder / f"{k}.parquet").write_bytes(data)
    monkeypatch.setattr(inventory, "_opened", lambda *a: pytest.fail("opened by the driver"))
    found = file_inventory(spark, f"{tmp_path}/files")
    months = found.groupBy(F.regexp_extract("file_path", "month=([0-9]+)", 1).cast("int").alias("m"))
    got = months.agg(F.count("*"), F.sum("n_rows"), F.min("n_columns"), F.max("n_columns"))
    assert rows(got) == sorted(((m, 1000, 1000 * m, 4, 4) for m in range(1, 11)), key=repr)


def test_inventory_opens_large_files_and_long_footers(spark, tmp_path, monkeypatch):
    from starloom.sources import inventory

    spark.range(50_000).coalesce(1).write.parquet(f"{tmp_path}/t/p=1")
    spark.range(3).withColumn("x", F.lit(1)).coalesce(1).write.parquet(f"{tmp_path}/t/p=2")
    whole = rows(file_inventory(spark, f"{tmp_path}/t").select("n_rows", "n_columns"))
    assert whole == [(3, 3), (50_000, 2)]
    monkeypatch.setattr(inventory, "IN_TASKS", 10_000)
    assert rows(file_inventory(spark, f"{tmp_path}/t").select("n_rows", "n_columns")) == whole
    monkeypatch.setattr(inventory, "_TAIL", 16)
    assert rows(file_inventory(spark, f"{tmp_path}/t").select("n_rows", "n_columns")) == whole


def test_staging_refuses_an_existing_path(spark, tmp_path):
    path = f"{tmp_path}/staged"
    assert rows(stage(spark.range(3), path)) == [(0,), (1,), (2,)]
    with pytest.raises(Exception, match="already exists"):
        stage(spark.range(3), path)


def test_write_table_replaces(spark, tmp_path):
    write_table(spark.range(3), f"{tmp_path}/t")
    assert rows(write_table(spark.range(1), f"{tmp_path}/t")) == [(0,)]


def test_partitioned_read_back_keeps_order_types_and_null_folder(spark, tmp_path):
    df = spark.createDataFrame([(2016, "01", 1), (None, "02", 2)], "y int, text string, v bigint")
    back = write_partitioned(df, f"{tmp_path}/p", ["y", "text"])
    assert back.schema.simpleString() == df.schema.simpleString()
    assert rows(back) == rows(df)
    assert glob.glob(f"{tmp_path}/p/y=__HIVE_DEFAULT_PARTITION__/text=02/*.parquet")


def test_replacing_only_the_written_partitions(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "p int, v string")
    path = f"{tmp_path}/p"
    write_partitioned(df, path, "p")
    changed = spark.createDataFrame([(2, "c")], "p int, v string")
    assert rows(write_partitioned(changed, path, "p", replace="partitions")) == [(1, "a"), (2, "c")]
    assert rows(write_partitioned(changed, path, "p")) == [(2, "c")]


def test_a_hot_folder_is_written_by_several_tasks(spark, tmp_path, setting):
    setting("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200000")
    folder = F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id") % 5)
    df = spark.range(0, 200000, 1, 8).withColumn("p", folder)
    back = write_partitioned(df, f"{tmp_path}/p", "p")
    assert back.count() == 200000
    assert len(glob.glob(f"{tmp_path}/p/p=0/*.parquet")) > 2


def test_few_files_per_folder_with_stated_tasks(spark, tmp_path):
    df = spark.range(0, 1000, 1, 8).withColumn("p", F.col("id") % 20)
    assert write_partitioned(df, f"{tmp_path}/p", "p", tasks=4).count() == 1000
    assert len(glob.glob(f"{tmp_path}/p/p=*/*.parquet")) == 20


def test_register_replaces_views(spark):
    register(sl_view=spark.range(2))
    register(sl_view=spark.range(3))
    assert spark.sql("SELECT count(*) AS n FROM sl_view").first().n == 3


class FakeSession:
    """A session's settings, without a session."""

    def __init__(self, folder=None, checkpoint=None):
        self.conf = {"spark.sql.warehouse.dir": "hdfs:///tables/"}
        if folder:
            self.conf[CHECKPOINT_DIR] = folder
        self.checkpoint = checkpoint

    @property
    def sparkContext(self):
        return self

    def getCheckpointDir(self):
        return self.checkpoint


def test_the_shared_folder_is_the_sessions():
    assert shared_dir(FakeSession("s3a://bucket/shared/")) == "s3a://bucket/shared"
    assert shared_dir(FakeSession(checkpoint="hdfs:///c")) == "hdfs:///c"
    assert shared_dir(FakeSession()) == "hdfs:///tables/scratch"


def test_scratch_paths_are_new_and_shared(spark):
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first != second and first.startswith(shared_dir(spark))
    table = materialise(spark.range(4), "four")
    assert table.count() == 4
    assert shared_dir(spark).removeprefix("file:") in table.inputFiles()[0]


def test_scratch_can_be_cleared(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("starloom.scratch.session_dir", lambda session: str(tmp_path / "own"))
    materialise(spark.range(4), "four")
    assert list((tmp_path / "own").rglob("*.parquet"))
    clear_scratch(spark)
    assert not list((tmp_path / "own").rglob("*.parquet"))


def test_malformed_csv_lines_fail_or_are_kept_apart(spark, tmp_path):
    path = str(tmp_path / "codes.csv")
    (tmp_path / "codes.csv").write_text("code,Name\n1,A\n10.0,B\n\"1,200\",C\n4\n5,E,extra\n")
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        read_csv(spark, path, COUNTRY_CODES).select("Name").collect()
    df = read_csv(spark, path, COUNTRY_CODES, malformed="line")
    got = {r.Name: r.line for r in df.collect()}
    assert len(got) == 5 and got["A"] is None
    assert got["B"] == "10.0,B" and got["C"] is not None and got["E"] is not None


def test_csv_with_one_more_column_is_refused_whatever_is_read(spark, tmp_path):
    (tmp_path / "codes.csv").write_text("code,Name,more\n1,A,x\n")
    with pytest.raises(Exception, match="header"):
        read_csv(spark, str(tmp_path / "codes.csv"), COUNTRY_CODES).select("Name").collect()


def test_months_agree_in_type_and_keep_more_columns(spark, tmp_path):
    (tmp_path / "jan.csv").write_text("b,a\nx,1\n")
    (tmp_path / "feb.csv").write_text("a,c\n2.5,z\n")
    paths = [str(tmp_path / f"{m}.csv") for m in ("jan", "feb")]
    df = read_many(spark, paths, "csv", "a double, b string")
    assert df.dtypes == [("a", "double"), ("b", "string"), ("c", "string")]
    assert rows(df) == [(1.0, "x", None), (2.5, None, "z")]


def test_inventory_tells_each_files_columns(spark, tmp_path):
    spark.range(3).coalesce(1).write.parquet(f"{tmp_path}/all")
    spark.range(5).selectExpr("id", "id as more").coalesce(1).write.mode("append").parquet(f"{tmp_path}/all")
    got = file_inventory(spark, f"{tmp_path}/all").where("n_rows > 0").select("n_rows", "n_columns")
    assert rows(got) == [(3, 1), (5, 2)]


def test_publishing_replaces_and_reads_back(spark, tmp_path):
    for n in (3, 4):
        built = f"{tmp_path}/built{n}"
        table = write_table(spark.range(n), built)
        assert publish(table, built, f"{tmp_path}/out/t").count() == n
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == ["t"]
