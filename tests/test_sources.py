import csv
import glob
import os
from types import SimpleNamespace

import pytest
from pyspark.errors import AnalysisException
from support import plan, rows

from loanscope.operators.cleaning import clean_loans, select_columns
from loanscope.schema import CLEAN_COLUMNS, CLEAN_SCHEMA, SELECTED_COLUMNS
from loanscope.sources.manifest import input_manifest, output_manifest, rows_per_file
from loanscope.sources.readers import read_csv, read_loans, read_processed
from loanscope.sources.scratch import scratch_path
from loanscope.sources.writers import write_loans


def with_header(golden_path, target, change):
    with open(golden_path, newline="") as f:
        records = list(csv.DictReader(f))
    columns = change(list(records[0]))
    with open(target, "w", newline="") as f:
        writer = csv.DictWriter(f, columns, restval="more")
        writer.writeheader()
        writer.writerows(records)


def test_quotes_and_line_breaks(golden_raw):
    assert golden_raw.columns == [*SELECTED_COLUMNS, "desc"]
    assert golden_raw.where("id = '1'").first()["desc"] == 'said "hi",\nnext line'
    assert golden_raw.where("id = '1'").first()["term"] == " 36 months"


def test_columns_are_found_by_name(spark, golden_path, golden_raw, tmp_path):
    with_header(golden_path, tmp_path / "a.csv", lambda c: ["extra", *reversed(c)])
    assert rows(select_columns(read_loans(spark, str(tmp_path)))) == rows(select_columns(golden_raw))


@pytest.mark.parametrize("multi_line", [True, False])
def test_a_file_with_another_header_fails(spark, golden_path, tmp_path, multi_line):
    with_header(golden_path, tmp_path / "a.csv", lambda c: c[:-1] + ["desc"])
    with_header(golden_path, tmp_path / "b.csv", lambda c: [*reversed(c)])
    with pytest.raises(Exception, match="header|CSV"):
        read_csv(spark, str(tmp_path), multi_line=multi_line).collect()


def test_inferred_types(spark, golden_path):
    types = dict(read_csv(spark, golden_path, schema=None).dtypes)
    assert (types["id"], types["loan_amnt"], types["annual_inc"], types["int_rate"]) == (
        "string", "int", "double", "string",
    )
    assert dict(read_csv(spark, golden_path).dtypes)["loan_amnt"] == "string"


def test_inferred_input_cleans_to_the_same_table(spark, golden_path, golden_clean):
    assert rows(clean_loans(read_csv(spark, golden_path, schema=None))) == rows(golden_clean)


@pytest.mark.parametrize("fmt", ["csv", "json", "orc", "parquet"])
@pytest.mark.parametrize("by_year", [False, True])
def test_clean_round_trip(spark, golden_clean, tmp_path, fmt, by_year):
    path = str(tmp_path / "out")
    write_loans(golden_clean, path, fmt, partition_by_year=by_year)
    back = read_processed(spark, path, fmt)
    assert [(f.name, f.dataType) for f in back.schema] == [(f.name, f.dataType) for f in CLEAN_SCHEMA]
    assert rows(back) == rows(golden_clean)
    if by_year:
        assert len(glob.glob(f"{path}/year=*")) == 3


@pytest.mark.parametrize("fmt", ["csv", "json", "orc", "parquet"])
def test_raw_round_trip(spark, golden_raw, tmp_path, fmt):
    raw = golden_raw.transform(select_columns)
    write_loans(raw, str(tmp_path / "out"), fmt)
    assert rows(select_columns(read_loans(spark, str(tmp_path / "out"), fmt))) == rows(raw)


def test_line_breaks_survive_the_csv_round_trip(spark, golden_clean, tmp_path):
    odd = golden_clean.where("id = '1'").withColumn("purpose", golden_clean["id"].substr(1, 1)).selectExpr(
        *[c if c != "purpose" else "concat('A\"', chr(10), ' B ') AS purpose" for c in CLEAN_COLUMNS]
    )
    write_loans(odd, str(tmp_path / "out"), "csv")
    assert read_processed(spark, str(tmp_path / "out"), "csv").first()["purpose"] == 'A"\n B '


@pytest.mark.parametrize("fmt", ["csv", "orc", "parquet"])
def test_year_filter_reads_one_folder(spark, golden_clean, tmp_path, fmt):
    path = str(tmp_path / "out")
    write_loans(golden_clean, path, fmt, partition_by_year=True)
    one = read_processed(spark, path, fmt).where("year = 2015")
    filters = plan(one).split("PartitionFilters: [")[1].split("]")[0]
    assert "= 2015" in filters
    assert one.count() == 5


def test_file_count(spark, tmp_path):
    df = spark.range(1000).selectExpr("id", "CAST(2000 + id % 3 AS INT) AS year")
    write_loans(df, str(tmp_path / "a"), n_files=3)
    assert len(glob.glob(f"{tmp_path}/a/part-*")) == 3
    write_loans(df.coalesce(1), str(tmp_path / "b"), max_records_per_file=300)
    assert len(glob.glob(f"{tmp_path}/b/part-*")) == 4
    assert spark.read.parquet(str(tmp_path / "b")).count() == 1000


def test_no_single_writer(golden_clean, tmp_path):
    with pytest.raises(ValueError, match="at least 2"):
        write_loans(golden_clean, str(tmp_path / "a"), n_files=1)
    with pytest.raises(ValueError, match="exclude"):
        write_loans(golden_clean, str(tmp_path / "a"), n_files=2, partition_by_year=True)


def test_unknown_format(spark, golden_clean, tmp_path):
    with pytest.raises(ValueError, match="unknown format"):
        read_loans(spark, str(tmp_path), "xml")
    with pytest.raises(ValueError, match="unknown format"):
        write_loans(golden_clean, str(tmp_path / "a"), "xml")


def test_manifests(spark, golden_clean, golden_path, tmp_path):
    row = input_manifest(spark, golden_path).first()
    assert row["path"].endswith("golden.csv") and row["length"] == os.path.getsize(golden_path) and row["status"] == "valid"
    path = str(tmp_path / "out")
    write_loans(golden_clean.repartition(2, "id"), path, "csv")
    sizes = {f: len(open(f, "rb").read()) for f in glob.glob(f"{path}/*.csv")}
    row = output_manifest(spark, path).first()
    assert (row["csv_files"], row["total_files"]) == (len(sizes), len(sizes))
    assert row["main_file_bytes"] == max(sizes.values())
    write_loans(golden_clean, str(tmp_path / "parquet"))
    assert tuple(output_manifest(spark, str(tmp_path / "parquet")).first())[2:] == (None, 0)


def test_manifest_reads_no_content(spark, golden_path):
    assert "content" not in plan(input_manifest(spark, golden_path)).split("ReadSchema")[-1]


def test_missing_input(spark, tmp_path):
    with pytest.raises(AnalysisException):
        input_manifest(spark, str(tmp_path / "nothing"))


def session_with(**settings):
    conf = {key.replace("_", "."): value for key, value in settings.items()}
    return SimpleNamespace(conf=SimpleNamespace(get=conf.get))


def test_scratch_is_a_new_path_in_the_shared_folder():
    session = session_with(spark_checkpoint_dir="hdfs://cluster/shared/")
    first, second = scratch_path(session, "a"), scratch_path(session, "a")
    assert first.startswith("hdfs://cluster/shared/loanscope-") and first != second


@pytest.mark.parametrize("master", ["local[4]", "yarn"])
def test_scratch_without_the_setting(master):
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: {"spark.sql.warehouse.dir": "s3://w/", "spark.master": master}.get(key, default)))
    assert scratch_path(session, "a").startswith("s3://w/checkpoints/loanscope-")


def test_compressed_csv_counts_as_csv(spark, golden_clean, tmp_path):
    golden_clean.coalesce(1).write.option("compression", "gzip").csv(str(tmp_path / "out"))
    assert output_manifest(spark, str(tmp_path / "out")).first()["csv_files"] == 1


@pytest.mark.parametrize("fmt", ["orc", "parquet"])
def test_columnar_files_with_different_columns(spark, golden_raw, tmp_path, fmt):
    selected = golden_raw.transform(select_columns)
    selected.where("id = '1'").drop("dti").write.format(fmt).save(str(tmp_path / "in" / "a"))
    selected.where("id = '2'").drop("grade").write.format(fmt).save(str(tmp_path / "in" / "b"))
    back = {r["id"]: r for r in read_loans(spark, str(tmp_path / "in" / "*"), fmt).transform(select_columns).collect()}
    assert (back["1"]["dti"], back["1"]["grade"], back["2"]["dti"], back["2"]["grade"]) == (None, "A", "10.0", None)


def test_csv_lists_its_folder_once(spark, golden_path):
    """One read gives names and rows; types come by a projection."""
    assert plan(read_loans(spark, golden_path)).count("FileScan csv") == 1


def test_rows_per_file(spark, golden_raw, tmp_path):
    golden_raw.select("id").coalesce(1).write.parquet(str(tmp_path / "t"))
    assert [r["n_rows"] for r in rows_per_file(spark.read.parquet(str(tmp_path / "t"))).collect()] == [13]


def test_intermediates_go_with_their_folder(spark, tmp_path):
    import glob

    from loanscope.sources.scratch import checkpointed, intermediates, shared_folder

    place = shared_folder(spark).removeprefix("file:")
    with intermediates(spark) as folder:
        kept = checkpointed(spark.range(10))
        assert kept.count() == 10 and glob.glob(f"{folder.removeprefix('file:')}/checkpoints/*/rdd-*")
        kept.write.parquet(f"{tmp_path}/kept")
    assert spark.read.parquet(f"{tmp_path}/kept").count() == 10
    assert not glob.glob(f"{folder.removeprefix('file:')}/*") and folder.removeprefix('file:') not in glob.glob(f"{place}/work_*")
    assert checkpointed(spark.range(5)).count() == 5


def test_a_local_folder_is_refused_on_a_cluster(monkeypatch):
    from types import SimpleNamespace

    from loanscope.sources.scratch import shared_folder

    def session(master, **conf):
        values = {"spark.sql.warehouse.dir": "file:/tmp/warehouse"} | conf
        return SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: values.get(k, d)), sparkContext=SimpleNamespace(master=master))

    assert shared_folder(session("local[4]")) == "file:/tmp/warehouse/checkpoints"
    with pytest.raises(ValueError):
        shared_folder(session("yarn"))
    assert shared_folder(session("yarn", **{"spark.sql.warehouse.dir": "hdfs:///w"})) == "hdfs:///w/checkpoints"
    assert shared_folder(session("yarn", **{"spark.checkpoint.dir": "file:///nfs/x/"})) == "file:///nfs/x"
