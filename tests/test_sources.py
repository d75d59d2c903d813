import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tallyloom.operators.ordinals import with_row_index
from tallyloom.schemas import RAW
from tallyloom.sources import extract_all, read_csv, read_json, read_parquet
from tallyloom.sources.registry import read_source


def test_six_sources_with_row_counts(spark, data_dir):
    sources = extract_all(spark, data_dir)
    counts = {name: e.row_count() for name, e in sources.items()}
    assert counts == {
        "orders": 6, "customers": 4, "returns": 2, "products": 4, "suppliers": 3, "shipping": 5,
    }
    for name, extraction in sources.items():
        assert extraction.columns == RAW[name].fieldNames()
        assert extraction.source_path.startswith(data_dir)


def test_observed_count_comes_with_the_first_action(spark, data_dir):
    df, watch = extract_all(spark, data_dir)["orders"].observed()
    df.write.format("noop").mode("overwrite").save()
    assert watch.get["rows"] == 6


def test_missing_file(spark, tmp_path):
    with pytest.raises(AnalysisException):
        extract_all(spark, str(tmp_path))


def test_unknown_override(spark, data_dir):
    with pytest.raises(KeyError):
        extract_all(spark, data_dir, {"invoices": ("csv", "x")})


def test_csv_columns_are_found_by_name(spark, tmp_path):
    path = tmp_path / "r.csv"
    path.write_text(" Reason ,ORDER_ID,return_id,return_date,extra\nbad,O1,R1,2024-01-01,x\n")
    row = read_csv(spark, str(path), RAW["returns"]).first()
    assert (row.return_id, row.order_id, row.reason, row.extra) == ("R1", "O1", "bad", "x")


def test_csv_missing_column(spark, tmp_path):
    path = tmp_path / "r.csv"
    path.write_text("return_id,order_id\nR1,O1\n")
    with pytest.raises(ValueError, match="return_date"):
        read_csv(spark, str(path), RAW["returns"])


def test_csv_bad_field_becomes_null_and_is_kept_on_request(spark, tmp_path):
    path = tmp_path / "s.csv"
    path.write_text(
        "supplier_id,name,country,lead_time_days,reliability_rating\nS1,n,DE,soon,4.5\n"
    )
    row = read_csv(spark, str(path), RAW["suppliers"], keep_corrupt=True).first()
    assert row.lead_time_days is None and row.supplier_id == "S1"
    assert "soon" in row._corrupt_record


def test_json_absent_keys_are_null_and_lines_work(spark, tmp_path):
    a, b = tmp_path / "a.json", tmp_path / "b.json"
    a.write_text(json.dumps([{"supplier_id": "S1", "name": "x"}, {"supplier_id": "S2"}]))
    b.write_text('{"supplier_id": "S1"}\n{"supplier_id": "S2"}\n')
    assert read_json(spark, str(a), RAW["suppliers"]).filter("country IS NULL").count() == 2
    assert read_json(spark, str(b), RAW["suppliers"], json_lines=True).count() == 2


def test_parquet_and_table_sources(spark, data_dir, sources, tmp_path):
    path = str(tmp_path / "orders_parquet")
    sources["orders"].write.parquet(path)
    sources["customers"].createOrReplaceTempView("raw_customers_view")
    found = extract_all(
        spark,
        data_dir,
        {"orders": ("parquet", path), "customers": ("table", "raw_customers_view", ["signup_date", "name"])},
    )
    assert found["orders"].row_count() == 6
    assert found["customers"].row_count() == sources["customers"].count()
    with pytest.raises(ValueError, match="order_by"):
        extract_all(spark, data_dir, {"customers": ("table", "raw_customers_view")})
    with pytest.raises(ValueError, match="missing columns"):
        read_parquet(spark, path, RAW["returns"])


def test_row_index_over_many_splits(spark, tmp_path):
    """Dense positions over several files and splits, without a sort."""
    folder = tmp_path / "many"
    folder.mkdir()
    expected = []
    for part in ("a", "b", "c"):
        lines = [f"R{part}{i:04d},O{i},2024-01-01,x" for i in range(700)]
        expected += [line.split(",")[0] for line in lines]
        (folder / f"{part}.csv").write_text(
            "return_id,order_id,return_date,reason\n" + "\n".join(lines) + "\n"
        )
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = read_csv(spark, str(folder), RAW["returns"])
        assert df.rdd.getNumPartitions() > 3
        kept = with_row_index(df, F.col("return_id").endswith("7"))
        got = {r.return_id: r.row_index for r in kept.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == {rid: i for i, rid in enumerate(expected) if rid.endswith("7")}


HEADER = "order_id,customer_id,product_id,quantity,unit_price,discount_pct,order_date,status"


def test_csv_files_with_different_column_order(spark, tmp_path):
    (tmp_path / "1.csv").write_text(f"{HEADER}\nO1,C1,P1,1.0,2.5,0,2024-01-01,completed\n")
    (tmp_path / "2.csv").write_text(
        "customer_id, ORDER_ID ,note,product_id,quantity,unit_price,discount_pct,order_date,status\n"
        "C2,O2,hello,P2,2.5,2.5,0,2024-01-01,pending\n"
    )
    rows = {r.order_id: r for r in read_csv(spark, str(tmp_path), RAW["orders"]).collect()}
    assert (rows["O1"].customer_id, rows["O1"].quantity, rows["O1"].note) == ("C1", 1, None)
    assert (rows["O2"].customer_id, rows["O2"].quantity, rows["O2"].note) == ("C2", None, "hello")


def test_csv_quotes_and_line_breaks(spark, tmp_path):
    (tmp_path / "s.csv").write_text(
        "supplier_id,name,country,lead_time_days,reliability_rating\n"
        'S1,"A ""B"" C, x",DE,5.0,4.5\n'
        'S2,"two\nlines",FR,7,3\n'
    )
    row = read_csv(spark, str(tmp_path), RAW["suppliers"]).filter("supplier_id = 'S1'").first()
    assert (row.name, row.country, row.lead_time_days) == ('A "B" C, x', "DE", 5)
    names = read_csv(spark, str(tmp_path), RAW["suppliers"], multiline=True).select("name", "country")
    assert sorted(map(tuple, names.collect())) == [('A "B" C, x', "DE"), ("two\nlines", "FR")]


@pytest.mark.parametrize("lines", [False, True])
def test_json_keys_in_any_case_and_undeclared_ones(spark, tmp_path, lines):
    one = '{"Supplier_ID": "S1", " NAME ": "a", "lead_time_days": 5.0, "extra": null, "Tags": [1, 2]}'
    two = '{"supplier_id": "S2", "name": "b", "Reliability_Rating": 4.5}'
    (tmp_path / "s.json").write_text(f"{one}\n{two}\n" if lines else f"[{one},\n {two}]")
    df = read_json(spark, str(tmp_path), RAW["suppliers"], json_lines=lines)
    assert df.columns == [*RAW["suppliers"].fieldNames(), "extra", "tags", "_ordinal"]
    assert sorted((r.supplier_id, r.name, r.lead_time_days, r.reliability_rating, r.tags) for r in df.collect()) == [
        ("S1", "a", 5, None, "[1,2]"), ("S2", "b", None, 4.5, None),
    ]


@pytest.mark.parametrize("lines", [False, True])
def test_json_keys_spelled_alike_are_looked_up_as_they_are(spark, tmp_path, lines):
    one, two = (json.dumps({" SUPPLIER_ID": k, "Name": k, "name": "later", "name ": "last"}) for k in ("S1", "S2"))
    three = json.dumps({" SUPPLIER_ID": None, "name": "x", " SUPPLIER_ID ": "S9"}).replace(" SUPPLIER_ID ", " SUPPLIER_ID")
    rows = [one, two, three]
    (tmp_path / "s.json").write_text("\n".join(rows) if lines else f"[{', '.join(rows)}]")
    df = read_json(spark, str(tmp_path), RAW["suppliers"], json_lines=lines)
    alike = df.select("supplier_id")._jdf.queryExecution().optimizedPlan().toString()
    assert "map_filter" not in alike
    found = df.select("supplier_id", "name", "country").collect()
    assert sorted(map(tuple, found), key=str) == sorted([("S1", "S1", None), ("S2", "S2", None), (None, "x", None)], key=str)


def test_parquet_keeps_undeclared_columns(spark, tmp_path):
    rows = spark.createDataFrame([("S1", "n", "DE", 5, 4.5, 7)],
                                 "SUPPLIER_ID string, name string, country string, lead_time_days int,"
                                 " reliability_rating double, Extra int")  # fmt: skip
    rows.write.parquet(str(tmp_path / "p"))
    row = read_parquet(spark, str(tmp_path / "p"), RAW["suppliers"]).first()
    assert (row.supplier_id, row.extra) == ("S1", "7")


def jobs_of(spark, group, action):
    spark.sparkContext.setJobGroup(group, group)
    try:
        out = action()
    finally:
        for name in ("spark.jobGroup.id", "spark.job.description", "spark.job.interruptOnCancel"):
            spark.sparkContext.setLocalProperty(name, None)
    return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_many_csv_files_need_few_jobs(spark, tmp_path):
    """Five hundred files of one header, then one with another: the jobs don't grow with the files."""
    folder = tmp_path / "many"
    folder.mkdir()
    for k in range(500):
        (folder / f"{k:03d}.csv").write_text(f"return_id,order_id,return_date,reason\nR{k},O{k},2024-01-01,x\n")
    df, jobs = jobs_of(spark, "one-header", lambda: read_csv(spark, str(folder), RAW["returns"]))
    assert jobs <= 3 and df.count() == 500
    (folder / "zzz.csv").write_text("\nreason,return_date,order_id,return_id\ny,2024-01-02,O,R\n")
    df, jobs = jobs_of(spark, "two-headers", lambda: read_csv(spark, str(folder), RAW["returns"]))
    assert jobs <= 10
    assert df.filter("reason = 'y'").first()[:4] == ("R", "O", "2024-01-02", "y")
    assert df.filter("reason = 'x' AND return_id = concat('R', substr(order_id, 2))").count() == 500


def test_csv_without_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_text("return_id,order_id,return_date,reason\n")
    (tmp_path / "b.csv").write_text("")
    df = read_csv(spark, str(tmp_path), RAW["returns"])
    assert df.count() == 0 and df.columns == [*RAW["returns"].fieldNames(), "_ordinal"]


def test_file_order_decides_between_copies(spark, tmp_path):
    """Copies of one customer that differ in nothing but their place: the first by file and line stays."""
    from tallyloom.operators.cleaning import clean_customers

    head = "customer_id,name,email,region,city,segment,signup_date\n"
    (tmp_path / "b.csv").write_text(head + "C1,third,e,r,c,s,2024-01-01\nC2,first,e,r,c,s,2024-01-01\n")
    (tmp_path / "a.csv").write_text(head + "C1,first,e,r,c,s,2024-01-01\nC1,second,e,r,c,s,2024-01-01\n")
    got = clean_customers(read_csv(spark, str(tmp_path), RAW["customers"]))
    assert sorted((r.customer_id, r.name) for r in got.collect()) == [("C1", "first"), ("C2", "first")]


def test_order_columns_decide_between_copies_in_a_table(spark):
    from tallyloom.operators.cleaning import clean_customers

    rows = [("C1", n, "e", "r", "c", "s", "2024-01-01", at) for n, at in (("late", 9), ("early", 2), ("later", 11))]
    table = spark.createDataFrame(rows, [*RAW["customers"].fieldNames(), "arrived"])
    table.createOrReplaceTempView("copied_customers")
    got = clean_customers(read_source(spark, "customers", "table", "copied_customers", ["arrived"]))
    assert [r.name for r in got.collect()] == ["early"]
