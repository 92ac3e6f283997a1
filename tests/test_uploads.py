import datetime as dt
import os

import pytest
from helpers import plan, rows
from pyspark.sql import Observation
from pyspark.sql import functions as F

from weathermart.schemas import RAW_SALES, RETAIL_UPLOAD
from weathermart.sources import ledger, uploads

HEADER = "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"
STAMP = "2025-01-01T00:00:00+00:00"


def put(folder, name, *lines, encoding="utf-8", header=HEADER):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes((header + "".join(line + "\n" for line in lines)).encode(encoding))
    return path


def scan(spark, folder, **options):
    return uploads.read_uploads(spark, str(folder), **options).drop("_metadata")


def test_each_file_is_decoded_by_its_own_encoding(spark, tmp_path):
    put(tmp_path, "utf8.csv", "1,A,Café,1,12/1/2010 8:26,2.5,17850.0,France")
    creme = "2,B,Cr\xe8me,1,12/1/2010 8:26,2.5,17850.0,France"
    put(tmp_path, "latin.csv", creme, encoding="latin-1")
    put(tmp_path, "ascii.csv", "3,C,Tea,1,12/1/2010 8:26,2.5,17850.0,France")
    found = scan(spark, tmp_path).select("InvoiceNo", "Description")
    assert rows(found) == [("1", "Café"), ("2", "Crème"), ("3", "Tea")]
    seen = uploads.inspect_csv(spark, [str(p) for p in tmp_path.glob("*.csv")]).collect()
    assert {os.path.basename(row.path): row.utf8 for row in seen} == {
        "utf8.csv": True, "latin.csv": False, "ascii.csv": True,
    }
    assert len({row.layout for row in seen}) == 1


def test_one_bad_byte_late_in_a_file_decides_for_the_whole_file(spark, tmp_path):
    lines = [f"{i},A,plain,1,12/1/2010 8:26,2.5,1.0,UK" for i in range(2000)]
    last = "x,A,\xa3 sign,1,12/1/2010 8:26,2.5,1.0,UK"
    put(tmp_path, "late.csv", *lines, last, encoding="latin-1")
    found = scan(spark, tmp_path)
    assert found.count() == 2001
    assert found.filter("InvoiceNo = 'x'").first().Description == "£ sign"


def test_named_encoding_needs_no_detection_pass(spark, tmp_path):
    put(tmp_path, "a.csv", "1,A,Cr\xe8me,1,12/1/2010 8:26,2.5,1.0,UK", encoding="latin-1")
    assert scan(spark, tmp_path, encoding="ISO-8859-1").first().Description == "Crème"


def test_quotes_backslashes_spaces_and_null_markers(spark, tmp_path):
    put(
        tmp_path,
        "a.csv",
        '1,A,"SAY ""HI"", NOW",1,12/1/2010 8:26,2.5,17850.0,UK',
        "2,B,back\\slash,1,12/1/2010 8:26,2.5,17850,UK",
        "3,C,  ,1,12/1/2010 8:26,2.5,,UK",
        "4,D,NaN,1,12/1/2010 8:26,2.5,NA,n/a",
        '5,E,"",1,12/1/2010 8:26,2.5,1,UK',
    )
    found = scan(spark, tmp_path).select("InvoiceNo", "Description", "CustomerID", "Country")
    assert rows(found) == [
        ("1", 'SAY "HI", NOW', 17850.0, "UK"),
        ("2", "back\\slash", 17850.0, "UK"),
        ("3", "  ", None, "UK"),
        ("4", None, None, None),
        ("5", None, 1.0, "UK"),
    ]


def test_quoted_line_breaks_need_the_multiline_option(spark, tmp_path):
    put(tmp_path, "a.csv", '1,A,"two\nlines",1,12/1/2010 8:26,2.5,1,UK')
    assert scan(spark, tmp_path, multiline=True).first().Description == "two\nlines"


def test_quoted_line_breaks_are_an_error_without_the_option(spark, tmp_path):
    put(tmp_path, "a.csv", '1,A,"two\nlines",1,12/1/2010 8:26,2.5,1,UK')
    with pytest.raises(Exception, match="multiline=True"):
        scan(spark, tmp_path).collect()


def test_line_break_in_the_last_cell_is_an_error_without_the_option(spark, tmp_path):
    split = '1,A,x,1,12/1/2010 8:26,2.5,1,"U\nK"'
    put(tmp_path, "a.csv", split, "2,A,x,1,12/1/2010 8:26,2.5,1,UK")
    with pytest.raises(Exception, match="multiline=True"):
        scan(spark, tmp_path).select("InvoiceNo").collect()


def test_rows_of_the_wrong_width(spark, tmp_path):
    put(tmp_path, "short.csv", "1,A,x,1")
    assert rows(scan(spark, tmp_path).select("InvoiceNo", "Quantity", "Country")) == [("1", 1, None)]
    put(tmp_path, "long.csv", '1,A,"x,y",1,12/1/2010 8:26,2.5,1,UK,more')
    with pytest.raises(Exception, match="too many cells"):
        scan(spark, tmp_path).collect()


def test_numbers_as_exports_write_them(spark, tmp_path):
    put(
        tmp_path,
        "a.csv",
        "1,A,x,6.0,12/1/2010 8:26,2,17850,UK",
        "2,A,x,NA,12/1/2010 8:26,1e2, 5 ,UK",
        "3,A,x,-3,12/1/2010 8:26,nan,,UK",
    )
    found = scan(spark, tmp_path).select("InvoiceNo", "Quantity", "UnitPrice", "CustomerID")
    assert rows(found) == [
        ("1", 6, 2.0, 17850.0), ("2", None, 100.0, 5.0), ("3", -3, None, None),
    ]


@pytest.mark.parametrize("quantity, message", [("6.5", "not a whole number"), ("six", "six")])
def test_unreadable_numbers_are_an_error(spark, tmp_path, quantity, message):
    put(tmp_path, "a.csv", f"1,A,x,{quantity},12/1/2010 8:26,2,17850,UK")
    with pytest.raises(Exception, match=message):
        scan(spark, tmp_path).collect()


def test_columns_are_found_by_name_in_every_file(spark, tmp_path):
    put(tmp_path, "a.csv", "1,A,x,1,12/1/2010 8:26,2.5,1,UK")
    put(
        tmp_path,
        "b.csv",
        "FR,2,2.5,6,B,yes,12/1/2010 8:26,y",
        "FR,3,2.5,6,B,no,12/1/2010 8:26,z",
        header="country,CustomerID,UnitPrice,Quantity,StockCode,Gift.Wrap,InvoiceDate,Text\n",
    )
    found = scan(spark, tmp_path)
    assert found.filter("InvoiceDate = '2010-12-01 08:26:00'").count() == 3
    columns = ("StockCode", "Quantity", "CustomerID", "Country", "`Gift.Wrap`")
    assert rows(found.select("InvoiceNo", *columns)) == [
        (None, "B", 6, 2.0, "FR", "yes"),
        (None, "B", 6, 3.0, "FR", "no"),
        ("1", "A", 1, 1.0, "UK", None),
    ]


def test_header_is_the_first_line_whatever_the_split_size(spark, tmp_path, conf):
    conf(spark__sql__files__maxPartitionBytes="20000")
    for name, first in (("a.csv", "Alpha"), ("b.csv", "Beta")):
        lines = [f"{i:05},A,x,1,12/1/2010 8:26,2.5,1,UK" for i in range(3000)]
        put(tmp_path, name, *lines, header=HEADER.replace("StockCode", first))
    found = scan(spark, tmp_path)
    assert {"Alpha", "Beta"} < set(found.columns)
    assert found.filter("Alpha = 'A'").count() == found.filter("Beta = 'A'").count() == 3000


def test_a_named_encoding_expects_the_declared_header(spark, tmp_path):
    header = HEADER.replace("StockCode", "Sku")
    put(tmp_path, "a.csv", "1,A,x,1,12/1/2010 8:26,2.5,1,UK", header=header)
    with pytest.raises(Exception, match="(?i)header"):
        scan(spark, tmp_path, encoding="UTF-8").collect()


def test_files_without_a_line_add_nothing(spark, tmp_path):
    put(tmp_path, "blank.csv", header="\n\n")
    assert uploads.read_uploads(spark, str(tmp_path)) is None
    put(tmp_path, "a.csv", "1,A,x,1,12/1/2010 8:26,2.5,1,UK", header="\n" + HEADER)
    assert rows(scan(spark, tmp_path).select("InvoiceNo")) == [("1",)]


def test_header_case_is_ignored(spark, tmp_path):
    header = HEADER.replace("Country", "country")
    put(tmp_path, "a.csv", "1,A,x,1,12/1/2010 8:26,2.5,1,UK", header=header)
    assert scan(spark, tmp_path).first().country == "UK"


def test_pruned_columns_still_match_the_header(spark, tmp_path):
    put(tmp_path, "a.csv", "1,A,x,1,12/1/2010 8:26,2.5,1,UK")
    assert rows(scan(spark, tmp_path).select("Quantity", "Country")) == [(1, "UK")]


def test_dates_are_parsed_and_bad_ones_become_null(spark, tmp_path):
    put(
        tmp_path,
        "a.csv",
        "1,A,x,1,12/1/2010 8:26,2.5,1,UK",
        "2,A,x,1,2010-12-01 08:26:00,2.5,1,UK",
        "3,A,x,1,13/13/2010 8:26,2.5,1,UK",
        "4,A,x,1,8:26,2.5,1,UK",
        "5,A,x,1,,2.5,1,UK",
    )
    moment = dt.datetime(2010, 12, 1, 8, 26)
    found = rows(scan(spark, tmp_path).select("InvoiceNo", "InvoiceDate"))
    assert found == [("1", moment), ("2", moment), ("3", None), ("4", None), ("5", None)]


def test_missing_folder_missing_file_and_unknown_type(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        uploads.read_uploads(spark, str(tmp_path / "nowhere"))
    with pytest.raises(FileNotFoundError):
        uploads.read_uploads(spark, str(tmp_path), "gone.csv")
    put(tmp_path, "sheet.xlsx", "x")
    with pytest.raises(ValueError, match="Unsupported file type: xlsx"):
        uploads.read_uploads(spark, str(tmp_path), "sheet.xlsx")


def test_folder_without_uploads_gives_nothing(spark, tmp_path):
    put(tmp_path, "notes.txt", "x")
    assert uploads.read_uploads(spark, str(tmp_path)) is None
    assert uploads.land_uploads(spark, str(tmp_path), str(tmp_path / "lake")) is None


def test_one_named_file_is_read_alone(spark, tmp_path):
    put(tmp_path, "a b+c.csv", "1,A,x,1,12/1/2010 8:26,2.5,1,UK")
    put(tmp_path, "other.csv", "2,A,x,1,12/1/2010 8:26,2.5,1,UK")
    one = uploads.add_provenance(
        uploads.read_uploads(spark, str(tmp_path), "a b+c.csv"), "retail_sales", STAMP
    )
    found = one.select("InvoiceNo", "_source_file", "_entity", "_ingested_at")
    assert rows(found) == [("1", "a b+c.csv", "retail_sales", STAMP)]


def test_csv_and_parquet_uploads_are_read_together(spark, tmp_path):
    put(tmp_path, "a.csv", "1,A,x,1,12/1/2010 8:26,2.5,1,UK")
    staging = tmp_path / "staging"
    spark.createDataFrame(
        [("2", "B", "y", 3, dt.datetime(2011, 1, 2, 3, 4), 1.5, 7, "FR", "extra")],
        "InvoiceNo string, StockCode string, Description string, Quantity bigint, "
        "InvoiceDate timestamp, UnitPrice double, CustomerID int, country string, note string",
    ).coalesce(1).write.parquet(str(staging))
    part = next(staging.glob("part-*.parquet"))
    (tmp_path / "b.parquet").write_bytes(part.read_bytes())
    columns = ("InvoiceNo", "InvoiceDate", "Quantity", "CustomerID", "note")
    found = scan(spark, tmp_path).select(*columns)
    assert rows(found) == [
        ("1", dt.datetime(2010, 12, 1, 8, 26), 1, 1.0, None),
        ("2", dt.datetime(2011, 1, 2, 3, 4), 3, 7.0, "extra"),
    ]


def test_validation_reports_every_listed_file(spark, tmp_path):
    put(tmp_path, "two.csv", "1,A,x,1,12/1/2010 8:26,2.5,1,UK", "2,A,x,1,12/1/2010 8:26,2.5,1,UK")
    put(tmp_path, "header only.csv")
    report = uploads.validate_uploads(spark, str(tmp_path)).collect()
    assert sorted((os.path.basename(r.path), r.rows, r.accepted) for r in report) == [
        ("header only.csv", 0, False),
        ("two.csv", 2, True),
    ]


@pytest.mark.parametrize(
    "columns, expected",
    [
        (["date", "invoice_date", "InvoiceDate"], "InvoiceDate"),
        (["Date", "date", "invoice_date"], "invoice_date"),
        (["Date", "date"], "date"),
        (["Date"], "Date"),
        (["when"], None),
    ],
)
def test_first_known_date_column_wins(columns, expected):
    assert uploads.date_column(columns) == expected


def test_frames_without_a_date_column_have_empty_parts(spark):
    df = spark.createDataFrame([(1,)], "x int")
    parted, parts = uploads.with_year_month(uploads.parse_date_column(df))
    assert parts == ["year", "month"] and rows(parted) == [(1, None, None)]


def test_landing_partitions_by_month_and_appends(spark, tmp_path):
    put(
        tmp_path / "in",
        "a.csv",
        "1,A,x,1,1/5/2011 8:26,2.5,1,UK",
        "2,A,x,1,12/5/2011 8:26,2.5,1,UK",
        "3,A,x,1,unknown,2.5,1,UK",
    )
    lake = tmp_path / "lake"
    first = uploads.land_uploads(spark, str(tmp_path / "in"), str(lake), ingested_at="t1")
    uploads.land_uploads(spark, str(tmp_path / "in"), str(lake), ingested_at="t2")
    assert first == f"{lake}/raw/retail_sales/uci_online_retail"
    folders = {p.relative_to(first).parts[:2] for p in (lake / "raw").glob("**/*.parquet")}
    assert folders == {
        ("year=2011", "month=01"),
        ("year=2011", "month=12"),
        ("year=__HIVE_DEFAULT_PARTITION__", "month=__HIVE_DEFAULT_PARTITION__"),
    }
    found = spark.read.parquet(first).select("InvoiceNo", "_source_file", "_ingested_at")
    assert rows(found) == [(n, "a.csv", t) for n in "123" for t in ("t1", "t2")]


def test_landing_without_the_shuffle_gives_the_same_rows(spark, tmp_path):
    put(tmp_path / "in", "a.csv", *(f"{i},A,x,1,{i}/5/2011 8:26,2.5,1,UK" for i in range(1, 13)))
    found = [
        rows(
            spark.read.parquet(
                uploads.land_uploads(
                    spark,
                    str(tmp_path / "in"),
                    f"{tmp_path}/lake-{rebalance}",
                    ingested_at=STAMP,
                    rebalance=rebalance,
                )
            )
        )
        for rebalance in (True, False)
    ]
    assert len(found[0]) == 12 and found[0] == found[1]


def test_the_date_column_is_detected_per_file(spark, tmp_path):
    line = "1,A,x,1,1/5/2011 8:26,2.5,1,UK"
    put(tmp_path / "in", "a.csv", line)
    put(tmp_path / "in", "b.csv", line, header=HEADER.replace("InvoiceDate", "invoice_date"))
    put(tmp_path / "in", "c.csv", line, header=HEADER.replace("InvoiceDate", "moment"))
    path = uploads.land_uploads(spark, str(tmp_path / "in"), str(tmp_path / "lake"))
    found = spark.read.parquet(path).select("_source_file", "year", "month", "moment")
    assert rows(found) == [
        ("a.csv", 2011, 1, None), ("b.csv", 2011, 1, None), ("c.csv", None, None, "1/5/2011 8:26"),
    ]
    assert spark.read.parquet(path).select("_ingested_at").distinct().count() == 1


def test_undated_uploads_stay_visible_beside_dated_ones(spark, tmp_path):
    put(tmp_path / "in", "a.csv", "1,x", header="StockCode,name\n")
    uploads.land_uploads(spark, str(tmp_path / "in"), str(tmp_path / "lake"))
    put(tmp_path / "more", "b.csv", "1,A,x,1,1/5/2011 8:26,2.5,1,UK")
    path = uploads.land_uploads(spark, str(tmp_path / "more"), str(tmp_path / "lake"))
    found = spark.read.schema(RAW_SALES).parquet(path)
    columns = ("_source_file", "StockCode", "Quantity", "Country", "year", "month")
    assert rows(found.select(*columns)) == [
        ("a.csv", "1", None, None, None, None), ("b.csv", "A", 1, "UK", 2011, "01"),
    ]


def test_file_names_are_taken_literally(spark, tmp_path):
    names = ["s_201?.csv", "s_2011.csv", "s [2011].csv", "s*.csv", "a{1,2}.csv", "a1.csv", "b\\c.csv"]
    for number, name in enumerate(names):
        turned = name in ("s_2011.csv", "a1.csv")
        header = "StockCode,InvoiceNo\n" if turned else "InvoiceNo,StockCode\n"
        put(tmp_path, name, f"S,{number}" if turned else f"{number},S", header=header)
    assert rows(scan(spark, tmp_path).select("InvoiceNo", "StockCode")) == [
        (str(number), "S") for number in range(len(names))
    ]
    assert rows(scan(spark, tmp_path, file_name="s_201?.csv").select("InvoiceNo")) == [("0",)]


def test_common_date_layouts_and_the_count_of_unreadable_ones(spark, tmp_path):
    texts = [
        "12/1/2010 8:26", "12/1/2010 8:26:00", "2010/12/01 08:26", "01-Dec-2010 08:26",
        "12/1/2010 8:26 AM", "1.12.2010 8:26", "12/1/10 8:26", "2010-12-01T08:26:00",
    ]
    days = ["20101201", "Dec 1 2010", "13.01.2010"]
    lines = [f"{i:02},A,x,1,{t},2.5,1,UK" for i, t in enumerate([*texts, *days, "soon", ""])]
    put(tmp_path / "in", "a.csv", *lines)
    moment, day = dt.datetime(2010, 12, 1, 8, 26), dt.datetime(2010, 12, 1)
    expected = [moment] * len(texts) + [day, day, dt.datetime(2010, 1, 13), None, None]
    found = scan(spark, tmp_path / "in").orderBy("InvoiceNo").select("InvoiceDate").collect()
    assert [row.InvoiceDate for row in found] == expected
    seen = Observation()
    uploads.land_uploads(spark, str(tmp_path / "in"), str(tmp_path / "lake"), dates=seen)
    assert seen.get["unreadable_dates"] == 1
    own = ("yyyy~MM~dd",)
    put(tmp_path / "own", "a.csv", "1,A,x,1,2010~12~01,2.5,1,UK")
    path = uploads.land_uploads(spark, str(tmp_path / "own"), f"{tmp_path}/own-lake", formats=own)
    assert spark.read.parquet(path).first().InvoiceDate == day


@pytest.mark.parametrize("quantity", ["6.5D", "3000000000L"])
def test_parquet_quantities_that_do_not_fit_are_an_error(spark, tmp_path, quantity):
    spark.sql(f"SELECT 'A' AS StockCode, {quantity} AS Quantity").write.parquet(str(tmp_path / "u"))
    with pytest.raises(Exception, match="(?i)whole number|overflow"):
        scan(spark, tmp_path / "u").collect()


def test_landing_as_csv_keeps_values(spark, tmp_path):
    put(tmp_path / "in", "a.csv", '1,A," say ""x"" ",1,1/5/2011 8:26,2.5,1,UK')
    path = uploads.land_uploads(
        spark, str(tmp_path / "in"), str(tmp_path / "lake"), format="csv", ingested_at=STAMP
    )
    back = spark.read.options(header=True, escape='"').csv(path).first()
    assert (back.Description, back.UnitPrice, back._source_file) == (' say "x" ', "2.5", "a.csv")
    with pytest.raises(ValueError, match="Unsupported output format"):
        uploads.land_uploads(spark, str(tmp_path / "in"), str(tmp_path / "lake"), format="orc")


def test_a_hot_month_is_written_by_several_tasks(spark, tmp_path, conf):
    """A third of the rows in one month must not end in a single writer task."""
    conf(
        spark__sql__adaptive__advisoryPartitionSizeInBytes="64k",
        spark__sql__adaptive__coalescePartitions__minPartitionSize="16k",
    )
    source = tmp_path / "in"
    spark.range(60000).select(
        F.col("id").cast("string").alias("InvoiceNo"),
        F.md5(F.col("id").cast("string")).alias("StockCode"),
        F.sha2(F.col("id").cast("string"), 256).alias("Description"),
        F.lit(1).alias("Quantity"),
        F.when(F.col("id") % 3 == 0, "1/5/2011 8:26")
        .otherwise(F.concat((F.col("id") % 12 + 1).cast("string"), F.lit("/5/2011 8:26")))
        .alias("InvoiceDate"),
        F.lit(1.0).alias("UnitPrice"),
        F.lit(1.0).alias("CustomerID"),
        F.lit("UK").alias("Country"),
    ).write.option("header", True).csv(str(source))
    path = uploads.land_uploads(spark, str(source), str(tmp_path / "lake"), ingested_at=STAMP)
    landed = spark.read.parquet(path)
    assert landed.count() == 60000
    assert landed.select(*RETAIL_UPLOAD.names).distinct().count() == 60000
    hot = landed.filter("month = 1").select(F.input_file_name().alias("f")).distinct().count()
    assert hot > 1


def test_partition_filters_prune_the_raw_scan(spark, tmp_path):
    put(tmp_path / "in", "a.csv", "1,A,x,1,1/5/2011 8:26,2.5,1,UK")
    path = uploads.land_uploads(spark, str(tmp_path / "in"), str(tmp_path / "lake"))
    text = plan(spark.read.parquet(path).filter("year = 2011 AND month = 1").select("InvoiceNo"))
    assert "PartitionFilters: [isnotnull(year" in text
    assert "ReadSchema: struct<InvoiceNo:string>" in text


def day_first(folder, name, *texts):
    put(folder, name, *(f"{i},A,x,1,{t},2.5,1,UK" for i, t in enumerate(texts)))


def moments(spark, folder):
    found = uploads.add_provenance(uploads.read_uploads(spark, str(folder)), "retail_sales", STAMP)
    return {
        (r._source_file, r.InvoiceNo): r.InvoiceDate and r.InvoiceDate.isoformat(" ", "minutes")
        for r in found.select("_source_file", "InvoiceNo", "InvoiceDate").collect()
    }


def test_each_upload_votes_for_its_own_date_layout(spark, tmp_path):
    day_first(tmp_path, "day.csv", "13/01/2011 08:26", "01/02/2011 08:26")
    day_first(tmp_path, "month.csv", "1/13/2011 8:26", "1/2/2011 8:26")
    day_first(tmp_path, "open.csv", "1/2/2011 8:26", "3/3/2011 9:00")
    day_first(tmp_path, "mixed.csv", "13/1/2011 8:26", "1/14/2011 8:26", "1/15/2011 8:26", "2/1/2011 8:26", "soon")
    day_first(tmp_path, "dash.csv", "31-01-2011", "01-02-2011")
    day_first(tmp_path, "short.csv", "13/01/11", "01/02/11")
    assert moments(spark, tmp_path) == {
        ("day.csv", "0"): "2011-01-13 08:26", ("day.csv", "1"): "2011-02-01 08:26",
        ("month.csv", "0"): "2011-01-13 08:26", ("month.csv", "1"): "2011-01-02 08:26",
        ("open.csv", "0"): "2011-01-02 08:26", ("open.csv", "1"): "2011-03-03 09:00",
        ("mixed.csv", "0"): "2011-01-13 08:26", ("mixed.csv", "1"): "2011-01-14 08:26",
        ("mixed.csv", "2"): "2011-01-15 08:26", ("mixed.csv", "3"): "2011-02-01 08:26", ("mixed.csv", "4"): None,
        ("dash.csv", "0"): "2011-01-31 00:00", ("dash.csv", "1"): "2011-02-01 00:00",
        ("short.csv", "0"): "2011-01-13 00:00", ("short.csv", "1"): "2011-02-01 00:00",
    }
    report = uploads.validate_uploads(spark, str(tmp_path))
    found = {
        os.path.basename(r.path): (r.date_layout[:3], r.date_exceptions, r.ambiguous_dates, r.unreadable_dates)
        for r in report.collect()
    }
    assert found == {
        "day.csv": ("d/M", 0, 0, 0), "month.csv": ("M/d", 0, 0, 0), "open.csv": ("M/d", 0, 1, 0),
        "mixed.csv": ("M/d", 1, 0, 1), "dash.csv": ("d-M", 0, 0, 0), "short.csv": ("d/M", 0, 0, 0),
    }


def test_refused_lines_go_to_their_own_table_when_asked(spark, tmp_path):
    good = "1,A,x,1,12/1/2010 8:26,2.5,1,UK"
    put(tmp_path / "in", "a.csv", good, "2,A,x,six,12/1/2010 8:26,2.5,1,UK", "3,A,x,1.5,12/1/2010 8:26,2.5,1,UK")
    put(tmp_path / "in", "b.csv", good, "4,A,x,1,12/1/2010 8:26,much,1,UK", '5,A,"cut', 'in two",1,12/1/2010 8:26,2.5,1,UK')
    put(tmp_path / "in", "c.csv", "6,A,Cr\xe8me,1,12/1/2010 8:26,2.5,1,UK,more", encoding="latin-1")
    with pytest.raises(Exception, match="(?i)not a|too many|line break"):
        uploads.land_uploads(spark, str(tmp_path / "in"), str(tmp_path / "lake"))
    assert not (tmp_path / "lake").exists() or not list((tmp_path / "lake").glob("reports/**/*.parquet"))
    seen = Observation()
    path = uploads.land_uploads(
        spark, str(tmp_path / "in"), f"{tmp_path}/other", ingested_at=STAMP, on_error="reject", observation=seen
    )
    assert seen.get["rows"] == 2 and spark.read.parquet(path).count() == 2
    refused = spark.read.parquet(uploads.report_path(f"{tmp_path}/other", "rejects"))
    name = F.substring_index("path", "/", -1)
    assert rows(refused.select(name, "line", "reason")) == [
        ("a.csv", "2,A,x,six,12/1/2010 8:26,2.5,1,UK", "Quantity is not a number: six"),
        ("a.csv", "3,A,x,1.5,12/1/2010 8:26,2.5,1,UK", "Quantity is not a whole number: 1.5"),
        ("b.csv", "4,A,x,1,12/1/2010 8:26,much,1,UK", "UnitPrice is not a number: much"),
        ("b.csv", '5,A,"cut', "quoted line break, read with multiline=True"),
        ("b.csv", 'in two",1,12/1/2010 8:26,2.5,1,UK', "quoted line break, read with multiline=True"),
        ("c.csv", "6,A,Crème,1,12/1/2010 8:26,2.5,1,UK,more", "too many cells"),
    ]
    landed = spark.read.parquet(uploads.report_path(f"{tmp_path}/other", "landed"))
    assert rows(landed.select(name, "rows", "rejected", "accepted")) == [
        ("a.csv", 1, 2, True), ("b.csv", 1, 3, True), ("c.csv", 0, 1, False),
    ]
    same = uploads.validate_uploads(spark, str(tmp_path / "in"))
    assert rows(same) == rows(landed.drop("_ingested_at"))


@pytest.mark.parametrize("options", [{}, {"multiline": True}, {"encoding": "ISO-8859-1"}])
def test_validation_counts_what_landing_adds(spark, tmp_path, options):
    put(tmp_path / "in", "a.csv", *(f"{i},A,Cr\xe8me,1,12/1/2010 8:26,2.5,1,UK" for i in range(7)), encoding="latin-1")
    put(tmp_path / "in", "b.csv")
    report = uploads.validate_uploads(spark, str(tmp_path / "in"), **options)
    assert sorted((os.path.basename(r.path), r.rows, r.accepted) for r in report.collect()) == [
        ("a.csv", 7, True), ("b.csv", 0, False),
    ]
    path = uploads.land_uploads(spark, str(tmp_path / "in"), str(tmp_path / "lake"), **options)
    found = spark.read.parquet(path)
    assert found.count() == found.filter("Description = 'Crème'").count() == 7


def test_parquet_uploads_of_several_schemas_are_read_together(spark, tmp_path, conf):
    kinds = ["17850L", "17850.0D", "17850", "'17850'"]
    for i, kind in enumerate(kinds):
        spark.sql(
            f"SELECT '{i}' AS InvoiceNo, {kind} AS CustomerID, timestamp'2011-01-13 08:26:00' AS InvoiceDate, "
            f"{'1' if i % 2 else '1.5D'} AS weight, {i} AS batch"
        ).coalesce(1).write.mode("append").parquet(str(tmp_path / "u"))
    conf(spark__sql__parquet__outputTimestampType="TIMESTAMP_MICROS")
    spark.sql("SELECT '9' AS InvoiceNo, '13/02/2011' AS InvoiceDate").coalesce(1).write.mode("append").parquet(str(tmp_path / "u"))
    found = scan(spark, tmp_path / "u").select("InvoiceNo", "CustomerID", F.col("InvoiceDate").cast("string"), "weight")
    first = "2011-01-13 08:26:00"
    assert rows(found) == [
        ("0", 17850.0, first, 1.5), ("1", 17850.0, first, 1.0), ("2", 17850.0, first, 1.5),
        ("3", 17850.0, first, 1.0), ("9", None, "2011-02-13 00:00:00", None),
    ]
    report = uploads.validate_uploads(spark, str(tmp_path / "u"))
    assert report.filter("rows = 1 AND accepted").count() == 5


def test_many_headers_are_one_branch_of_the_plan(spark, tmp_path):
    names = ["InvoiceNo", "StockCode", "Quantity", "Country"]
    for i in range(12):
        order = names[i % 4 :] + names[: i % 4] + [f"Extra {i}"]
        cells = {"InvoiceNo": str(i), "StockCode": "A", "Quantity": "3", "Country": "UK", f"Extra {i}": f"e{i}"}
        put(tmp_path, f"{i:02}.csv", ",".join(cells[n] for n in order), header=",".join(order) + "\n")
    found = scan(spark, tmp_path)
    assert {f"Extra {i}" for i in range(12)} < set(found.columns)
    assert plan(found).count("Scan parquet") <= 4 and "Union" not in plan(found)
    assert rows(found.select("StockCode", "Quantity", "Country").distinct()) == [("A", 3, "UK")]
    assert found.filter("`Extra 7` = 'e7'").first().InvoiceNo == "7"


def test_repeated_and_missing_header_names(spark, tmp_path):
    put(tmp_path, "a.csv", "1,a,b,c,d", header="InvoiceNo,note,Note,,note\n")
    row = scan(spark, tmp_path).first().asDict()
    assert row == {"InvoiceNo": "1", "note": "a", "Note.1": "b", "_c3": "c", "note.2": "d"}


def test_a_second_date_column_of_a_file_stays_text(spark, tmp_path):
    put(tmp_path, "a.csv", "1,1/5/2011,some day", header="InvoiceNo,InvoiceDate,date\n")
    put(tmp_path, "b.csv", "2,2/5/2011", header="InvoiceNo,date\n")
    found = scan(spark, tmp_path).select("InvoiceNo", F.col("InvoiceDate").cast("date").cast("string"), F.col("date").cast("date").cast("string"), "date_text")
    assert rows(found) == [("1", "2011-01-05", None, "some day"), ("2", None, "2011-02-05", None)]


def test_landing_leaves_no_scratch_behind(spark, tmp_path):
    put(tmp_path / "in", "a.csv", "1,A,x,1,1/5/2011 8:26,2.5,1,UK")
    root = tmp_path.parents[1]
    before = {p for p in root.glob("shared*/weathermart/*/*")}
    uploads.land_uploads(spark, str(tmp_path / "in"), str(tmp_path / "lake"))
    assert {p for p in root.glob("shared*/weathermart/*/*")} == before


def test_uploads_are_landed_once_when_asked(spark, tmp_path, monkeypatch):
    folder, lake = tmp_path / "in", str(tmp_path / "lake")
    put(folder, "a.csv", "1,A,x,1,1/5/2011 8:26,2.5,1,UK", "1,A,x,1,1/5/2011 8:26,2.5,1,UK")
    spark.sql("SELECT '2' AS InvoiceNo, 3L AS Quantity").coalesce(1).write.mode("append").parquet(str(folder))

    def land(stamp, **options):
        path = uploads.land_uploads(spark, str(folder), lake, ingested_at=stamp, once=True, **options)
        found = spark.read.schema(RAW_SALES).parquet(path)
        return rows(found.groupBy("InvoiceNo", "_ingested_at").count())

    first = [("1", "t1", 2), ("2", "t1", 1)]
    assert land("t1") == first and land("t2") == first
    (folder / "a.csv").rename(folder / "other name.csv")
    assert land("t3") == first
    put(folder, "b.csv", "3,A,x,1,1/5/2011 8:26,2.5,1,UK")
    # A crash after the rows and before the ledger: the next landing makes up for the commit.
    with monkeypatch.context() as broken:
        broken.setattr(ledger.Ledger, "commit", lambda self, report: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            land("t4")
    after = [*first, ("3", "t4", 1)]
    assert land("t5") == after and land("t6") == after
    # A crash in which only some files arrived: they are removed, and the upload is landed anew.
    put(folder, "c.csv", *(f"4,A,x,1,{m}/5/2011 8:26,2.5,1,UK" for m in range(1, 7)))
    with monkeypatch.context() as broken:
        broken.setattr(ledger.Ledger, "commit", lambda self, report: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            land("t7")
    new = spark.read.parquet(f"{lake}/raw/retail_sales/uci_online_retail").filter("_ingested_at = 't7'")
    ledger.delete(spark, new.select("_metadata.file_path").first().file_path)
    assert land("t8") == [*after, ("4", "t8", 6)]
    assert land("t9") == [*after, ("4", "t8", 6)]
    landed = spark.read.parquet(uploads.report_path(lake, "landed"))
    assert rows(ledger.newest_batches(landed).filter("_source_file LIKE '%.csv'")) == [
        ("a.csv", "t1"), ("b.csv", "t4"), ("c.csv", "t8"),
    ]


def test_content_tells_uploads_apart(spark, tmp_path):
    line = "1,A,x,1,1/5/2011 8:26,2.5,1,UK"
    for name, lines in (("a", [line]), ("b", [line, line]), ("c", [line] * 3), ("d", [line]), ("e", [line + " "])):
        put(tmp_path, f"{name}.csv", *lines)
    found = uploads.validate_uploads(spark, str(tmp_path)).collect()
    digests = {os.path.basename(r.path)[0]: r.digest for r in found}
    assert digests["a"] == digests["d"] and len(set(digests.values())) == 4


def test_layouts_read_the_same_with_and_without_a_look_at_the_shape_first(spark):
    from weathermart.sources import date_votes

    texts = [
        "1/2/2011", "01/02/2011 8:26", "1/2/2011 8:26:01", "1/2/2011 8:26 PM", "1/2/11", "2011/1/2 3:04", "2.1.2011",
        "2-Jan-2011", "2-JAN-2011 3:04", "Jan 2 2011", "20110102", "1-2-2011", "13-2-2011 5:06", "25/12/2010", "123.0",
        "99999.0", "", " 1/2/2011", "1/2/2011 ", "-1/2/2011", "1/2/+12011", "May 5 2011 1:02:03", "2011-01-02T03:04", "?",
    ]
    formats = uploads.UPLOAD_DATE_FORMATS
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t", F.array(*date_votes._readings(F.col("t"), formats)).cast("array<string>").alias("a"),
        F.array(*date_votes._sifted(F.col("t"), formats)).cast("array<string>").alias("b"),
    )
    for row in df.collect():
        assert row.a == row.b, row.t
    assert date_votes._shape("E d/M/yyyy") is None and date_votes._shape("d 'of' M yyyy") is None


def test_refused_lines_are_judged_once_and_by_short_methods(spark, tmp_path):
    import re

    for n in range(3):
        put(tmp_path, f"{n}.csv", f"{n},A,Caf\xe9,1,12/1/2010 8:26,2.5,1.0,UK", f"{n},A,Tea,x,12/1/2010 8:26,2.5,1.0,UK")
    scan_ = uploads.Scan(spark, str(tmp_path))
    # Votes, lines, refused lines and the report all start from the judged table.
    for df in (scan_.rows, scan_.rejected(), scan_.report()):
        read = {path.split("/")[-2] for path in df.inputFiles()}
        assert "upload_rows" in read and "upload_lines" not in read
    assert scan_.rejected().count() == 3 and scan_.accepted().count() == 3
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        codegen = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
        code = scan_.undated._jdf.queryExecution().explainString(codegen)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    # The JVM compiles no method of more than 8,000 bytes.
    assert max(map(int, re.findall(r"maxMethodCodeSize: *(\d+)", code))) < 8000


def test_a_header_is_found_without_sorting_cells(spark, tmp_path):
    from weathermart.sources import csv_scan

    put(tmp_path, "a.csv", *(f"{i},A,plain,1,12/1/2010 8:26,2.5,1.0,UK" for i in range(500)))
    put(tmp_path, "b.csv", "1,A,plain,1,12/1/2010 8:26,2.5,1.0,UK", header=HEADER.replace("Country", "Land"))
    found = {r.name: r for r in csv_scan.stage(spark, str(tmp_path)).files.collect()}
    assert found["a.csv"].names == HEADER.strip().split(",") and found["a.csv"].lines == 500
    assert found["b.csv"].names[-1] == "Land" and found["b.csv"].width == 8
