from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import ITEM_SCHEMA, rows
from tillroll.fixed_values import SOURCE_HEADERS
from tillroll.functions import standardise as std
from tillroll.operators import audit, warehouse
from tillroll.plans import jobs
from tillroll.schemas import FACT, RAW
from tillroll.sources import items as item_files
from tillroll.sources import raw as raw_files
from tillroll.sources import tables
from tillroll.sources.marts import read_manifest

SOURCE = "Invoice string, StockCode string, Description string, Quantity int, InvoiceDate timestamp_ntz, Price double, `Customer ID` double, Country string"


@pytest.fixture(scope="module")
def periods(spark):
    """One cancelled line without a customer among three, in two seasons."""
    spring = [
        ("700001", "11042", "  Blue   enamel  MUG ", 4, dt.datetime(2015, 3, 2, 9, 10), 3.2, 4411.0, "Norway"),
        ("C700002", "30517", "Linen towel", -3, dt.datetime(2015, 3, 4, 16, 5), 7.75, None, "Chile"),
    ]
    autumn = [("810003", "44871B", None, 9, dt.datetime(2015, 9, 21, 12, 0), 0.85, 9127.0, "Norway")]
    return {"Spring 2015": spark.createDataFrame(spring, SOURCE), "Autumn 2015": spark.createDataFrame(autumn, SOURCE)}


def apply(spark, expression, value, kind):
    return spark.createDataFrame([(value,)], T.StructType([T.StructField("v", kind)])).select(expression(F.col("v"))).first()[0]


@pytest.mark.parametrize(
    ("value", "kind", "expected"),
    [
        (None, T.StringType(), ""),
        ("\t 44871B ", T.StringType(), "44871B"),
        (4411.0, T.DoubleType(), "4411"),
        (1e20, T.DoubleType(), "100000000000000000000"),
        (12345678.5, T.DoubleType(), "12345678.5"),
        (0.25, T.DoubleType(), "0.25"),
        (700001, T.LongType(), "700001"),
        (True, T.BooleanType(), "True"),
    ],
)
def test_identifier(spark, value, kind, expected):
    assert apply(spark, lambda c: std.norm_id(c, kind), value, kind) == expected


def test_text_collapses_all_white_space(spark):
    text = " a b　 c\n\td\x1f "
    assert apply(spark, std.norm_text, text, T.StringType()) == "a b c d" == " ".join(text.split())
    assert apply(spark, std.norm_text, None, T.StringType()) == ""


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        (None, ""),
        ("  ", ""),
        ("6.950", "6.950"),
        ("+5", "5"),
        ("-0.5", "-0.5"),
        (".5", "0.5"),
        ("5.", "5"),
        ("007", "7"),
        ("0", "0"),
        ("000.10", "0.10"),
        ("1E+3", "1000"),
        ("1.50E1", "15.0"),
        ("-1.5e2", "-150"),
        ("1E-7", "0.0000001"),
        ("12.34e-1", "1.234"),
        ("12.34e1", "123.4"),
        ("+0.05E2", "5"),
    ],
)
def test_decimal(spark, text, expected):
    assert apply(spark, std.norm_decimal, text, T.StringType()) == expected
    if text and text.strip():
        assert expected == format(Decimal(text), "f")


@pytest.mark.parametrize(("text", "expected"), [("7\n", "7"), (" 1.5", "1.5"), ("-05", "-5"), ("-0", "-0"), ("1.2.3", None), ("n/a", None)])
def test_decimal_as_it_stands_or_tidied(spark, text, expected):
    """A tidy number is taken as it stands by a first look; all else goes the long way."""
    assert apply(spark, lambda c: std.norm_decimal(c, "null"), text, T.StringType()) == expected
    taken = std.norm_decimal(F.col("x"), "null")._jc.toString()
    assert taken.startswith("CASE WHEN rlike(")


def test_decimal_error_modes(spark):
    assert apply(spark, lambda c: std.norm_decimal(c, "null"), "abc", T.StringType()) is None
    with pytest.raises(Exception, match="Invalid decimal value: abc"):
        apply(spark, std.norm_decimal, "abc", T.StringType())


def test_timestamp(spark):
    stamp = dt.datetime(2010, 1, 2, 3, 4, 5)
    assert apply(spark, lambda c: std.norm_ts(c, T.TimestampNTZType()), stamp, T.TimestampNTZType()) == "2010-01-02 03:04:05"
    assert apply(spark, lambda c: std.norm_ts(c, T.DateType()), stamp.date(), T.DateType()) == "2010-01-02 00:00:00"
    assert apply(spark, lambda c: std.norm_ts(c, T.StringType()), " soon ", T.StringType()) == "soon"
    assert apply(spark, lambda c: std.norm_ts(c, T.DateType()), None, T.DateType()) == ""


def test_header_is_checked_before_any_job(spark, periods):
    df = next(iter(periods.values()))
    raw_files.check_header(df)
    raw_files.check_header(df.withColumnRenamed("Customer ID", " Customer  ID "))
    with pytest.raises(ValueError, match="unexpected source columns"):
        raw_files.check_header(df.withColumnRenamed("Price", "UnitPrice"))
    with pytest.raises(ValueError):
        raw_files.check_header(df.select(*reversed(SOURCE_HEADERS)))


def test_batch_id_is_utc():
    moment = dt.datetime(2026, 7, 21, 10, 0, tzinfo=dt.timezone(dt.timedelta(hours=8)))
    assert raw_files.batch_id(moment) == "20260721T020000Z"


def test_ingest_round_trip_and_audit(spark, periods, tmp_path):
    raw = raw_files.ingest(periods, "TEST_BATCH")
    assert raw.columns == RAW.names
    raw_files.write_raw(raw, str(tmp_path / "raw"))
    back = raw_files.read_raw(spark, str(tmp_path / "raw"))
    assert rows(back) == rows(raw)
    line = {r.invoice_no: r for r in back.collect()}
    assert line["700001"].customer_id == "4411"
    assert line["700001"].description == "Blue enamel MUG"
    assert line["C700002"].customer_id == "" and line["810003"].description == ""
    assert line["810003"].invoice_ts == "2015-09-21 12:00:00"
    counts = {r.source_year: r for r in audit.ingest_audit(back).collect()}
    total = counts["ALL"]
    assert (total.row_count, total.missing_customer_rows, total.cancelled_rows) == (3, 1, 1)
    assert (total.non_positive_quantity_rows, total.non_positive_price_rows) == (1, 0)
    assert counts["Spring 2015"].row_count == 2 and len(counts) == 3


def test_period_csv_is_read_as_text(spark, tmp_path):
    path = tmp_path / "period.csv"
    path.write_text(",".join(SOURCE_HEADERS) + '\n1,A,"say ""hi"", twice",2,2010-01-01 00:00:00,1.50,007,UK\n')
    df = raw_files.read_period_csv(spark, str(path))
    raw_files.check_header(df)
    assert raw_files.ingest({"P": df}, "B").first().description == 'say "hi", twice'
    assert raw_files.ingest({"P": df}, "B").first().customer_id == "007"


@pytest.mark.parametrize(
    ("value", "expected"),
    [(1e7, "10000000.0"), (12345678.0, "12345678.0"), (12345678.9, "12345678.9"), (1e15, "1000000000000000.0"), (1e16, "10000000000000000"), (0.0001, "0.0001"), (-2.5e-5, "-0.000025"), (3.0, "3.0"), (None, "")],
)
def test_doubles_keep_their_shortest_digits(spark, value, expected):
    assert apply(spark, lambda c: std.norm_decimal(c, data_type=T.DoubleType()), value, T.DoubleType()) == expected


def test_every_file_of_a_period_needs_the_same_header(spark, tmp_path):
    folder = tmp_path / "period"
    folder.mkdir()
    (folder / "a.csv").write_text(",".join(SOURCE_HEADERS) + "\nA,1,x,2,2010-01-01 00:00:00,1.50,007,UK\n")
    swapped = [SOURCE_HEADERS[1], SOURCE_HEADERS[0], *SOURCE_HEADERS[2:]]
    (folder / "b.csv").write_text(",".join(swapped) + "\n2,B,x,2,2010-01-01 00:00:00,1.50,007,UK\n")
    with pytest.raises(Exception, match="header"):
        raw_files.ingest({"P": raw_files.read_period_csv(spark, str(folder))}, "B").collect()
    with pytest.raises(Exception, match="header|unexpected"):
        jobs.run_ingest(spark, {"P": str(folder)}, str(tmp_path / "landing"))


def test_ingest_job_writes_landing_files_and_audit(spark, tmp_path):
    paths = {}
    for name, rows_ in {"P1": ["C1,A,x,-2,2010-01-01 00:00:00,1.50,,UK"], "P2": ["2,B,y,2,2010-01-01 00:00:00,0,7,UK", "3,B,y,2,2010-01-01 00:00:00,1,7,UK"]}.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "lines.csv").write_text("\n".join([",".join(SOURCE_HEADERS), *rows_]) + "\n")
        paths[name] = str(tmp_path / name)
    folder = str(tmp_path / "landing")
    manifest = jobs.run_ingest(spark, paths, folder, "B1")
    assert read_manifest(spark, folder) == manifest
    counts = {r["source_year"]: r["row_count"] for r in manifest["audit"]}
    assert counts == {"ALL": 3, "P1": 1, "P2": 2}
    landed = raw_files.read_raw(spark, manifest["raw"])
    assert {r.ingest_batch_id for r in landed.collect()} == {"B1"} and landed.count() == 3


BROKEN_FILE = [
    '1,A,"fine, thing",2,2010-01-01 00:00:00,1.50,7,UK',
    '2,B,"unclosed,2,2010-01-01 00:00:00,1.50,7,UK',
    "3,C,too many,2,2010-01-01 00:00:00,1.50,7,UK,more",
    "4,D,too few,2,2010-01-01 00:00:00",
    "5,E,no number,two,2010-01-01 00:00:00,1.50,7,UK",
    "6,F,no price,2,2010-01-01 00:00:00,free,7,UK",
    "7,G,blank price,2,2010-01-01 00:00:00,,7,UK",
]


def test_rejected_lines_are_listed_and_audited(spark, tmp_path):
    """Whatever columns a later step selects, the same lines are sound."""
    for name, lines in {"P1": BROKEN_FILE, "P2": BROKEN_FILE[1:2], "P3": BROKEN_FILE[:1]}.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "lines.csv").write_text("\n".join([",".join(SOURCE_HEADERS), *lines]) + "\n")
    paths = {name: str(tmp_path / name) for name in ("P1", "P2", "P3")}
    folder = str(tmp_path / "landing")
    with pytest.raises(Exception, match="Invalid decimal value: two|Invalid decimal value: free"):
        jobs.run_ingest(spark, paths, folder, "B1")
    manifest = jobs.run_ingest(spark, paths, folder, "B1", on_error="reject", most_rejected=6)
    landed = raw_files.read_raw(spark, manifest["raw"])
    assert sorted((r.source_year, r.invoice_no) for r in landed.collect()) == [("P1", "1"), ("P1", "7"), ("P3", "1")]
    found = {(r.source_year, r.line[0], r.reason) for r in spark.read.parquet(manifest["rejects"]).collect()}
    broken = {("P1", n, "BROKEN_LINE") for n in "234"} | {("P2", "2", "BROKEN_LINE")}
    assert found == broken | {("P1", n, "UNREADABLE_NUMBER") for n in "56"}
    lines = {r.line for r in spark.read.parquet(manifest["rejects"]).collect()}
    assert set(BROKEN_FILE[1:6]) <= lines
    counts = {r["source_year"]: (r["row_count"], r["rejected_rows"]) for r in manifest["audit"]}
    assert counts == {"ALL": (3, 6), "P1": (2, 5), "P2": (0, 1), "P3": (1, 0)}
    df = raw_files.read_period_csv(spark, paths["P1"])
    assert raw_files.ingest({"P": df}, "B", "reject").select("invoice_no").count() == 2
    assert raw_files.rejects(df, True).select("reason").count() == 5
    with pytest.raises(ValueError, match="6 lines rejected, 5 allowed"):
        jobs.run_ingest(spark, paths, folder, "B2", on_error="reject", most_rejected=5)
    assert read_manifest(spark, folder) == manifest


def test_fractional_quantities_are_no_piece_counts(spark, make_items):
    items = make_items([("1", "C", dt.datetime(2020, 1, 1), "A", "a", 1, 1)]).drop("item_quantity")
    given = items.join(spark.createDataFrame([("0.5",), ("2.7",), ("2.0",), ("3",), ("1e2",)], "item_quantity string"), how="cross")
    assert sorted(r.item_quantity for r in warehouse.positive_rows(given).collect()) == [2, 3, 100]


def test_blank_month_survives_the_fact_table(spark, tmp_path):
    values = ("p", "1", "A", "d", "1", "", "2.5", "C1", "UK", "b")
    fact = warehouse.clean(spark.createDataFrame([values], RAW))
    tables.write_fact(fact, str(tmp_path / "fact"), "parquet")
    assert tables.read_fact(spark, str(tmp_path / "fact"), "parquet").first().invoice_month == fact.first().invoice_month == ""


def test_basket_file_defaults_and_dropped_rows(spark, tmp_path):
    path = tmp_path / "items.tsv"
    path.write_text(
        "1\tC1\t2010-01-01 08:00:00\tA\tname\t2\t3.5\n"
        "2\tC1\t2010-01-01 08:00:00\tA\t\\N\tx\t3.5\tMODEL_GENERATED\tNEW\t0.75\tB1\n"
        "3\t\t2010-01-01 08:00:00\tA\tname\t2\t3.5\n"
        "4\tC1\tnever\tA\tname\t2\t3.5\n"
        "5\tC1\t2010-01-01 08:00:00\tA\tname\t2\tn/a\n"
    )
    found = {r.invoice_no: r for r in item_files.read_basket_items(spark, str(path)).collect()}
    assert sorted(found) == ["1", "2"]
    assert (found["1"].data_origin, found["1"].generation_confidence) == ("REAL", 1.0)
    assert found["1"].generation_batch_id is None
    assert (found["2"].product_name, found["2"].item_quantity) == (None, None)
    assert (found["2"].data_origin, found["2"].generation_confidence) == ("MODEL_GENERATED", 0.75)


def test_export_round_trip_keeps_nulls_tabs_and_quotes(spark, tmp_path):
    stamp = dt.datetime(2010, 1, 1)
    data = [
        ("1", "C1", stamp, "A", None, 1, Decimal("1.5000")),
        ("2", "C1", stamp, "B", 'a "quoted"\tname', 1, Decimal("2.0000")),
        ("3", "C1", stamp, "C", '"all quoted"', 1, Decimal("2.0000")),
    ]
    df = spark.createDataFrame(data, ITEM_SCHEMA)
    item_files.export_tsv(df, str(tmp_path / "out"), [F.col("invoice_no")])
    back = item_files.read_basket_items(spark, str(tmp_path / "out")).select(*df.columns)
    assert rows(back) == rows(df)


def test_segments_keep_text_ids(spark, tmp_path):
    path = tmp_path / "segments.csv"
    path.write_text("snapshot_date,customer_id,segment_code,segment_name\n2020-01-01,00123,NEW,x\n")
    df = item_files.read_segments(spark, str(path))
    assert [tuple(r) for r in df.collect()] == [("00123", "NEW", "x")]
    path.write_text("snapshot_date,customer_id,segment_name\n2020-01-01,00123,x\n")
    with pytest.raises(ValueError, match="lacks .'segment_code'"):
        item_files.read_segments(spark, str(path))


@pytest.mark.parametrize("fmt", ["orc", "parquet"])
def test_fact_partitions_are_replaced_one_by_one(spark, tmp_path, fmt):
    def fact(month, invoice):
        values = ["p", invoice, "A", "d", "1", f"{month}-05 00:00:00", "2.5", "C1", "UK", "b"]
        return warehouse.clean(spark.createDataFrame([tuple(values)], RAW))

    path = str(tmp_path / "fact")
    tables.write_fact(fact("2010-01", "1").unionByName(fact("2010-02", "2")), path, fmt)
    tables.write_fact(fact("2010-02", "3"), path, fmt)
    back = tables.read_fact(spark, path, fmt)
    assert back.schema.names == FACT.names
    assert sorted((r.invoice_month, r.invoice_no, r.line_amount) for r in back.collect()) == [
        ("2010-01", "1", Decimal("2.5000")),
        ("2010-02", "3", Decimal("2.5000")),
    ]
    assert back.first().invoice_ts.day == 5
