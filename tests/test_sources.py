"""CSV sources and sinks on hand-written files in a fresh temporary folder."""

import datetime as dt
import os
import tempfile

from torqueframe.operators import report
from torqueframe.sources import csv as C
from torqueframe.sources import sinks


def _write(folder, name, text, encoding="utf-8"):
    p = os.path.join(folder, name)
    with open(p, "w", encoding=encoding) as f:
        f.write(text)
    return p


def test_visits_and_contracts(spark):
    d = tempfile.mkdtemp(prefix="tf-src-")
    v = _write(d, "visits.csv", "Customer;Registration_Number;Chassis_Number;Vehicle_In_Date;"
               "Registration_Date_PSE;Registration_Date_VHE;SLR_Document_Account;NLR_Code;Kms;(no column name)\n"
               "007;98-IQ-85;WBA1234567;2017-05-01;2012-01-01;;4;101;12000;10,5\n")
    df = C.read_visits(spark, v)
    r = df.collect()[0]
    assert r.customer == "007" and r.registration_number == "98-IQ-85"
    assert r.vehicle_in_date == dt.datetime(2017, 5, 1) and r.registration_date_vhe is None
    assert r.nlr_code == 101 and "total" in df.columns
    crp = _write(d, "crp.txt", "x,WBA1234567,24,60000,01/02/2015,31/01/2017\n", encoding="latin-1")
    c = C.read_contracts_crp(spark, crp).collect()[0]
    assert c.cm_years == 2.0 and c.cm_date_end == dt.datetime(2017, 1, 31)


def test_visit_rows_keep_their_place_under_any_split(spark):
    d = tempfile.mkdtemp(prefix="tf-src-")
    head = "Customer;Registration_Number;Vehicle_In_Date;Registration_Date_PSE;Registration_Date_VHE;NLR_Code;Kms;SLR_Document_Account\n"
    for f, lines in (("b.csv", 400), ("a.csv", 250)):
        _write(d, f, head + "".join(f"{f[0]}{i};98-IQ-85;2017-05-01;;;4;{i};101\n" for i in range(lines)))
    want = [f"a{i}" for i in range(250)] + [f"b{i}" for i in range(400)]
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("128m", "4k", "1k"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            rows = C.read_visits(spark, d).collect()
            assert [r.customer for r in sorted(rows, key=lambda r: r.source_row)] == want
            assert sorted(r.source_row for r in rows) == list(range(650))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_option_lines_decimal_comma(spark):
    d = tempfile.mkdtemp(prefix="tf-src-")
    p = _write(d, "enc.csv", "Nº Stock;Opcional;Custo;Margem;Data Compra;Data Venda\n"
               "1;Navegação;1.234,50;10,25;2017-01-01;2017-02-01\n")
    r = C.read_option_lines(spark, p, thousands=".").collect()[0]
    assert r.Custo == 1234.5 and r.Margem == 10.25


def test_sinks_roundtrip(spark):
    d = tempfile.mkdtemp(prefix="tf-sink-")
    df = spark.createDataFrame([(1, None), (2, 1)], "id int, flag int")
    sinks.write_table(df, os.path.join(d, "t"), fmt="csv")
    text = "".join(open(os.path.join(d, "t", f)).read() for f in os.listdir(os.path.join(d, "t"))
                   if f.endswith(".csv"))
    assert "NULL" in text
    m = spark.createDataFrame([("classification", "dt", "new_score", "accuracy", 0.9),
                               ("classification", "rf", "new_score", "accuracy", 0.8)],
                              "approach string, model string, target string, metric string, value double")
    sinks.append_metrics(m, os.path.join(d, "metrics"))
    back = spark.read.parquet(os.path.join(d, "metrics"))
    piv = report.metrics_pivot(back, "metric", "model", "value").collect()[0]
    assert piv.dt == 0.9 and piv.rf == 0.8
