"""Raw CSV source (gzip, latin-1, ';', quoted multi-line text, NA tokens), stage sink, file stream."""

import gzip
import os
import tempfile

from casebook.schema import RAW_COLUMNS
from casebook.sources import journal as IO
from casebook.streaming.ingest import journal_stream, land

ROWS = [
    ["h1", "BER01", "1", "27.07.24", "W", "01.07.95", "*", "", '"M. Gaucher\nE75.22G ""x"""', "NA", ""],
    ["h2", "FRA01", "2", "01.01.80", "M", "02.03.05", "Y", "", "HKT=43- %", "", ""],
]


def write_raw(folder, name="BER01.csv.gz"):
    os.makedirs(folder, exist_ok=True)
    text = ";".join(RAW_COLUMNS) + "\n" + "\n".join(";".join(r) for r in ROWS) + "\n"
    with gzip.open(os.path.join(folder, name), "wb") as f:
        f.write(text.encode("latin-1"))


def test_read_journal_and_stage(spark):
    d = tempfile.mkdtemp(prefix="cb-io-")
    write_raw(os.path.join(d, "raw"))
    df = IO.read_journal(spark, os.path.join(d, "raw"), partitions=2)
    got = {r.PATIENT_HASH: r for r in df.collect()}
    assert got["h1"].TEXT == 'M. Gaucher\nE75.22G "x"'
    assert got["h1"].ICD10 is None and got["h1"].TYP_EXT is None
    IO.write_stage(df, os.path.join(d, "stage"))
    back = IO.read_stage(spark, os.path.join(d, "stage"))
    assert back.filter("ZENTRUM_ID = 'FRA01'").count() == 1


def test_file_stream_lands_flagged_rows(spark):
    d = tempfile.mkdtemp(prefix="cb-stream-")
    write_raw(os.path.join(d, "in"))
    q = land(journal_stream(spark, os.path.join(d, "in")), os.path.join(d, "out"), os.path.join(d, "ckpt"))
    q.awaitTermination(120)
    out = spark.read.parquet(os.path.join(d, "out"))
    assert out.count() == 2
    assert out.filter("PATIENT_HASH = 'h1'").first().is_E75_22 == 2


def test_stage_files_are_sorted_by_patient_and_csv_keeps_types(spark):
    d = tempfile.mkdtemp(prefix="cb-sorted-")
    df = spark.range(400).selectExpr("md5(cast(id as string)) as PATIENT_HASH", "concat('S', id % 4) as ZENTRUM_ID", "id as n").repartition(3)
    IO.write_stage(df, os.path.join(d, "p"))
    parts = [os.path.join(top, f) for top, _, names in os.walk(os.path.join(d, "p")) for f in names if f.endswith(".parquet")]
    assert len(parts) >= 4
    for part in parts:
        ids = [r[0] for r in spark.read.parquet(part).select("PATIENT_HASH").collect()]
        assert ids == sorted(ids)
    IO.write_stage(df, os.path.join(d, "c"), fmt="csv")
    back = IO.read_stage(spark, os.path.join(d, "c"), fmt="csv", schema=df.select("PATIENT_HASH", "n", "ZENTRUM_ID").schema)
    assert dict(back.dtypes)["n"] == "bigint" and back.agg({"n": "sum"}).first()[0] == 400 * 399 // 2


def test_plain_files_are_not_shuffled(spark):
    d = tempfile.mkdtemp(prefix="cb-plain-")
    with open(os.path.join(d, "a.csv"), "wb") as f:
        f.write((";".join(RAW_COLUMNS) + "\n" + "\n".join(";".join(["h", "BER01", "1"] + [""] * 8) for _ in range(5)) + "\n").encode("latin-1"))
    df = IO.read_journal(spark, d, multi_line=False)
    assert df.count() == 5 and "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


def test_line_breaks_in_quotes_are_read_by_several_tasks(spark):
    """Many splits, some of which lie within one record, against Spark's reader of whole files."""
    import random

    from casebook.sources import records

    rnd, d = random.Random(5), tempfile.mkdtemp(prefix="cb-quotes-")
    made = 0
    for name in ("a.csv", "b.csv", "c.csv"):
        rows = []
        for i in range(300):
            text = "".join(rnd.choice(["x", "é", ";", "\n", '""', "word ", "\n\n"]) for _ in range(rnd.randint(0, 40)))
            if i == 150:
                text = "long\n" * 2000  # a record over several splits
            rows.append(["p%d" % rnd.randint(0, 99), "BER01", str(i), "", "W", "", "A", "", f'"{text}"', "NA", ""])
            made += 1
        with open(os.path.join(d, name), "wb") as f:
            f.write((";".join(RAW_COLUMNS) + "\n" + "\n".join(";".join(r) for r in rows) + ("\n" if name != "b.csv" else "")).encode("latin-1"))
    write_raw(d, "z.csv.gz")
    whole = IO.read_journal(spark, d, whole=True)
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    spark.conf.set("spark.sql.files.openCostInBytes", "3000")
    try:
        assert records.split_lines(spark, d, "ISO-8859-1").rdd.getNumPartitions() > 20
        split = IO.read_journal(spark, d)
        assert split.count() == whole.count() == made + 2
        assert split.exceptAll(whole).count() == whole.exceptAll(split).count() == 0
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_unbalanced_quotes_are_an_error(spark):
    import pytest

    d = tempfile.mkdtemp(prefix="cb-odd-")
    with open(os.path.join(d, "a.csv"), "w") as f:
        f.write(";".join(RAW_COLUMNS) + "\n" + 'p;BER01;1;;W;;A;;"open;;\n')
    with pytest.raises(ValueError, match="unbalanced"):
        IO.read_journal(spark, d)
