"""Stores: awkward texts, repeated and empty runs, null fields, rows that cannot be read."""

import datetime as dt

from bondscope.sources import results, tables

TEXTS = ["", " outer ", "a\nb", "a\r\nb", "back\\slash", "\\n", "\\N", "\\\\N", 'say "so"', "c,d", None, "\\", "tab\t", "é😀"]


def test_csv_gives_any_text_back(spark, tmp_path):
    df = spark.createDataFrame([(i, t, dt.datetime(2024, 1, 1, 0, 0, 0, i)) for i, t in enumerate(TEXTS)],
                               "id int, `a text` string, t timestamp_ntz")
    tables.write_csv(df, str(tmp_path / "c"))
    found = tables.read_csv(spark, str(tmp_path / "c"), df.schema).orderBy("id").collect()
    assert [r["a text"] for r in found] == TEXTS and [r.t.microsecond for r in found] == list(range(len(TEXTS)))


def test_bad_rows_come_with_their_reason(spark, tmp_path):
    path = tmp_path / "bad"
    path.mkdir()
    (path / "part.csv").write_text("id,x,t\n1,2.5,a\nz,2.5,b\n3,\\N,c\n4,no,d\n5,1.5\n")
    good, bad = tables.checked_csv(spark, str(path), "id int, x double, t string")
    assert [tuple(r) for r in good.orderBy("id").collect()] == [(1, 2.5, "a"), (3, None, "c")]
    assert (good.count(), bad.count(), good.where("id > 1").select("id").count()) == (2, 3, 1)
    assert {r.line: r.reason.rsplit(": ")[1] for r in bad.collect()} == {"z,2.5,b": "id", "4,no,d": "x", "5,1.5": "t"}


def test_an_empty_run_replaces_the_run_before(spark, tmp_path):
    path, rows = str(tmp_path), spark.createDataFrame([("u", 1.0)], "mapping_uid string, a double")
    results.save_predictions(rows, path, "m", "r")
    results.save_predictions(rows.limit(0), path, "m", "r")
    assert results.load_predictions(spark, path, "m", "r", ["a"]).count() == 0


def test_run_ids_are_text(spark, tmp_path):
    path = str(tmp_path)
    for run, value in (("1", 1.0), ("01", 2.0), ("1.0", 3.0)):
        results.save_predictions(spark.createDataFrame([("u", value)], "mapping_uid string, a double"), path, "m/x=1", run)
    found = [results.load_predictions(spark, path, "m/x=1", r, ["a"]).first().a for r in ("1", "01", "1.0")]
    assert found == [1.0, 2.0, 3.0]
    assert results.load_predictions(spark, path, "m/x=1", "2", ["a"]).count() == 0


def test_records_keep_null_fields(spark):
    df = spark.createDataFrame([(1, None), (None, float("nan"))], "a int, b double")
    found = [r.record for r in results.json_records(df, m="x").collect()]
    assert found == ['{"m":"x","a":1,"b":null}', '{"m":"x","a":null,"b":null}']
