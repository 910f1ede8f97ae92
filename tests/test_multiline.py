"""CSV with line breaks in quotes, over many splits, against Python's reader."""

import csv
import io
import os
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rampart import TableContract
from rampart.sources import multiline
from rampart.sources.files import read_table

C = TableContract.from_dict({"table_name": "t", "columns": [{"name": c, "type": "string"} for c in ("id", "note", "tail")]})


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "97")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def open_after(text, opened):
    """The state machine character by character: quotes open where a field begins."""
    at_start, k = not opened, 0
    while k < len(text):
        ch = text[k]
        if opened:
            if ch == '"':
                if text[k + 1:k + 2] == '"':
                    k += 1
                else:
                    opened = at_start = False
        elif ch == '"' and at_start:
            opened = True
        else:
            at_start = ch == ","
        k += 1
    return opened


def test_states_of_lines():
    rng = random.Random(1)
    for _ in range(20_000):
        line = "".join(rng.choice('"",ab ') for _ in range(rng.randint(0, 12)))
        for opened in (False, True):
            assert multiline.ends_open(line.encode(), opened) == open_after(line, opened), (line, opened)


def test_states_of_splits_compose(spark):
    rng = random.Random(2)
    rows, want = [], {}
    for f in range(30):
        state, first = False, 0
        for b in range(rng.randint(1, 25)):
            out, inside = rng.choice([(False, True), (False, True), (True, False), (True, True), (False, False)])
            s_out, s_in = rng.randint(0, 9), rng.randint(0, 9)
            rows.append((f"f{f}", b * 10, out, inside, s_out, s_in))
            want[f"f{f}", b * 10] = (state, first)
            first += s_in if state else s_out
            state = inside if state else out
    df = spark.createDataFrame(rows, "file string, blk long, out boolean, inside boolean, starts_out long, starts_inside long").repartition(4)
    got = {(r["file"], r["blk"]): (r["opened"], r["first"]) for r in multiline.split_states(df).collect()}
    assert got == want


def body(rng, n, newline="\n"):
    notes = ["plain", "", 'say "hi"', "two\nlines", "a,b", 'x\n"q",\n\ny', "crlf\r\nin quotes", "5\" pipe", "é漢🙂\n", "w" * 300, "long\n" * 30, '"', "\n"]
    out = io.StringIO()
    w = csv.writer(out, lineterminator=newline)
    w.writerow(["id", "note", "tail"])
    for i in range(n):
        w.writerow([str(i), rng.choice(notes), rng.choice(["z", "last one", 'q"'])])
        if rng.random() < 0.1:
            out.write(rng.choice(["", "   "]) + newline)  # a blank line is no record
    return out.getvalue()


def want_rows(text):
    rows = list(csv.reader(io.StringIO(text, newline="")))[1:]
    return [tuple(v or None for v in r) for r in rows if r and not (len(r) == 1 and not r[0].strip())]


@pytest.mark.parametrize("joined_by_shuffle", [False, True])
def test_records_over_many_splits(spark, tmp_dir, small_splits, monkeypatch, joined_by_shuffle):
    if joined_by_shuffle:
        monkeypatch.setattr(multiline, "BROADCAST_SPLITS", 0)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    rng = random.Random(3)
    want = []
    for name, n, newline in (("a.csv", 50, "\n"), ("b.csv", 0, "\n"), ("c/d.csv", 40, "\r\n"), ("e.csv", 1, "\n")):
        text = body(rng, n, newline)
        if name == "e.csv":
            text = text.rstrip("\n")  # no break at the end
        path = f"{tmp_dir}/in/{name}"
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w", newline="", encoding="utf-8") as fh:
            fh.write(text)
        want += want_rows(text)
    try:
        got = read_table(spark, f"{tmp_dir}/in", "csv", contract=C, multiline=True, index=True).orderBy("_source_index").collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert [r["_source_index"] for r in got] == list(range(len(want)))
    assert [(r["id"], r["note"], r["tail"]) for r in got] == want
    assert {os.path.basename(r["_source_file"]) for r in got} == {"a.csv", "d.csv", "e.csv"}
    plain = read_table(spark, f"{tmp_dir}/in", "csv", contract=C, multiline=True)
    assert plain.columns == ["id", "note", "tail"] and plain.count() == len(want)


def test_a_split_is_many_tasks(spark, tmp_dir, small_splits):
    os.makedirs(f"{tmp_dir}/one")
    with open(f"{tmp_dir}/one/big.csv", "w", newline="") as fh:
        fh.write(body(random.Random(4), 120))
    lines = multiline._lines(spark, [f"{tmp_dir}/one"])
    assert lines.rdd.getNumPartitions() > 40
    assert multiline.split_functions(lines).count() > 40


def test_unclosed_quotes_and_ragged_records(spark, tmp_dir, small_splits):
    os.makedirs(f"{tmp_dir}/odd")
    with open(f"{tmp_dir}/odd/x.csv", "w", newline="") as fh:
        fh.write('id,note,tail\n1,a,b\n2,"x\ny"\n3,"p\nq",r,extra\n4,"' + "never closed\n" * 40)
    got = read_table(spark, f"{tmp_dir}/odd", "csv", contract=C, multiline=True, index=True, flag_malformed=True).orderBy("_source_index").collect()
    assert [r["id"] for r in got][:3] == ["1", "2", "3"] and len(got) == 4
    assert [r["_corrupt_record"] is not None for r in got][:3] == [False, True, True]
    assert got[1]["note"] == "x\ny" and got[2]["note"] == "p\nq"
    with pytest.raises(ValueError, match="schema or contract"):
        read_table(spark, f"{tmp_dir}/odd", "csv", multiline=True)


def test_the_index_parses_a_csv_once(spark, tmp_dir):
    spark.range(5000).select(F.col("id").cast("string").alias("id"), F.lit("n").alias("note"), F.lit("t").alias("tail")).repartition(3).write.option("header", True).csv(f"{tmp_dir}/csv")
    indexed = read_table(spark, f"{tmp_dir}/csv", "csv", contract=C, index=True)
    plan = indexed._jdf.queryExecution().executedPlan().toString()
    assert "FileScan csv" not in plan and plan.count("FileScan parquet") == 2  # the copy and the offsets
    assert indexed.agg(F.count_distinct("_source_index"), F.max("_source_index")).first()[:] == (5000, 4999)


def test_states_of_many_lines():
    rng = random.Random(5)
    for letters in ('"",ab  ', '",a'):
        lines = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 12))) for _ in range(3_000)]
        array = pa.array([line.encode() for line in lines], pa.large_binary())
        for part in (array, array.slice(7, 500), array.slice(3, 0)):
            texts = [x.as_py().decode() for x in part]
            found = multiline.Lines(part)
            assert found.filled.tolist() == [bool(t.strip()) for t in texts]
            for opened in (False, True):
                want = [opened]
                for t in texts:
                    want.append(open_after(t, want[-1]))
                assert found.states(opened).tolist() == want
