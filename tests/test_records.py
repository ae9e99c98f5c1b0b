"""Line breaks inside quotes, in files that are cut anywhere."""

from __future__ import annotations

import csv
import io
import random

import pytest

from wardline.schema import CORRUPT, PATIENTS
from wardline.sources import read_csv_extract
from wardline.sources.records import quoted_records

SPLIT = "spark.sql.files.maxPartitionBytes"
COST = "spark.sql.files.openCostInBytes"


@pytest.fixture(params=["96b", "700b", "1m"])
def splits(spark, request):
    before = spark.conf.get(SPLIT), spark.conf.get(COST)
    spark.conf.set(SPLIT, request.param)
    spark.conf.set(COST, "1b")
    yield request.param
    spark.conf.set(SPLIT, before[0])
    spark.conf.set(COST, before[1])


def _text(rng: random.Random) -> str:
    return "".join(rng.choice(("a", "é", '"', ",", "\n", " ", "\n\n", "b c", "")) for _ in range(rng.randrange(12)))


def _records(rows: list[list[str]], line_end: str = "\n") -> list[str]:
    out = []
    for row in rows:
        text = io.StringIO()
        csv.writer(text, lineterminator="").writerow(row)
        out.append(text.getvalue())
    return out


@pytest.mark.parametrize("line_end", ["\n", "\r\n"])
def test_records_of_files_of_any_size(spark, tmp_path, splits, line_end):
    rng = random.Random(3)
    wanted = []
    for file, n in enumerate((0, 1, 2, 40, 130)):
        rows = [[f"{file}-{i}", _text(rng), _text(rng)] for i in range(n)]
        # The first line is a header, with a line break of its own.
        written = _records([["key", "with\nbreak", "x"], *rows])
        (tmp_path / f"{file}.csv").write_bytes((line_end.join(written) + line_end * (file % 2)).encode())
        wanted += written[1:]
    found = [r.record for r in quoted_records(spark, str(tmp_path)).collect()]
    assert sorted(found) == sorted(wanted)


def test_many_tasks_read_one_file(spark, tmp_path, splits):
    rows = [[str(i), "x\ny" * (i % 3), "z" * 20] for i in range(300)]
    (tmp_path / "a.csv").write_text("\n".join(["a,b,c", *_records(rows)]))
    lines = spark.read.option("lineSep", "\n").text(str(tmp_path))
    assert (lines.rdd.getNumPartitions() > 10) == (splits != "1m")
    assert quoted_records(spark, str(tmp_path)).count() == 300


def test_a_quote_that_is_never_closed(spark, tmp_path, splits):
    good = [f"{i},ok" for i in range(30)]
    (tmp_path / "a.csv").write_text("\n".join(["h,h", *good, '30,"open', *[f"{i},lost" for i in range(31, 60)]]))
    (tmp_path / "b.csv").write_text("\n".join(["h,h", *good]))
    found = sorted(r.record for r in quoted_records(spark, str(tmp_path)).collect())
    assert found == sorted(good * 2 + ['30,"open'] + [f"{i},lost" for i in range(31, 60)])


def test_typed_rows(spark, tmp_path, splits):
    line = 'P{0},Ann,Lee,F,1980-02-29,555,"1 ""Elm""\nSt, {0}",2022-01-01,Care,INS1,a@x'
    bad = line.format(99).replace("1980-02-29", "soon")
    (tmp_path / "p.csv").write_text("\n".join([",".join(PATIENTS.columns), *(line.format(i) for i in range(40)), bad, "P98,short"]) + "\n")
    rows = {r.Patient_ID: r for r in read_csv_extract(spark, PATIENTS, str(tmp_path / "p.csv"), multi_line=True).collect()}
    assert len(rows) == 42 and rows["P7"].Address == '1 "Elm"\nSt, 7' and str(rows["P7"].Date_Of_Birth) == "1980-02-29"
    assert {k for k, r in rows.items() if r[CORRUPT] is not None} == {"P98", "P99"}
    plain = read_csv_extract(spark, PATIENTS, str(tmp_path / "p.csv"))
    assert plain.columns == list(rows["P7"].asDict())


def test_nothing_to_read(spark, tmp_path, splits):
    (tmp_path / "a.csv").write_text("")
    (tmp_path / "b.csv").write_text("only,a,header\n")
    assert quoted_records(spark, str(tmp_path)).isEmpty()
