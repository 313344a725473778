import os
import random
import re
import time
from collections import Counter
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from lensmill.functions.windows import DateRange
from lensmill.plans import claims
from lensmill.plans.enquiry import response_diff
from lensmill.sources import sinks
from lensmill.sources.text import number_lines, raw_lines, read_lines, read_responses
from lensmill.streaming.landing import benefit_landing, read_landed
from tests.conftest import rows

SUMMARY = "230620200944-A100000-H20017-SummaryReport.txt"


def record(member, when, n=0, tail="       "):
    return f"{member:08d}{n:08d}001  {n:06d}{when:06d}{7:06d} A100000{tail}"


def reorder(text):
    """Batch order by plain Python: members as they first appear, their claims by date, latest first."""
    groups = {}
    for line in text.splitlines(keepends=True):
        for found in re.finditer(r"(\d{8})\d{8}\d{3}\s{2}\d{6}(\d{6})\d{6}\sA\d{6}\s{7}", line):
            groups.setdefault(found[1], []).append((found[2], found[0]))
    return [text for claims_ in groups.values() for _, text in sorted(claims_, key=lambda c: c[0], reverse=True)]


def batch(rng, size):
    lines = []
    for n in range(size):
        member = 1 if rng.random() < 0.35 else rng.randrange(2, 9)
        line = record(member, rng.randrange(200101, 200106), n)
        if rng.random() < 0.2:
            line += record(member, rng.randrange(200101, 200106), n + 1000)
        lines.append(rng.choice([line, line, line, f"noise {n}"]))
    return "".join(f"{line}\n" for line in lines)


@pytest.fixture
def incoming(tmp_path):
    rng = random.Random(3)
    folder = tmp_path / "in"
    folder.mkdir()
    for provider, size in (("A100000", 400), ("A100001", 40)):
        (folder / f"19022020-{provider}-H20017.txt").write_text(batch(rng, size))
    (folder / "20022020-A100000-H20017.txt").write_text(record(5, 200101, tail="      ") + "\n" + record(5, 200102, tail="      ") + "\n")
    return folder


def test_claims_keep_member_order_and_sort_by_date(spark, incoming):
    got = claims.claims_reordered(read_lines(spark, str(incoming))).collect()
    for path in incoming.iterdir():
        assert [r.record for r in got if r.file == path.name] == reorder(path.read_text())


def test_batches_are_written_back_in_order(spark, incoming, tmp_path):
    ordered = claims.claims_reordered(read_lines(spark, str(incoming)))
    sinks.write_claim_batches(ordered, str(tmp_path / "lines"))
    sinks.write_claim_batches(ordered.filter(~F.col("file").startswith("20")), str(tmp_path / "joined"), joined=True)
    for path in incoming.iterdir():
        expected = reorder(path.read_text())
        parts = sorted((tmp_path / "lines" / f"batch={path.name}").glob("part-*"))
        assert "".join(p.read_text() for p in parts) == "".join(r.rstrip("\n") + "\n" for r in expected)
        if not path.name.startswith("20"):
            parts = sorted((tmp_path / "joined" / f"batch={path.name}").glob("part-*"))
            assert "".join(p.read_text() for p in parts) == "".join(expected)


def test_line_numbers_survive_splitting(spark, tmp_path):
    sizes = {"big.txt": 20_000, "small.txt": 3, "one.txt": 1}
    for name, size in sizes.items():
        (tmp_path / name).write_text("\n".join(f"{name} line {i}" for i in range(1, size + 1)))
    (tmp_path / "empty.txt").write_text("")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40000")
    try:
        raw = raw_lines(spark.read.text(str(tmp_path)))
        assert raw.filter("file = 'big.txt'").select("block").distinct().count() > 5
        numbered = number_lines(raw)
        wrong = numbered.filter("line <> concat(file, ' line ', line_no)")
        assert wrong.count() == 0 and numbered.count() == sum(sizes.values())
        # A filter above must not change the numbers.
        late = number_lines(raw).filter("file = 'big.txt' and line like '% 19999'")
        assert rows(late, "line_no") == [(19999,)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_report_file_names(spark, branches):
    names = spark.createDataFrame(
        [(SUMMARY,), ("230620200944-A999999-H20017-Error.txt",), ("310220200944-A100001-H20017-ExceptionReport.txt",), ("notes.txt",)],
        "file string",
    )
    assert rows(claims.benefit_files(names, branches), "branch", "kind", "picked_at") == [
        ("", "Error", datetime(2020, 6, 23, 9, 44)),
        ("B0", "SummaryReport", datetime(2020, 6, 23, 9, 44)),
        ("B1", "ExceptionReport", None),  # 31 February
    ]
    assert rows(claims.files_for_branch(names, branches)) == [("B0", SUMMARY), ("B1", "310220200944-A100001-H20017-ExceptionReport.txt")]


SUMMARY_TEXT = (
    "12 A 34 56 X 78 90 this first line is a title\n"
    "123 A 00123  45678 HP01   03/10/1998 011294  Paid in full\n"
    "123456789B1 2 X y 3 \n"
    "Claim total :\n"
    "\t\tPaid : 12.50 by card\n"
    "--- nothing\n"
    "Total:\n"
    "999 Z 1 2 Q 3 4 last line"
)


@pytest.fixture
def patients(make_clinic):
    def member(id, number, surname):
        return dict(ID=id, MEMBER_NUMBER=number, TITLE="MR", GIVEN="AL", SURNAME=surname)

    return make_clinic(
        patient=[member(9, "00000123", "LATER"), member(2, "00000123", "FIRST"), member(3, "123456789", "LONG"), member(4, None, "X")]
    )["patient"]


def check_summary(frame):
    got = {r.line_no: r for r in frame.collect()}
    assert sorted(got) == [2, 3, 4, 5, 8]
    first = got[2]
    assert (first.entry, first.name, first.branch) == ("claim", "MR AL FIRST", "B0")
    assert tuple(first[c] for c in claims.SUMMARY_FIELDS) == (
        "123", "A", "00123", "45678", "HP01", "03/10/1998", "011294", "Paid in full",
    )
    assert (got[3].name, got[3].member_no, got[3].message) == ("MR AL LONG", "123456789", "")
    assert (got[4].entry, got[4].heading, got[4].member_no) == ("heading", "Claim total", None)
    assert (got[5].entry, got[5].detail_key, got[5].detail_value) == ("detail", "Paid", "12.50 by card")
    assert (got[8].name, got[8].message) == (None, "last line")


def test_summary_lines(spark, tmp_path, branches, patients):
    (tmp_path / SUMMARY).write_text(SUMMARY_TEXT)
    (tmp_path / SUMMARY.replace("Summary", "Exception")).write_text(SUMMARY_TEXT)
    (tmp_path / SUMMARY.replace("A100000", "A100001")).write_text(SUMMARY_TEXT)
    lines = read_lines(spark, str(tmp_path))
    assert claims.benefit_summary(lines, branches, patients).count() == 10
    check_summary(claims.benefit_summary_by_branch(lines, branches, patients, "B0"))


def test_files_are_picked_up_once(spark, tmp_path, branches, patients):
    incoming, target, progress = (str(tmp_path / d) for d in ("in", "out", "progress"))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / SUMMARY).write_text(SUMMARY_TEXT)
    (tmp_path / "in" / "230620200944-A100001-H20017-Error.txt").write_text("late")

    def pick_up():
        for query in benefit_landing(spark, incoming, target, progress, branches, patients):
            query.awaitTermination()
        return spark.read.parquet(f"{target}/files"), spark.read.parquet(f"{target}/summary")

    files, summary = pick_up()
    assert rows(files, "branch", "kind") == [("B0", "SummaryReport"), ("B1", "Error")]
    check_summary(summary)
    files, summary = pick_up()
    assert files.count() == 2
    check_summary(summary)
    (tmp_path / "in" / SUMMARY.replace("0944", "1100")).write_text(SUMMARY_TEXT)
    files, summary = pick_up()
    assert files.count() == 3 and summary.count() == 10


def test_a_pick_up_that_fails_midway_is_repeated_whole(spark, tmp_path, patients, branches):
    incoming, target, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / SUMMARY).write_text(SUMMARY_TEXT)
    (tmp_path / "in" / "230620200944-A100001-H20017-Error.txt").write_text("late")
    broken = patients.withColumn("GIVEN", F.raise_error(F.lit("killed")).cast("string"))
    with pytest.raises(Exception, match="killed"):
        for query in benefit_landing(spark, incoming, target, progress, branches, broken):
            query.awaitTermination()
    # The list of files was written, but the batch is not whole.
    assert (tmp_path / "out" / "files").exists()
    with pytest.raises(ValueError, match="no batch"):
        read_landed(spark, target, "files")
    for _ in range(2):
        for query in benefit_landing(spark, incoming, target, progress, branches, patients):
            query.awaitTermination()
    assert read_landed(spark, target, "files").count() == 2
    check_summary(read_landed(spark, target, "summary"))


def test_a_file_that_is_sent_again_replaces_its_rows(spark, tmp_path, patients, branches):
    incoming, target, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    (tmp_path / "in").mkdir()
    other = SUMMARY.replace("0944", "1100")
    (tmp_path / "in" / SUMMARY).write_text(SUMMARY_TEXT)
    (tmp_path / "in" / other).write_text(SUMMARY_TEXT)

    def pick_up():
        for query in benefit_landing(spark, incoming, target, progress, branches, patients):
            query.awaitTermination()
        return Counter(r.file for r in read_landed(spark, target, "summary").collect())

    before = pick_up()
    for k, text in enumerate((SUMMARY_TEXT + "\nClaim total :\n", SUMMARY_TEXT + "\nClaim total :\nOther total :\n")):
        (tmp_path / "in" / SUMMARY).write_text(text)
        os.utime(tmp_path / "in" / SUMMARY, (time.time() + 100 * (k + 1),) * 2)
        (tmp_path / "in" / SUMMARY.replace("0944", f"120{k}")).write_text(SUMMARY_TEXT)
        after = pick_up()
        assert after[SUMMARY] == before[SUMMARY] + k + 1 and after[other] == before[other]
        assert len(after) == 3 + k
    assert pick_up() == after
    assert read_landed(spark, target, "files").count() == 4


def test_report_sinks(spark, tmp_path):
    window = DateRange(date(2020, 5, 1), date(2020, 5, 31))
    assert sinks.report_name("dispensers", window, "B0") == "report-dispensers-2020-05-01-to-2020-05-31-B0.csv"
    frame = spark.sql("select * from values ('B0', 1), ('B1', cast(null as int)) as t(branch, n)")
    path = sinks.write_report(frame, str(tmp_path), "utilisation", window)
    assert path.endswith("/report-utilisation-2020-05-01-to-2020-05-31.csv")
    assert rows(spark.read.csv(path, header=True)) == [("B0", "1"), ("B1", None)]
    path = sinks.write_report_by_branch(frame, str(tmp_path), "scores", window)
    assert rows(spark.read.csv(f"{path}/branch=B0", header=True)) == [("1",)]


def test_responses_are_read_whole(spark, tmp_path):
    (tmp_path / "test_dep-12345678.txt").write_text("x\ny")
    (tmp_path / "prod_dep-12345678.txt").write_text("x\nz")
    responses = read_responses(spark, str(tmp_path))
    assert rows(responses) == [("dep-12345678", "prod", "x\nz"), ("dep-12345678", "test", "x\ny")]
    assert rows(response_diff(responses), "line_no", "change") == [(1, "changed")]


def test_files_are_matched_by_codes_of_any_shape(spark):
    names = spark.createDataFrame([("2-ZZ-77-x.txt",), ("19022020-A100000-H20017.txt",), ("zz.txt",), (None,)], "file string")
    codes = spark.createDataFrame([("B0", "A100000"), ("B7", "ZZ-77"), ("B8", "Z-7"), ("B9", None), ("BX", "")], "code string, provider_code string")
    want = [("B0", "19022020-A100000-H20017.txt"), ("B7", "2-ZZ-77-x.txt"), ("B8", "2-ZZ-77-x.txt")]
    assert rows(claims.files_for_branch(names, codes)) == want
    assert claims.files_for_branch(names, codes.limit(0)).count() == 0


def test_batches_of_one_name_in_two_folders_stay_apart(spark, tmp_path):
    for folder, members in (("a", (1, 2)), ("b", (2, 1))):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "x.txt").write_text("".join(record(m, 200101) + "\n" for m in members))
    got = claims.claims_reordered(read_lines(spark, f"{tmp_path}/*")).collect()
    assert [(r.path[-7:], int(r.member)) for r in got] == [("a/x.txt", 1), ("a/x.txt", 2), ("b/x.txt", 2), ("b/x.txt", 1)]


def test_summary_filter_prunes_files(spark, tmp_path):
    (tmp_path / SUMMARY).write_text(SUMMARY_TEXT)
    (tmp_path / SUMMARY.replace("A100000", "A100001")).write_text(SUMMARY_TEXT)
    (tmp_path / "230620200944-A100000-H20017-Error.txt").write_text("late")
    raw = raw_lines(spark.read.text(str(tmp_path)))
    kept = raw.filter(claims.is_summary(["A100000"]))
    assert number_lines(kept).select("file").distinct().collect()[0].file == SUMMARY
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(regexp_extract(_metadata.file_name" in plan or "_metadata" in plan
