import itertools
import random
import time
from collections import Counter
from datetime import date

import numpy as np
import pytest

from lensmill.operators import lines
from lensmill.plans import enquiry, maintenance
from tests.conftest import day, rows, ts

DEP = "DEP~~00000001~00000002~A~" + "ANN".ljust(24) + "~" + "LEE".ljust(20) + "~F~01021980~1~01072001~        ~  $10.00~  $20.00~N~   $5.00"
GAPS = "GAPS~~00000001~00000002~ ~B~01011999~31121999~ABCDEFGHIJKL1"
HISTC = "HISTC~~00000001~00000002~BDATA~~00001~00042~03041999~L12345~A100001 ~ABC  ~S1 23~05061999~  $50.00~  $10.00"


def responses(spark, *bodies):
    return spark.createDataFrame([(i, env, body) for i, env, body in bodies], "response_id long, env string, body string")


def test_records_and_fields(spark):
    frame = responses(spark, (1, "test", f"x{DEP}{DEP.replace('ANN', 'BOB')}\n{GAPS}"), (2, "test", "nothing"), (3, "test", HISTC), (4, "test", None))
    dep = enquiry.records(frame, "dep").orderBy("rec_no").collect()
    assert [(r.response_id, r.rec_no, r["first"].strip(), r["last"].strip(), r.l_boost) for r in dep] == [
        (1, 0, "ANN", "LEE", "   $5.00"),
        (1, 1, "BOB", "LEE", "   $5.00"),
    ]
    assert tuple(enquiry.records(frame, "gaps").first())[3:] == ("00000001", "00000002", " ", "B", "01011999", "31121999", "ABCDEFGHIJKL1")
    assert tuple(enquiry.records(frame, "histc").first())[3:] == (
        "00000001", "00000002", "BDATA", "00001", "00042", "03041999", "L12345", "A100001 ", "ABC  ", "S1 23", "05061999", "  $50.00", "  $10.00",
    )
    counts = {r.kind: r["count"] for r in enquiry.enquiry_records(frame).groupBy("kind").count().collect()}
    assert counts == {"dep": 28, "gaps": 7, "histc": 13}
    assert [len(x.places) for x in enquiry.LAYOUTS.values()] == [14, 7, 13, 44]


def test_broken_records_are_not_found(spark):
    frame = responses(spark, (1, "test", DEP.replace("~F~", "~f~")), (2, "test", GAPS.replace("31121999", "3112199X")))
    assert enquiry.records(frame, "dep").count() == 0 and enquiry.records(frame, "gaps").count() == 0


def test_response_diff(spark):
    frame = responses(
        spark,
        (1, "prod", "same\nold\ngone"),
        (1, "test", "same\r\nnew"),
        (2, "prod", "a"),
        (2, "test", "a"),
        (3, "test", "only"),
        (1, "other", "ignored"),
    )
    assert rows(enquiry.response_diff(frame)) == [
        (1, 1, "changed", "old", "new"),
        (1, 2, "removed", "gone", None),
        (3, 0, "added", None, "only"),
    ]


def test_search_keys(spark, make_clinic):
    people = make_clinic(
        patient=[
            dict(ID=1, SURNAME="SMITH", GIVEN="JO", BIRTHDATE=day("1980-02-01")),
            dict(ID=2, SURNAME="A" * 21, GIVEN=None, BIRTHDATE=None),
        ]
    )["patient"]
    assert rows(enquiry.search_keys(people)) == [
        (1, "SEARCH~~SMITH~~~~~~~~~~~~~~~~J~~D~01021980~~~~~"),
        (2, f"SEARCH~~{'A' * 21}~~~~D~~~~~~~~~~~~~~"),
    ]


def test_request_keys(spark):
    numbers = spark.sql("select '00000042' as n")
    assert rows(enquiry.request_keys(numbers, "n"), "request_key") == [("GAPS~~00000042",), ("HISTP~~00000042",)]
    policy = rows(enquiry.request_keys(numbers, "n", "policy"), "request_key")
    assert policy == [("DEP~~00000042",), ("DETAILS~~00000042",), ("HISTC~~00000042",)]


def test_eligibility(make_clinic):
    links = [(1, "ME"), (1, "VIP"), (1, None), (2, "MNE"), (3, "ME"), (None, "ME"), (4, "MNE")]
    clinic = make_clinic(
        patient_categories_link=[dict(PATIENT_ID=p, IDENTIFIER=c) for p, c in links],
        appointment=[
            dict(ID=1, PATIENTID=1, STARTDATE=ts("2024-01-11 00:00:01")),
            dict(ID=2, PATIENTID=1, STARTDATE=ts("2024-02-11 00:00:00")),
            dict(ID=3, PATIENTID=2, STARTDATE=ts("2024-01-11 00:00:00")),
            dict(ID=4, PATIENTID=None, STARTDATE=ts("2024-03-11 00:00:00")),
            dict(ID=5, PATIENTID=4, STARTDATE=ts("2024-03-11 00:00:00")),
        ],
    )
    today = date(2024, 1, 8)
    cleared = rows(maintenance.eligibility_cleared(clinic, today))
    assert cleared == [(1, "ME"), (4, "MNE")]
    assert rows(maintenance.eligibility_cleared_count(clinic, today)) == [(2,)]
    assert rows(maintenance.eligibility_kept(clinic, today)) == sorted((x for x in links if x not in cleared), key=repr)


def test_marks_are_deleted_in_place(spark, make_clinic, tmp_path):
    links = [(p, code) for p in range(60) for code in ("ME", "VIP", None)] + [(None, "ME"), (None, None), (7, "MNE"), (7, "MNE")]
    ahead = [dict(ID=p, PATIENTID=p, STARTDATE=ts("2024-01-11 00:00:01")) for p in (3, 7)]
    clinic = make_clinic(patient_categories_link=[dict(PATIENT_ID=p, IDENTIFIER=c) for p, c in links], appointment=ahead)
    root, today = str(tmp_path / "links"), date(2024, 1, 8)
    maintenance.write_categories(clinic["patient_categories_link"], root, parts=16)
    files = lambda: {str(f): f.stat().st_mtime_ns for f in (tmp_path / "links").rglob("part-*")}
    before = files()
    counts = maintenance.clear_eligibility(spark, clinic, today, root, str(tmp_path / "work"), parts=16)
    assert counts == {"cleared": 4, "rows": len(links)}
    cleared = spark.read.parquet(str(tmp_path / "work" / "cleared")).drop("part")
    assert rows(cleared) == rows(maintenance.eligibility_cleared(clinic, today)) == [(3, "ME"), (7, "ME"), (7, "MNE"), (7, "MNE")]
    # A row without a patient and a code says nothing and goes.
    want = sorted((x for x in links if x not in {(3, "ME"), (7, "ME"), (7, "MNE"), (None, None)}), key=repr)
    assert rows(maintenance.read_categories(spark, root)) == want
    kept = {f for f, at in files().items() if before.get(f) == at}
    assert len({f.split("part=")[1].split("/")[0] for f in before.keys() - kept}) <= 2 and kept
    now = files()
    again = maintenance.clear_eligibility(spark, clinic, today, root, str(tmp_path / "again"), parts=16)
    assert again["cleared"] == 0 and files() == now


def test_response_diff_aligned(spark):
    frame = responses(
        spark,
        (1, "prod", "a\nb\nb\nc"),
        (1, "test", "new\na\nb\nin between\nc"),
        (2, "prod", "same"),
        (2, "test", "same"),
        (3, "prod", "gone"),
    )
    assert rows(enquiry.response_diff(frame, aligned=True)) == [
        (1, 0, "added", None, "new"),
        (1, 2, "removed", "b", None),
        (1, 3, "added", None, "in between"),
        (3, 0, "removed", "gone", None),
    ]



def test_response_alignment(spark):
    frame = responses(
        spark,
        (1, "prod", "a\nb\nc"),
        (1, "test", "c\nb\na"),
        (2, "prod", "same"),
        (2, "test", "same"),
        (3, "prod", "gone\r\ntwice\ntwice"),
        (4, "test", ""),
        (5, "prod", "a\nx\nx\nb\nx"),
        (5, "test", "a\nx\nb\nnew\nx"),
        (6, "prod", None),
        (6, "test", None),
    )
    assert rows(enquiry.response_alignment(frame)) == sorted(
        [
            (1, "moved", 0, 2, "a", "a"),
            (1, "moved", 1, 1, "b", "b"),
            (3, "removed", 0, None, "gone", None),
            (3, "removed", 1, None, "twice", None),
            (3, "removed", 2, None, "twice", None),
            (4, "added", None, 0, None, ""),
            (5, "removed", 2, None, "x", None),
            (5, "added", None, 3, None, "new"),
        ],
        key=repr,
    )


@pytest.mark.parametrize("seed", range(6))
def test_alignment_keeps_order_and_accounts_for_every_line(seed):
    rng = random.Random(seed)
    for _ in range(150):
        left = [rng.choice("abcdefghij"[: rng.randrange(1, 11)]) for _ in range(rng.randrange(0, 14))]
        right = list(left)
        for _ in range(rng.randrange(0, 5)):
            at = rng.randrange(0, len(right) + 1)
            right[at : at + rng.randrange(0, 2)] = rng.choices("abcdexyz", k=rng.randrange(0, 3))
        codes = {x: k for k, x in enumerate({*left, *right})}
        i, j = lines.aligned(*(np.array([codes[x] for x in side], np.int64) for side in (left, right)))
        assert all(left[a] == right[b] for a, b in zip(i, j, strict=True))
        assert (np.diff(i) > 0).all() and (np.diff(j) > 0).all()
        found = lines.changes(left, right)
        assert sorted([*i.tolist(), *(a for _, a, _ in found if a is not None)]) == list(range(len(left)))
        assert sorted([*j.tolist(), *(b for _, _, b in found if b is not None)]) == list(range(len(right)))
        assert all(left[a] == right[b] for kind, a, b in found if kind == "moved")
        over = Counter(left[a] for kind, a, _ in found if kind == "removed")
        assert not over.keys() & {right[b] for kind, _, b in found if kind == "added"}


def test_longest_ascending_run_equals_brute_force():
    rng = random.Random(4)
    for _ in range(200):
        places = rng.sample(range(20), rng.randrange(0, 9))
        run = lines.ascending(places)
        longest = max((len(c) for n in range(len(places) + 1) for c in itertools.combinations(places, n) if list(c) == sorted(c)), default=0)
        assert [places[k] for k in run] == sorted(places[k] for k in run) and len(run) == longest


def test_alignment_of_long_bodies_takes_seconds(spark):
    """50,000 lines, of which many are alike, in another order, or in no order at all."""
    rng = random.Random(1)
    body = [f"line {k}" if k % 3 else "same" for k in range(50_000)]
    moved = body[:10_000] + body[30_000:] + body[10_000:30_000]
    mixed = rng.sample(body, len(body))
    frame = responses(spark, *((k, env, "\n".join(b)) for k, other in enumerate((moved, mixed, body[::-1])) for env, b in (("prod", body), ("test", other))))
    began = time.perf_counter()
    counts = enquiry.response_alignment(frame).groupBy("response_id", "change").count().collect()
    assert time.perf_counter() - began < 30
    assert {r.change for r in counts} == {"moved"}
    assert [r["count"] for r in counts if r.response_id == 0][0] <= 20_000
