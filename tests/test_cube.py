import random
from datetime import date, timedelta

import pytest

from lensmill.functions.windows import DateRange
from lensmill.operators.partials import merged_metrics
from lensmill.operators.tally import Metric
from lensmill.plans import branch, cube, first_purchase, staff
from tests.conftest import money, rows, ts

DAYS = DateRange(date(2024, 5, 20), date(2024, 6, 10))
WINDOWS = [DAYS, DateRange(date(2024, 5, 27), date(2024, 6, 2)), DateRange(date(2024, 6, 3), date(2024, 6, 3))]
TIMES = ("00:00:00", "09:30:00", "23:59:59", "23:59:59.5")
BARCODES = ("0001", "NG12", "GAP1", "OCT", "LTPRO", "10911", "10914", "x", None)


def tables(n=400, seed=3):
    """Facts on every day, also in a day's last split second, with nulls and a hot patient."""
    rng = random.Random(seed)

    def at():
        return ts(f"{DAYS.first + timedelta(days=rng.randrange(22))} {rng.choice(TIMES)}")

    def some(*values):
        return rng.choice(values)

    def one(k):
        who = dict(PATIENTID=some(1, 1, 2, 3, 4, 5, None), BRANCH_IDENTIFIER=some("B0", "B1", "B1", None), USER_ADDED=some("D1", "D2", None))
        return k, who

    ids = [one(k) for k in range(n)]
    invoice = [
        dict(
            ID=k, SALE_DATE=at(), USER_IDENTIFIER=some("O1", "O2"), TYPE=some(2, 2, 6, 1), DESPENSE_TOTAL=money(some("0", "10", "-5")),
            ORDER_TYPE=some(0, 1), DISCOUNTID=some(71, 77, 106, 26, None), STOCK_CHARGED=money("9.50"), STOCK_PAID=money(some("9.50", "2.00")), **who,
        )
        for k, who in ids
    ]
    items = [
        dict(
            INVOICEID=rng.randrange(n), QTY=some(1, 2, None), UNITPRICE=money(some("5.00", "7.25")), DISCOUNT_AMOUNT=money(some("0", "1.1250")),
            STOCK_TYPE=some(2, 3, 4, 5), ITEM_BARCODE=some(*BARCODES),
        )
        for _ in range(2 * n)
    ]
    visits = [dict(ID=k, STARTDATE=at(), RESID=some("O1", "O2"), APPOINTMENT_TYPE=some("SC", "CL", "AL", "BRK", "LT"), APP_PROGRESS=some(5, 5, 1), **{c: v for c, v in who.items() if c != "USER_ADDED"}) for k, who in ids]
    glasses = [
        dict(
            ID=k, ORDER_DATE=at(), COLLECTED_DATE=some(at(), None), DELIVERY_BRANCH=some("B0", "B1"), WARRANTY=some("", "P", "S"), CANCELLED=some(0, 1),
            STAFFFIT=some("D1", "D2", None), STAFFCHK=some("D1", None), STAFFPCK=some("D2", None), STAFFDEL=some("D1", None), **who,
        )
        for k, who in ids
    ]
    lenses = [
        dict(ID=k, ORDER_DATE=at(), COLLECTED_DATE=some(at(), None), CANCELLED=0, TRIAL=0, TRIAL_ONLY=some(0, 1), WARRANTY="", RX_REFERENCE=k % 9, **who)
        for k, who in ids
    ]
    return dict(
        invoice=invoice, invoice_items=items, appointment=visits, spectacle_orders=glasses, contact_lens_orders=lenses,
        contact_rx=[dict(ID=k, DATE_ADDED=ts("2024-03-01 10:00:00") if k % 2 else ts("2023-03-01 10:00:00")) for k in range(9)],
        examination=[dict(ID=k, PATIENT_ID=who["PATIENTID"], EXAM_DATE=at(), USER_IDENTIFIER=some("O1", "O2")) for k, who in ids],
        clockinout=[dict(TIMESTMP=at(), BRANCH_IDENTIFIER=who["BRANCH_IDENTIFIER"], USER_ADDED=who["USER_ADDED"]) for _, who in ids],
        patient_letters=[dict(ID=k, DATE_ADDED=at(), USER_ADDED=some("O1", "O2"), LETTER_DESCRIPTION=some("AMD", "CAT", "other")) for k, _ in ids],
        stock_arrival=[dict(ID=k, ARRIVAL_DATE=at(), BRANCH_IDENTIFIER=who["BRANCH_IDENTIFIER"], USER_ADDED=who["USER_ADDED"]) for k, who in ids],
        users=[dict(IDENTIFIER=i, USER_TYPE=t, INACTIVE=0) for i, t in (("D1", 2), ("D2", 4), ("O1", 1), ("O2", 1))],
        patient=[dict(ID=k, BRANCH_IDENTIFIER=f"B{k % 2}") for k in range(6)],
    )


@pytest.fixture(scope="module")
def data():
    return tables()


def test_reports_from_days_equal_the_direct_ones(spark, make_clinic, data, branches, tmp_path):
    clinic = make_clinic(**data)
    stored = cube.Cube(spark, clinic, str(tmp_path / "cube"))
    stored.update(DAYS)
    for window in WINDOWS:
        assert rows(stored.branch_masterdata(window, branches)) == rows(branch.branch_masterdata(clinic, window, branches))
        assert rows(stored.utilisation(window, branches)) == rows(branch.utilisation(clinic, window, branches))
        assert rows(stored.dispenser_scorecard(window, branches)) == rows(staff.dispenser_scorecard(clinic, window, branches))
        assert rows(stored.optometrist_scorecard(window)) == rows(staff.optometrist_scorecard(clinic, window))
    assert len(rows(stored.dispenser_scorecard(DAYS, branches))) == 4


def test_reports_from_days_read_no_fact(spark, make_clinic, data, branches, tmp_path):
    """After the update the facts may be gone; only the named days are read."""
    stored = cube.Cube(spark, make_clinic(**data), str(tmp_path / "cube"))
    stored.update(DAYS)
    want = rows(stored.branch_masterdata(WINDOWS[1], branches))
    without = {name: [] for name in data} | {"users": data["users"]}
    later = cube.Cube(spark, make_clinic(**without), str(tmp_path / "cube"))
    assert rows(later.branch_masterdata(WINDOWS[1], branches)) == want
    assert rows(later.optometrist_scorecard(WINDOWS[1])) == rows(stored.optometrist_scorecard(WINDOWS[1]))
    plan = later.dispenser_scorecard(WINDOWS[1], branches)._jdf.queryExecution().executedPlan().toString()
    assert "LogicalRDD" not in plan and plan.count("FileScan") == 4 and "PartitionFilters: [isnotnull(_day" in plan


def test_every_source_is_one_scan_of_its_fact(make_clinic, data):
    """What a day's update runs reads each fact once (the invoices once more, with their items)."""
    found = cube.sources(make_clinic(**data), DAYS)
    assert set(found) == set(cube._WINDOW)
    assert len({s.folder for s in found.values()}) == len(found)


def test_days_are_replaced(spark, make_clinic, data, branches, tmp_path):
    root = str(tmp_path / "cube")
    cube.Cube(spark, make_clinic(**data), root).update(DAYS)
    # A day's rows change, another day loses all of them; the others stay as they are stored.
    changed = {n: [dict(r) for r in table] for n, table in data.items()}
    changed["invoice"] = [r for r in changed["invoice"] if r["SALE_DATE"].date() != date(2024, 6, 3)]
    for r in changed["invoice"]:
        if r["SALE_DATE"].date() == date(2024, 6, 4):
            r["BRANCH_IDENTIFIER"] = "B0"
    clinic = make_clinic(**changed)
    stored = cube.Cube(spark, clinic, root)
    stored.update(DateRange(date(2024, 6, 3), date(2024, 6, 4)), ("invoices", "lines"))
    assert rows(stored.branch_masterdata(DAYS, branches)) == rows(branch.branch_masterdata(clinic, DAYS, branches))
    assert rows(stored.dispenser_scorecard(DAYS, branches)) == rows(staff.dispenser_scorecard(clinic, DAYS, branches))


def test_metrics_of_one_name_must_be_one_metric():
    assert len(merged_metrics([Metric("a", "count")], [Metric("a", "count"), Metric("b", "count")])) == 2
    with pytest.raises(ValueError, match="two metrics are called a"):
        merged_metrics([Metric("a", "count")], [Metric("a", "distinct")])


def sales(*pairs):
    return [dict(ID=k, PATIENTID=p, SALE_DATE=ts(at), TYPE=2) for k, (p, at) in enumerate(pairs)]


PEOPLE = [dict(ID=k, BRANCH_IDENTIFIER=f"B{k % 2}") for k in range(9)]
SALES = sales(
    (1, "2023-07-05 10:00:00"), (1, "2024-05-28 10:00:00"), (2, "2024-05-27 00:00:00"), (3, "2024-05-27 00:00:01"), (4, "2024-06-02 23:59:59"),
    (5, "2024-06-02 23:59:59.5"), (6, "2023-06-30 10:00:00"), (6, "2024-05-29 10:00:00"), (None, "2024-05-29 10:00:00"), (7, "2024-06-28 10:00:00"),
    (7, "2024-07-02 10:00:00"), (8, "2024-07-02 10:00:00"), (3, "2024-05-30 10:00:00"),
)


def test_first_purchases_equal_the_direct_report(spark, make_clinic, branches, tmp_path):
    clinic = make_clinic(invoice=SALES, patient=PEOPLE)
    index = first_purchase.Index(spark, clinic, str(tmp_path / "index"))
    # The last days come first, then the older ones, then one day again.
    for first, last in (("2024-05-20", "2024-07-10"), ("2023-06-01", "2024-05-19"), ("2024-05-28", "2024-05-28")):
        index.update(DateRange(date.fromisoformat(first), date.fromisoformat(last)))
    for window in (WINDOWS[1], DAYS, DateRange(date(2024, 6, 25), date(2024, 7, 5)), DateRange(date(2024, 7, 1), date(2024, 7, 31))):
        for exclusive in (False, True):
            got = rows(index.unique_customers(window, branches, exclusive))
            assert got == rows(branch.unique_customers_fy(clinic, window, branches, exclusive)), (window, exclusive)


def test_a_late_day_moves_first_purchases_back(spark, make_clinic, branches, tmp_path):
    window = DateRange(date(2024, 5, 27), date(2024, 6, 2))
    early = make_clinic(invoice=sales((1, "2024-05-28 10:00:00"), (2, "2024-05-28 11:00:00")), patient=PEOPLE)
    first_purchase.Index(spark, early, str(tmp_path / "index")).update(window)
    clinic = make_clinic(
        invoice=sales((1, "2024-05-28 10:00:00"), (2, "2024-05-28 11:00:00"), (1, "2024-05-02 10:00:00"), (2, "2024-05-27 10:00:00")), patient=PEOPLE
    )
    index = first_purchase.Index(spark, clinic, str(tmp_path / "index"))
    assert rows(index.unique_customers(window, branches)) == [("B0", 1), ("B1", 1)]
    index.update(DateRange(date(2024, 5, 1), date(2024, 5, 27)))
    assert rows(index.unique_customers(window, branches)) == [("B0", 1), ("B1", 0)]
    # The 28th has lost both of its patients, and says so.
    assert {(r.patient, r.day) for r in index._stored().collect()} == {(1, date(2024, 5, 2)), (2, date(2024, 5, 27))}
    plan = index.unique_customers(window, branches)._jdf.queryExecution().executedPlan().toString()
    assert "day#" in plan.split("PartitionFilters: [")[1].split("]")[0]
