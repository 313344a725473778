from datetime import date

from lensmill.functions.windows import DateRange
from lensmill.plans import branch
from tests.conftest import money, rows, ts

MAY = DateRange(date(2020, 5, 1), date(2020, 5, 31))


def inv(id, patient, when, where="B0", type=2, total="10", **more):
    return dict(
        ID=id, PATIENTID=patient, SALE_DATE=ts(when), BRANCH_IDENTIFIER=where, TYPE=type, DESPENSE_TOTAL=money(total), **more
    )


def item(invoice, stock=2, barcode="X", qty=1):
    return dict(
        INVOICEID=invoice, STOCK_TYPE=stock, ITEM_BARCODE=barcode, QTY=qty, UNITPRICE=money("5"), DISCOUNT_AMOUNT=money("1")
    )


def appt(id, patient, when, where="B0", kind="SC", progress=5):
    return dict(
        ID=id, PATIENTID=patient, STARTDATE=ts(when), BRANCH_IDENTIFIER=where, APPOINTMENT_TYPE=kind, APP_PROGRESS=progress
    )


def lens(id, when, rx, where="B0", **more):
    base = dict(CANCELLED=0, TRIAL=0, WARRANTY="", PATIENTID=id)
    return base | dict(ID=id, ORDER_DATE=ts(when), RX_REFERENCE=rx, BRANCH_IDENTIFIER=where) | more


def test_trial_followup(make_clinic):
    def trial(id, patient, collected, **more):
        base = dict(USER_ADDED="D1", BRANCH_IDENTIFIER="B0", TRIAL_ONLY=1)
        return base | dict(ID=id, PATIENTID=patient, COLLECTED_DATE=ts(collected)) | more

    clinic = make_clinic(
        patient=[dict(ID=1), dict(ID=2)],
        contact_lens_orders=[
            trial(1, 1, "2020-05-01 00:00:00", BRANCH_IDENTIFIER="B1"),
            trial(2, 2, "2020-05-31 23:59:59", USER_ADDED=None),
            trial(3, 2, "2020-05-31 23:59:59.5"),
            trial(4, 1, "2020-05-10 10:00:00", TRIAL_ONLY=0),
            trial(5, 1, "2020-05-10 10:00:00", FOLLOWED_UP_DATE=ts("2020-05-11 00:00:00")),
            trial(6, 3, "2020-05-10 10:00:00"),
            trial(7, None, "2020-05-10 10:00:00"),
        ],
    )
    got = branch.trial_followup(clinic, MAY).collect()
    assert [tuple(r) for r in got] == [(None, 2, "B0"), ("D1", 1, "B1")]


def test_script_window_edges(make_clinic, branches):
    clinic = make_clinic(
        contact_lens_orders=[
            lens(1, "2020-05-31 10:00:00", 1),  # three months back clamps to 29 February
            lens(2, "2020-05-31 10:00:00", 2),
            lens(3, "2020-05-10 10:00:00", 3),  # script later than the order
            lens(4, "2020-05-10 10:00:00", 4, CANCELLED=1),
            lens(5, "2020-05-10 10:00:00", 4, TRIAL=1),
            lens(6, "2020-05-10 10:00:00", 4, WARRANTY="P"),
            lens(7, "2020-05-10 10:00:00", 4, WARRANTY=None),
            lens(8, "2020-05-10 10:00:00", 4),
            lens(9, "2020-05-10 10:00:00", 4, where="ELSEWHERE"),
            lens(10, "2020-05-10 10:00:00", None),
        ],
        contact_rx=[
            dict(ID=1, DATE_ADDED=ts("2020-02-29 10:00:00")),
            dict(ID=2, DATE_ADDED=ts("2020-02-29 09:59:59")),
            dict(ID=3, DATE_ADDED=ts("2020-05-11 00:00:00")),
            dict(ID=4, DATE_ADDED=ts("2020-05-10 10:00:00")),
        ],
        appointment=[appt(1, 5, "2020-05-02 09:00:00", "B1", "CL"), appt(2, 5, "2020-05-03 09:00:00", "B1", "CLV")],
    )
    assert rows(branch.cl_orders_vs_exams(clinic, MAY, branches)) == [("B0", 2, 0), ("B1", 0, 1)]
    assert rows(branch.cl_orders_vs_exams(clinic, MAY, branches, script_months=4)) == [("B0", 3, 0), ("B1", 0, 1)]
    assert rows(branch.cl_orders_vs_exams(clinic, MAY, branches, strict_reference=True)) == [("B0", 2, 0), ("B1", 0, 0)]


def test_glasses_customers(make_clinic, branches):
    clinic = make_clinic(
        invoice=[
            inv(1, 1, "2020-05-01 00:00:00"),
            inv(2, 1, "2020-05-02 00:00:00"),
            inv(3, 2, "2020-05-03 00:00:00"),
            inv(4, 2, "2020-05-04 00:00:00", type=6, total="-10"),
            inv(5, 3, "2020-05-04 00:00:00", type=6, total="-10", where="B1"),
            inv(6, 4, "2020-05-04 00:00:00", total="0"),
            inv(7, None, "2020-05-04 00:00:00"),
            inv(8, 5, "2020-05-31 23:59:59.5"),
        ],
        invoice_items=[item(i, 4) for i in range(1, 9)] + [item(1, 2), item(99, 2)],
        appointment=[
            appt(1, 1, "2020-05-02 09:00:00", "B1", "CD"),
            appt(2, None, "2020-05-02 09:00:00", "B0", "CD"),
            appt(3, 1, "2020-05-02 09:00:00", "B0", "CD", progress=1),
        ],
    )
    assert rows(branch.glasses_customers_vs_exams(clinic, MAY, branches)) == [("B0", 1, 0), ("B1", 0, 1)]
    strict = branch.glasses_customers_vs_exams(clinic, MAY, branches, strict_reference=True)
    assert rows(strict) == [("B0", 1, 0), ("B1", 0, 0)]


def test_unique_customers(make_clinic, branches):
    clinic = make_clinic(
        patient=[dict(ID=i, BRANCH_IDENTIFIER="B0" if i < 5 else "B9") for i in range(1, 7)],
        invoice=[
            inv(1, 1, "2020-05-10 00:00:00", where="B1"),  # counted at the home branch
            inv(2, 1, "2020-05-12 00:00:00"),
            inv(3, 2, "2020-05-10 00:00:00"),
            inv(4, 2, "2019-07-01 00:00:00"),  # earlier this fiscal year
            inv(5, 3, "2020-05-10 00:00:00"),
            inv(6, 3, "2019-06-30 23:59:59"),  # last fiscal year
            inv(7, 4, "2020-05-01 00:00:00"),  # first midnight of the window
            inv(8, 5, "2020-05-10 00:00:00"),  # branch outside the roster
            inv(9, None, "2020-05-10 00:00:00"),
            inv(10, 77, "2020-05-10 00:00:00"),  # unknown patient
        ],
    )
    assert rows(branch.unique_customers_fy(clinic, MAY, branches)) == [("B0", 2), ("B1", 0)]
    assert rows(branch.unique_customers_fy(clinic, MAY, branches, exclusive=True)) == [("B0", 3), ("B1", 0)]


def test_utilisation(make_clinic, branches):
    at = ts("2020-05-10 00:00:00")
    clinic = make_clinic(
        invoice=[inv(1, 1, "2020-05-10 00:00:00"), inv(2, 1, "2020-05-10 00:00:00"), inv(3, None, "2020-05-10 00:00:00")],
        spectacle_orders=[dict(ID=1, PATIENTID=1, COLLECTED_DATE=at, BRANCH_IDENTIFIER="B0", DELIVERY_BRANCH="B1"), dict(ID=2, PATIENTID=1, DELIVERY_BRANCH="B1")],
        contact_lens_orders=[dict(ID=1, PATIENTID=1, COLLECTED_DATE=at, BRANCH_IDENTIFIER="B0"), dict(ID=2, PATIENTID=1, COLLECTED_DATE=at, BRANCH_IDENTIFIER=None)],
    )
    assert rows(branch.utilisation(clinic, MAY, branches)) == [("B0", 3), ("B1", 1)]


def test_masterdata(make_clinic, branches):
    clinic = make_clinic(
        appointment=[
            appt(1, 1, "2020-05-02 09:00:00", kind="SC"),
            appt(2, 1, "2020-05-03 09:00:00", kind="CL"),
            appt(3, 2, "2020-05-03 09:00:00", kind="AL"),
            appt(4, 3, "2020-05-03 09:00:00", kind="LUN"),
            appt(5, 4, "2020-05-03 09:00:00", kind=None),
            appt(6, None, "2020-05-03 09:00:00", kind="CL"),
        ],
        invoice=[
            inv(1, 1, "2020-05-10 00:00:00"),
            inv(2, 2, "2020-05-10 00:00:00", total="0"),
            inv(3, 3, "2020-05-10 00:00:00", type=6, total="-5"),
            inv(4, 4, "2020-05-10 00:00:00", where="B9"),
        ],
        invoice_items=[item(1, 2), item(1, 5), item(2, 1, "OCT"), item(2, 4), item(3, 2, "OCT"), item(1, 1, "LTPRO")],
        contact_lens_orders=[lens(1, "2020-05-10 10:00:00", 1)],
        contact_rx=[dict(ID=1, DATE_ADDED=ts("2020-01-10 10:00:00"))],
    )
    b0, b1 = branch.branch_masterdata(clinic, MAY, branches).orderBy("branch").collect()
    assert b0.asDict() == dict(
        branch="B0", appt_px_all=2, gls_appt_no=1, cl_appt_no=1, cx_all=1, gl_cx_no=1, cl_cx_no=1, cl_cx_per_rx=1,
        total_appt_no=4, oct_no=1, cl_new_fit=1, cl_refit=1, unique_cx=3,
    )
    assert set(b1[1:]) == {0} and b1.branch == "B1"
    assert branch.branch_masterdata(clinic, MAY, branches, script_months=3).orderBy("branch").first().cl_cx_per_rx == 0
