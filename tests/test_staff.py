from datetime import date
from decimal import Decimal

from lensmill.functions.windows import DateRange
from lensmill.plans import staff
from tests.conftest import money, rows, ts
from tests.test_branch import inv, item

MAY = DateRange(date(2020, 5, 1), date(2020, 5, 31))
AT = "2020-05-10 00:00:00"


def user(code, kind=2, inactive=0):
    return dict(IDENTIFIER=code, USER_TYPE=kind, INACTIVE=inactive)


def sold(id, patient=1, who="D1", **more):
    return inv(id, patient, AT, USER_ADDED=who, **({"STOCK_CHARGED": money("20"), "STOCK_PAID": money("5")} | more))


def by_staff(frame):
    return {(r.branch, r.staff): r for r in frame.collect()}


def test_rosters(make_clinic):
    clinic = make_clinic(
        users=[user("D1"), user("D1"), user("D2", 4), user("D3", 5, 1), user("D4", 5), user("O1", 1), user("", 1), user(None)]
    )
    assert rows(staff.active_dispensers(clinic, ["D4"])) == [("D1",), ("D2",)]
    assert rows(staff.active_optometrists(clinic)) == [("O1",)]


def test_sales_amounts_and_discount_rules(make_clinic):
    clinic = make_clinic(
        invoice=[
            sold(1, DISCOUNTID=106),
            sold(2, DISCOUNTID=None),
            sold(3, DISCOUNTID=71),
            sold(4, type=6, total="-10", DISCOUNTID=71),
            sold(5, who="D2", type=6, total="-10", DISCOUNTID=71),
        ],
        invoice_items=[
            item(1, 3, qty=1),
            item(2, 3, qty=2),
            item(3, 3, qty=4),
            item(3, 2, "0001", qty=8),
            item(3, 4, "GAP9", qty=16),
            item(3, 4, "NG12", qty=32),
            item(4, 4, None, qty=-64),
            item(5, 2, qty=-1),
        ],
    )
    got = by_staff(staff.staff_sales(clinic, MAY))
    d1 = got["B0", "D1"]
    assert (d1.fr_qty, d1.suns_qty, d1.own_fr, d1.lens_qty, d1.lens_ng) == (7, 4, 8, 32, 32)
    assert (d1.fr_amt, d1.suns_amt) == (Decimal("39.0000"), Decimal("32.0000"))
    # The balance of 15 counts per item by default, per invoice in the extra column.
    assert (d1.unpaid, d1.unpaid_per_invoice) == (Decimal("105.00"), Decimal("60.00"))
    off = by_staff(staff.staff_discounts(clinic, MAY))
    assert off["B0", "D1"].mgmt_d == 4 - 1 and off["B0", "D1"].match_d == 0
    assert ("B0", "D2") not in off  # returns only


def test_net_counts(make_clinic):
    clinic = make_clinic(
        invoice=[
            sold(1, 1),
            sold(2, 1),
            sold(3, None),
            sold(4, 2, type=6, total="-10"),
            sold(5, 3, who=None),
            sold(6, 4, who="D2", type=6, total="-1"),
            sold(7, 5, who="D3", DISCOUNTID=26),
        ],
        invoice_items=[item(i, 2, "0001") for i in range(1, 7)] + [item(1, 4), item(7, 1)],
    )
    got = by_staff(staff.staff_net_counts(clinic, MAY))
    assert tuple(got["B0", "D1"])[2:] == (1, 3 - 1, 1 - 1, 0)
    assert tuple(got["B0", None])[2:] == (1, 1, 1, 0)
    assert tuple(got["B0", "D3"])[2:] == (0, 0, 0, 1)
    assert ("B0", "D2") not in got


def test_order_roles_and_warranty(make_clinic):
    def order(id, **more):
        return dict(ID=id, ORDER_DATE=ts(AT), BRANCH_IDENTIFIER="B0", WARRANTY="", CANCELLED=0) | more

    clinic = make_clinic(
        spectacle_orders=[
            order(1, USER_ADDED="D1", STAFFFIT="D1", STAFFCHK="D2", STAFFPCK="D2", STAFFDEL=None, WARRANTY="P", CANCELLED=1),
            order(2, USER_ADDED="D1", STAFFFIT="D2", STAFFCHK="D2", STAFFPCK="D1", STAFFDEL="D1", WARRANTY="S"),
            order(3, USER_ADDED="D3", WARRANTY=None, CANCELLED=None),
        ]
    )
    stages = by_staff(staff.staff_order_stages(clinic, MAY))
    assert tuple(stages["B0", "D1"])[2:] == (1, 0, 1, 1)
    assert tuple(stages["B0", "D2"])[2:] == (1, 2, 1, 0)
    assert tuple(stages["B0", None])[2:] == (1, 1, 1, 2)
    assert rows(staff.staff_warranty_cancel(clinic, MAY)) == [("B0", "D1", 1, 2, 1)]


def test_clock_and_priced(make_clinic):
    clock = [dict(TIMESTMP=ts(f"2020-05-{d} 08:00:00"), BRANCH_IDENTIFIER="B0", USER_ADDED="D1") for d in ("01", "01", "02")]
    arrivals = [dict(ID=i, ARRIVAL_DATE=ts(AT), BRANCH_IDENTIFIER="B0", USER_ADDED="D1") for i in (1, 2, None)]
    clinic = make_clinic(clockinout=clock, stock_arrival=arrivals)
    assert rows(staff.staff_clock_days(clinic, MAY)) == [("B0", "D1", 3, 2)]
    assert rows(staff.staff_priced(clinic, MAY)) == [("B0", "D1", 2)]


def test_dispenser_scorecard(make_clinic, branches):
    clinic = make_clinic(
        users=[user("D1"), user("D2"), user("D3"), user("D4", inactive=1), user("D5")],
        invoice=[
            sold(1, 1),
            sold(2, 1, who="D2", type=6, total="-1"),
            sold(3, 1, who="D4"),
            sold(4, 1, where="B9"),
            sold(5, 1, who="D5", STOCK_CHARGED=None),
        ],
        invoice_items=[item(1, 2), item(3, 2), item(4, 2), item(5, 1), item(2, 1, qty=0)],
        stock_arrival=[dict(ID=1, ARRIVAL_DATE=ts(AT), BRANCH_IDENTIFIER="B1", USER_ADDED="D1")],
    )
    got = {(r.branch, r.dispenser): r for r in staff.dispenser_scorecard(clinic, MAY, branches).collect()}
    # D3 has nothing, D4 is inactive, B9 is unknown; D2 has an unpaid balance only, D5 an unknown one.
    assert set(got) == {("B0", "D1"), ("B1", "D1"), ("B0", "D2"), ("B0", "D5")}
    assert got["B0", "D1"].sale == 1 and got["B1", "D1"].sale == 0 and got["B1", "D1"].priced == 1
    assert got["B0", "D5"].unpaid is None and got["B0", "D5"].fr_qty == 0
    assert len(staff.DISPENSER_COLUMNS) == 25


def test_optometrist_scorecard(make_clinic):
    at = ts(AT)
    clinic = make_clinic(
        users=[user("O1", 1), user("O2", 1), user("O3", 1, 1)],
        invoice=[
            inv(1, 1, AT, USER_IDENTIFIER="O1", ORDER_TYPE=1),
            inv(2, 2, AT, USER_IDENTIFIER="O1", type=6, total="-1", ORDER_TYPE=1),
            inv(3, 3, AT, USER_IDENTIFIER="O1", type=9, total="0", ORDER_TYPE=0),
        ],
        invoice_items=[item(1, 5), item(2, 5), item(3, 1, "10900", qty=3), item(3, 1, "10910", qty=5)],
        appointment=[dict(ID=1, STARTDATE=at, RESID="O1", APPOINTMENT_TYPE="LT", APP_PROGRESS=5)],
        examination=[dict(ID=i, PATIENT_ID=7, EXAM_DATE=at, USER_IDENTIFIER="O1") for i in (1, 2)],
        clockinout=[dict(TIMESTMP=at, USER_ADDED="O1")],
        patient_letters=[dict(ID=1, DATE_ADDED=at, USER_ADDED="O1", LETTER_DESCRIPTION=t) for t in ("AMD", "amd", "Cat")],
    )
    o1, o2 = staff.optometrist_scorecard(clinic, MAY).orderBy("optometrist").collect()
    assert (o1.cl_cx, o1.cl_amt, o1.cons_amt, o1.item_910_11) == (0, Decimal("8.0000"), Decimal("38.0000"), 3)
    assert (o1.cl_appt, o1.lt_appt, o1.upx, o1.ex, o1.w_days, o1.amd, o1.cat, o1.lasik) == (0, 1, 1, 2, 1, 1, 1, 0)
    assert o2.optometrist == "O2" and set(o2[1:]) == {0}
    wider = staff.BILLED_ITEMS | {"item_910_11": ("10910", "10911")}
    assert staff.optometrist_scorecard(clinic, MAY, items=wider).orderBy("optometrist").first().item_910_11 == 5
