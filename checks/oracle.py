"""The registered queries written again as plain SQL, one sub-query per metric, for comparison."""

from __future__ import annotations

from checks import inputs as I
from lensmill.functions.windows import DateRange
from lensmill.plans.codes import GLASSES_TYPES, LENS_TEACH_TYPES, LENS_TYPES
from checks.adapter import view_sql

VIEWS = view_sql()
DIMENSIONS = {
    "branches": I.BRANCHES,
    "appt_budget": I.APPT_BUDGET,
    "appointment_info": I.APPOINTMENT_INFO,
    "claim_lines": I.derived_sql(I.CLAIM_LINES),
    "report_lines": I.derived_sql(I.REPORT_LINES),
    "report_names": I.derived_sql(I.REPORT_NAMES),
    "coded_names": I.derived_sql(I.CODED_NAMES),
    "coded_branches": I.CODED_BRANCHES,
    "responses": I.derived_sql(I.RESPONSES),
    "reordered": I.derived_sql(I.REORDERED),
}
SOURCES = VIEWS | DIMENSIONS


def with_sources(body: str, names: str, extra: dict[str, str] | None = None) -> str:
    parts = [f"{n} as ({SOURCES[n]})" for n in names.split()]
    parts += [f"{n} as ({q})" for n, q in (extra or {}).items()]
    return f"with {', '.join(parts)} {body}"


def in_window(column: str, w: DateRange) -> str:
    return f"{column} between timestamp '{w.first} 00:00:00' and timestamp '{w.last} 23:59:59'"


LINES = "invoice i join invoice_items ii on ii.INVOICEID = i.ID"
AMOUNT = "sum(ii.QTY * ii.UNITPRICE - ii.DISCOUNT_AMOUNT)"


def metric(keys: str, name: str, value: str, source: str, where: str) -> str:
    """One metric in long form; ``keys`` lists the key expressions."""
    return (
        f"select {keys}, '{name}' as m, cast({value} as decimal(38,4)) as v from {source} where {where} group by all"
    )


def net(keys: list[str], name: str, value: str, source: str, sale: str, ret: str) -> str:
    """Sales less returns, only for keys with sales."""
    cols = ", ".join(f"{k} as k{i}" for i, k in enumerate(keys))
    side = f"(select {cols}, {value} as x from {source} where {{}} group by all)"
    on = " and ".join(f"a.k{i} = b.k{i}" for i in range(len(keys)))
    out = ", ".join(f"a.k{i}" for i in range(len(keys)))
    return (
        f"select {out}, '{name}' as m, cast(coalesce(a.x, 0) - coalesce(b.x, 0) as decimal(38,4)) as v"
        f" from {side.format(sale)} a left join {side.format(ret)} b on {on}"
    )


def wide(columns: dict[str, str], keys: list[str]) -> str:
    """Long metrics ``long(k.., m, v)`` to columns: no row is 0, a null value stays null."""
    picks = ", ".join(
        f"cast(case when count(case when m = '{c}' then 1 end) = 0 then 0 else max(case when m = '{c}' then v end) end as {t})"
        f" as {c}"
        for c, t in columns.items()
    )
    return f"select {', '.join(keys)}, {picks} from long group by {', '.join(keys)}"


def named(parts: list[str], keys: list[str]) -> str:
    cols = ", ".join([*keys, "m", "v"])
    return " union all ".join(f"select * from ({p}) as q({cols})" for p in parts)


MONEY, COUNT = "decimal(38,4)", "bigint"

# ---- branch reports


def _scripted(w: DateRange, months: int) -> str:
    return (
        f"{in_window('co.ORDER_DATE', w)} and co.CANCELLED = 0 and co.TRIAL = 0 and co.WARRANTY = ''"
        " and exists (select 1 from contact_rx cr where cr.ID = co.RX_REFERENCE and cr.DATE_ADDED"
        f" between co.ORDER_DATE - interval '{months}' month and co.ORDER_DATE)"
    )


def trial_followup(w: DateRange) -> str:
    body = (
        "select co.USER_ADDED, p.ID, co.BRANCH_IDENTIFIER from contact_lens_orders co, patient p"
        f" where co.TRIAL_ONLY = 1 and p.ID = co.PATIENTID and co.FOLLOWED_UP_DATE is null and {in_window('co.COLLECTED_DATE', w)}"
    )
    return with_sources(body, "contact_lens_orders patient")


def cl_orders_vs_exams(w: DateRange, visits: DateRange) -> str:
    body = f"""
select b.code as branch, coalesce(o.n, 0) as cl_cx, coalesce(e.n, 0) as cl_ex from branches b
left join (select BRANCH_IDENTIFIER k, count(co.ID) n from contact_lens_orders co where {_scripted(w, 3)} group by 1) o on o.k = b.code
left join (select BRANCH_IDENTIFIER k, count(distinct PATIENTID) n from appointment
 where {in_window('STARTDATE', visits)} and APPOINTMENT_TYPE in ({LENS_TYPES}) and APP_PROGRESS = 5 group by 1) e on e.k = b.code"""
    return with_sources(body, "contact_lens_orders contact_rx appointment branches")


def glasses_customers_vs_exams(w: DateRange, visits: DateRange) -> str:
    base = f"{LINES} where {in_window('SALE_DATE', w)} and STOCK_TYPE in (2,3,4)"
    body = f"""
select b.code as branch, case when s.k is null then 0 else s.n - coalesce(r.n, 0) end as gl_cx, coalesce(e.n, 0) as gl_ex from branches b
left join (select BRANCH_IDENTIFIER k, count(distinct PATIENTID) n from {base} and TYPE = 2 and DESPENSE_TOTAL > 0 group by 1) s on s.k = b.code
left join (select BRANCH_IDENTIFIER k, count(distinct PATIENTID) n from {base} and TYPE = 6 and DESPENSE_TOTAL < 0 group by 1) r on r.k = b.code
left join (select BRANCH_IDENTIFIER k, count(distinct PATIENTID) n from appointment
 where {in_window('STARTDATE', visits)} and APPOINTMENT_TYPE in ({GLASSES_TYPES}) and APP_PROGRESS = 5 group by 1) e on e.k = b.code"""
    return with_sources(body, "invoice invoice_items appointment branches")


def unique_customers_fy(w: DateRange, fy_start: str) -> str:
    body = f"""
select b.code as branch, count(n.PATIENTID) as unique_cx from branches b left join (
 select distinct i.PATIENTID, p.BRANCH_IDENTIFIER from invoice i, patient p where {in_window('i.SALE_DATE', w)} and i.PATIENTID = p.ID
 and i.PATIENTID not in (select PATIENTID from invoice where SALE_DATE between timestamp '{fy_start} 00:00:00' and timestamp '{w.first} 00:00:00')
) n on n.BRANCH_IDENTIFIER = b.code group by b.code"""
    return with_sources(body, "invoice patient branches")


def utilisation(w: DateRange) -> str:
    body = f"""
select b.code as branch, cast(coalesce(sum(u.n), 0) as bigint) as utilisation from branches b left join (
 select BRANCH_IDENTIFIER k, count(PATIENTID) n from invoice where {in_window('SALE_DATE', w)} group by 1
 union all select DELIVERY_BRANCH, count(PATIENTID) from spectacle_orders where {in_window('COLLECTED_DATE', w)} group by 1
 union all select BRANCH_IDENTIFIER, count(PATIENTID) from contact_lens_orders where {in_window('COLLECTED_DATE', w)} group by 1
) u on u.k = b.code group by b.code"""
    return with_sources(body, "invoice spectacle_orders contact_lens_orders branches")


def branch_masterdata(sales: DateRange, visits: DateRange) -> str:
    k, who = "BRANCH_IDENTIFIER", "count(distinct PATIENTID)"
    done = f"{in_window('STARTDATE', visits)} and APP_PROGRESS = 5"
    sold = f"{in_window('SALE_DATE', sales)}"
    real = f"{done} and APPOINTMENT_TYPE not in ('BRK','LUN','REP','SP')"
    paid = f"{sold} and DESPENSE_TOTAL > 0 and TYPE = 2"
    parts = [
        metric(k, "appt_px_all", who, "appointment", real),
        metric(k, "gls_appt_no", who, "appointment", f"{done} and APPOINTMENT_TYPE in ({GLASSES_TYPES})"),
        metric(k, "cl_appt_no", who, "appointment", f"{done} and APPOINTMENT_TYPE in ({LENS_TYPES})"),
        metric(k, "cx_all", who, "invoice", paid),
        metric(k, "gl_cx_no", who, LINES, f"{paid} and STOCK_TYPE in (2,3,4)"),
        metric(k, "cl_cx_no", who, LINES, f"{paid} and STOCK_TYPE in (5)"),
        metric(k, "cl_cx_per_rx", who, "contact_lens_orders co", _scripted(sales, 4)),
        metric(k, "total_appt_no", "count(ID)", "appointment", real),
        metric(k, "oct_no", who, LINES, f"{sold} and TYPE = 2 and ITEM_BARCODE = 'OCT'"),
        metric(k, "cl_new_fit", who, LINES, f"{sold} and TYPE = 2 and ITEM_BARCODE = 'LTPRO'"),
        metric(k, "cl_refit", who, "appointment", f"{done} and APPOINTMENT_TYPE in ('AL','SL')"),
        metric(k, "unique_cx", who, "invoice", sold),
    ]
    columns = {p.split("'")[1]: COUNT for p in parts}
    picks = ", ".join(
        f"cast(coalesce(max(case when m = '{c}' then v end), 0) as bigint) as {c}" for c in columns
    )
    body = f"select b.code as branch, {picks} from branches b left join long l on l.branch = b.code group by b.code"
    return with_sources(
        body, "invoice invoice_items appointment contact_lens_orders contact_rx branches", {"long": named(parts, ["branch"])}
    )


# ---- staff reports


def _dispenser_parts(sales: DateRange, clock: DateRange) -> dict[str, tuple[str, str]]:
    """metric -> (type, long-form SQL) per branch and dispenser."""
    keys = ["BRANCH_IDENTIFIER", "USER_ADDED"]
    k = ", ".join(keys)
    sold, ordered = in_window("SALE_DATE", sales), in_window("ORDER_DATE", sales)

    def line(name, value, where):
        return metric(k, name, value, LINES, f"{sold} and {where}")

    def net_line(name, value, where):
        return net(keys, name, value, LINES, f"{sold} and {where} and TYPE = 2", f"{sold} and {where} and TYPE = 6")

    def order(name, where, who="USER_ADDED"):
        return metric(f"BRANCH_IDENTIFIER, {who}", name, "count(ID)", "spectacle_orders", f"{ordered} and {where}")

    px, off = "count(distinct PATIENTID)", "sum(DISCOUNT_AMOUNT)"
    return {
        "cust": (COUNT, line("cust", px, "STOCK_TYPE in (2,3,4) and TYPE = 2 and DESPENSE_TOTAL > 0")),
        "sale": (COUNT, net_line("sale", "count(distinct i.ID)", "STOCK_TYPE in (2,3,4)")),
        "fr_qty": (
            COUNT,
            line("fr_qty", "sum(QTY)", "STOCK_TYPE in (2,3) and TYPE = 2 and DESPENSE_TOTAL > 0 and ITEM_BARCODE <> '0001'"),
        ),
        "fr_amt": (MONEY, line("fr_amt", AMOUNT, "STOCK_TYPE = 2 and TYPE in (2,6)")),
        "lens_qty": (COUNT, line("lens_qty", "sum(QTY)", "STOCK_TYPE = 4 and TYPE in (2,6) and left(ITEM_BARCODE,3) <> 'GAP'")),
        "lens_amt": (MONEY, line("lens_amt", AMOUNT, "STOCK_TYPE = 4 and TYPE in (2,6)")),
        "suns_qty": (COUNT, line("suns_qty", "sum(QTY)", "STOCK_TYPE = 3 and TYPE in (2,6) and DISCOUNTID <> 106")),
        "suns_amt": (MONEY, line("suns_amt", AMOUNT, "STOCK_TYPE = 3 and TYPE in (2,6)")),
        "own_fr": (COUNT, line("own_fr", "sum(QTY)", "ITEM_BARCODE = '0001' and TYPE in (2,6)")),
        "own_fr_cx": (COUNT, net_line("own_fr_cx", px, "ITEM_BARCODE = '0001'")),
        "lens_ng": (COUNT, line("lens_ng", "sum(QTY)", "left(ITEM_BARCODE,2) = 'NG' and TYPE in (2,6)")),
        "mgmt_d": (MONEY, net_line("mgmt_d", off, "DISCOUNTID = 71")),
        "match_d": (MONEY, net_line("match_d", off, "DISCOUNTID in (77,89)")),
        "total_d": (MONEY, net_line("total_d", off, "STOCK_TYPE in (2,3,4)")),
        "unpaid": ("decimal(38,2)", line("unpaid", "sum(STOCK_CHARGED - STOCK_PAID)", "TYPE in (2,6)")),
        "remake": (COUNT, order("remake", "WARRANTY = 'P'")),
        "w_days": (COUNT, metric(k, "w_days", "count(TIMESTMP)", "clockinout", in_window("TIMESTMP", clock))),
        "wrty": (COUNT, order("wrty", "WARRANTY in ('S','P')")),
        "cncl": (COUNT, order("cncl", "CANCELLED = 1")),
        "px_2pr": (COUNT, line("px_2pr", px, "TYPE = 2 and DISCOUNTID in (26,74,75,97,105)")),
        "fit": (COUNT, order("fit", "true", "STAFFFIT")),
        "check": (COUNT, order("check", "true", "STAFFCHK")),
        "pack": (COUNT, order("pack", "true", "STAFFPCK")),
        "deliv": (COUNT, order("deliv", "true", "STAFFDEL")),
        "priced": (COUNT, metric(k, "priced", "count(ID)", "stock_arrival", in_window("ARRIVAL_DATE", sales))),
    }


DISPENSER_SOURCES = "invoice invoice_items spectacle_orders clockinout stock_arrival users branches"


def dispenser_scorecard(sales: DateRange, clock: DateRange) -> str:
    parts = _dispenser_parts(sales, clock)
    types = {name: t for name, (t, _) in parts.items()}
    table = wide(types, ["branch", "staff"])
    some = " or ".join(f"coalesce({c}, 1) <> 0" for c in map(_quoted, types))
    body = f"""
select branch, staff as dispenser, {', '.join(map(_quoted, types))} from ({table}) t
where ({some}) and branch in (select code from branches)
and staff in (select IDENTIFIER from users where USER_TYPE in (2,4,5) and INACTIVE = 0)"""
    return with_sources(body, DISPENSER_SOURCES, {"long": named([q for _, q in parts.values()], ["branch", "staff"])})


def _quoted(name: str) -> str:
    return f'"{name}"'


def _group(parts: dict[str, tuple[str, str]], names: str, keys: list[str], sources: str) -> str:
    chosen = {n: parts[n] for n in names.split()}
    types = {n: t for n, (t, _) in chosen.items()}
    long = named([q for _, q in chosen.values()], keys)
    return with_sources(wide(types, keys), sources, {"long": long})


def dispenser_group(names: str, sales: DateRange, clock: DateRange) -> str:
    parts = _dispenser_parts(sales, clock)
    k = "BRANCH_IDENTIFIER, USER_ADDED"
    once = f"(select distinct i.* from {LINES} where {in_window('SALE_DATE', sales)} and TYPE in (2,6)) x"
    parts["unpaid_per_invoice"] = (
        "decimal(38,2)",
        metric(k, "unpaid_per_invoice", "sum(STOCK_CHARGED - STOCK_PAID)", once, "true"),
    )
    parts["w_days_distinct"] = (
        COUNT,
        metric(k, "w_days_distinct", "count(distinct cast(TIMESTMP as date))", "clockinout", in_window("TIMESTMP", clock)),
    )
    return _group(parts, names, ["branch", "staff"], DISPENSER_SOURCES)


def _optometrist_parts(sales: DateRange, events: DateRange) -> dict[str, tuple[str, str]]:
    k = "USER_IDENTIFIER"
    sold, done = in_window("SALE_DATE", sales), f"{in_window('STARTDATE', events)} and APP_PROGRESS = 5"

    def line(name, value, where):
        return metric(k, name, value, LINES, f"{sold} and {where}")

    def letters(name, kinds):
        where = f"{in_window('DATE_ADDED', events)} and LETTER_DESCRIPTION in ({kinds})"
        return COUNT, metric("USER_ADDED", name, "count(ID)", "patient_letters", where)

    px, cl = "count(distinct PATIENTID)", "STOCK_TYPE in (5)"
    exam = in_window("EXAM_DATE", events)
    return {
        "cl_cx": (COUNT, net([k], "cl_cx", px, LINES, f"{sold} and TYPE = 2 and {cl}", f"{sold} and TYPE = 6 and {cl}")),
        "cl_amt": (MONEY, line("cl_amt", AMOUNT, f"{cl} and TYPE in (2,6)")),
        "cl_appt": (
            COUNT,
            metric("RESID", "cl_appt", "count(ID)", "appointment", f"{done} and APPOINTMENT_TYPE in ({LENS_TYPES})"),
        ),
        "lt_appt": (
            COUNT,
            metric("RESID", "lt_appt", "count(ID)", "appointment", f"{done} and APPOINTMENT_TYPE in ({LENS_TEACH_TYPES})"),
        ),
        "lens_qty": (COUNT, line("lens_qty", "sum(QTY)", "STOCK_TYPE = 4 and TYPE in (2,6) and left(ITEM_BARCODE,3) <> 'GAP'")),
        "lens_amt": (MONEY, line("lens_amt", AMOUNT, "STOCK_TYPE = 4 and TYPE in (2,6)")),
        "upx": (COUNT, metric(k, "upx", "count(distinct PATIENT_ID)", "examination", exam)),
        "ex": (COUNT, metric(k, "ex", "count(ID)", "examination", exam)),
        "cons_amt": (MONEY, line("cons_amt", AMOUNT, "DESPENSE_TOTAL = 0 and ORDER_TYPE = 0")),
        "w_days": (COUNT, metric("USER_ADDED", "w_days", "count(TIMESTMP)", "clockinout", in_window("TIMESTMP", events))),
        "item_910_11": (COUNT, line("item_910_11", "sum(QTY)", "ITEM_BARCODE in ('10900','10911')")),
        "item_912_14": (COUNT, line("item_912_14", "sum(QTY)", "ITEM_BARCODE in ('10912','10913','10914')")),
        "item_916_18": (COUNT, line("item_916_18", "sum(QTY)", "ITEM_BARCODE in ('10916','10918')")),
        "item_940_41": (COUNT, line("item_940_41", "sum(QTY)", "ITEM_BARCODE in ('10940','10941')")),
        "tmpl": letters("tmpl", "'Treatment Plan','CL Treatment Plan'"),
        "amd": letters("amd", "'Checklist - AMD Referral','AMD','Amd'"),
        "cat": letters("cat", "'Checklist - Cataract Referral','CAT','Cat'"),
        "lasik": letters("lasik", "'Checklist - Lasik','LASIK','Lasik'"),
    }


OPTOMETRIST_SOURCES = "invoice invoice_items appointment examination clockinout patient_letters users"


def optometrist_group(names: str, sales: DateRange, events: DateRange) -> str:
    return _group(_optometrist_parts(sales, events), names, ["staff"], OPTOMETRIST_SOURCES)


def optometrist_scorecard(sales: DateRange, events: DateRange) -> str:
    parts = _optometrist_parts(sales, events)
    types = {name: t for name, (t, _) in parts.items()}
    picks = ", ".join(f"case when w.staff is null then 0 else w.{c} end as {c}" for c in types)
    body = f"""
select u.IDENTIFIER as optometrist, {picks} from (select distinct IDENTIFIER from users where USER_TYPE = 1 and INACTIVE = 0 and IDENTIFIER <> '') u
left join ({wide(types, ['staff'])}) w on w.staff = u.IDENTIFIER"""
    return with_sources(body, OPTOMETRIST_SOURCES, {"long": named([q for _, q in parts.values()], ["staff"])})


def _roster(types: str, excluded: str) -> str:
    return with_sources(
        f"select distinct IDENTIFIER as staff from users where USER_TYPE in ({types}) and INACTIVE = 0 and IDENTIFIER not in ({excluded})",
        "users",
    )


# ---- capacity

_CELLS = f"""
select b.branch, d.day, coalesce(v.volume, 0) as volume, coalesce(v.minutes, 0) as minutes, coalesce(o.n, 0) as optometrists
from (select code as branch from branches) b
cross join (select cast(x as date) as day from generate_series(timestamp '{I.AHEAD.first}', timestamp '{I.AHEAD.last}', interval '1' day) g(x) where dayofweek(x) <> 0) d
left join (select BRANCH_IDENTIFIER k, cast(STARTDATE as date) dd, count(ID) volume, sum(date_diff('minute', STARTDATE, ENDDATE)) as minutes
 from appt where APPOINTMENT_TYPE not in ('SP','LUN','BRK') group by 1, 2) v on v.k = b.branch and v.dd = d.day
left join (select a.BRANCH_IDENTIFIER k, cast(a.STARTDATE as date) dd, count(distinct a.RESID) n from appt a
 where exists (select 1 from appt x where x.RESID = a.RESID and cast(x.STARTDATE as date) = cast(a.STARTDATE as date) and x.APPOINTMENT_TYPE not in ('SP','LUN','BRK'))
 group by 1, 2) o on o.k = b.branch and o.dd = d.day
"""
_CAPACITY = {
    "appt": f"select * from appointment where {in_window('STARTDATE', I.AHEAD)}"
    " and STARTDATE <= cast(cast(STARTDATE as date) as timestamp) + interval '86399' second",
    "own": _CELLS,
    "cells": "select * from own union all select 'TOTAL', day, sum(volume), sum(minutes), sum(optometrists) from own group by day",
    "fte_budget": "select code as branch, cast(fte_100 as double) as budget_100, cast(fte_85 as double) as budget_85 from branches"
    " union all select 'TOTAL', cast(sum(fte_100) as double), cast(sum(fte_85) as double) from branches",
    "day_budget": "select branch, fiscal_month, cast(per_day as double) as per_day from appt_budget"
    " union all select 'TOTAL', fiscal_month, cast(sum(per_day) as double) from appt_budget group by fiscal_month",
    "sheet": """
select c.branch, c.day, cast(c.volume as bigint) as volume, cast(c.minutes as double) / 465.0::double as fte, f.budget_100, f.budget_85,
 cast(c.minutes as double) / 465.0::double / f.budget_85 as fte_vs_budget, cast(c.optometrists as bigint) as optometrists,
 case when c.optometrists <> 0 then cast(c.minutes as double) / 465.0::double / cast(c.optometrists as double)
  when c.branch = 'TOTAL' then null else 0.0::double end as fte_actual,
 cast(c.volume as double) / d.per_day as volume_vs_budget
from cells c left join fte_budget f on f.branch = c.branch
left join day_budget d on d.branch = c.branch and d.fiscal_month = (month(c.day) + 5) % 12""",
}


def capacity(columns: str) -> str:
    return with_sources(f"select branch, day, {columns} from sheet", "appointment branches appt_budget", _CAPACITY)


def capacity_report() -> str:
    sections = ["volume", "fte", "fte_vs_budget", "optometrists", "fte_actual", "volume_vs_budget"]
    body = " union all ".join(f"select '{s}' as section, branch, day, cast({s} as double) as value from sheet" for s in sections)
    return with_sources(body, "appointment branches appt_budget", _CAPACITY)


# ---- mail

_PERSON = "p.TITLE, p.GIVEN, p.SURNAME, p.EMAIL, p.NOEMAIL, p.BIRTHDATE"
_VISIT = (
    "a.ID, a.APPOINTMENT_TYPE, a.STARTDATE, a.BRANCH_IDENTIFIER as BRANCH, p.ID as PID,"
    " sha256(cast(p.ID as varchar)) as GENID"
)


def _reachable(as_of) -> str:
    return (
        f"p.EMAIL <> '' and p.NOEMAIL = false and date_sub('year', p.BIRTHDATE, date '{as_of}') > 17"
    )


def audience_feedback() -> str:
    day = DateRange(I.EVENTS_AS_OF, I.EVENTS_AS_OF)
    body = f"""
select {_VISIT}, {_PERSON} from appointment a, patient p where {in_window('a.STARTDATE', day)} and a.APP_PROGRESS = 5 and p.ID = a.PATIENTID
and p.ID not in (select i.PATIENTID from invoice i where {in_window('i.SALE_DATE', I.MONTH)} and i.DESPENSE_TOTAL > 0)
and {_reachable(I.EVENTS_AS_OF)}"""
    return with_sources(body, "appointment patient invoice")


def audience_followup(day) -> str:
    body = f"""
select {_PERSON}, s.BRANCH_IDENTIFIER as BRANCH from spectacle_orders s, patient p
where s.COLLECTED_DATE = timestamp '{day} 00:00:00' and p.ID = s.PATIENTID and {_reachable(I.ORDERS_AS_OF)}"""
    return with_sources(body, "spectacle_orders patient")


_PRE_EXAM = f"""
select {_VISIT}, {_PERSON}, u.GIVEN_NAME as O_GIVEN, u.SURNAME as O_SURNAME from appointment a, patient p, users u
where {in_window('a.STARTDATE', DateRange(I.EVENTS_AS_OF, I.EVENTS_AS_OF))} and p.ID = a.PATIENTID and u.IDENTIFIER = a.RESID
and {_reachable(I.EVENTS_AS_OF)}"""


def audience_script_expiry() -> str:
    body = f"""
select {_PERSON}, p.BRANCH_IDENTIFIER as BRANCH from patient p, contact_rx c
where c.EXPIRY_DATE = timestamp '{I.ORDERS_AS_OF} 00:00:00' and p.ID = c.PATIENTID and {_reachable(I.ORDERS_AS_OF)}"""
    return with_sources(body, "patient contact_rx")


def render_messages(by_type: bool = False) -> str:
    def title(column: str) -> str:
        low = f"lower(coalesce(cast({column} as varchar), 'None'))"
        return (
            f"array_to_string(list_transform(string_split({low}, ''), lambda c, i: case when i = 1"
            f" or not regexp_matches(substr({low}, i - 1, 1), '[a-z]') then upper(c) else c end), '')"
        )

    start = "case when microsecond(STARTDATE) % 1000000 = 0 then strftime(STARTDATE, '%Y-%m-%d %H:%M:%S') else strftime(STARTDATE, '%Y-%m-%d %H:%M:%S.%f') end"
    values = {f"D_{c}": title(c) for c in ("TITLE", "GIVEN", "SURNAME", "O_GIVEN", "O_SURNAME")}
    values |= {"D_STARTDATE": start, "D_GENID": "GENID"}
    values |= {f"B_{c}": f"b.{c}" for c in ("NAME", "ADDRESS", "PHONE", "MANAGER_NAME", "MANAGER_EMAIL")}
    values["A_APP_EXTRA"] = "coalesce(x.extra, '')"

    def filled(template: str) -> str:
        message = "'" + template.replace("'", "''") + "'"
        for field, value in values.items():
            message = f"replace({message}, '{{{{{field}}}}}', {value})"
        return message

    message, where = filled(I.TEMPLATE), "true"
    if by_type:
        kind = I.TYPE.replace("APPOINTMENT_TYPE", "a.APPOINTMENT_TYPE")
        message = "case " + " ".join(f"when {kind} = '{t}' then {filled(text)}" for t, text in I.TEMPLATES.items()) + " end"
        where = f"{kind} in ({', '.join(repr(t) for t in I.TEMPLATES)})"
    body = f"""
select a.ID, a.EMAIL, {message} as message from ({_PRE_EXAM}) a join branches b on b.code = a.BRANCH
left join appointment_info x on x.appointment_type = a.APPOINTMENT_TYPE where {where}"""
    return with_sources(body, "appointment patient users branches appointment_info")


# ---- files


def claims_reordered() -> str:
    record = r"\d{8}\d{8}\d{3}\s{2}\d{6}\d{6}\d{6}\sA\d{6}\s{7}"
    body = f"""
select file, first_value(line_no) over w as first_line, first_value(pos) over w as first_pos, member, number_2, line_no, pos, record
from (select *, substr(record, 1, 8) as member, substr(record, 28, 6) as number_2 from
 (select file, line_no, cast(generate_subscripts(found, 1) - 1 as int) as pos, unnest(found) as record from
  (select file, line_no, regexp_extract_all(line || chr(10), '{record}') as found from claim_lines)))
window w as (partition by file, member order by line_no, pos rows between unbounded preceding and unbounded following)"""
    return with_sources(body, "claim_lines")


_FILE = r"^(\d{12})-(A\d{6})-H20017-(\w*)\.txt"


def benefit_files() -> str:
    body = f"""
select n.file, regexp_extract(n.file, '{_FILE}', 2) as provider, coalesce(b.code, '') as branch, regexp_extract(n.file, '{_FILE}', 3) as kind,
 strptime(regexp_extract(n.file, '{_FILE}', 1), '%d%m%Y%H%M') as picked_at
from report_names n left join branches b on b.provider_code = regexp_extract(n.file, '{_FILE}', 2)"""
    return with_sources(body, "report_names branches")


def benefit_summary(branch: str | None = None, renumbered: bool = False) -> str:
    """``renumbered``: lines count from 1 per file, as they do once written to files."""
    source = "report_lines"
    if renumbered:
        source = (
            "(select file, row_number() over (partition by file order by line_no) as line_no, line from report_lines)"
        )
    claim = r"^(\d+)\s*(\w)\s*(\d+)\s+(\d+)\s(\w+)\s+([\w/]+)\s+(\d+)\s+(.*)$"
    heading, detail = r"^(\w+\s*\w*)\s:$", r"^\t{2}(\w+)\s:\s(.+)"
    fields = ["member_no", "suffix", "item_code", "policy", "h_policy", "date_service", "benefit_paid", "message"]
    cut = ", ".join(
        f"case when entry = 'claim' then regexp_extract(line, '{claim}', {i}) end as {f}" for i, f in enumerate(fields, 1)
    )
    only = f"and b.code = '{branch}'" if branch else ""
    body = f"""
select t.file, coalesce(b.code, '') as branch, t.line_no, t.entry, p.TITLE || ' ' || p.GIVEN || ' ' || p.SURNAME as name, {', '.join('t.' + f for f in fields)},
 t.heading, t.detail_key, t.detail_value
from (select *, {cut},
  case when entry = 'heading' then regexp_extract(line, '{heading}', 1) end as heading,
  case when entry = 'detail' then regexp_extract(line, '{detail}', 1) end as detail_key,
  case when entry = 'detail' then regexp_extract(line, '{detail}', 2) end as detail_value
 from (select *, case when regexp_matches(line, '{claim}') then 'claim' when regexp_matches(line, '{heading}') then 'heading'
  when regexp_matches(line, '{detail}') then 'detail' end as entry from {source}
  where line_no > 1 and regexp_extract(file, '{_FILE}', 3) = 'SummaryReport')
 where entry is not null) t
left join branches b on b.provider_code = regexp_extract(t.file, '{_FILE}', 2)
left join patient p on p.MEMBER_NUMBER = case when length(t.member_no) < 8 then lpad(t.member_no, 8, '0') else t.member_no end
where true {only}"""
    return with_sources(body, "report_lines branches patient")


# Field positions (start, width) per record kind, read off the format by hand.
_PLACES = {
    "dep": "policy_no 6 8, member_no 15 8, order 24 1, first 26 24, last 51 20, gender 72 1, dob 74 8, status 83 1,"
    " start_dt 85 8, term_dt 94 8, a_limit 103 8, o_limit 112 8, n_flag 121 1, l_boost 123 8",
    "gaps": "member_no 7 8, unknown 16 8, space 25 1, type 27 1, date_fr 29 8, date_to 38 8, reason 47 13",
    "histc": "policy_no 8 8, member_no 17 8, data 26 5, line_no 33 5, claim_no 39 5, processed_dt 45 8, location 54 6,"
    " provider 61 8, a 70 5, item_code 76 5, service_dt 82 8, cost 91 8, benefit 100 8",
    "details": "client 10 8, customer 19 8, suffix 28 1, title_code 35 2, first 38 24, last 63 20, gender 84 1, dob 86 8,"
    " home_ph 101 15, work_ph 117 15, h_addr1 138 26, h_addr2 165 26, h_suburb 192 26, h_pcode 219 6,"
    " h_mail_ret_date 226 8, p_addr1 240 26, p_addr2 267 26, p_suburb 294 26, p_pcode 321 6, p_mail_ret_date 328 8,"
    " status 344 1, status_date 346 8, eff_date 355 8, scale 364 1, pay_method 366 1, pay_freq 368 1,"
    " enrolment_code 370 2, waver_code 373 2, id_ind 376 1, dte_on 378 8, dte_payed_to 387 8, state 396 1, card_no 398 2,"
    " card_date_issued 401 8, p1 416 3, p2 420 3, p3 424 3, p4 428 3, p5 432 3, p6 436 8, group_dpt 446 8, group_no 455 5,"
    " sect_no 461 3, user_resp 465 3",
}
# The derived responses hold only well-formed records, so a short pattern of fixed total width finds them.
_RECORD = {"dep": r"DEP~~[^\n]{125}", "gaps": r"GAPS~~[^\n]{53}", "histc": r"HISTC~~\d[^\n]{99}", "details": r"DETAILS~~[^\n]{458}"}


def _places(kind: str) -> list[tuple[str, int, int]]:
    return [(n, int(s), int(w)) for n, s, w in (part.split() for part in _PLACES[kind].split(","))]


def _found(kind: str) -> str:
    return f"""
select response_id, env, cast(generate_subscripts(found, 1) - 1 as int) as rec_no, unnest(found) as rec
from (select response_id, env, regexp_extract_all(body, '{_RECORD[kind]}') as found from responses)"""


def enquiry(kind: str) -> str:
    cut = ", ".join(f'substr(rec, {s}, {w}) as "{n}"' for n, s, w in _places(kind))
    return with_sources(f"select response_id, env, rec_no, {cut} from ({_found(kind)})", "responses")


def enquiry_records() -> str:
    parts = [
        f"select response_id, env, '{kind}' as kind, rec_no, cast({i} as int) as field_no, '{n}' as field, substr(rec, {s}, {w}) as value"
        f" from found_{kind}"
        for kind in _PLACES
        for i, (n, s, w) in enumerate(_places(kind))
    ]
    return with_sources(" union all ".join(parts), "responses", {f"found_{k}": _found(k) for k in _PLACES})


def response_diff() -> str:
    def side(env: str) -> str:
        return (
            "select response_id, cast(generate_subscripts(x, 1) - 1 as int) as line_no, unnest(x) as line from"
            f" (select response_id, string_split(body, chr(10)) as x from responses where env = '{env}')"
        )

    body = f"""
select response_id, line_no, case when r.line is null then 'removed' when l.line is null then 'added' else 'changed' end as change,
 l.line as left_line, r.line as right_line
from ({side('prod')}) l full join ({side('test')}) r using (response_id, line_no) where l.line is distinct from r.line"""
    return with_sources(body, "responses")


def response_diff_aligned() -> str:
    def side(env: str) -> str:
        return (
            "select *, row_number() over (partition by response_id, line order by line_no) as nth from"
            " (select response_id, cast(generate_subscripts(x, 1) - 1 as int) as line_no, unnest(x) as line from"
            f" (select response_id, string_split(body, chr(10)) as x from responses where env = '{env}'))"
        )

    body = f"""
select response_id, coalesce(l.line_no, r.line_no) as line_no, case when r.nth is null then 'removed' else 'added' end as change,
 case when r.nth is null then line end as left_line, case when l.nth is null then line end as right_line
from ({side('prod')}) l full join ({side('test')}) r using (response_id, line, nth) where l.nth is null or r.nth is null"""
    return with_sources(body, "responses")


def response_alignment() -> str:
    """For bodies of few lines that occur once each: all ascending runs of common lines are listed."""

    def side(env: str) -> str:
        return (
            "select response_id, cast(generate_subscripts(x, 1) - 1 as int) as line_no, unnest(x) as line from"
            f" (select response_id, string_split(body, chr(10)) as x from reordered where env = '{env}')"
        )

    pairs = "select response_id, l.line_no as l, r.line_no as r from l join r using (response_id, line)"
    runs = (
        "select response_id, l, r, 1 as n from pairs union"
        " select p.response_id, p.l, p.r, n + 1 from runs join pairs p on p.response_id = runs.response_id and p.l > runs.l and p.r > runs.r"
    )
    kept = (
        "select response_id, max(l), n from longest where (response_id, n) in (select response_id, max(n) from longest group by 1)"
        " group by 1, 3 union all select b.response_id, max(b.l), b.n from kept join longest b"
        " on b.response_id = kept.response_id and b.n = kept.n - 1 and b.l < kept.l group by 1, 3"
    )
    both = "full join r using (response_id, line) left join kept k on k.response_id = l.response_id and k.l = l.line_no"
    body = f"""
select response_id, case when r.line_no is null then 'removed' when l.line_no is null then 'added' else 'moved' end as change,
 l.line_no as left_no, r.line_no as right_no, case when l.line_no is not null then line end as left_line,
 case when r.line_no is not null then line end as right_line
from l {both} where k.l is null"""
    longest = "select response_id, l, max(n) as n from runs group by all"
    extra = {"l": side("prod"), "r": side("test"), "pairs": pairs, "runs(response_id, l, r, n)": runs, "longest": longest}
    sql = with_sources(body, "reordered", extra | {"kept(response_id, l, n)": kept})
    return sql.replace("with ", "with recursive ", 1)


def search_keys() -> str:
    def padded(x: str, n: int) -> str:
        return f"case when length({x}) < {n} then rpad({x}, {n}, '~') else {x} end"

    body = (
        f"select ID, 'SEARCH~~' || {padded('SURNAME', 20)} || '~' || {padded('left(GIVEN, 1)', 2)} || '~D~' ||"
        " strftime(BIRTHDATE, '%d%m%Y') || '~~~~~' as search_key from patient"
    )
    return with_sources(body, "patient")


_CLEAR = (
    "IDENTIFIER in ('ME','MNE') and PATIENT_ID in (select a.PATIENTID from appointment a where a.STARTDATE > timestamp '2024-01-11 00:00:00')"
)


def _eligibility(select: str, where: str) -> str:
    return with_sources(f"select {select} from patient_categories_link where {where}", "patient_categories_link appointment")


def _suite(reports: dict[str, str]) -> str:
    def values(name: str, query: str) -> str:
        keys = I.SUITE_KEYS[name]
        row = f"concat_ws('|', {', '.join(keys)})"
        if name == "trial_followup":  # keys alone
            return f"select '{name}' as report, {row} as row, 'rows' as metric, cast(1 as decimal(38,4)) as value from ({query}) q"
        wide = f"select {row} as row, cast(columns(* exclude ({', '.join(keys)})) as decimal(38,4)) from ({query}) q"
        long = f"({wide}) as w unpivot include nulls (value for metric in (columns(* exclude (row))))"
        return f"select '{name}' as report, row, metric, value from {long}"

    return " union all ".join(f"({values(n, q)})" for n, q in reports.items())


# The printed headings of some reports (fixed values), in the order of their columns.
HEADINGS = {
    "weekly_utilisation": ["Utilisation Cx"],
    "masterdata": [
        "appt_px_all", "Gls Appt No", "Cl Appt No", "cx_all", "Gl Cx No", "Cl Cx No", "CL Cx Per RX", "Total Appt No", "OCT No",
        "CL New Fit", "Cl Refit", "Unique Cx Per Month",
    ],
    "optometrists": [
        "#cl_cx", "$cl", "#cl_appt", "#lt_appt", "#lens", "$lens", "#upx", "#ex", "$cons", "#w_days", "#910/11", "#912/13/14", "#916/18",
        "#940/41", "#tmpl", "#amd", "#cat", "#lasik",
    ],
}


def suite_files(reports: dict[str, str]) -> str:
    """Values by place: the n-th column after the key has the n-th heading."""

    def values(title: str, query: str) -> str:
        names = [f"c{k}" for k in range(len(HEADINGS[title]))]
        picks = " union all ".join(
            f"select '{title}' as title, row, '{h}' as heading, cast({c} as decimal(38,4)) as value from q"
            for c, h in zip(names, HEADINGS[title], strict=True)
        )
        return f"with q(row, {', '.join(names)}) as ({query}) {picks}"

    return " union all ".join(f"({values(t, q)})" for t, q in reports.items())


def claim_batches_joined() -> str:
    return f"select file, record, count(*) as n from ({claims_reordered()}) group by all"


def claim_batches_written() -> str:
    order = "first_line, first_pos, number_2 desc, line_no, pos"
    return (
        f"select file, row_number() over (partition by file order by {order}) as place, rtrim(record, chr(10)) as record"
        f" from ({claims_reordered()})"
    )


def oracle_sql() -> dict[str, str]:
    month, week, events = I.MONTH, I.WEEK, I.EVENT_WEEK
    sql = {
        "trial_followup": trial_followup(month),
        "cl_orders_vs_exams": cl_orders_vs_exams(month, events),
        "glasses_customers_vs_exams": glasses_customers_vs_exams(month, events),
        "unique_customers_fy": unique_customers_fy(month, "1998-07-01"),
        "unique_customers_fy_weekly": unique_customers_fy(week, "1998-07-01"),
        "utilisation": utilisation(month),
        "utilisation_weekly": utilisation(week),
        "utilisation_all_dates": utilisation(I.ALL_ORDER_DATES),
        "branch_masterdata": branch_masterdata(month, events),
        "branch_masterdata_weekly": branch_masterdata(week, events),
        "branch_masterdata_all_dates": branch_masterdata(I.ALL_ORDER_DATES, I.ALL_EVENT_DATES),
        "dispenser_scorecard": dispenser_scorecard(month, events),
        "dispenser_scorecard_all_dates": dispenser_scorecard(I.ALL_ORDER_DATES, I.ALL_EVENT_DATES),
        "optometrist_scorecard": optometrist_scorecard(month, events),
        "optometrist_scorecard_all_dates": optometrist_scorecard(I.ALL_ORDER_DATES, I.ALL_EVENT_DATES),
        "staff_sales": dispenser_group(
            "fr_qty fr_amt lens_qty lens_amt suns_qty suns_amt own_fr lens_ng unpaid unpaid_per_invoice", month, events
        ),
        "staff_net_counts": dispenser_group("cust sale own_fr_cx px_2pr", month, events),
        "staff_discounts": dispenser_group("mgmt_d match_d total_d", month, events),
        "staff_order_stages": dispenser_group("fit check pack deliv", month, events),
        "staff_warranty_cancel": dispenser_group("remake wrty cncl", month, events),
        "staff_clock_days": dispenser_group("w_days w_days_distinct", month, events),
        "staff_priced": dispenser_group("priced", month, events),
        "optom_appointments": optometrist_group("cl_appt lt_appt", month, events),
        "optom_exams": optometrist_group("upx ex", month, events),
        "optom_revenue": optometrist_group("cl_cx cl_amt lens_qty lens_amt cons_amt", month, events),
        "optom_item_billing": optometrist_group("item_910_11 item_912_14 item_916_18 item_940_41", month, events),
        "optom_letters": optometrist_group("tmpl amd cat lasik", month, events),
        "active_dispensers": _roster("2,4,5", "'D3'"),
        "active_optometrists": _roster("1", "'', 'O5'"),
        "daily_volume": capacity("volume"),
        "daily_fte": capacity("fte"),
        "daily_fte_vs_budget": capacity("budget_100, budget_85, fte_vs_budget"),
        "daily_optometrists": capacity("optometrists"),
        "daily_fte_actual": capacity("fte_actual"),
        "daily_volume_vs_budget": capacity("volume_vs_budget"),
        "capacity_report": capacity_report(),
        "audience_feedback": audience_feedback(),
        "audience_followup": audience_followup("1998-10-12"),
        "audience_pre_exam": with_sources(_PRE_EXAM, "appointment patient users"),
        "audience_script_expiry": audience_script_expiry(),
        "render_messages": render_messages(),
        "claims_reordered": claims_reordered(),
        "benefit_files": benefit_files(),
        "files_for_branch": with_sources(
            "select b.code, n.file from coded_names n join coded_branches b on contains(n.file, b.provider_code)",
            "coded_names coded_branches",
        ),
        "benefit_summary": benefit_summary(),
        "benefit_summary_by_branch": benefit_summary("B2"),
        "benefit_landing": benefit_summary(renumbered=True),
        "enquiry_records": enquiry_records(),
        **{f"enquiry_{kind}": enquiry(kind) for kind in _PLACES},
        "search_keys": search_keys(),
        "request_keys": with_sources(
            "select MEMBER_NUMBER as number, r as request, r || '~~' || MEMBER_NUMBER as request_key"
            " from patient, (values ('GAPS'), ('HISTP')) t(r)",
            "patient",
        ),
        "response_diff": response_diff(),
        "response_diff_aligned": response_diff_aligned(),
        "response_alignment": response_alignment(),
        "eligibility_cleared": _eligibility("*", _CLEAR),
        "eligibility_cleared_count": _eligibility("count(*) as cleared", _CLEAR),
        "eligibility_kept": _eligibility("*", f"({_CLEAR}) is not true"),
    }
    sql["report_csv"] = sql["branch_masterdata_monthly_layout"] = sql["branch_masterdata"]
    sql["dispenser_csv_by_branch"] = sql["dispenser_scorecard_monthly_layout"] = sql["dispenser_scorecard"]
    sql["messages_by_type"] = render_messages(by_type=True)
    for part, name in (("kept", "kept"), ("cleared", "cleared"), ("count", "cleared_count")):
        sql[f"eligibility_table_{part}"] = sql[f"eligibility_{name}"]
    sql["branch_masterdata_from_days"] = branch_masterdata(I.LAST_WEEK, events)
    sql["dispenser_scorecard_from_days"] = sql["dispenser_scorecard"]
    sql["optometrist_scorecard_from_days"] = sql["optometrist_scorecard"]
    sql["unique_customers_fy_from_index"] = sql["unique_customers_fy"]
    sql["claim_batches_joined"] = claim_batches_joined()
    sql["suite_files"] = suite_files(
        {"weekly_utilisation": sql["utilisation"], "masterdata": sql["branch_masterdata"], "optometrists": sql["optometrist_scorecard"]}
    )
    sql["claim_batches_written"] = claim_batches_written()
    sql["report_suite_monthly"] = _suite(
        {
            "utilisation": sql["utilisation"],
            "unique_customers_fy": sql["unique_customers_fy"],
            "trial_followup": trial_followup(DateRange(I.date(1998, 11, 1), I.date(1998, 11, 8))),
            "branch_masterdata": sql["branch_masterdata"],
            "dispenser_scorecard": sql["dispenser_scorecard"],
            "optometrist_scorecard": sql["optometrist_scorecard"],
        }
    )
    sql["report_suite_weekly"] = _suite(
        {n: sql[f"{n}_weekly"] for n in ("unique_customers_fy", "utilisation", "branch_masterdata")}
    )
    sql["report_suite_monthly_from_days"] = sql["report_suite_monthly"]
    sql["report_suite_weekly_from_days"] = sql["report_suite_weekly"]
    return sql
