"""Dimensions and derived text inputs, as SQL that Spark and DuckDB both run.

Everything grows with the source tables: claim batches and report files come from all orders, enquiry
responses from all customers. All codes and names are invented.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from lensmill.functions.windows import DateRange, look_ahead, previous_month, trailing_week
from checks.adapter import source

ORDERS_AS_OF = date(1998, 11, 15)
EVENTS_AS_OF = date(2024, 1, 8)
MONTH = previous_month(ORDERS_AS_OF)
WEEK = trailing_week(ORDERS_AS_OF)
LAST_WEEK = DateRange(date(1998, 10, 25), date(1998, 10, 31))
EVENT_WEEK = trailing_week(EVENTS_AS_OF)
AHEAD = look_ahead(EVENTS_AS_OF)
ALL_ORDER_DATES = DateRange(date(1995, 1, 1), date(2001, 12, 31))
ALL_EVENT_DATES = DateRange(date(2024, 1, 1), date(2024, 1, 31))
# What names a row of a suite's report.
SUITE_KEYS = {
    "utilisation": ["branch"],
    "unique_customers_fy": ["branch"],
    "trial_followup": ["BRANCH_IDENTIFIER", "USER_ADDED", "ID"],
    "branch_masterdata": ["branch"],
    "dispenser_scorecard": ["branch", "dispenser"],
    "optometrist_scorecard": ["optometrist"],
}
# Reports of the suite whose first column names a row.
SUITE_FILES = ("utilisation", "branch_masterdata", "optometrist_scorecard")
EVENT_FACTS = ("appointment", "examination", "clockinout", "patient_letters")


def windows(orders: DateRange, events: DateRange) -> dict[str, DateRange]:
    return {"default": orders} | {fact: events for fact in EVENT_FACTS}


MONTH_WINDOWS = windows(MONTH, EVENT_WEEK)
WEEK_WINDOWS = windows(WEEK, EVENT_WEEK)
ALL_WINDOWS = windows(ALL_ORDER_DATES, ALL_EVENT_DATES)

BRANCHES = "select * from (values " + ", ".join(
    f"('B{i}', 'A10000{i}', cast({6 + i}.5 as decimal(6,2)), cast({5 + i}.25 as decimal(6,2)), 'Branch {i}',"
    f" '{i} Example Street', '555-010{i}', 'Manager {i}', 'manager{i}@example.test')"
    for i in range(7)
) + ") as t(code, provider_code, fte_100, fte_85, name, address, phone, manager_name, manager_email)"

# One more branch whose provider code has another shape, and files that name it.
OTHER_CODE = "ZZ-77"
CODED_BRANCHES = f"{BRANCHES} union all select 'B7', '{OTHER_CODE}', 1.00, 1.00, 'Branch 7', '', '', '', ''"

APPT_BUDGET = "select * from (values " + ", ".join(
    f"('B{i}', {month}, {20 + 2 * i + month})" for i in range(7) for month in range(12)
) + ") as t(branch, fiscal_month, per_day)"

APPOINTMENT_INFO = (
    "select * from (values ('CL', 'Please bring your lenses.'), ('LT', 'Please leave your lenses out.'))"
    " as t(appointment_type, extra)"
)

# An invented pre-exam message; {{branch}} has no prefix and stays as it is.
TEMPLATE = (
    "<p>Dear {{D_TITLE}} {{D_GIVEN}} {{D_SURNAME}},</p><p>{{D_STARTDATE}} with {{D_O_GIVEN}} {{D_O_SURNAME}} at"
    " {{B_NAME}}, {{B_ADDRESS}}, {{B_PHONE}}. {{A_APP_EXTRA}}</p><a href='https://example.test/{{D_GENID}}'>form</a>"
    "<p>{{B_MANAGER_NAME}} {{B_MANAGER_EMAIL}} {{branch}}</p>"
)

# One template per type of message, of which the first is the one above.
TEMPLATES = {"exam": TEMPLATE, "lenses": "{{D_GIVEN}}: {{A_APP_EXTRA}} }} {{B_PHONE}}{{D_NOTHING}} {{b_phone}} {{D_GIVEN}}"}
TYPE = "case when APPOINTMENT_TYPE in ('CL', 'LT') then 'lenses' when APPOINTMENT_TYPE = 'SC' then 'exam' else 'other' end"


def _pad(expression: str, width: int) -> str:
    return f"lpad(cast({expression} as string), {width}, '0')"


def _yymmdd(column: str) -> str:
    return f"{_pad(f'year({column}) % 100', 2)} || {_pad(f'month({column})', 2)} || {_pad(f'day({column})', 2)}"


def _claim(offset: int) -> str:
    return (
        f"{_pad('o_custkey', 8)} || {_pad('o_orderkey', 8)} || {_pad('o_orderkey % 1000', 3)} || '  ' || "
        f"{_pad(f'o_orderkey % 7919 + {offset}', 6)} || {_yymmdd('o_orderdate')} || {_pad('o_custkey % 5000', 6)}"
        " || ' A10000' || cast(o_orderkey % 7 as string) || '       '"
    )


# One batch per branch and year. Every fifth order has two claims on its line, some records are broken.
CLAIM_LINES = f"""
select '3006' || cast(year(o_orderdate) as string) || '-A10000' || cast(o_orderkey % 7 as string) || '-H20017.txt' as file,
 o_orderkey as line_no,
 case when o_orderkey % 11 = 0 then 'broken ' || cast(o_orderkey as string)
  when o_orderkey % 5 = 0 then {_claim(0)} || {_claim(1)} else {_claim(0)} end as line
from {{orders}}
"""

# Report files per branch, year, kind and million orders, so files multiply with the data; each starts with a title line.
_REPORT = """
select o_orderkey as k, o_custkey as c, o_orderdate as d, o_totalprice as p, o_orderstatus as s,
 '3006' || cast(year(o_orderdate) as string) || {hours} || '44-A10000' || cast(case when o_orderkey % 97 = 0 then 9 else o_orderkey % 7 end as string)
 || '-H20017-' || case when o_orderpriority = '1-URGENT' then 'ExceptionReport' when o_orderpriority = '2-HIGH' then 'Error' else 'SummaryReport' end
 || '.txt' as file
from {orders}
""".replace("{hours}", _pad("cast(floor(o_orderkey / 1000000) as int) % 24", 2))
REPORT_LINES = f"""
with r as ({_REPORT})
select distinct file, cast(1 as bigint) as line_no, '12 A 34 56 X 78 90 title line' as line from r
union all select file, k * 4 + 2, cast(c as string) || ' A 0' || cast(k % 100 as string) || '  ' || cast(k as string)
 || ' HP' || cast(k % 9 as string) || '   ' || {_pad('day(d)', 2)} || '/' || {_pad('month(d)', 2)} || '/' || cast(year(d) as string)
 || ' ' || cast(k % 10000 as string) || '  Paid part ' || cast(k % 3 as string) from r
union all select file, k * 4 + 3, 'Claim total' || ' :' from r where s = 'F'
union all select file, k * 4 + 4, chr(9) || chr(9) || 'Paid : ' || cast(k % 1000 as string) || '.00 by card' from r
union all select file, k * 4 + 5, '--- end of claim ' || cast(k as string) from r
"""
REPORT_NAMES = f"select distinct file from ({_REPORT}) as r"
CODED_NAMES = (
    f"{REPORT_NAMES} union all select distinct '2-{OTHER_CODE}-' || cast(year(o_orderdate) as string) || '.txt' as file from {{orders}}"
)

_D8 = _pad("c_custkey", 8)
_TEXT24, _TEXT20 = "rpad(c_mktsegment, 24, ' ')", "rpad(reverse(c_mktsegment), 20, ' ')"
_DEP = (
    f"'DEP~~' || {_D8} || '~' || {_pad('c_custkey + 1', 8)} || '~A~' || {_TEXT24} || '~' || {_TEXT20} ||"
    " '~F~01021980~1~01072001~        ~  $10.00~  $20.00~N~   $5.00'"
)
_GAPS = f"'GAPS~~' || {_D8} || '~00000001~ ~B~01011999~31121999~REASON' || {_pad('c_custkey % 10000000', 7)}"
_HISTC = (
    f"'HISTC~~' || {_D8} || '~' || {_D8} || '~ADATA~~' || {_pad('c_custkey % 100000', 5)} ||"
    " '~00042~03041999~L12345~A100001 ~ABC  ~S1 23~05061999~  $50.00~'"
)
_DETAILS = (
    f"'DETAILS~~' || {_D8} || '~' || {_D8} || '~ANAME~~ 1~' || {_TEXT24} || '~' || {_TEXT20} || '~M~02031970PHONE~~' ||"
    " rpad('0255501', 15, ' ') || '~' || rpad('', 15, ' ') || 'HOME~~' || rpad('1 EXAMPLE ST', 26, ' ') || '~' ||"
    " rpad('', 26, ' ') || '~' || rpad('SUBURB-EAST', 26, ' ') || '~2000  ~' || rpad('', 8, ' ') || 'POST~~' ||"
    " rpad('PO BOX 1', 26, ' ') || '~' || rpad('', 26, ' ') || '~' || rpad('SUBURB', 26, ' ') || '~2001  ~' ||"
    f" rpad('', 8, ' ') || 'POLICY~~A~01012000~02012000~F~D~M~01~02~Y~03012000~04012000~N~' || {_pad('c_custkey % 100', 2)} ||"
    f" '~05012000PRODS~~A01~B02~   ~   ~   ~' || rpad('GROUP', 8, ' ') || '~~' || {_D8} || '~00007~ 12~345'"
)

# Two environments per customer with none, one or two records of a kind; the copies differ in places.
RESPONSES = f"""
select c_custkey as response_id, env,
 case when env = 'test' and c_custkey % 9 = 0 then 'put in first' || chr(10) else '' end
 || 'Return     : ' || cast(c_custkey as string) || chr(10)
 || case when c_custkey % 3 > 0 then {_DEP} else 'no dependants' end || case when c_custkey % 3 = 2 then {_DEP} else '' end || chr(10)
 || {_GAPS} || chr(10)
 || case when c_custkey % 2 = 0 then {_HISTC} || case when env = 'test' and c_custkey % 4 = 0 then '  $11.00' else '  $10.00' end else 'HISTC~~none' end || chr(10)
 || case when env = 'test' and c_custkey % 8 = 0 then 'put in between' || chr(10) || {_GAPS} || chr(10) else '' end
 || {_DETAILS}
 || case when env = 'test' and c_custkey % 5 = 0 then chr(10) || 'extra' else '' end
 || case when env = 'prod' and c_custkey % 7 = 0 then chr(10) || 'only here' else '' end as body
from (select *, 'prod' as env from {{customer}} union all select *, 'test' as env from {{customer}}) as both_sides
"""


# Two environments per customer whose lines occur once a body: some are moved, put in, left out or on one side alone.
_LINES = [f"'{k} ' || cast(c_custkey * {k + 1} as string)" for k in range(8)]
_ORDERS = ["01234567", "01234567", "12345670", "70123456", "01432567", "10325476", "76543210", "0123x567", "x0123467"]
REORDERED = f"""
select c_custkey as response_id, env, case {" ".join(
    f"when env = 'test' and c_custkey % {len(_ORDERS)} = {n} then "
    + " || chr(10) || ".join("'new'" if k == "x" else _LINES[int(k)] for k in order)
    for n, order in enumerate(_ORDERS)
)} else {" || chr(10) || ".join(_LINES)} end as body
from (select *, 'prod' as env from {{customer}} union all select *, 'test' as env from {{customer}} where c_custkey % 41 > 0) as both_sides
"""


def derive(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """Runs one of the texts above over the source tables."""
    tables = {t: source(spark, sf_dir, t) for t in ("orders", "customer") if f"{{{t}}}" in text}
    return spark.sql(text, **tables)


def derived_sql(text: str) -> str:
    return text.format(orders="orders", customer="customer")
