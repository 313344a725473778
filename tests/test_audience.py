import hashlib
from datetime import date

import pytest
from pyspark.sql import functions as F

from lensmill.operators.exclusion import not_in
from lensmill.plans import audience
from lensmill.sources.text import read_template_table, read_templates
from tests.conftest import day, rows, ts
from tests.test_branch import inv

TODAY = date(2024, 1, 8)


def person(id, **more):
    base = dict(TITLE="MS", GIVEN="ANN", SURNAME="o'neill", EMAIL="a@example.test", NOEMAIL=False, BIRTHDATE=day("1980-01-01"))
    return base | dict(ID=id, BRANCH_IDENTIFIER="B0") | more


def visit(id, patient, when="2024-01-08 09:00:00", **more):
    base = dict(APPOINTMENT_TYPE="CL", BRANCH_IDENTIFIER="B0", RESID="O1", APP_PROGRESS=5)
    return base | dict(ID=id, PATIENTID=patient, STARTDATE=ts(when)) | more


PEOPLE = [
    person(1),
    person(2, EMAIL=""),
    person(3, EMAIL=None),
    person(4, NOEMAIL=True),
    person(5, NOEMAIL=None),
    person(6, BIRTHDATE=day("2006-01-09")),
    person(7, BIRTHDATE=day("2006-01-08")),
    person(8, BIRTHDATE=None),
]


def test_contactable(make_clinic):
    clinic = make_clinic(patient=PEOPLE)
    assert rows(audience.contactable(clinic["patient"], TODAY), "ID") == [(1,), (7,)]


def test_feedback_excludes_buyers_of_the_day(make_clinic):
    def build(*invoices):
        return make_clinic(
            patient=PEOPLE,
            appointment=[visit(10, 1), visit(11, 7), visit(12, 2), visit(13, 1, APP_PROGRESS=1), visit(14, 1, "2024-01-09 09:00:00")],
            invoice=list(invoices),
        )

    paid, unpaid = inv(1, 1, "2024-01-08 10:00:00"), inv(2, 7, "2024-01-08 10:00:00", total="0")
    got = audience.audience_feedback(build(paid, unpaid), TODAY, TODAY)
    assert rows(got, "ID", "PID") == [(11, 7)]
    assert got.first().GENID == hashlib.sha256(b"7").hexdigest()
    assert rows(audience.audience_feedback(build(), TODAY, TODAY), "ID") == [(10,), (11,)]
    # A paid invoice without a patient empties the result, as NOT IN does.
    nameless = inv(3, None, "2024-01-08 10:00:00")
    assert rows(audience.audience_feedback(build(nameless), TODAY, TODAY), "ID") == []


def test_not_in_follows_sql(spark):
    left = spark.sql("select * from values (1), (2), (null) as t(k)")
    lists = {"empty": "select 1 as x where false", "some": "select 2 as x", "null": "select cast(null as int) as x union all select 2"}
    for text in lists.values():
        right = spark.sql(text)
        left.createOrReplaceTempView("l")
        right.createOrReplaceTempView("r")
        expected = rows(spark.sql("select k from l where k not in (select x from r)"))
        assert rows(not_in(left, "k", right, "x")) == expected


def test_followup_needs_exact_midnight(make_clinic):
    orders = [
        dict(ID=1, PATIENTID=1, COLLECTED_DATE=ts("2024-01-08 00:00:00"), BRANCH_IDENTIFIER="B1"),
        dict(ID=2, PATIENTID=1, COLLECTED_DATE=ts("2024-01-08 00:00:01"), BRANCH_IDENTIFIER="B1"),
        dict(ID=3, PATIENTID=2, COLLECTED_DATE=ts("2024-01-08 00:00:00"), BRANCH_IDENTIFIER="B1"),
    ]
    clinic = make_clinic(patient=PEOPLE, spectacle_orders=orders)
    assert rows(audience.audience_followup(clinic, TODAY, TODAY), "SURNAME", "BRANCH") == [("o'neill", "B1")]


def test_pre_exam_and_script_expiry(make_clinic):
    clinic = make_clinic(
        patient=PEOPLE,
        users=[dict(IDENTIFIER="O1", GIVEN_NAME="Ola", SURNAME="Optom")],
        appointment=[visit(1, 1), visit(2, 1, RESID="O9"), visit(3, 1, RESID=None), visit(4, 99), visit(5, 7, APP_PROGRESS=0)],
        contact_rx=[dict(ID=1, PATIENTID=7, EXPIRY_DATE=ts("2024-01-08 00:00:00")), dict(ID=2, PATIENTID=1, EXPIRY_DATE=ts("2024-01-08 01:00:00"))],
    )
    got = audience.audience_pre_exam(clinic, TODAY, TODAY)
    assert rows(got, "ID", "O_GIVEN", "O_SURNAME") == [(1, "Ola", "Optom"), (5, "Ola", "Optom")]
    assert rows(audience.audience_script_expiry(clinic, TODAY), "BIRTHDATE", "BRANCH") == [(day("2006-01-08"), "B0")]


@pytest.fixture
def pre_exam(make_clinic):
    clinic = make_clinic(
        patient=[person(1), person(2, GIVEN=None, SURNAME="smith-JONES 3rd")],
        users=[dict(IDENTIFIER="O1", GIVEN_NAME="OLA", SURNAME="mc optom")],
        appointment=[visit(1, 1), visit(2, 2, "2024-01-08 09:00:00.25", APPOINTMENT_TYPE="SC"), visit(3, 1, BRANCH_IDENTIFIER="B9")],
    )
    return audience.audience_pre_exam(clinic, TODAY, TODAY)


def test_messages(spark, branches, pre_exam):
    template = (
        "{{D_TITLE}} {{D_GIVEN}} {{D_SURNAME}} {{D_STARTDATE}} {{D_O_SURNAME}} {{D_GENID}} {{D_NOEMAIL}} {{D_NOPE}}"
        "|{{B_NAME}} {{B_PHONE}} {{B_MANAGER_NAME}} {{B_NOPE}}|{{A_APP_EXTRA}}|{{branch}}"
    )
    info = spark.sql("select 'CL' as appointment_type, 'Bring lenses.' as extra")
    got = dict(rows(audience.render_messages(pre_exam, template, branches, info), "ID", "message"))
    key = [hashlib.sha256(x).hexdigest() for x in (b"1", b"2")]
    assert got == {
        1: f"Ms Ann O'Neill 2024-01-08 09:00:00 Mc Optom {key[0]} False {{{{D_NOPE}}}}|North 555-1 Mo {{{{B_NOPE}}}}|Bring lenses.|{{{{branch}}}}",
        2: f"Ms None Smith-Jones 3Rd 2024-01-08 09:00:00.250000 Mc Optom {key[1]} False {{{{D_NOPE}}}}|North 555-1 Mo {{{{B_NOPE}}}}||{{{{branch}}}}",
    }
    plain = audience.render_messages(pre_exam, "{{A_APP_EXTRA}} {{B_NAME}}", branches)
    assert rows(plain, "message") == [("{{A_APP_EXTRA}} North",)] * 2


def test_messages_read_only_the_named_columns(pre_exam, branches):
    got = audience.render_messages(pre_exam, "Dear {{D_TITLE}}", branches).select("message")
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "sha2" not in plan and "address" not in plan


def test_templates_are_read_by_type(spark, tmp_path):
    (tmp_path / "recall.html").write_text("<p>{{D_TITLE}}\n</p>")
    (tmp_path / "script.html").write_text("x")
    assert read_templates(spark, str(tmp_path), ["recall", "script"]) == {"recall": "<p>{{D_TITLE}}\n</p>", "script": "x"}


def test_placeholder_text_in_data_is_not_a_column(spark, branches, make_clinic):
    clinic = make_clinic(
        patient=[person(1, SURNAME="{{B_NAME}}")], contact_rx=[dict(ID=1, PATIENTID=1, EXPIRY_DATE=ts("2024-01-08 00:00:00"))]
    )
    got = audience.render_messages(audience.audience_script_expiry(clinic, TODAY), "{{D_SURNAME}}", branches)
    assert got.select(F.col("message")).first()[0] == "{{B_Name}}"


@pytest.fixture
def expiring(make_clinic):
    return make_clinic(
        patient=[person(1, SURNAME="LEE"), person(2, SURNAME=None)],
        contact_rx=[dict(ID=k, PATIENTID=k, EXPIRY_DATE=ts("2024-01-08 00:00:00")) for k in (1, 2)],
    )


def test_messages_are_one_concatenation(spark, branches, expiring):
    clinic = expiring
    people = audience.audience_script_expiry(clinic, TODAY)
    template = "a {{D_SURNAME}}{{D_GIVEN}} {{B_NAME}}{{D_NOPE}}{{X_NAME}} {{{{D_SURNAME}}"
    plan = audience.render_messages(people, template, branches)._jdf.queryExecution().optimizedPlan().toString()
    assert "concat(" in plan and "replace(replace(" not in plan


def test_templates_of_types_are_joined(spark, tmp_path, branches, expiring):
    clinic = expiring
    people = audience.audience_script_expiry(clinic, TODAY).withColumn("KIND", F.lit("script"))
    other = people.withColumn("KIND", F.lit("none"))
    template = "<p>{{D_SURNAME}}{{D_GIVEN}} {{B_NAME}}{{D_NOPE}} }} {{B_name}} {{{{D_SURNAME}}\n</p>"
    (tmp_path / "script.html").write_text(template)
    (tmp_path / "other.html").write_text("x")
    (tmp_path / "notes.txt").write_text("not a template")
    table = read_template_table(spark, str(tmp_path))
    assert rows(table) == [("other", "x"), ("script", template)]
    got = rows(audience.render_by_type(people.unionByName(other), table, branches, type="KIND"), "message")
    assert got == rows(audience.render_messages(people, template, branches), "message") and got
