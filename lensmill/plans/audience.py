"""Whom to write to, and the message each of them gets."""

from __future__ import annotations

import re
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import TimestampNTZType

from lensmill.functions.exprs import age_on, ntz, person_key, title_case
from lensmill.functions.windows import DateRange
from lensmill.operators.exclusion import not_in
from lensmill.sources.catalog import Clinic

ADULT = 18
PERSON = ["TITLE", "GIVEN", "SURNAME", "EMAIL", "NOEMAIL", "BIRTHDATE"]


def contactable(frame: DataFrame, as_of: date) -> DataFrame:
    """Adults with an address who have not opted out; a missing address is no address."""
    return frame.filter("EMAIL <> '' and not NOEMAIL").filter(age_on(F.col("BIRTHDATE"), as_of) >= ADULT)


def _patients(clinic: Clinic, as_of: date) -> DataFrame:
    """Filtering people first keeps the others out of the joins."""
    return contactable(clinic["patient"], as_of).select(F.col("ID").alias("PID"), *PERSON, "BRANCH_IDENTIFIER")


def _visits(clinic: Clinic, day: date, condition: str = "true") -> DataFrame:
    return (
        clinic.within("appointment", "STARTDATE", DateRange(day, day))
        .filter(condition)
        .select(
            "ID", "APPOINTMENT_TYPE", "STARTDATE", F.col("BRANCH_IDENTIFIER").alias("BRANCH"), "PATIENTID", "RESID"
        )
    )


VISIT = ["ID", "APPOINTMENT_TYPE", "STARTDATE", "BRANCH", "PID", "GENID"]


def audience_feedback(
    clinic: Clinic, day: date, as_of: date, paid_within: DateRange | None = None
) -> DataFrame:
    """Completed appointments of the day whose patient has no paid invoice that day (or ``paid_within``)."""
    paid = clinic.within("invoice", "SALE_DATE", paid_within or DateRange(day, day)).filter("DESPENSE_TOTAL > 0")
    people = _patients(clinic, as_of).drop("BRANCH_IDENTIFIER")
    seen = _visits(clinic, day, "APP_PROGRESS = 5").join(people, F.col("PATIENTID") == F.col("PID"))
    return not_in(seen, "PID", paid, "PATIENTID").select(
        *VISIT[:-1], person_key(F.col("PID")).alias("GENID"), *PERSON
    )


def audience_followup(clinic: Clinic, day: date, as_of: date) -> DataFrame:
    """Spectacle orders collected on the day, stamped exactly at midnight."""
    collected = (
        clinic["spectacle_orders"]
        .filter(F.col("COLLECTED_DATE") == ntz(f"{day} 00:00:00"))
        .select("PATIENTID", F.col("BRANCH_IDENTIFIER").alias("BRANCH"))
    )
    people = _patients(clinic, as_of).drop("BRANCH_IDENTIFIER")
    return collected.join(people, F.col("PATIENTID") == F.col("PID")).select(*PERSON, "BRANCH")


def audience_pre_exam(clinic: Clinic, day: date, as_of: date) -> DataFrame:
    """Appointments of the day with the optometrist's name."""
    optometrists = clinic["users"].select(
        F.col("IDENTIFIER"), F.col("GIVEN_NAME").alias("O_GIVEN"), F.col("SURNAME").alias("O_SURNAME")
    )
    people = _patients(clinic, as_of).drop("BRANCH_IDENTIFIER")
    return (
        _visits(clinic, day)
        .join(people, F.col("PATIENTID") == F.col("PID"))
        .join(optometrists, F.col("RESID") == F.col("IDENTIFIER"))
        .select(*VISIT[:-1], person_key(F.col("PID")).alias("GENID"), *PERSON, "O_GIVEN", "O_SURNAME")
    )


def audience_script_expiry(clinic: Clinic, as_of: date) -> DataFrame:
    """Patients whose contact script expires on the day."""
    expiring = clinic["contact_rx"].filter(F.col("EXPIRY_DATE") == ntz(f"{as_of} 00:00:00")).select("PATIENTID")
    people = _patients(clinic, as_of).withColumnRenamed("BRANCH_IDENTIFIER", "BRANCH")
    return expiring.join(people, F.col("PATIENTID") == F.col("PID")).select(*PERSON, "BRANCH")


def _spoken(audience: DataFrame, name: str) -> Column:
    """A field as it reads in a message: capitalised text; the opaque person key stays as it is."""
    col = F.col(name)
    if name == "GENID":
        return F.coalesce(col, F.lit("None"))
    text = col.cast("string")
    if isinstance(audience.schema[name].dataType, TimestampNTZType):
        # A fraction of a second is written with six digits, a whole second without.
        text = F.when(text.contains("."), F.rpad(text, 26, "0")).otherwise(text)
    return title_case(F.coalesce(text, F.lit("None")))


# A placeholder: audience column, branch column, or the text for the appointment type.
_PLACE = r"\{\{(?:D_\w+|B_\w+|A_APP_EXTRA)\}\}"


def _with_sources(audience: DataFrame, branches: DataFrame, appointment_info: DataFrame | None, places: list[str]) -> DataFrame:
    """The audience with the branch columns (``_b_x``) and the appointment type's text (``_extra``) that are asked for."""
    known = {c.lower() for c in branches.columns}
    asked = [p for p in dict.fromkeys(p.lower() for p in places) if p in known]
    branch = branches.select(F.col("code").alias("_code"), *(F.col(p).alias(f"_b_{p}") for p in asked))
    rows = audience.join(branch, F.col("BRANCH") == F.col("_code"))
    if appointment_info is None:
        return rows
    info = appointment_info.select(F.col("appointment_type").alias("_type"), F.col("extra").alias("_extra"))
    return rows.join(info, F.col("APPOINTMENT_TYPE") == F.col("_type"), "left")


def _filled(place: str, audience: DataFrame, rows: DataFrame) -> Column:
    """What a placeholder stands for in a row; itself where it has no source."""
    kind, name = place[2], place[4:-2]
    if kind == "D" and name in audience.columns:
        return _spoken(audience, name)
    if kind == "B" and f"_b_{name.lower()}" in rows.columns:
        return F.coalesce(F.col(f"_b_{name.lower()}").cast("string"), F.lit(""))
    if kind == "A" and "_extra" in rows.columns:
        return F.coalesce(F.col("_extra"), F.lit(""))
    return F.lit(place)


def render_messages(
    audience: DataFrame,
    template: str,
    branches: DataFrame,
    appointment_info: DataFrame | None = None,
) -> DataFrame:
    """Adds ``message``: the template with the placeholders of each row filled in.

    ``{{D_x}}`` takes audience column x, ``{{B_x}}`` column x of the branch; with ``appointment_info``
    (appointment_type, extra) ``{{A_APP_EXTRA}}`` takes the text for the appointment type, or nothing.
    Placeholders without a source stay, and text that is filled in is not searched for placeholders. The template is one
    small text and is cut once, so a message is one concatenation, and only the columns it names are read. Rows of a
    branch outside ``branches`` are left out.
    """
    segments = [s for s in re.split(f"({_PLACE})", template) if s]
    rows = _with_sources(audience, branches, appointment_info, [s[4:-2] for s in segments if s.startswith("{{B_")])
    parts = [_filled(s, audience, rows) if re.fullmatch(_PLACE, s) else F.lit(s) for s in segments]
    return rows.select(*audience.columns, F.concat(F.lit(""), *parts).alias("message"))


def render_by_type(
    audience: DataFrame,
    templates: DataFrame,
    branches: DataFrame,
    appointment_info: DataFrame | None = None,
    type: str = "TYPE",
) -> DataFrame:
    """``render_messages`` for an audience of several types, each with a template of its own.

    templates: (type, template), as ``sources.text.read_template_table`` gives them; they are joined by the audience's
    column ``type`` and never come to the driver, and are cut into literals and placeholders once each. Rows of a type
    without a template are left out.
    """
    cut = templates.select(
        F.col("type").alias("_of_type"), F.split("template", f"(?={_PLACE})|(?<=\\}}\\}})").alias("_segments")
    )
    rows = _with_sources(audience, branches, appointment_info, branches.columns)
    rows = rows.join(cut, F.col(type) == F.col("_of_type"))
    places = [f"{{{{D_{c}}}}}" for c in audience.columns] + ["{{A_APP_EXTRA}}"]
    # A template may write a branch column in capitals.
    for c in branches.columns:
        places += [f"{{{{B_{n}}}}}" for n in dict.fromkeys((c, c.upper(), c.lower()))]
    values = F.create_map(*(x for p in places for x in (F.lit(p), _filled(p, audience, rows))))
    filled = F.transform("_segments", lambda s: F.coalesce(F.try_element_at(F.col("_values"), s), s))
    return rows.withColumn("_values", values).select(*audience.columns, F.array_join(filled, "").alias("message"))

