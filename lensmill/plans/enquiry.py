"""Membership enquiry responses: record extraction, comparison of two environments, search keys."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lensmill.functions.exprs import pad_right
from lensmill.operators.lines import changes

# Record layouts (fixed values): text before the field, name, pattern, width.
FIELDS: dict[str, list[tuple[str, str, str, int]]] = {
    "dep": [
        ("DEP~~", "policy_no", r"[0-9]{8}", 8),
        ("~", "member_no", r"[0-9]{8}", 8),
        ("~", "order", r"[A-Z]{1}", 1),
        ("~", "first", r"[A-Z\s]{24}", 24),
        ("~", "last", r"[A-Z\s]{20}", 20),
        ("~", "gender", r"[A-Z]{1}", 1),
        ("~", "dob", r"[0-9]{8}", 8),
        ("~", "status", r"[1-9A-Z]{1}", 1),
        ("~", "start_dt", r"[0-9]{8}", 8),
        ("~", "term_dt", r"[0-9\s]{8}", 8),
        ("~", "a_limit", r"[$\.0-9\s]{8}", 8),
        ("~", "o_limit", r"[$\.0-9\s]{8}", 8),
        ("~", "n_flag", r"[A-Z]{1}", 1),
        ("~", "l_boost", r"[$\.0-9\s]{8}", 8),
    ],
    "gaps": [
        ("GAPS~~", "member_no", r"[0-9]{8}", 8),
        ("~", "unknown", r"[0-9]{8}", 8),
        ("~", "space", r"[A-Z0-9\s]{1}", 1),
        ("~", "type", r"[A-Z0-9]{1}", 1),
        ("~", "date_fr", r"[0-9]{8}", 8),
        ("~", "date_to", r"[0-9]{8}", 8),
        ("~", "reason", r"[A-Z0-9]{13}", 13),
    ],
    "histc": [
        ("HISTC~~", "policy_no", r"[0-9]{8}", 8),
        ("~", "member_no", r"[0-9]{8}", 8),
        ("~", "data", r"[A-D]DATA", 5),
        ("~~", "line_no", r"[0-9]{5}", 5),
        ("~", "claim_no", r"[0-9]{5}", 5),
        ("~", "processed_dt", r"[0-9]{8}", 8),
        ("~", "location", r"[A-Z][0-9]{5}", 6),
        ("~", "provider", r"[A-Z0-9\s]{8}", 8),
        ("~", "a", r"[A-Z\s]{5}", 5),
        ("~", "item_code", r"[A-Z][0-9\s]{4}", 5),
        ("~", "service_dt", r"[0-9]{8}", 8),
        ("~", "cost", r"[\s$0-9\.]{8}", 8),
        ("~", "benefit", r"[\s$0-9\.]{8}", 8),
    ],
    "details": [
        ("DETAILS~~", "client", r"[0-9]{8}", 8),
        ("~", "customer", r"[0-9]{8}", 8),
        ("~", "suffix", r"[A-Z]{1}", 1),
        ("NAME~~", "title_code", r"[\s0-9]{2}", 2),
        ("~", "first", r"[A-Z\s]{24}", 24),
        ("~", "last", r"[A-Z\s]{20}", 20),
        ("~", "gender", r"[A-Z\s]{1}", 1),
        ("~", "dob", r"[0-9]{8}", 8),
        ("PHONE~~", "home_ph", r"[0-9\s]{15}", 15),
        ("~", "work_ph", r"[0-9\s]{15}", 15),
        ("HOME~~", "h_addr1", r"[0-9A-Z\s\-]{26}", 26),
        ("~", "h_addr2", r"[0-9A-Z\s\-]{26}", 26),
        ("~", "h_suburb", r"[0-9A-Z\s\-]{26}", 26),
        ("~", "h_pcode", r"[0-9\s]{6}", 6),
        ("~", "h_mail_ret_date", r"[0-9A-Z\s]{8}", 8),
        ("POST~~", "p_addr1", r"[0-9A-Z\s\-]{26}", 26),
        ("~", "p_addr2", r"[0-9A-Z\s\-]{26}", 26),
        ("~", "p_suburb", r"[0-9A-Z\s\-]{26}", 26),
        ("~", "p_pcode", r"[0-9\s]{6}", 6),
        ("~", "p_mail_ret_date", r"[0-9A-Z\s]{8}", 8),
        ("POLICY~~", "status", r"[A-Z\s]{1}", 1),
        ("~", "status_date", r"[0-9]{8}", 8),
        ("~", "eff_date", r"[0-9]{8}", 8),
        ("~", "scale", r"[A-Z\s]{1}", 1),
        ("~", "pay_method", r"[A-Z\s]{1}", 1),
        ("~", "pay_freq", r"[A-Z\s]{1}", 1),
        ("~", "enrolment_code", r"[0-9]{2}", 2),
        ("~", "waver_code", r"[0-9]{2}", 2),
        ("~", "id_ind", r"[A-Z\s]{1}", 1),
        ("~", "dte_on", r"[0-9]{8}", 8),
        ("~", "dte_payed_to", r"[0-9]{8}", 8),
        ("~", "state", r"[A-Z\s]{1}", 1),
        ("~", "card_no", r"[0-9]{2}", 2),
        ("~", "card_date_issued", r"[0-9]{8}", 8),
        ("PRODS~~", "p1", r"[0-9A-Z\s]{3}", 3),
        ("~", "p2", r"[0-9A-Z\s]{3}", 3),
        ("~", "p3", r"[0-9A-Z\s]{3}", 3),
        ("~", "p4", r"[0-9A-Z\s]{3}", 3),
        ("~", "p5", r"[0-9A-Z\s]{3}", 3),
        ("~", "p6", r"[A-Z\s]{8}", 8),
        ("~~", "group_dpt", r"[0-9]{8}", 8),
        ("~", "group_no", r"[0-9]{5}", 5),
        ("~", "sect_no", r"[0-9\s]{3}", 3),
        ("~", "user_resp", r"[0-9]{3}", 3),
    ],
}


@dataclass(frozen=True)
class Layout:
    """A fixed-width record: the pattern that finds it and where each field sits in it."""

    pattern: str
    places: dict[str, tuple[int, int]]

    def fields(self, record: str) -> list[Column]:
        return [F.substring(record, start, width).alias(name) for name, (start, width) in self.places.items()]


def _layout(fields: list[tuple[str, str, str, int]]) -> Layout:
    pattern, places, at = "", {}, 1
    for before, name, field, width in fields:
        pattern += before + field
        at += len(before)
        places[name] = (at, width)
        at += width
    return Layout(pattern, places)


LAYOUTS = {kind: _layout(fields) for kind, fields in FIELDS.items()}


def records(responses: DataFrame, kind: str) -> DataFrame:
    """Typed rows of one record kind from (response_id, env, body): one column per field.

    The pattern runs once per body; fields are cut by position.
    """
    layout = LAYOUTS[kind]
    found = F.regexp_extract_all("body", F.lit(layout.pattern), F.lit(0))
    rows = responses.select("response_id", "env", F.posexplode(found).alias("rec_no", "_record"))
    return rows.select("response_id", "env", "rec_no", *layout.fields("_record"))


def enquiry_records(responses: DataFrame) -> DataFrame:
    """All record kinds as (response_id, env, kind, rec_no, field_no, field, value), in one pass."""
    found = F.array(
        *(
            F.struct(
                F.lit(kind).alias("kind"),
                F.regexp_extract_all("body", F.lit(layout.pattern), F.lit(0)).alias("found"),
            )
            for kind, layout in LAYOUTS.items()
        )
    )
    rows = responses.select("response_id", "env", F.inline(found)).select(
        "response_id", "env", "kind", F.posexplode("found").alias("rec_no", "_record")
    )
    per_kind = None
    for kind, layout in LAYOUTS.items():
        cut = F.array(
            *(
                F.struct(F.lit(name).alias("field"), F.substring("_record", start, width).alias("value"))
                for name, (start, width) in layout.places.items()
            )
        )
        is_kind = F.col("kind") == kind
        per_kind = F.when(is_kind, cut) if per_kind is None else per_kind.when(is_kind, cut)
    fields = rows.select("response_id", "env", "kind", "rec_no", F.posexplode(per_kind).alias("field_no", "_f"))
    return fields.select("response_id", "env", "kind", "rec_no", "field_no", "_f.field", "_f.value")


def response_diff(
    responses: DataFrame, left: str = "prod", right: str = "test", aligned: bool = False
) -> DataFrame:
    """Lines that differ between two environments' responses, by line position.

    ``change`` is removed (only left), added (only right) or changed. ``aligned`` pairs equal lines wherever they
    stand, by line and how often it has occurred before, so a line put in at the top is one added line; line_no is
    then the place on the line's own side, and nothing is "changed". Only unequal bodies are taken apart.
    """

    def side(env: str, name: str) -> DataFrame:
        one = responses.filter(F.col("env") == env)
        return one.select("response_id", F.col("body").alias(name))

    pairs = side(left, "_left").join(side(right, "_right"), "response_id", "full_outer")
    unequal = pairs.filter(~F.col("_left").eqNullSafe(F.col("_right")))
    lines = unequal.select("response_id", *(F.split(c, "\r?\n").alias(c) for c in ("_left", "_right")))
    if aligned:
        found = F.concat(_unmatched("_left", "_right", "removed"), _unmatched("_right", "_left", "added"))
        return lines.select("response_id", F.inline(found))
    zipped = F.arrays_zip(*(F.coalesce(c, F.array().cast("array<string>")).alias(c) for c in ("_left", "_right")))
    sides = lines.select("response_id", F.posexplode(zipped).alias("line_no", "_of")).select(
        "response_id", "line_no", F.col("_of")["_left"].alias("left_line"), F.col("_of")["_right"].alias("right_line")
    )
    change = (
        F.when(F.col("right_line").isNull(), "removed")
        .when(F.col("left_line").isNull(), "added")
        .when(F.col("left_line") != F.col("right_line"), "changed")
    )
    return sides.select("response_id", "line_no", change.alias("change"), "left_line", "right_line").filter(
        "change is not null"
    )


def _unmatched(own: str, other: str, change: str) -> Column:
    """The own lines whose n-th occurrence the other side lacks, as (line_no, change, left_line, right_line)."""
    none = F.lit(None).cast("string")
    times = lambda lines, line: F.size(F.filter(lines, lambda x: x == line))
    there = F.coalesce(F.col(other), F.array().cast("array<string>"))
    here = F.coalesce(F.col(own), F.array().cast("array<string>"))
    places = F.transform(here, lambda line, i: F.struct(i.alias("line_no"), line.alias("line"), times(F.slice(here, 1, i + 1), line).alias("nth")))
    only = F.filter(places, lambda x: x["nth"] > times(there, x["line"]))
    sides = ("line", None) if own == "_left" else (None, "line")
    return F.transform(
        only,
        lambda x: F.struct(
            x["line_no"].alias("line_no"),
            F.lit(change).alias("change"),
            *((x["line"] if s else none).alias(n) for s, n in zip(sides, ("left_line", "right_line"), strict=True)),
        ),
    )


def response_alignment(responses: DataFrame, left: str = "prod", right: str = "test") -> DataFrame:
    """Lines that differ between two environments' responses, each paired in order with its like on the other side.

    ``change`` is removed, added, or moved (the line is on both sides, but not in the order of the others), with the
    line's place on either side. A response that only one environment has is all removed or all added. Unequal bodies are
    aligned in the task that holds them, in time near linear in their lines; nothing is shuffled but the bodies, once.
    """

    def side(env: str, name: str) -> DataFrame:
        return responses.filter(F.col("env") == env).select("response_id", F.col("body").alias(name))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                bodies = [batch.column(c)[k].as_py() for c in ("_left", "_right")]
                lines = [[] if b is None else re.split("\r?\n", b) for b in bodies]
                found = changes(*lines)
                columns = list(zip(*found, strict=True)) or [()] * 3
                texts = [[None if p is None else own[p] for p in at] for own, at in zip(lines, columns[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("response_id").take(pa.array([k] * len(found), pa.int64())),
                        pa.array(columns[0], pa.string()),
                        *(pa.array(at, pa.int32()) for at in columns[1:]),
                        *(pa.array(t, pa.string()) for t in texts),
                    ],
                    names=["response_id", "change", "left_no", "right_no", "left_line", "right_line"],
                )

    pairs = side(left, "_left").join(side(right, "_right"), "response_id", "full_outer")
    unequal = pairs.filter(~F.col("_left").eqNullSafe(F.col("_right")))
    key = responses.schema["response_id"].dataType.simpleString()
    return unequal.mapInArrow(
        run, f"response_id {key}, change string, left_no int, right_no int, left_line string, right_line string"
    )


# Enquiries keyed by one number, and which number that is (fixed values).
REQUEST_NUMBERS = {"DEP": "policy", "DETAILS": "policy", "HISTC": "policy", "HISTP": "member", "GAPS": "member"}


def request_keys(numbers: DataFrame, column: str, number: str = "member") -> DataFrame:
    """(number, request, request_key) for every row and enquiry that takes a ``member`` or ``policy`` number."""
    requests = [request for request, takes in REQUEST_NUMBERS.items() if takes == number]
    each = numbers.select(
        F.col(column).alias("number"), F.explode(F.array(*(F.lit(r) for r in requests))).alias("request")
    )
    return each.select("number", "request", F.concat("request", F.lit("~~"), "number").alias("request_key"))


def search_keys(patients: DataFrame, postcode: str = "~~~~") -> DataFrame:
    """The enquiry key of every patient: surname, initial and birth date (DDMMYYYY), padded with ``~``."""

    def padded(text: Column, width: int) -> Column:
        return pad_right(F.coalesce(text, F.lit("")), width)

    key = F.concat_ws(
        "~",
        F.lit("SEARCH~"),
        padded(F.col("SURNAME"), 20),
        padded(F.substring("GIVEN", 1, 1), 2),
        F.lit("D"),
        padded(F.date_format("BIRTHDATE", "ddMMyyyy"), 8),
        F.lit(postcode),
    )
    return patients.select("ID", key.alias("search_key"))
