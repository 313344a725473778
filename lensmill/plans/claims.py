"""Claim batches sent out and benefit report files coming back.

All functions take numbered lines (file, line_no, line) as ``sources.text.read_lines`` gives them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lensmill.functions.exprs import pad_left

# File and record patterns (fixed values of the exchange format).
REPORT_FILE = r"^(\d{12})-(A\d{6})-H20017-(\w*)\.txt"
CLAIM_RECORD = r"\d{8}\d{8}\d{3}\s{2}\d{6}\d{6}\d{6}\sA\d{6}\s{7}"
SUMMARY_CLAIM = r"^(\d+)\s*(\w)\s*(\d+)\s+(\d+)\s(\w+)\s+([\w/]+)\s+(\d+)\s+(.*)$"
SUMMARY_HEADING = r"^(\w+\s*\w*)\s:$"
SUMMARY_DETAIL = r"^\t{2}(\w+)\s:\s(.+)"
SUMMARY_FIELDS = [
    "member_no",
    "suffix",
    "item_code",
    "policy",
    "h_policy",
    "date_service",
    "benefit_paid",
    "message",
]

# More than the records of 56 characters that fit into a string of 2 GB.
POSITIONS_PER_LINE = 1 << 26

# Separates captured fields; the last field keeps any such character of its own.
MARK = "\u0001"

# Fixed-width fields of a claim record: name -> (1-based start, width).
CLAIM_LAYOUT = {
    "member": (1, 8),
    "reference": (9, 8),
    "code": (17, 3),
    "number_1": (22, 6),
    "number_2": (28, 6),
    "number_3": (34, 6),
    "provider": (41, 7),
}


def _found(lines: DataFrame) -> DataFrame:
    found = F.regexp_extract_all(F.concat("line", F.lit("\n")), F.lit(CLAIM_RECORD), F.lit(0))
    place = [c for c in ("path", "file", "line_no") if c in lines.columns]
    return lines.select(*place, F.posexplode(found).alias("pos", "record"))


def _fields(records: DataFrame) -> DataFrame:
    fields = (F.substring("record", start, width).alias(name) for name, (start, width) in CLAIM_LAYOUT.items())
    return records.select(*(c for c in records.columns if c != "record"), *fields, "record")


def claim_records(lines: DataFrame) -> DataFrame:
    """Every claim record with its place (line_no, pos): several may share a line.

    A record ends in seven blanks of which the last may be the line break, so that is put back first.
    """
    return _fields(_found(lines))


def claims_reordered(lines: DataFrame) -> DataFrame:
    """Records of each batch grouped by member in order of first appearance, latest number_2 first.

    A batch is a file; where lines carry their path, files of one name in two folders are two batches.

    The order is expressed as sort keys that end in the unique record position, so the sort can split a
    batch or member of any size; first appearances are found by aggregation, not over a window.
    """
    # Both uses below share one exchange, so the pattern runs once; it also splits a hot member. Fields are cut above it:
    # then both uses need the same columns of it.
    batch = [c for c in ("path", "file") if c in lines.columns]
    records = _fields(_found(lines).hint("rebalance"))
    # Line and position as one number, which unlike a struct can be aggregated in place.
    place = F.col("line_no").cast("decimal(20,0)") * POSITIONS_PER_LINE + F.col("pos")
    first = records.groupBy(*batch, "member").agg(F.min(place).alias("_first"))
    placed = records.join(first, [*batch, "member"]).select(
        *batch,
        F.expr(f"_first div {POSITIONS_PER_LINE}").alias("first_line"),
        F.expr(f"cast(_first % {POSITIONS_PER_LINE} as int)").alias("first_pos"),
        "member",
        "number_2",
        "line_no",
        "pos",
        "record",
    )
    return placed.orderBy(*batch, "first_line", "first_pos", F.desc("number_2"), "line_no", "pos")


def benefit_files(names: DataFrame, branches: DataFrame) -> DataFrame:
    """Catalogue of report files: branch ('' for an unknown provider), kind and pick-up time.

    ``names`` has a ``file`` column, one row per file; other file names are left out.
    """
    stamp, provider, kind = (F.regexp_extract("file", REPORT_FILE, i) for i in (1, 2, 3))

    def digits(start: int, width: int) -> Column:
        return F.substring("_stamp", start, width).cast("int")

    picked = F.try_make_timestamp_ntz(
        digits(5, 4), digits(3, 2), digits(1, 2), digits(9, 2), digits(11, 2), F.lit(0)
    )
    parsed = (
        names.filter(F.col("file").rlike(REPORT_FILE))
        .select("file", stamp.alias("_stamp"), provider.alias("provider"), kind.alias("kind"))
        .withColumn("picked_at", picked)
    )
    codes = branches.select(F.col("code").alias("_branch"), F.col("provider_code").alias("provider"))
    return parsed.join(codes, "provider", "left").select(
        "file", "provider", F.coalesce("_branch", F.lit("")).alias("branch"), "kind", "picked_at"
    )


def files_for_branch(names: DataFrame, branches: DataFrame) -> DataFrame:
    """(code, file) where the file name contains the branch's provider code anywhere, whatever its shape.

    Every part of a name that is as long as some code is matched by equality, so no name is compared with every
    branch. The distinct lengths of the codes are read first. An empty code, which any name contains, names no file.
    """
    length = F.length("provider_code").alias("n")
    lengths = sorted(r.n for r in branches.select(length).where("n >= 1").distinct().collect())
    if not lengths:
        return names.select(F.lit("").alias("code"), "file").limit(0)

    def parts(n: int) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.length("file") - n + 1, F.lit(1)))
        return F.transform(starts, lambda i: F.substring("file", i, F.lit(n)))

    every = F.array_distinct(F.concat(*map(parts, lengths)))
    coded = names.select("file", F.explode(every).alias("provider_code"))
    return branches.select("code", "provider_code").join(coded, "provider_code").select("code", "file")


def member_names(patients: DataFrame) -> DataFrame:
    """One name per member number: that of the lowest patient ID."""
    name = F.concat_ws(" ", "TITLE", "GIVEN", "SURNAME")
    return (
        patients.filter("MEMBER_NUMBER is not null")
        .groupBy(F.col("MEMBER_NUMBER").alias("_member"))
        .agg(F.min_by(name, "ID").alias("name"))
    )


def _provider() -> Column:
    return F.regexp_extract("file", REPORT_FILE, 2)


def is_summary(providers: list[str] | None = None) -> Column:
    """Condition on ``file``: a summary report, of these providers if given. On a file scan it prunes the files read."""
    summary = F.regexp_extract("file", REPORT_FILE, 3) == "SummaryReport"
    return summary if providers is None else summary & _provider().isin(providers)


def benefit_summary(lines: DataFrame, branches: DataFrame, patients: DataFrame) -> DataFrame:
    """Summary report files as rows: claims with the member's name, headings and details.

    Line 1 is a title. A line is a claim, else a heading, else a detail, else left out.
    """
    # The catalogue needs only file names; deriving them per line avoids a second pass over the text.
    body = lines.filter(is_summary()).filter("line_no > 1").withColumn("_provider", _provider())
    # One pass both recognises a claim and separates its fields: the line changes only if it matches.
    marks = MARK.join(f"${i}" for i in range(1, len(SUMMARY_FIELDS) + 1))
    body = body.withColumn("_cut", F.regexp_replace("line", SUMMARY_CLAIM, marks))
    entry = (
        F.when(F.col("_cut") != F.col("line"), "claim")
        .when(F.col("line").rlike(SUMMARY_HEADING), "heading")
        .when(F.col("line").rlike(SUMMARY_DETAIL), "detail")
    )
    typed = body.withColumn("entry", entry).filter("entry is not null")
    claim = F.when(F.col("entry") == "claim", F.split("_cut", MARK, len(SUMMARY_FIELDS)))
    rows = typed.select(
        "file",
        "_provider",
        "line_no",
        "entry",
        claim.alias("_claim"),
        F.when(F.col("entry") == "heading", F.regexp_extract("line", SUMMARY_HEADING, 1)).alias("heading"),
        F.when(F.col("entry") == "detail", F.regexp_extract("line", SUMMARY_DETAIL, 1)).alias("detail_key"),
        F.when(F.col("entry") == "detail", F.regexp_extract("line", SUMMARY_DETAIL, 2)).alias("detail_value"),
    ).withColumns({name: F.get("_claim", F.lit(i)) for i, name in enumerate(SUMMARY_FIELDS)})
    codes = branches.select(F.col("code").alias("_branch"), F.col("provider_code").alias("_provider"))
    # Lines without a member get keys of their own that match nothing, so they do not meet in one task.
    key = F.coalesce(pad_left(F.col("member_no"), 8), F.concat(F.lit("line "), F.col("line_no")))
    named = rows.withColumn("_member", key).join(member_names(patients), "_member", "left")
    return named.join(codes, "_provider", "left").select(
        "file",
        F.coalesce("_branch", F.lit("")).alias("branch"),
        "line_no",
        "entry",
        "name",
        *SUMMARY_FIELDS,
        "heading",
        "detail_key",
        "detail_value",
    )


def benefit_summary_by_branch(
    lines: DataFrame, branches: DataFrame, patients: DataFrame, branch: str
) -> DataFrame:
    """The summary of one branch. Its provider code is looked up first and becomes a filter on file names, so the lines
    of other files are not parsed. With lines from files, filter by ``is_summary`` before numbering them: then other
    files are not even opened."""
    own = branches.filter(F.col("code") == branch)
    providers = [r.provider_code for r in own.select("provider_code").distinct().collect()]
    return benefit_summary(lines.filter(is_summary(providers)), own, patients)
