"""Error lists handed over as JSON text, and the report written from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.dates import second_text

# Fields of an error and their labels in the report, the stand-in for a
# missing field, and the report's frame.
ERROR_FIELDS = (
    ("SchemaName", "Schema"),
    ("ProcedureName", "Procedure"),
    ("Status", "Status"),
    ("ErrorMessage", "Error Msg"),
    ("StartTime", "Start Time"),
    ("EndTime", "End Time"),
)
MISSING = "N/A"
NULL_TEXT = "None"
LABEL_WIDTH = 14
DOUBLE_RULE = "=" * 65
SINGLE_RULE = "-" * 65
TITLE = "  🔴 FABRIC PIPELINE ALERT — Execution Errors Detected"
CLOSING = "  ⚡ Action Required: Check the procedures listed above."


def parsed_errors(text: Column) -> Column:
    """The text as an array of field maps; NULL for empty, invalid or non-array text.

    Maps, not a struct: a field that is absent and one that is null are told apart. White space of
    any kind may stand around the list, but no other text. from_json stops reading after the first
    value, so the list is read within an object and within an array: what follows it would have to
    end both, which no text can.
    """
    trimmed = F.regexp_replace(text, r"^\s+|\s+$", "")
    strict = {"allowSingleQuotes": "false"}
    held = F.from_json(F.concat(F.lit('{"v":'), trimmed, F.lit("}")), "v array<map<string,string>>", strict)["v"]
    alone = F.from_json(F.concat(F.lit("["), trimmed, F.lit("]")), "array<array<map<string,string>>>", strict)
    return F.when(trimmed.startswith("[") & (F.size(alone) == 1) & F.try_element_at(alone, F.lit(1)).isNotNull(), held)


def _field(error: Column, name: str) -> Column:
    value = F.coalesce(F.try_element_at(error, F.lit(name)), F.lit(NULL_TEXT))
    return F.when(F.map_contains_key(error, name), value).otherwise(MISSING)


def error_rows(df: DataFrame, text: str, *keep: str) -> DataFrame:
    """One row per listed error, numbered from 1, with the ``keep`` columns of its list."""
    return df.select(*keep, F.posexplode(parsed_errors(F.col(text))).alias("pos", "error")).select(
        *keep,
        (F.col("pos") + 1).alias("error_no"),
        *[_field(F.col("error"), name).alias(name) for name, _ in ERROR_FIELDS],
    )


def error_reports(df: DataFrame, text: str, as_of: Column, *keep: str) -> DataFrame:
    """The report on each list of errors, NULL where there is none to report.

    Built from array functions within the row: nothing is exploded or grouped. The text is
    parsed in a step of its own, or each mention of the errors would parse it again.
    """
    errors = F.col("_errors")

    def block(error: Column, index: Column) -> Column:
        lines = [F.format_string("  Error #%d", index + 1)]
        lines += [
            F.concat(F.lit(f"  {label + ':':<{LABEL_WIDTH}}"), _field(error, name))
            for name, label in ERROR_FIELDS
        ]
        return F.concat_ws("\n", *lines, F.lit(SINGLE_RULE), F.lit("\n"))

    header = F.concat(
        F.lit(f"{DOUBLE_RULE}\n{TITLE}\n{DOUBLE_RULE}\n\n"),
        F.lit(f"  {'Timestamp:':<{LABEL_WIDTH}}"),
        second_text(as_of),
        F.lit(f"\n  {'Total Errors:':<{LABEL_WIDTH}}"),
        F.size(errors).cast("string"),
        F.lit(f"\n\n{SINGLE_RULE}\n\n"),
    )
    blocks = F.array_join(F.transform(errors, block), "")
    report = F.concat(header, blocks, F.lit(f"{CLOSING}\n{DOUBLE_RULE}\n"))
    return df.select(*keep, parsed_errors(F.col(text)).alias("_errors")).select(
        *keep, F.when(F.size(errors) > 0, report).alias("report")
    )
