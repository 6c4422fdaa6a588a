from support import by_key

from loanscope.operators import quality as Q
from loanscope.schema import CLEAN_SCHEMA, NUMERIC_COLUMNS, RAW_SCHEMA


def test_row_loss(golden_raw):
    assert [tuple(r) for r in Q.row_loss(golden_raw).collect()] == [
        ("required_filter", 13, 9, 4, 30.77),
        ("dedup_by_id", 9, 7, 2, 22.22),
        ("total", 13, 7, 6, 46.15),
    ]


def test_row_loss_of_nothing(spark):
    empty = spark.createDataFrame([], RAW_SCHEMA)
    assert {tuple(r)[1:] for r in Q.row_loss(empty).collect()} == {(0, 0, 0, 0.0)}


def test_row_loss_when_all_rows_fail(golden_raw):
    lost = golden_raw.where("loan_status IS NULL")
    assert tuple(by_key(Q.row_loss(lost), "step")["total"]) == ("total", 2, 0, 2, 100.0)


def test_completeness(golden_raw):
    got = by_key(Q.completeness(golden_raw), "column_name")
    assert len(got) == 24
    assert tuple(got["id"])[1:] == (11, 0.8462)
    assert tuple(got["annual_inc"])[1:] == (11, 0.8462)
    assert tuple(got["dti"])[1:] == (10, 0.7692)


def test_completeness_of_nothing(spark):
    got = Q.completeness(spark.createDataFrame([], RAW_SCHEMA)).collect()
    assert {tuple(r)[1:] for r in got} == {(0, None)}


def test_validation(golden_raw):
    got = {r["rule"]: r["violations"] for r in Q.validation_report(golden_raw).collect()}
    assert got == {
        **{f"unparsed_{c}": 0 for c in NUMERIC_COLUMNS},
        "missing_id": 2, "missing_loan_status": 2, "missing_annual_inc": 2, "missing_issue_d": 2,
        "unparsed_term": 1, "unparsed_int_rate": 1, "unparsed_emp_length": 1, "unparsed_revol_util": 0,
        "unparsed_issue_d": 1, "empty_input": 0, "empty_output": 0,
    }


def test_malformed_numbers_are_reported_and_kept(golden_raw):
    odd = golden_raw.replace({"50000.0": "50,000", "10000": "$9"}, subset=["annual_inc", "loan_amnt"])
    got = {r["rule"]: r["violations"] for r in Q.validation_report(odd).collect()}
    n_income, n_amount = (golden_raw.where(c).count() for c in ("annual_inc = '50000.0'", "loan_amnt = '10000'"))
    assert (got["unparsed_annual_inc"], got["unparsed_loan_amnt"], got["missing_annual_inc"]) == (n_income, n_amount, 2)
    assert [tuple(r)[1:3] for r in Q.row_loss(odd).collect()] == [tuple(r)[1:3] for r in Q.row_loss(golden_raw).collect()]


def test_validation_finds_empty_tables(spark, golden_raw):
    nothing = spark.createDataFrame([], RAW_SCHEMA)
    got = {r["rule"]: r["violations"] for r in Q.validation_report(nothing).collect()}
    assert (got["empty_input"], got["empty_output"], got["missing_id"]) == (1, 1, 0)
    lost = golden_raw.where("loan_status IS NULL")
    got = {r["rule"]: r["violations"] for r in Q.validation_report(lost).collect()}
    assert (got["empty_input"], got["empty_output"]) == (0, 1)


def test_output_validation(spark, golden_clean):
    assert {r["violations"] for r in Q.output_validation(golden_clean).collect()} == {0}
    bad = golden_clean.union(golden_clean.where("id = '1'")).selectExpr(
        *[c for c in CLEAN_SCHEMA.fieldNames() if c not in ("is_default", "annual_inc")],
        "2 * is_default AS is_default", "nullif(annual_inc, 33333.0) AS annual_inc",
    )
    got = {r["rule"]: r["violations"] for r in Q.output_validation(bad).collect()}
    assert got == {
        "missing_loan_status": 0, "missing_annual_inc": 1, "invalid_is_default": 3, "repeated_id": 1, "empty_output": 0,
    }
    empty = spark.createDataFrame([], CLEAN_SCHEMA)
    got = {r["rule"]: r["violations"] for r in Q.output_validation(empty).collect()}
    assert got["empty_output"] == 1 and sum(got.values()) == 1
