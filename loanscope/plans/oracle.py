"""The same results in standard SQL, for comparison on the same tables."""

from loanscope.plans.loan_view import LOAN_EXPRESSIONS, REPEATED, UPDATED
from loanscope.plans.stand_ins import DAMAGE, FILE_COLUMNS, LATER
from loanscope.schema import CLEAN_COLUMNS, NUMERIC_COLUMNS, SELECTED_COLUMNS, STATISTIC_COLUMNS, TEXT_COLUMNS

_SELECTED = ", ".join(SELECTED_COLUMNS)
_CLEAN = ", ".join(CLEAN_COLUMNS)
_VIEW = ", ".join(f"{e} AS {c}" for c, e in LOAN_EXPRESSIONS.items())

_INTEGER = "TRY_CAST(regexp_extract({0}, '(\\d+)', 1) AS INTEGER)"
_DECIMAL = "TRY_CAST(regexp_extract({0}, '([\\d.]+)', 1) AS DOUBLE)"
_EMP_LENGTH = (
    "CASE WHEN contains(emp_length, '10+') THEN 10 WHEN contains(emp_length, '< 1') THEN 0 "
    f"ELSE {_INTEGER.format('emp_length')} END"
)
_ISSUE_DATE = "CAST(try_strptime(issue_d, '%b-%Y') AS DATE)"

_NUMBER = {c: f"TRY_CAST({c} AS DOUBLE)" for c in NUMERIC_COLUMNS}
# Copies of a loan in the order of a digest: the lengths of all values, then the values, numbers as doubles.
_DIGESTED = [f"CAST({_NUMBER[c]} AS VARCHAR)" if c in _NUMBER else c for c in SELECTED_COLUMNS if c != "id"]
_DIGEST = f"md5(concat_ws('|', {', '.join([*(f'coalesce(strlen({t}), -1)' for t in _DIGESTED), *_DIGESTED])}))"

_REPLACED = {
    **_NUMBER,
    "term": _INTEGER.format("term"),
    "int_rate": _DECIMAL.format("int_rate"),
    "revol_util": _DECIMAL.format("revol_util"),
    "emp_length": _EMP_LENGTH,
    "issue_d": _ISSUE_DATE,
    **{c: f"upper(trim({c}))" for c in TEXT_COLUMNS},
}
_DERIVED = {
    "is_default": "CAST(CASE WHEN loan_status IN ('Charged Off', 'Default') THEN 1 ELSE 0 END AS INTEGER)",
    "fico_avg": f"CAST(round(({_NUMBER['fico_range_low']} + {_NUMBER['fico_range_high']}) / 2, 0) AS INTEGER)",
    "income_to_loan_ratio": f"CASE WHEN {_NUMBER['loan_amnt']} > 0 THEN round({_NUMBER['annual_inc']} / {_NUMBER['loan_amnt']}, 2) END",
    "year": f"CAST(year({_ISSUE_DATE}) AS INTEGER)",
}
_FEATURES = ", ".join(
    [f"{_REPLACED.get(c, c)} AS {c}" for c in SELECTED_COLUMNS] + [f"{e} AS {c}" for c, e in _DERIVED.items()]
)

_WITH = f"""
WITH base AS (
  SELECT o_orderkey AS k, o_orderdate AS d, *
  FROM orders JOIN customer ON o_custkey = c_custkey
), loans AS (
  SELECT {_VIEW} FROM (
    SELECT *, 0 AS copy FROM base
    UNION ALL
    SELECT *, 1 AS copy FROM base WHERE {REPEATED}
    UNION ALL
    SELECT *, 2 AS copy FROM base WHERE {UPDATED} AND NOT {REPEATED}
  )
), required AS (
  SELECT * FROM loans
  WHERE loan_status IS NOT NULL AND annual_inc IS NOT NULL AND issue_d IS NOT NULL
), deduped AS (
  SELECT * EXCLUDE (rn)
  FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY {_DIGEST}) AS rn FROM required)
  WHERE rn = 1
), clean AS (
  SELECT {_FEATURES} FROM deduped
), faulty AS (
  SELECT * REPLACE (CASE WHEN grade = 'C' THEN 2 ELSE is_default END AS is_default) FROM (SELECT {_FEATURES} FROM loans)
)
"""


_OLD = f"""
, required_old AS (
  SELECT * FROM required WHERE NOT {LATER}
), deduped_old AS (
  SELECT * EXCLUDE (rn)
  FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY {_DIGEST}) AS rn FROM required_old)
  WHERE rn = 1
), clean_old AS (
  SELECT {_FEATURES} FROM deduped_old
), changed AS (
  SELECT year FROM (SELECT * FROM clean EXCEPT ALL SELECT * FROM clean_old)
  UNION
  SELECT year FROM (SELECT * FROM clean_old EXCEPT ALL SELECT * FROM clean)
)
"""


def _sql(query: str) -> str:
    return _WITH + query


def _union(parts) -> str:
    return " UNION ALL ".join(parts)


_RAW = _sql(f"SELECT {_SELECTED} FROM loans")
# An empty string comes back from CSV as NULL.
_RAW_FROM_CSV = _sql(f"SELECT * REPLACE (nullif(revol_util, '') AS revol_util) FROM (SELECT {_SELECTED} FROM loans)")
_RAW_INFERRED = _sql(
    "SELECT * REPLACE (CAST(id AS INTEGER) AS id, nullif(revol_util, '') AS revol_util) "
    f"FROM (SELECT {_SELECTED} FROM loans)"
)
_CLEAN_ROWS = _sql(f"SELECT {_CLEAN} FROM clean")
_PCT = "round(100.0 * n / (SELECT count(*) FROM clean), 2) AS pct"


def _file_digest(table: str, columns: list[str]) -> str:
    """Rows and content of a table that is one file: the first 60 bits of the MD5 of each row, summed up."""
    values = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '~')" for c in columns)
    return (
        f"SELECT '{table}.parquet' AS file_name, 'valid' AS status, count(*) AS n_rows, "
        f"CAST(sum(CAST(concat('0x', substr(md5(concat_ws('|', {values})), 1, 15)) AS BIGINT)) AS VARCHAR) AS digest FROM {table}"
    )


def _type(c: str) -> str:
    """The type of a column of text: of the kinds of its values, the widest if these are numbers, text if they mix."""
    kind = (
        f"CASE WHEN regexp_full_match({c}, '[+-]?\\d{{1,18}}') THEN "
        f"CASE WHEN CAST({c} AS BIGINT) BETWEEN -2147483648 AND 2147483647 THEN 'int' ELSE 'bigint' END "
        f"WHEN regexp_full_match({c}, '[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?') THEN 'double' "
        f"WHEN regexp_full_match({c}, '\\d{{4}}-\\d{{2}}-\\d{{2}}') AND TRY_CAST({c} AS DATE) IS NOT NULL THEN 'date' "
        f"WHEN lower({c}) IN ('true', 'false') THEN 'boolean' ELSE 'string' END"
    )
    kinds = f"(SELECT list(DISTINCT {kind}) FROM loans WHERE {c} <> '')"
    return (
        f"SELECT '{c}' AS column_name, CASE WHEN len(k) = 1 THEN k[1] WHEN list_has_all(['int', 'bigint'], k) THEN 'bigint' "
        f"WHEN list_has_all(['int', 'bigint', 'double'], k) THEN 'double' ELSE 'string' END AS type FROM (SELECT {kinds} AS k)"
    )


def _feature(*columns: str) -> str:
    return _sql(f"SELECT id, {', '.join(columns)} FROM clean")


def _counts(key: str) -> str:
    return f"(SELECT {key}, count(*) AS n FROM clean GROUP BY {key})"


def _top10(key: str) -> str:
    return f"(SELECT * FROM {_counts(key)} WHERE {key} IS NOT NULL ORDER BY n DESC, {key} LIMIT 10)"


def _stats(column: str, deviation: bool = False) -> str:
    extra = f", round(stddev_samp({column}), 4) AS stddev" if deviation else ""
    return _sql(
        f"SELECT CAST(min({column}) AS DOUBLE) AS min, CAST(max({column}) AS DOUBLE) AS max, "
        f"round(avg({column}), 4) AS mean, round(median({column}), 4) AS median{extra} FROM clean"
    )


def _describe(c: str) -> str:
    return (
        f"'{c}' AS column_name, count({c}) AS n, round(avg({c}), 4) AS mean, "
        f"round(stddev_samp({c}), 4) AS stddev, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max"
    )


def _quartiles(c: str) -> str:
    return ", ".join(
        f"round(quantile_cont(CAST({c} AS DOUBLE), {p}), 4) AS {q}"
        for p, q in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))
    )


_LABELS = """
  CASE WHEN r > 0 THEN 'positive' WHEN r IS NOT NULL THEN 'negative' END AS direction,
  CASE WHEN abs(r) > 0.3 THEN 'strong' WHEN abs(r) > 0.1 THEN 'moderate' WHEN r IS NOT NULL THEN 'weak' END AS strength
"""


def _correlation(c: str) -> str:
    return (
        f"SELECT '{c}' AS column_name, CASE WHEN isnan(r) THEN NULL ELSE r END AS r "
        f"FROM (SELECT corr({c}, is_default) AS r FROM clean)"
    )


_CORRELATIONS = _union(_correlation(c) for c in STATISTIC_COLUMNS)


def _loss(step: str, before: str, after: str) -> str:
    return (
        f"SELECT '{step}' AS step, {before} AS rows_before, {after} AS rows_after, {before} - {after} AS removed, "
        f"round(100.0 * ({before} - {after}) / {before}, 2) AS pct_removed "
        "FROM (SELECT (SELECT count(*) FROM loans) AS a, (SELECT count(*) FROM required) AS b, "
        "(SELECT count(*) FROM deduped) AS c)"
    )


def _violations(table: str, rules: dict[str, str]) -> str:
    return _sql(
        _union(f"SELECT '{name}' AS rule, {count} AS violations FROM {table}" for name, count in rules.items())
    )


def _count(condition: str) -> str:
    return f"count(*) FILTER (WHERE {condition})"


_INPUT_RULES = {
    **{f"missing_{c}": _count(f"{c} IS NULL") for c in ("id", "loan_status", "annual_inc", "issue_d")},
    **{
        f"unparsed_{c}": _count(f"{c} <> '' AND ({_REPLACED[c]}) IS NULL")
        for c in (*NUMERIC_COLUMNS, "term", "int_rate", "emp_length", "revol_util", "issue_d")
    },
    "empty_input": "CAST(count(*) = 0 AS BIGINT)",
    "empty_output": f"CAST({_count('loan_status IS NOT NULL AND annual_inc IS NOT NULL AND issue_d IS NOT NULL')} = 0 "
    "AS BIGINT)",
}
_OUTPUT_RULES = {
    "missing_loan_status": _count("loan_status IS NULL"),
    "missing_annual_inc": _count("annual_inc IS NULL"),
    "invalid_is_default": _count("is_default IS NULL OR is_default NOT IN (0, 1)"),
    "repeated_id": "count(*) - (SELECT count(*) FROM (SELECT DISTINCT id FROM faulty))",
    "empty_output": "CAST(count(*) = 0 AS BIGINT)",
}

# The loans of the damaged files by what is done to them; of an empty value nothing comes back.
_DAMAGED = "SELECT *, coalesce(TRY_CAST(loan_amnt AS BIGINT), 0) AS amount FROM loans"
_KIND = "CASE " + " ".join(f"WHEN {when} THEN '{name}'" for name, when in DAMAGE.items()) + " ELSE 'none' END"

ORACLE_SQL: dict[str, str] = {
    "scan_csv": _RAW_FROM_CSV,
    "scan_csv_split": _RAW_FROM_CSV,
    "scan_csv_inferred": _RAW_INFERRED,
    "scan_processed": _CLEAN_ROWS,
    "scan_year_partition": _sql(f"SELECT {_CLEAN} FROM clean WHERE year = 1997"),
    "csv_roundtrip": _RAW_FROM_CSV,
    "orc_roundtrip": _RAW,
    "json_roundtrip": _RAW,
    "parquet_roundtrip": _RAW,
    "partitioned_roundtrip": _CLEAN_ROWS,
    "select_columns": _RAW,
    "required_filter": _sql(f"SELECT {_SELECTED} FROM required"),
    "dedup_by_id": _sql(f"SELECT {_SELECTED} FROM deduped"),
    "parse_term": _feature("term"),
    "parse_int_rate": _feature("int_rate"),
    "parse_revol_util": _feature("revol_util"),
    "parse_emp_length": _feature("emp_length"),
    "parse_issue_date": _feature("issue_d"),
    "default_flag": _feature("is_default"),
    "fico_avg": _feature("fico_avg"),
    "income_to_loan_ratio": _feature("income_to_loan_ratio"),
    "issue_year": _feature("year"),
    "normalize_text": _feature(*TEXT_COLUMNS),
    "clean_loans": _CLEAN_ROWS,
    "preview": _sql(
        "SELECT id, loan_amnt, int_rate, grade, is_default, fico_avg, year FROM clean ORDER BY id NULLS FIRST LIMIT 5"
    ),
    "row_count": _sql("SELECT count(*) AS n FROM clean"),
    "row_loss": _sql(
        _union([_loss("required_filter", "a", "b"), _loss("dedup_by_id", "b", "c"), _loss("total", "a", "c")])
    ),
    "default_distribution": _sql(f"SELECT is_default, n, {_PCT} FROM {_counts('is_default')} ORDER BY is_default"),
    "year_distribution": _sql(f"SELECT year, n FROM {_counts('year')} ORDER BY year"),
    "grade_distribution": _sql(f"SELECT grade, n FROM {_counts('grade')} ORDER BY grade"),
    "grade_top10": _sql(f"SELECT grade, n, {_PCT} FROM {_top10('grade')} ORDER BY grade"),
    "purpose_top10": _sql(
        "SELECT CAST(row_number() OVER (ORDER BY n DESC, purpose) AS INTEGER) AS rank, purpose, n, "
        f"{_PCT} FROM {_top10('purpose')} ORDER BY rank"
    ),
    "numeric_describe": _sql(_union(f"SELECT {_describe(c)} FROM clean" for c in STATISTIC_COLUMNS)),
    "key_metrics": _sql(
        "SELECT min(loan_amnt) AS min_loan, max(loan_amnt) AS max_loan, round(avg(loan_amnt), 4) AS avg_loan, "
        "round(avg(int_rate), 4) AS avg_int_rate, round(avg(fico_avg), 4) AS avg_fico FROM clean"
    ),
    "distinct_years": _sql("SELECT DISTINCT year FROM clean"),
    "year_coverage": _sql(
        "SELECT min(year) AS min_year, max(year) AS max_year, count(DISTINCT year) AS n_years FROM clean"
    ),
    "loan_amnt_stats": _stats("loan_amnt", deviation=True),
    "int_rate_stats": _stats("int_rate"),
    "fico_stats": _stats("fico_avg"),
    "numeric_quartiles": _sql(
        _union(f"SELECT '{c}' AS column_name, {_quartiles(c)} FROM clean" for c in STATISTIC_COLUMNS)
    ),
    "default_correlations": _sql(f"SELECT column_name, round(r, 6) AS corr, {_LABELS} FROM ({_CORRELATIONS})"),
    "default_rate": _sql("SELECT coalesce(round(avg(is_default) * 100, 2), 0) AS default_rate_pct FROM clean"),
    "portfolio_summary": _sql(
        f"SELECT d.*, round(r, 6) AS corr, {_LABELS} FROM ("
        + _union(f"SELECT {_describe(c)}, {_quartiles(c)} FROM clean" for c in STATISTIC_COLUMNS)
        + f") d JOIN ({_CORRELATIONS}) USING (column_name)"
    ),
    "completeness": _sql(
        _union(
            f"SELECT '{c}' AS column_name, count({c}) AS n_non_null, round(count({c}) / count(*), 4) AS rate FROM loans"
            for c in SELECTED_COLUMNS
        )
    ),
    "validation_report": _violations("loans", _INPUT_RULES),
    "output_validation": _violations("faulty", _OUTPUT_RULES),
    "input_check": _union(_file_digest(t, columns) for t, columns in FILE_COLUMNS.items()),
    "column_types": _sql(_union(_type(c) for c in SELECTED_COLUMNS)),
    "compacted_rows": _RAW_FROM_CSV,
    "compacted_listing": _sql("SELECT count(*) AS n_rows, TRUE AS several_files, TRUE AS sizes_in_bounds FROM loans"),
    "incremental_years": _CLEAN_ROWS,
    "refreshed_years": _sql(
        f"{_OLD} SELECT coalesce(y, -1) AS year, bool_or(hit IS NOT NULL) AS rewritten "
        "FROM (SELECT DISTINCT year AS y FROM clean) LEFT JOIN (SELECT *, TRUE AS hit FROM changed) c ON y IS NOT DISTINCT FROM c.year GROUP BY 1"
    ),
    "sketch_quartiles": _sql(
        _union(
            f"SELECT '{c}' AS column_name, CAST({p} AS DOUBLE) AS probability, TRUE AS within_bound FROM clean HAVING count({c}) > 0"
            for c in STATISTIC_COLUMNS for p in (0.25, 0.5, 0.75)
        )
    ),
    "merged_summary": _sql(
        f"SELECT d.*, round(r, 6) AS corr, {_LABELS} FROM ("
        + _union(f"SELECT {_describe(c)} FROM clean" for c in STATISTIC_COLUMNS)
        + f") d JOIN ({_CORRELATIONS}) USING (column_name)"
    ),
    "merged_top10": _sql(
        "SELECT CAST(row_number() OVER (ORDER BY n DESC, purpose) AS INTEGER) AS rank, purpose, n, "
        f"{_PCT} FROM {_top10('purpose')} ORDER BY rank"
    ),
    "merged_years": _sql(f"SELECT year, n FROM {_counts('year')} ORDER BY year"),
    "malformed_records": _sql(
        "SELECT rule, count(kind) AS records FROM (VALUES ('none'), ('too_short'), ('too_long'), ('unclosed')) r(rule) "
        f"LEFT JOIN (SELECT {_KIND} AS kind FROM ({_DAMAGED})) ON kind = rule GROUP BY rule"
    ),
    "well_formed_rows": _sql(
        f"SELECT {', '.join(f'nullif({c}, {chr(39) * 2}) AS {c}' for c in SELECTED_COLUMNS)} FROM ({_DAMAGED}) WHERE {_KIND} = 'none'"
    ),
    "input_rows": _union(f"SELECT '{t}.parquet' AS file_name, count(*) AS n_rows FROM {t}" for t in ("orders", "customer")),
    "run_summary": _sql(f"SELECT count(*) AS n_rows, CAST({len(CLEAN_COLUMNS)} AS INTEGER) AS n_columns, 'loans' AS source FROM clean"),
    "phase_rows": _sql(
        "SELECT 'extract' AS phase, count(*) AS rows FROM loans UNION ALL "
        + _union(f"SELECT '{phase}' AS phase, count(*) AS rows FROM clean" for phase in ("transform", "load", "report"))
    ),
    "output_listing": _sql(
        "SELECT count(*) AS n_rows, TRUE AS several_files, TRUE AS all_files_csv, TRUE AS main_file_is_largest FROM loans"
    ),
    "broadcast_join": (
        "SELECT o_orderkey, c_name, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey"
    ),
}
