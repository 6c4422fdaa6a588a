"""Random raw tables with hot keys, checked against a plain Python account of the rules."""

import hashlib
import random
import re
from collections import Counter
from datetime import datetime

import pytest
from support import by_key, rows

from loanscope.operators import quality as Q
from loanscope.operators import reports as R
from loanscope.operators.cleaning import clean_loans
from loanscope.schema import CLEAN_COLUMNS, NUMERIC_COLUMNS, RAW_SCHEMA, SELECTED_COLUMNS, TEXT_COLUMNS

TEXTS = {
    "term": [" 36 months", "60", "n/a", "", None, "7 of 36"],
    "int_rate": ["13.99%", "7.5", ".5", "1.2.3", "", None, "5.%"],
    "revol_util": ["29.7%", "0%", "", None, "abc"],
    "emp_length": ["10+ years", "< 1 year", "1 year", "9 years", "n/a", "", None, "2 to 10+"],
    "issue_d": ["Dec-2015", "Jan-2018", "2015-12-01", "", None, "Foo-2015"],
    "loan_status": ["Charged Off", " Charged Off", "Default", "Fully Paid", "charged off", None],
    "grade": ["A", " b ", "", None, "a"],
    "purpose": ["car"] * 6 + [" Small_Business ", "wedding", None],
}
NUMBERS = ["0", "-5.0", "1.0", "664", "665.0", "7000", "33333.0", "7e3", "50,000", "$9", "", None]


def random_rows(seed, n=600):
    rng = random.Random(seed)

    def row():
        kind = rng.random()
        key = None if kind < 0.33 else "hot" if kind < 0.5 else str(rng.randrange(80))
        return tuple(
            key if f.name == "id"
            else rng.choice(NUMBERS) if f.name in NUMERIC_COLUMNS
            else rng.choice(TEXTS.get(f.name, ["x", " Y "]))
            for f in RAW_SCHEMA
        )

    return [row() for _ in range(n)]


def number(text):
    try:
        return float(text)
    except (TypeError, ValueError):
        return None


def is_complete(raw):
    r = dict(zip(SELECTED_COLUMNS, raw))
    return None not in (r["loan_status"], r["annual_inc"], r["issue_d"])


def place(raw):
    """Order of copies: a digest of the lengths of all values, then the values, numbers as doubles."""
    r = dict(zip(SELECTED_COLUMNS, raw))
    r |= {c: None if number(r[c]) is None else str(number(r[c])) for c in NUMERIC_COLUMNS}
    texts = [r[c] for c in SELECTED_COLUMNS if c != "id"]
    lengths = [str(-1 if t is None else len(t.encode())) for t in texts]
    return hashlib.md5("|".join([*lengths, *(t for t in texts if t is not None)]).encode()).digest()


def clean_by_hand(raw):
    r = dict(zip(SELECTED_COLUMNS, raw))
    r |= {c: number(r[c]) for c in NUMERIC_COLUMNS}

    def digits(text):
        found = re.search(r"\d+", text or "")
        return int(found.group()) if found else None

    def decimal(text):
        found = re.search(r"[\d.]+", text or "")
        try:
            return float(found.group()) if found else None
        except ValueError:
            return None

    def month(text):
        try:
            return datetime.strptime(text, "%b-%Y").date()
        except ValueError:
            return None

    def half_up(value, places=0):
        scale = 10**places
        return int(abs(value) * scale + 0.5 + 1e-9) / scale * (1 if value >= 0 else -1)

    out = dict(r)
    out["is_default"] = int(r["loan_status"] in ("Charged Off", "Default"))
    years = r["emp_length"] or ""
    out["emp_length"] = 10 if "10+" in years else 0 if "< 1" in years else digits(years)
    out["term"] = digits(r["term"])
    out["int_rate"], out["revol_util"] = decimal(r["int_rate"]), decimal(r["revol_util"])
    out["issue_d"] = month(r["issue_d"])
    out["year"] = out["issue_d"].year if out["issue_d"] else None
    low, high = r["fico_range_low"], r["fico_range_high"]
    out["fico_avg"] = None if low is None or high is None else int(half_up((low + high) / 2))
    positive = r["loan_amnt"] is not None and r["loan_amnt"] > 0
    known = positive and r["annual_inc"] is not None
    out["income_to_loan_ratio"] = half_up(r["annual_inc"] / r["loan_amnt"], 2) if known else None
    for c in TEXT_COLUMNS:
        out[c] = None if r[c] is None else r[c].strip(" ").upper()
    return tuple(out[c] for c in CLEAN_COLUMNS)


@pytest.fixture(scope="module", params=[1, 2, 3])
def case(request, spark):
    raw = random_rows(request.param)
    kept = [r for r in raw if is_complete(r)]
    smallest = {}
    for r in kept:
        if r[0] not in smallest or place(r) < place(smallest[r[0]]):
            smallest[r[0]] = r
    df = spark.createDataFrame(raw, RAW_SCHEMA).repartition(5)
    return raw, kept, [clean_by_hand(r) for r in smallest.values()], df


def test_clean_table(case):
    _, _, expected, df = case
    assert rows(clean_loans(df)) == sorted(expected, key=repr)


def test_cleaning_is_repeatable(case):
    df = case[3]
    assert rows(clean_loans(df)) == rows(clean_loans(df.repartition(2)))


def test_row_loss_adds_up(case):
    raw, kept, expected, df = case
    got = by_key(Q.row_loss(df), "step")
    assert tuple(got["required_filter"])[1:4] == (len(raw), len(kept), len(raw) - len(kept))
    assert tuple(got["dedup_by_id"])[1:4] == (len(kept), len(expected), len(kept) - len(expected))
    assert got["total"]["removed"] == got["required_filter"]["removed"] + got["dedup_by_id"]["removed"]


def test_output_is_valid(case):
    _, _, expected, df = case
    unreadable = sum(e[CLEAN_COLUMNS.index("annual_inc")] is None for e in expected)
    got = {r["rule"]: r["violations"] for r in Q.output_validation(clean_loans(df)).collect()}
    assert unreadable and got == dict.fromkeys(got, 0) | {"missing_annual_inc": unreadable}


def test_distributions(case):
    _, _, expected, df = case
    clean = clean_loans(df)
    at = CLEAN_COLUMNS.index
    for report, column in [(R.year_distribution, "year"), (R.grade_distribution, "grade")]:
        assert {tuple(r) for r in report(clean).collect()} == set(Counter(e[at(column)] for e in expected).items())
    shares = R.default_distribution(clean).collect()
    assert sum(r["pct"] for r in shares) == pytest.approx(100, abs=0.05)
    assert {r["is_default"] for r in shares} <= {0, 1}
    purposes = Counter(e[at("purpose")] for e in expected if e[at("purpose")] is not None)
    ranked = sorted(purposes.items(), key=lambda item: (-item[1], item[0]))[:2]
    assert [(r["purpose"], r["n"]) for r in R.purpose_top(clean, 2).collect()] == ranked
