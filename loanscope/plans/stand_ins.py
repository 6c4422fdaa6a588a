"""Inputs for queries whose input no test table is, derived from the loan view."""

#: Which loans of a stand-in for damaged files are damaged, by their amount; how, says the name.
DAMAGE = {"too_short": "amount % 41 = 3", "too_long": "amount % 43 = 5", "unclosed": "amount % 5003 = 7"}

#: Loans that an earlier version of the raw table lacks.
LATER = "coalesce(issue_d LIKE '%-1997' AND dti = '7', FALSE)"

# --- Fixed values: the columns of two given tables, for SQL ---
FILE_COLUMNS = {"orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"], "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]}
