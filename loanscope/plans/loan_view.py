"""A loan table derived from ``orders`` and ``customer``, for checks and timings.

The expressions are plain SQL that Spark and other engines read alike; ``k`` is
the order key, ``d`` the order date.
"""

from pyspark.sql import DataFrame, SparkSession

from loanscope.operators.joins import join_lookup
from loanscope.schema import SELECTED_COLUMNS

_MONTHS = "JanFebMarAprMayJunJulAugSepOctNovDec"
_GRADES = "ABCDEFGHIJKLMN"

# ``copy`` is 0 for the first row of a loan, 1 for an exact copy and 2 for a later, different one.
_DEFAULTED = "(k%7=3 OR copy=2)"


def _number(expression: str, malformed: str) -> str:
    """A whole number as text; some rows hold text that is none."""
    return f"CASE WHEN {malformed} THEN 'n.a.' ELSE CAST(CAST({expression} AS BIGINT) AS STRING) END"


_PRICE = "floor(o_totalprice)"

LOAN_EXPRESSIONS = {
    "id": "CASE WHEN k%211=0 THEN NULL ELSE CAST(k AS STRING) END",
    "loan_amnt": "CASE WHEN k%151=0 THEN '$9' WHEN k%97=0 THEN '0' "
    f"ELSE CAST(CAST({_PRICE}+500*copy AS BIGINT) AS STRING) END",
    "term": "CASE WHEN k%89=0 THEN 'n/a' WHEN k%2=0 THEN ' 36 months' ELSE ' 60 months' END",
    "int_rate": "CASE WHEN k%83=0 THEN NULL WHEN k%139=0 THEN 'abc%' ELSE "
    f"concat(CAST(5+k%12+CASE WHEN {_DEFAULTED} THEN 10 ELSE 0 END AS STRING),'.',lpad(CAST(k%100 AS STRING),2,'0'),'%') END",
    "installment": _number(_PRICE, "k%149=1"),
    "grade": f"concat(' ',lower(substr('{_GRADES}',CAST(1+k%14 AS INT),1)),' ')",
    "sub_grade": f"concat(substr('{_GRADES}',CAST(1+k%14 AS INT),1),CAST(1+k%5 AS STRING))",
    "emp_length": "CASE WHEN k%13=11 THEN '10+ years' WHEN k%13=0 THEN '< 1 year' WHEN k%13=12 THEN 'n/a' "
    "WHEN k%13=1 THEN '1 year' ELSE concat(CAST(k%13 AS STRING),' years') END",
    "home_ownership": "CASE WHEN c_nationkey%3=0 THEN 'rent' WHEN c_nationkey%3=1 THEN ' OWN ' ELSE 'Mortgage' END",
    "annual_inc": "CASE WHEN k%101=0 THEN NULL WHEN k%157=0 THEN '50,000' "
    "ELSE CAST(CAST(floor(c_acctbal) AS BIGINT)*10 AS STRING) END",
    "verification_status": "CASE WHEN k%3=0 THEN 'Verified' WHEN k%3=1 THEN 'Source Verified' "
    "ELSE 'Not Verified' END",
    "loan_status": "CASE WHEN k%103=0 THEN NULL WHEN copy=2 THEN 'Charged Off' WHEN k%7=3 THEN 'Default' "
    "WHEN k%61=0 THEN 'Does not meet the credit policy. Status:Charged Off' "
    "WHEN k%53=0 THEN ' Charged Off' WHEN o_orderstatus='F' THEN 'Fully Paid' ELSE 'Current' END",
    "purpose": "CASE WHEN k%127=0 THEN concat('said \"',lower(c_mktsegment),'\",',chr(10),'next line ') "
    "ELSE lower(concat(c_mktsegment,'_',substr(o_orderpriority,1,1))) END",
    "dti": f"CASE WHEN k%71=0 THEN NULL ELSE {_number(f'k%40+CASE WHEN {_DEFAULTED} THEN 6 ELSE 0 END', 'k%163=0')} END",
    "delinq_2yrs": _number("k%4", "k%167=0"),
    "fico_range_low": f"CASE WHEN k%67=0 THEN NULL ELSE {_number('660+5*(k%38)', 'k%173=0')} END",
    "fico_range_high": _number("664+5*(k%38)+k%2", "k%179=0"),
    "open_acc": _number("k%30", "k%181=0"),
    "pub_rec": _number("k%2", "k%191=0"),
    "revol_bal": _number("floor(o_totalprice/3)", "k%193=0"),
    "revol_util": "CASE WHEN k%73=0 THEN '' WHEN k%137=0 THEN 'x%' ELSE concat(CAST(k%120 AS STRING),'.',CAST(k%10 AS STRING),'%') END",
    "total_acc": _number("k%60", "k%197=0"),
    "issue_d": "CASE WHEN k%107=0 THEN NULL WHEN k%109=0 THEN '2015-12-01' "
    f"ELSE concat(substr('{_MONTHS}',CAST(3*((month(d)+copy-1)%12)+1 AS INT),3),'-',CAST(year(d) AS STRING)) END",
    "addr_state": "concat('s',CAST(c_nationkey AS STRING))",
}

REPEATED = "k%50=0"  # these rows appear twice, as exact duplicates
UPDATED = "k%30=7"  # these appear a second time with another status, month and amount

assert list(LOAN_EXPRESSIONS) == SELECTED_COLUMNS


_OF_COPIES = {c: e for c, e in LOAN_EXPRESSIONS.items() if "copy" in e}
_SHARED = {c: e for c, e in LOAN_EXPRESSIONS.items() if c not in _OF_COPIES}


def loan_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw loan table: the 24 columns and one more, ``desc``, that cleaning drops.

    What the copies of a loan share is computed before they are made, the rest while
    they are. Making them with a higher-order function ends a stretch of generated
    code there: all expressions in one method would be too much for the JVM to compile.
    """
    # A test table is one row group, so one task; loans come from as many as a real input has.
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").repartition("o_orderkey")
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet").withColumnRenamed("c_custkey", "o_custkey")
    # Making one or two copies of a row needs no second scan.
    chosen = f"filter(array(0, 1, 2), c -> c = 0 OR CASE WHEN {REPEATED} THEN c = 1 ELSE {UPDATED} AND c = 2 END)"
    fields = ", ".join(f"{e} AS {c}" for c, e in _OF_COPIES.items())
    return (
        join_lookup(orders, customer, "o_custkey")
        .selectExpr("*", "coalesce(o_orderkey, 0L) AS k", "o_orderdate AS d")
        .selectExpr("k", "d", "o_totalprice", "o_orderstatus", "o_orderpriority AS `desc`", *[f"{e} AS {c}" for c, e in _SHARED.items()])
        .selectExpr("*", f"inline(transform({chosen}, copy -> struct({fields})))")
        .select(*LOAN_EXPRESSIONS, "desc")
    )
