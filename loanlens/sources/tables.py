"""Readers for the driver's parquet tables and the loan-application adapter.

The adapter turns ``orders ⋈ customer ⋈ lineitem(agg) ⋈ part`` into a raw loan
table with the 17 application fields, ``loan_status`` and ``issue_d``.  It is a
test-data view only: it produces rows in the raw-loan schema and does none of
the operators' work.  The same SQL text runs in Spark (tables bound as
DataFrame parameters) and in DuckDB (tables as views), so the oracle sees the
same input value for value.
"""

from __future__ import annotations

import hashlib
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed adapter text (FIXTURES.md §8).  ``$name`` marks a base table.
_ADAPTER_TEMPLATE = """
with li as (
 select l_orderkey, count(*) as open_acc,
  sum(case when l_returnflag='R' then 1 else 0 end) as delinq_2yrs,
  sum(case when l_linestatus='O' then 1 else 0 end) as inq_last_6mths,
  sum(case when l_tax >= 0.08 then 1 else 0 end) as pub_rec,
  cast(sum(cast(l_extendedprice as decimal(18,2))) as double) as revol_bal,
  cast(sum(cast(l_discount as decimal(18,2))) as double)*400 as revol_util,
  cast(max(cast(l_tax as decimal(18,2))) as double)*250 as int_rate,
  min(l_partkey) as partkey
 from $lineitem group by l_orderkey)
select o.o_orderkey as app_id, o.o_orderdate as issue_ts,
 case o.o_orderstatus when 'F' then 'Charged Off' when 'O' then 'Fully Paid' else 'Current' end as loan_status,
 o.o_totalprice as loan_amnt, c.c_acctbal as annual_inc,
 case when o.o_orderkey % 29 = 0 then null else 300 + cast(o.o_custkey % 551 as double) end as fico_range_low,
 li.revol_bal / nullif(o.o_totalprice,0) * 20 as dti, li.revol_util, li.int_rate,
 cast(li.open_acc as double) as open_acc, cast(li.delinq_2yrs as double) as delinq_2yrs,
 cast(li.inq_last_6mths as double) as inq_last_6mths, cast(li.pub_rec as double) as pub_rec, li.revol_bal,
 concat(substr('ABCDEFG', cast(o.o_custkey % 7 as int)+1, 1), cast(cast(substr(o.o_orderpriority,1,1) as int) as varchar(1))) as sub_grade,
 case when o.o_orderkey % 3 = 0 then ' 60 months' else ' 36 months' end as term,
 case o.o_custkey % 13 when 0 then '< 1 year' when 1 then '1 year' when 10 then '10+ years' when 11 then null
   when 12 then 'n/a' else concat(cast(o.o_custkey % 13 as varchar(2)),' years') end as emp_length,
 c.c_mktsegment as home_ownership,
 case when o.o_orderkey % 5 < 2 then 'Not Verified' when o.o_orderkey % 5 < 4 then 'Verified' else 'Source Verified' end as verification_status,
 p.p_type as purpose
from $orders o left join $customer c on o.o_custkey=c.c_custkey
left join li on li.l_orderkey=o.o_orderkey left join $part p on p.p_partkey=li.partkey
"""

_BASE = ("lineitem", "orders", "customer", "part")

#: DuckDB form of the adapter plus the raw ``issue_d`` text column.
APPLICATIONS_SQL = (
    "select a.* exclude (issue_ts), strftime(a.issue_ts, '%b-%Y') as issue_d from ("
    + _ADAPTER_TEMPLATE.replace("$", "") + ") a"
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table; column pruning and filters push into the parquet scan."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The adapter view with ``issue_ts`` (timestamp) as the driver gives it."""
    text = _ADAPTER_TEMPLATE
    for name in _BASE:
        text = text.replace(f"${name}", "{" + name + "}")
    return spark.sql(text, **{n: read_table(spark, sf_dir, n) for n in _BASE})


def loan_applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw loan rows: 17 fields, ``loan_status``, ``issue_d`` as ``Mon-YYYY`` text, ``app_id``."""
    apps = applications(spark, sf_dir)
    cols = [c for c in apps.columns if c != "issue_ts"]
    return apps.select(*cols, F.date_format("issue_ts", "MMM-yyyy").alias("issue_d"))


def input_key(spark: SparkSession, sf_dir: str) -> tuple:
    """What a session's kept tables and models depend on: the application, the folder, and on a local
    path the newest change of its base tables (other stores: the folder alone)."""
    newest = 0
    for name in _BASE:
        path = f"{sf_dir.rstrip('/')}/{name}.parquet"
        files = [os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs] if os.path.isdir(path) else [path]
        newest = max([newest, *(os.stat(f).st_mtime_ns for f in files if os.path.exists(f))])
    return spark.sparkContext.applicationId, sf_dir, newest


_STAGED: dict[tuple, str] = {}


def staged_loan_applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw loan table written once per session to the shared checkpoint
    folder (the stand-in for the stored loan file every job reads).

    Later reads are plain parquet scans with column pruning and pushed-down
    filters; the written table also cuts lineage, so a lost executor never
    forces the adapter joins to run again.
    """
    return spark.read.parquet(staged_path(spark, sf_dir))


def staged_path(spark: SparkSession, sf_dir: str) -> str:
    """Folder of the staged table; written on first use in the session."""
    from loanlens.session import scratch_path
    key = input_key(spark, sf_dir)
    path = _STAGED.get(key)
    if path is None:
        tag = hashlib.sha1(repr(key).encode()).hexdigest()[:12]
        path = scratch_path(spark, f"loans-{tag}")
        loan_applications(spark, sf_dir).write.mode("overwrite").parquet(path)
        _STAGED[key] = path
    return path
