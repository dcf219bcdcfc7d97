"""Independent DuckDB SQL for the registered queries (the correctness oracle).

The SQL re-states each operator's definition directly (brute force where
that is simplest); it shares only the fixed input adapter and fixed
constants with the Spark code.
"""

from __future__ import annotations

import re

from loanlens.functions.columns import (
    CALIBRATION_EDGES, EMP_LENGTH_YEARS, THRESHOLD_GRID, round_ratio_sql,
)
from loanlens.operators.scoring import CHAMPION, CHALLENGER
from loanlens.sources.tables import APPLICATIONS_SQL


def _emp_case(col: str = "emp_length") -> str:
    whens = " ".join(f"when '{k}' then {float(v)!r}" for k, v in EMP_LENGTH_YEARS.items())
    return f"(case {col} {whens} else null end)"


NUMS = ["dti", "fico_range_low", "revol_util", "annual_inc", "loan_amnt", "int_rate",
        "delinq_2yrs", "inq_last_6mths", "open_acc", "pub_rec", "revol_bal"]

CTES: dict[str, str] = {}
CTES["apps"] = APPLICATIONS_SQL
CTES["resolved"] = """
select r.*, case when issue_year in (1995,1996,1997) then 'train' when issue_year = 1998 then 'val'
  when issue_year = 1999 then 'test' when issue_year = 2000 then 'drift_2000'
  when issue_year = 2001 then 'extra_2001' end as split
from (select a.* exclude (issue_d), cast(a.loan_status = 'Charged Off' as integer) as "default",
        cast(try_strptime(a.issue_d, '%b-%Y') as date) as issue_d,
        cast(year(try_strptime(a.issue_d, '%b-%Y')) as integer) as issue_year
      from apps a where a.loan_status in ('Fully Paid', 'Charged Off')) r
where issue_year between 1995 and 2001"""
CTES["params"] = ("select " + ", ".join(f"median({c}) as med_{c}" for c in NUMS)
                  + f", median({_emp_case()}) as med_emp_length_num"
                  + ", quantile_cont(annual_inc, 0.99) as cap_annual_inc"
                  + ", quantile_cont(revol_bal, 0.99) as cap_revol_bal"
                  + ", quantile_cont(dti, 0.99) as cap_dti, 100.0::double as cap_revol_util"
                  + " from resolved where split = 'train'")
CTES["cats"] = """
select distinct 'home_ownership' as col, home_ownership as cat from resolved where split='train' and home_ownership is not null
union all select distinct 'verification_status', verification_status from resolved where split='train' and verification_status is not null
union all select distinct 'purpose', purpose from resolved where split='train' and purpose is not null"""
_filled = ",\n ".join(f"coalesce({c}, p.med_{c}) as f_{c}" for c in NUMS)
CTES["prepared_wide"] = f"""
select r.app_id, r.split, r."default", r.issue_year, r.home_ownership, r.verification_status, r.purpose,
 {_filled},
 coalesce({_emp_case('r.emp_length')}, p.med_emp_length_num) as emp_length_num,
 {",".join(f"cast({c} is null as integer) as {c}_was_missing" for c in NUMS)},
 cast({_emp_case('r.emp_length')} is null as integer) as emp_length_num_was_missing,
 cast(case when regexp_full_match(coalesce(sub_grade, ''), '[A-G][1-5]')
   then (instr('ABCDEFG', substr(sub_grade, 1, 1)) - 1) * 5 + cast(substr(sub_grade, 2, 1) as integer) - 1
   else 17 end as double) as sub_grade_encoded,
 coalesce(try_cast(nullif(regexp_extract(term, '(\\d+)', 1), '') as double), 0.0) as term_num,
 p.cap_annual_inc, p.cap_revol_bal, p.cap_dti, p.cap_revol_util
from resolved r, params p"""
CTES["prepared"] = """
select *, f_fico_range_low as fico_range_low, f_loan_amnt as loan_amnt, f_int_rate as int_rate,
 f_delinq_2yrs as delinq_2yrs, f_inq_last_6mths as inq_last_6mths, f_open_acc as open_acc, f_pub_rec as pub_rec,
 case when f_annual_inc > cap_annual_inc then cap_annual_inc else f_annual_inc end as annual_inc_capped,
 case when f_revol_bal > cap_revol_bal then cap_revol_bal else f_revol_bal end as revol_bal_capped,
 case when f_revol_util > cap_revol_util then cap_revol_util else f_revol_util end as revol_util_capped,
 case when f_dti > cap_dti then cap_dti else f_dti end as dti_capped
from prepared_wide"""
CTES["scored"] = f"""
select app_id, split, "default", issue_year, loan_amnt, {CHAMPION.sql()} as p from prepared"""
CTES["scored_both"] = f"""
select app_id, split, "default", loan_amnt, {CHAMPION.sql()} as champion_p,
 {CHALLENGER.sql()} as challenger_p from prepared"""


def with_ctes(body: str, *names: str, extra: dict[str, str] | None = None) -> str:
    order = list(CTES)
    wanted = set()
    deps = {"resolved": ["apps"], "params": ["resolved"], "cats": ["resolved"],
            "prepared_wide": ["params", "resolved"], "prepared": ["prepared_wide"],
            "scored": ["prepared"], "scored_both": ["prepared"]}

    def add(n):
        if n in wanted:
            return
        wanted.add(n)
        for d in deps.get(n, []):
            add(d)
    for n in names:
        add(n)
    parts = [f"{n} as ({CTES[n]})" for n in order if n in wanted]
    parts += [f"{n} as ({q})" for n, q in (extra or {}).items()]
    sql = "with " + ",\n".join(parts) + "\n" + body
    # ``window`` is a keyword in DuckDB: quote it where it is a column name
    sql = re.sub(r'(?<!")\bwindow\b(?!")', '"window"', sql)
    return sql.replace('"window" w as', "window w as").replace('over "window"', "over window")


def grid_values() -> str:
    rows = ", ".join(f"({j}, cast({t!r} as double), cast({round(t, 2)!r} as double))"
                     for j, t in enumerate(THRESHOLD_GRID))
    return f"(values {rows}) g(idx, t, threshold)"


def rr(num: str, den: str, d: int = 4) -> str:
    return round_ratio_sql(num, den, d)


def sweep_sql(src: str) -> str:
    return f"""
select g.idx, g.threshold,
 cast(sum(case when s.p < g.t and s."default" = 1 then 1 else 0 end) as bigint) as false_negatives,
 cast(sum(case when s.p >= g.t and s."default" = 0 then 1 else 0 end) as bigint) as false_positives,
 cast(300 * sum(case when s.p < g.t and s."default" = 1 then 1 else 0 end)
   + 45 * sum(case when s.p >= g.t and s."default" = 0 then 1 else 0 end) as double) as total_cost,
 coalesce(sum(case when s.p < g.t then 1 else 0 end) / nullif(count(*), 0), 0.0) as approval_rate,
 coalesce(sum(case when s.p >= g.t and s."default" = 1 then 1 else 0 end)
   / nullif(sum(case when s."default" = 1 then 1 else 0 end), 0), 0.0) as recall_default
from {grid_values()} cross join ({src}) s group by g.idx, g.threshold"""


def calib_bin(col: str = "p") -> str:
    return "(" + " + ".join(f"cast({col} > {e!r} as integer)" for e in CALIBRATION_EDGES) + ")"
