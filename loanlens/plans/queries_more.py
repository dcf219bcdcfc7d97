"""Registered queries over the remaining operators (same registry as ``plans.queries``)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from loanlens.functions.columns import round_ratio

from loanlens.operators import clean as cl
from loanlens.operators import drift as dr
from loanlens.operators import evaluate as ev
from loanlens.operators import explore as xe
from loanlens.operators import learn as ml
from loanlens.operators import profile as pr
from loanlens.operators import quality as qa
from loanlens.operators.prep import NUMERIC_FEATURES, RAW_FIELDS
from loanlens.operators.scoring import CHAMPION, ScorecardModel
from loanlens.plans import oracle as O
from loanlens.plans.pipeline import CHAMPION_THRESHOLD, fitted_prep, prepared, resolved_loans, scored, scored_both, stored_prepared
from loanlens.plans.queries import (
    _ANOVA_COLS, _FIXED_FEATURES, _FS_EXTRA, _MONITOR_BODY, _MONITOR_EXTRA, _WINDOWS, _binary, _faulty, _fs, _learned, register,
)
from loanlens.session import scratch_path
from loanlens.sources import loans as io
from loanlens.sources.tables import input_key, staged_loan_applications
from loanlens.streaming import jobs as sj


# ------------------------------------------------------------------ rows and columns
@register("sampled_rows")
def sampled_rows(spark, sf_dir):
    """A3: 15 % Bernoulli sample of the raw loans (sampling is the feature)."""
    return io.sample_rows(staged_loan_applications(spark, sf_dir)).select("app_id", "loan_status")


@register("feature_projection", O.with_ctes("select * exclude (\"default\", issue_d, issue_year) from (select app_id, \"default\", issue_d, issue_year, dti, loan_amnt, purpose from resolved)", "resolved"))
def feature_projection(spark, sf_dir):
    """Every column but the target and the dates."""
    return cl.feature_columns(resolved_loans(spark, sf_dir).select("app_id", "default", "issue_d", "issue_year", "dti", "loan_amnt", "purpose"))


@register("trimmed_income", O.with_ctes("select app_id, annual_inc from resolved where annual_inc <= (select quantile_cont(annual_inc, 0.99) from resolved)", "resolved"))
def trimmed_income(spark, sf_dir):
    """Loans whose income is at most the 99 % quantile."""
    return cl.trim_upper_quantile(resolved_loans(spark, sf_dir).select("app_id", "annual_inc"), "annual_inc", 0.99)


@register("issue_calendar", O.with_ctes("select app_id, cast(year(issue_d) as integer) as issue_year, cast(month(issue_d) as integer) as issue_month from resolved", "resolved"))
def issue_calendar(spark, sf_dir):
    """H9: year and month of the issue date."""
    return resolved_loans(spark, sf_dir).select("app_id", "issue_year", F.month("issue_d").alias("issue_month"))


_DUP_COLS = ["sub_grade", "term", "home_ownership", "verification_status", "delinq_2yrs"]


@register("marked_duplicates", O.with_ctes(f"select app_id, row_number() over (partition by {', '.join(_DUP_COLS)} order by app_id) > 1 as is_duplicate from resolved", "resolved"))
def marked_duplicates(spark, sf_dir):
    """Every loan, marked if an earlier one has the same five categorical fields."""
    return qa.mark_duplicates(resolved_loans(spark, sf_dir).select("app_id", *_DUP_COLS), _DUP_COLS, "app_id").select("app_id", "is_duplicate")


def _status_sql() -> str:
    bad = ", ".join(f"case when not coalesce({p}, true) then '{n}' end" for n, _, p, _ in qa.FIELD_RULES)
    sev = ", ".join(f"case when not coalesce({p}, true) then '{s}' end" for _, _, p, s in qa.FIELD_RULES)
    return O.with_ctes(f"""select app_id, len(list_filter([{bad}], lambda x: x is not null)) as n_violations,
 case when list_contains([{sev}], 'reject') then 'reject' when list_contains([{sev}], 'warn') then 'warn' else 'accept' end as status from apps""", "apps")


@register("quarantine", _status_sql())
def quarantine(spark, sf_dir):
    """B14 + B15: accept, warn or reject every application, with its number of violated rules."""
    q = qa.quarantine(staged_loan_applications(spark, sf_dir))
    return q.select("app_id", F.size("violations").cast("long").alias("n_violations"), "status")


_Z = ["loan_amnt", "int_rate", "dti"]


@register("standard_scores", O.with_ctes("select app_id, " + ", ".join(
    f"round(({c} - avg({c}) over ()) / stddev_pop({c}) over (), 6) as {c}" for c in _Z) + " from resolved", "resolved"))
def standard_scores(spark, sf_dir):
    """Z-scores with the population deviation."""
    z = xe.standardise(resolved_loans(spark, sf_dir).select("app_id", *_Z), _Z)
    return z.select("app_id", *[F.round(c, 6).alias(c) for c in _Z])


# ------------------------------------------------------------------ tests and redundancy
@register("anova_p")
def anova_p(spark, sf_dir):
    """D20 with p values."""
    return xe.anova_test(_fs(spark, sf_dir), _ANOVA_COLS)


@register("variance_inflation")
def variance_inflation(spark, sf_dir):
    """Variance inflation of the numeric train features."""
    return xe.variance_inflation(_fs(spark, sf_dir), [c for c in _ANOVA_COLS if c != "grade_num"])


_VIF2 = ("loan_amnt", "revol_bal")


@register("variance_inflation_pair", O.with_ctes(f"""select f as feature, round(1 / (1 - ab * ab / (aa * bb)), 6) as vif from (
 select sum(a * b) as ab, sum(a * a) as aa, sum(b * b) as bb from (select {_VIF2[0]} as a, {_VIF2[1]} as b from resolved where split = 'train')
 where a is not null and b is not null), (values ('{_VIF2[0]}'), ('{_VIF2[1]}')) v(f)""", "resolved"))
def variance_inflation_pair(spark, sf_dir):
    """D23 for two columns, where the factor is a closed form."""
    df = resolved_loans(spark, sf_dir).where(F.col("split") == "train")
    return xe.variance_inflation(df, _VIF2).select("feature", F.round("vif", 6).alias("vif"))


_KNN_COLS = ["int_rate", "dti", "revol_util", "loan_amnt", "annual_inc"]


def _psi_sql(x: str) -> str:
    y = f"({x} + 10.0)"
    inv = f"(1.0 / ({y} * {y}))"
    series = f"{inv} * ({1 / 12!r} - {inv} * ({1 / 120!r} - {inv} * ({1 / 252!r} - {inv} * ({1 / 240!r} - {inv} / 132.0))))"
    return f"(ln({y}) - 0.5 / {y} - {series} - (" + " + ".join(f"1.0 / ({x} + {i}.0)" for i in range(10)) + "))"


def _knn_sql() -> str:
    near = ", ".join(f"abs(x - {f}(x, {i}) over (partition by feature, y order by x, id))" for f in ("lag", "lead") for i in (1, 2, 3))
    return O.with_ctes(f"""select feature, round(greatest(0.0, {_psi_sql('sum(n)')} + sum({_psi_sql('k')}) / sum(n) - sum({_psi_sql('nc')}) / sum(n)
      - sum({_psi_sql('m')}) / sum(n)), 6) as mutual_info, cast(sum(n) as bigint) as n_rows from last group by feature""", "resolved", extra={
        **_FS_EXTRA,
        "pts": " union all ".join(f"select '{c}' as feature, app_id as id, \"default\" as y, cast({c} as double) as x from fs where {c} is not null"
                                  for c in _KNN_COLS),
        "live": "select * from (select *, count(*) over (partition by feature, y) as nc from pts) where nc > 1",
        "rad": f"""select feature, x, nc, least(3, nc - 1) as k, list_sort(list_filter([{near}], lambda d: d is not null))[least(3, nc - 1)] as r from live""",
        "vals": "select feature, x, count(*) as n from live group by all",
        "wide": "select feature, x, nc, k, r, case when r > 0 then x - r else x end as lo, case when r > 0 then x + r else x end as hi from rad",
        "cnt": """select w.feature, w.x, w.r, sum(v.n) as m from (select distinct feature, x, r, lo, hi from wide) w join vals v
          on v.feature = w.feature and v.x >= w.lo and v.x <= w.hi and (w.r = 0 or (v.x > w.lo and v.x < w.hi)) group by all""",
        "last": "select w.feature, 1 as n, w.k, w.nc, c.m from wide w join cnt c on c.feature = w.feature and c.x = w.x and c.r = w.r"})


@register("mutual_info_knn", _knn_sql())
def mutual_info_knn(spark, sf_dir):
    """Nearest-neighbour mutual information of five numeric train features with default."""
    return xe.mutual_info_knn(_fs(spark, sf_dir), _KNN_COLS)


# ------------------------------------------------------------------ scoring and documents
@register("scorecard_decisions", O.with_ctes(f"""select app_id, p, case when p >= {CHAMPION_THRESHOLD} then 'DENY' else 'APPROVE' end as decision,
 {CHAMPION_THRESHOLD}::double as threshold_used, '{CHAMPION.name}' as model_version from scored where split = 'test'""", "scored"))
def scorecard_decisions(spark, sf_dir):
    """I8: the scorecard as a Spark ML transformer over the test split."""
    test = prepared(spark, sf_dir).where(F.col("split") == "test")
    return ScorecardModel(CHAMPION, CHAMPION_THRESHOLD, keep=("app_id",)).transform(test)


@register("application_document", O.with_ctes("select p from scored where app_id = (select min(app_id) from scored)", "scored"))
def application_document(spark, sf_dir):
    """One application written as a JSON document, read back, prepared and scored."""
    raw = resolved_loans(spark, sf_dir)
    path = scratch_path(spark, f"application-{uuid.uuid4().hex}")
    raw.where(F.col("app_id") == raw.agg(F.min("app_id")).scalar()).select(*RAW_FIELDS).coalesce(1).write.json(path)
    prep = fitted_prep(spark, sf_dir).transform(io.application_from_json(spark, path))
    return prep.select(CHAMPION.probability().alias("p"))


@register("prep_document", O.with_ctes(" union all ".join(
    f"select '{c}' as feature, round(avg({c}), 6) as mean, min({c})::double as low, max({c})::double as high from prepared" for c in _FIXED_FEATURES), "prepared"))
def prep_document(spark, sf_dir):
    """A8 + B10: the parameter document written, amended, reloaded and applied
    (width is checked on load); mean and range of every feature it makes."""
    from loanlens.operators.prep import LoanPrepModel
    path = scratch_path(spark, f"prep-{uuid.uuid4().hex}")
    fitted_prep(spark, sf_dir).amend(final_shapes={"written": True}).save(spark, path)
    out = LoanPrepModel.load(spark, path).transform(resolved_loans(spark, sf_dir))
    made = out.agg(*[x for i, c in enumerate(_FIXED_FEATURES) for x in (F.avg(c).alias(f"m{i}"), F.min(c).alias(f"l{i}"), F.max(c).alias(f"h{i}"))])
    return made.select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.round(f"m{i}", 6).alias("mean"), F.col(f"l{i}").alias("low"),
                                                    F.col(f"h{i}").alias("high")) for i, c in enumerate(_FIXED_FEATURES)])).alias("s")).select("s.*")


@register("evidence_file", O.with_ctes("select round(corr(int_rate, \"default\"), 6) as correlation, 'int_rate' as feature from resolved", "resolved"))
def evidence_file(spark, sf_dir):
    """An evidence table written as CSV with a header and read back."""
    path = scratch_path(spark, f"evidence-{uuid.uuid4().hex}")
    io.write_evidence_csv(xe.correlations(resolved_loans(spark, sf_dir), [("int_rate", "default")], 0.3).select("feature", "correlation"), path)
    return spark.read.option("header", True).schema("feature string, correlation double").csv(path)


@register("schema_report", O.with_ctes("""select split as "window", case when split = 'val' then 'dti' else '' end as missing,
 case when split = 'val' then 'surplus' else '' end as extra, count(*) as n from resolved group by split""", "resolved"))
def schema_report(spark, sf_dir):
    """Every window stored by itself, one without a column and with another
    too many; what each lacks and has beyond the expected list, and its rows."""
    expected, loans, found = ["app_id", *NUMERIC_FEATURES], resolved_loans(spark, sf_dir), None
    folder = scratch_path(spark, f"stored-windows-{uuid.uuid4().hex}")
    for w in ["train", *_WINDOWS]:
        rows = loans.where(F.col("split") == w).select(*expected)
        (rows.drop("dti").withColumn("surplus", F.lit(1)) if w == "val" else rows).write.parquet(f"{folder}/{w}")
        stored = spark.read.parquet(f"{folder}/{w}")
        missing, extra = qa.schema_diff(expected, stored.columns)
        row = stored.agg(F.count(F.lit(1)).alias("n")).select(F.lit(w).alias("window"), F.lit(",".join(missing)).alias("missing"),
                                                              F.lit(",".join(extra)).alias("extra"), "n")
        found = row if found is None else found.unionByName(row)
    return found


# ------------------------------------------------------------------ learners, on fixed scorecards where SQL can follow
@register("stratified_split", O.with_ctes("""select app_id, "default", case when rn <= floor(n * 0.2::double) then 'val' else 'train' end as part from (
 select app_id, "default", row_number() over (partition by "default" order by md5(app_id::varchar || '|42'), app_id) as rn,
  count(*) over (partition by "default") as n from resolved where split = 'train')""", "resolved"))
def stratified_split(spark, sf_dir):
    """80/20 split of the train rows, equal in both classes."""
    train = resolved_loans(spark, sf_dir).where(F.col("split") == "train").select("app_id", "default")
    return ml.stratified_split(train, "app_id")


_CARD_FEATS = [c for c, _, _ in CHAMPION.terms]
_REPEATS, _SEED = 10, 42


def _shift_sql(r: int) -> str:
    import hashlib
    return f"1 + {int(hashlib.md5(f'{_SEED}|{r}'.encode()).hexdigest()[:12], 16)} % greatest(1, n - 1)"


def _perm_sql() -> str:
    score = CHAMPION.sql()
    swapped = " union all ".join(
        f"select '{f}' as feature, r, y, {score} as p from (select a.r, a.y, " + ", ".join(
            f"{'b' if g == f else 'a'}.{g} as {g}" for g in _CARD_FEATS) + " from moved a join v b on b.i = a.j)" for f in _CARD_FEATS)
    return O.with_ctes(f"""select feature, round(avg(b.auc - s.auc), 6) as perm_importance_mean, round(stddev_pop(b.auc - s.auc), 6) as perm_importance_std
 from per s, base b group by feature""", "prepared", extra={
        "v": f"""select row_number() over (order by md5(app_id::varchar || '|{_SEED}'), app_id) - 1 as i, count(*) over () as n, "default" as y,
          {', '.join(_CARD_FEATS)} from prepared where split = 'val'""",
        "moved": " union all ".join(f"select v.*, {r} as r, (i + {_shift_sql(r)}) % n as j from v" for r in range(_REPEATS)),
        "sw": swapped,
        "per": """select feature, r, sum(pos * (2 * below + neg)) / (2.0 * sum(pos) * sum(neg)) as auc from (
          select feature, r, pos, neg, coalesce(sum(neg) over (partition by feature, r order by p rows between unbounded preceding and 1 preceding), 0) as below
          from (select feature, r, p, count_if(y = 1) as pos, count_if(y = 0) as neg from sw group by all)) group by all""",
        "base": f"""select sum(pos * (2 * below + neg)) / (2.0 * sum(pos) * sum(neg)) as auc from (
          select pos, neg, coalesce(sum(neg) over (order by p rows between unbounded preceding and 1 preceding), 0) as below
          from (select {score} as p, count_if(y = 1) as pos, count_if(y = 0) as neg from v group by all))"""})


@register("perm_importance_card", _perm_sql())
def perm_importance_card(spark, sf_dir):
    """I14 on the fixed scorecard: AUC drop of each of its fields, ten repeats."""
    val = prepared(spark, sf_dir).where(F.col("split") == "val")
    return ml.permutation_importance(lambda rows: rows.withColumn("p", CHAMPION.probability()), val, _CARD_FEATS, repeats=_REPEATS, seed=_SEED)


@register("model_registry", O.with_ctes("""select 'scorecard' as model_name, version, case when auc > old then 'promoted' else 'kept_existing' end as decision,
 round(auc, 6) as new_auc, round(old, 6) as old_auc, path from (
 select 1 as version, champion_auc as auc, 0.0 as old, 'champion' as path from au
 union all select 2, challenger_auc, champion_auc, 'challenger' from au
 union all select 3, champion_auc, greatest(champion_auc, challenger_auc), 'champion again' from au)""", "scored_both", extra={
    "lab": "select s.*, coalesce(\"default\", 0) as y from scored_both s where split = 'test'",
    **{f"{k}_c": f"select {k}_p as p, count_if(y = 1) as pos, count_if(y = 0) as neg from lab group by all" for k in ("champion", "challenger")},
    "au": "select " + ", ".join(f"(select sum(pos * (2 * below + neg)) / (2.0 * sum(pos) * sum(neg)) from (select pos, neg, coalesce(sum(neg) over "
                                f"(order by p rows between unbounded preceding and 1 preceding), 0) as below from {k}_c)) as {k}_auc" for k in ("champion", "challenger"))}))
def model_registry(spark, sf_dir):
    """I16 + I17: three candidates registered in turn; each is promoted only if it beats the champion of that time."""
    test = scored_both(spark, sf_dir).where(F.col("split") == "test")
    path = f"{scratch_path(spark, f'registry-{uuid.uuid4().hex}')}/table"
    for col, label in (("champion_p", "champion"), ("challenger_p", "challenger"), ("champion_p", "champion again")):
        ml.register_candidate(spark, path, "scorecard", ev.auc(test, p=col).first()["auc"], label)
    return ml.read_registry(spark, path).select("model_name", "version", "decision", F.round("new_auc", 6).alias("new_auc"),
                                               F.round("old_auc", 6).alias("old_auc"), "path")


# ------------------------------------------------------------------ scheduled monitoring and its log
_PROFILES: dict[tuple, str] = {}


def _profile(spark, sf_dir, model):
    """The train window's stored profile; made once per session and input, with the measured approval as baseline."""
    key = input_key(spark, sf_dir)
    if key not in _PROFILES:
        path = scratch_path(spark, f"profile-{uuid.uuid4().hex}")
        rows = stored_prepared(spark, sf_dir).where(F.col("split") == "train")
        base = _approval_rates(rows.select("split", CHAMPION.probability().alias("p"))).first()["approval_rate"]
        pr.save_profile(spark, pr.reference_profile(rows, model.feature_columns, _binary(model), base), path)
        _PROFILES[key] = path
    return pr.load_profile(spark, _PROFILES[key])


def _window_approval(spark, sf_dir, model, windows):
    return _approval_rates(scored(spark, sf_dir, model=model).where(F.col("split").isin(*windows)))


def _approval_rates(scores):
    return scores.groupBy(F.col("split").alias("window")).agg(
        round_ratio(F.count_if(F.col("p") < CHAMPION_THRESHOLD), F.count(F.lit(1)), 4).alias("approval_rate"))


def _monitored(spark, sf_dir):
    """ST4: the windows arrive as a stream of labels; each is judged against the
    stored profile, from its own rows alone, and logged.  The log as written."""
    model = fitted_prep(spark, sf_dir)
    df, binary, stored = _faulty(spark, sf_dir, model), _binary(model), _profile(spark, sf_dir, model)
    arrived = scratch_path(spark, f"arrivals-{uuid.uuid4().hex}")
    spark.createDataFrame([(w,) for w in _WINDOWS], "window string").repartition(len(_WINDOWS), "window").write.parquet(arrived)
    log = scratch_path(spark, f"monitoring-{uuid.uuid4().hex}")

    def judge(windows):
        ends = resolved_loans(spark, sf_dir).where(F.col("split").isin(*windows)).groupBy(F.col("split").alias("window")).agg(F.max("issue_d").alias("timestamp"))
        approval = _window_approval(spark, sf_dir, model, windows)
        return pr.monitor_against(df, stored, windows, approval, binary=binary).join(ends, "window")

    sj.monitoring_job(sj.file_stream(spark, arrived, "*.parquet", "window string"), judge, log)
    return io.read_monitoring_log(spark, log)


@register("retrain_loop")
def retrain_loop(spark, sf_dir):
    """I16: the windows' verdict against the stored profile, one of them shifted, and a candidate
    trained with the windows that ask for it, tested and registered; the steps done."""
    from loanlens.operators.retrain import retrain
    model, base = fitted_prep(spark, sf_dir), scratch_path(spark, f"retraining-{uuid.uuid4().hex}")
    late = F.col("split") == "drift_2000"
    stored = stored_prepared(spark, sf_dir)
    rows = stored
    for c, move in (("sub_grade_encoded", 12.0), ("dti_capped", 15.0), ("revol_util_capped", 20.0)):           # riskier applications in one window
        rows = rows.withColumn(c, F.col(c) + F.when(late, move).otherwise(0.0))
    approval = _approval_rates(rows.where(F.col("split").isin(*_WINDOWS)).select("split", CHAMPION.probability().alias("p")))
    verdict = pr.monitor_against(rows, _profile(spark, sf_dir, model), _WINDOWS, approval, binary=_binary(model))
    val = stored.where(F.col("split") == "val")
    return retrain(spark, base, "run", verdict, lambda windows: _learned(spark, sf_dir, "logistic", ("train", *windows), stored),
                   lambda m: ev.auc(ml.score(m, val)).first()["auc"], f"{base}/registry", "logistic")


_LOGGED = {**_MONITOR_EXTRA, "mon": _MONITOR_BODY, "ends": "select split as window, max(issue_d) as timestamp from resolved group by split"}


@register("monitoring_log", O.with_ctes("""select strftime(timestamp, '%Y-%m-%d') as timestamp, window, failure_type, drift_score, approval_rate, should_retrain
 from mon join ends using (window)""", "prepared", "cats", "scored", extra=_LOGGED))
def monitoring_log(spark, sf_dir):
    """ST4 + J6 + A10 + E5: the monitoring history that the scheduled job has written."""
    return dr.history(_monitored(spark, sf_dir)).withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd"))


@register("monitoring_latest", O.with_ctes("""select window, failure_type, should_retrain, round(approval_rate - baseline_approval_rate, 6) as approval_delta
 from mon join ends using (window) order by timestamp desc limit 1""", "prepared", "cats", "scored", extra=_LOGGED))
def monitoring_latest(spark, sf_dir):
    """The newest entry of the monitoring log and its approval change."""
    return dr.latest_entry(_monitored(spark, sf_dir)).select("window", "failure_type", "should_retrain", F.round("approval_delta", 6).alias("approval_delta"))
