"""Whole experiment readout: every test of the analysis in one result table.

The per-user frame is computed once and materialized; each test reduces it
(or the bucket frame) to one row, and the rows are stacked with
``unionByName``. Columns: method, arm (for per-arm rows), statistic,
p_value, ci_lo, ci_hi, significant.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import experiment, stats
from ..session import materialize


def _row(df: DataFrame, method: str, statistic, p_value, ci_lo=None, ci_hi=None,
         significant=None, arm=None) -> DataFrame:
    def c(x):
        if x is None:
            return F.lit(None).cast("double")
        return F.col(x).cast("double") if isinstance(x, str) else x.cast("double")
    if significant is None:
        sig = F.col("significant")
    elif significant is False:
        sig = F.lit(None)
    else:
        sig = significant
    arm_col = F.lit(None) if arm is None else F.col(arm)
    return df.select(F.lit(method).alias("method"), arm_col.cast("int").alias("arm"),
                     c(statistic).alias("statistic"),
                     c(p_value).alias("p_value"), c(ci_lo).alias("ci_lo"),
                     c(ci_hi).alias("ci_hi"), sig.cast("boolean").alias("significant"))


def experiment_report(feed: DataFrame, start, end, control=1, treatment=2,
                      alpha: float = stats.ALPHA, b: int = 5000, seed: int = 0,
                      n_buckets: int = 50, smoothing_alpha: float = experiment.SMOOTHING_ALPHA,
                      smoothed_value: str = "smoothed_ctr",
                      bootstrap_method: str = "grouped") -> DataFrame:
    """Per-arm mean and median CTR, Welch and Mann-Whitney on user CTR, Welch
    on smoothed CTR, the Poisson bootstrap interval of the CTR difference,
    Welch and Mann-Whitney on bucket CTR. Treatment comes first in the user-level tests, control first
    in the bucket tests (both two-sided, so only the sign of t differs).

    ``smoothed_value='ctr'`` reproduces a smoothed test that passes the raw
    column by mistake (it then equals the first row). The bootstrap uses the
    pattern-grouped Poisson draws by default (work grows with distinct
    (likes, views) pairs, not users); ``bootstrap_method='per_user'`` uses the
    per-user hash weights that SQL can reproduce.
    """
    users = materialize(experiment.user_ctr(feed, start, end, (control, treatment)))
    smoothed = experiment.smoothed_ctr(users, smoothing_alpha)
    buckets = materialize(experiment.bucket_ctr(users, n_buckets))
    g = "exp_group"
    t_user = stats.welch_ttest(users, g, "ctr", treatment, control, alpha)
    u_user = stats.mann_whitney(users, g, "ctr", treatment, control, alpha)
    t_smooth = stats.welch_ttest(smoothed, g, smoothed_value, treatment, control, alpha)
    reps = stats.poisson_bootstrap(users, b, seed, control, treatment, method=bootstrap_method)
    ci = stats.bootstrap_ci(reps, 1.0 - alpha)
    # the bootstrap row carries the interval; significant = 0 lies outside it
    boot_row = _row(ci, "poisson_bootstrap", "mean", None, "lo", "hi", F.col("excludes_zero"))
    summary = experiment.arm_summary(users, "ctr")
    arm_rows = (_row(summary, "mean_ctr", "mean", None, significant=False, arm=g)
                .unionByName(_row(summary, "median_ctr", "median", None, significant=False, arm=g)))
    u_bucket = stats.mann_whitney(buckets, g, "bucket_ctr", control, treatment, alpha)
    t_bucket = stats.welch_ttest(buckets, g, "bucket_ctr", control, treatment, alpha)
    return (arm_rows
            .unionByName(_row(t_user, "ttest_ctr", "t", "p_value"))
            .unionByName(_row(u_user, "mannwhitney_ctr", "u1", "p_value"))
            .unionByName(_row(t_smooth, "ttest_smoothed_ctr", "t", "p_value"))
            .unionByName(boot_row)
            .unionByName(_row(u_bucket, "mannwhitney_bucket_ctr", "u1", "p_value"))
            .unionByName(_row(t_bucket, "ttest_bucket_ctr", "t", "p_value")))
