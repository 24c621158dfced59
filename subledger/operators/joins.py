"""J1 plan join and the F1-F3 retention filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subledger.params import ReportParams

def join_plans(subs: DataFrame, plans: DataFrame) -> DataFrame:
    """Left join user subscriptions to plans on ``subscription_id = plans.id``.

    The right side is pruned to the key and the interval; its key becomes
    ``plan_id``. NULL keys match each other (as pandas merge does); duplicate
    plan ids fan out. Both sides are plain shuffles, so at run time AQE
    broadcasts the catalogue if it measured small, or else splits the rows of a
    popular plan (or of NULL) over several tasks.
    """
    right = plans.select(F.col("id").alias("plan_id"),
                         F.col("price.recurring_interval").alias("recurring_interval"))
    return subs.join(right, subs["subscription_id"].eqNullSafe(right["plan_id"]), "left")


def _not_in_keep_null(c: Column, values) -> Column:
    """NOT c IN values, but NULL counts as kept (pandas ``~isin`` on NaN is True).

    Written with coalesce so it is not null-rejecting: Catalyst must not turn
    the left join into an inner join.
    """
    if not values:
        return F.lit(True)
    return F.coalesce(~c.isin(*values), F.lit(True))


def retention_predicates(params: ReportParams, plan_col: str = "plan_id",
                         status_col: str = "status", user_col: str = "user.id") -> list[Column]:
    """F1 excluded plans, F2 kept statuses (NULL dropped), F3 excluded users."""
    return [
        _not_in_keep_null(F.col(plan_col), params.excluded_plan_ids),
        F.coalesce(F.col(status_col).isin(*params.kept_statuses), F.lit(False))
        if params.kept_statuses else F.lit(False),
        _not_in_keep_null(F.col(user_col), params.excluded_user_ids),
    ]


def retain(df: DataFrame, params: ReportParams, **cols) -> DataFrame:
    f1, f2, f3 = retention_predicates(params, **cols)
    return df.filter(f1 & f2 & f3)
