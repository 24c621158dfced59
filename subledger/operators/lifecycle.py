"""P20: lifecycle status of a subscription from its expiry and the run's "now"."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from subledger.functions.blank import _col, is_blank
from subledger.functions.dates import ntz_literal
from subledger.params import ReportParams


def lifecycle_status(client_sub_id: Column | str, expires_at: Column | str,
                     params: ReportParams) -> Column:
    """id blank -> unspecified; expiry after now -> cancelled (active);
    expiry blank or unparseable -> active; otherwise -> cancelled.

    A text expiry is parsed leniently (both 'YYYY-MM-DD HH:MM:SS' and
    'YYYY-MM-DD' forms). ``params.as_of`` None means the query's time in
    ``params.local_timezone``, the zone of the expiry's wall clock.
    """
    lb = params.labels
    exp = _col(expires_at).try_cast("timestamp_ntz")
    now = ntz_literal(params.as_of) if params.as_of is not None else \
        F.convert_timezone(F.current_timezone(), F.lit(params.local_timezone), F.localtimestamp())
    return (F.when(is_blank(client_sub_id), F.lit(lb.lifecycle_unspecified))
            .when(exp > now, F.lit(lb.lifecycle_cancelled_active))
            .when(exp.isNull(), F.lit(lb.lifecycle_active))
            .otherwise(F.lit(lb.lifecycle_cancelled)))
