"""ledgerline — subscription-billing analytics on Spark.

Raw, untyped customer / subscription / invoice tables go in; cleaned staging
models with visible defect flags, effective subscription windows, a monthly
activity grain, MRR, churn and realised lifetime value come out.  Around those
sit incremental upsert loads with a guarded high-water mark, Type-2 history,
currency conversion and declarative data-quality checks.

Everything is DataFrame / Spark SQL; every time-dependent result takes an
explicit ``as_of`` date.
"""

from ledgerline.session import get_session, scale_conf, scratch_dir, stored


def __getattr__(name):
    # Lazy re-exports of the main entry points (keeps ``import ledgerline`` light).
    if name == "BillingModels":
        from ledgerline.plans.models import BillingModels
        return BillingModels
    if name == "run":
        from ledgerline.plans.pipeline import run
        return run
    raise AttributeError(name)


__all__ = ["BillingModels", "stored", "get_session", "run", "scale_conf", "scratch_dir"]
