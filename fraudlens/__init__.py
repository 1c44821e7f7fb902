"""fraudlens — payment-fraud analytics on PySpark.

Main entry points::

    from fraudlens import build_session, RawSources, FraudModels
    spark = build_session()
    models = FraudModels(RawSources.from_dir(spark, "/data/raw", fmt="parquet"), as_of="2024-12-31")
    models.dim_merchants.where("merchant_risk_tier = 'CRITICAL'").show()
"""

from fraudlens.plans.models import FraudModels
from fraudlens.session import build_session, materialize, scale_conf
from fraudlens.sources.readers import RawSources

__all__ = ["FraudModels", "RawSources", "build_session", "materialize", "scale_conf"]
__version__ = "0.1.0"
