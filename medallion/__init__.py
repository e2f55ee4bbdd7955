"""medallion: bronze/silver/gold incremental pipelines for sensor measurements on Spark.

Entry points::

    from medallion import build_session, PipelineConfig, Runner
    spark = build_session()
    Runner(spark, PipelineConfig(landing_root=..., warehouse_root=...)).run_pipeline()
"""

__version__ = "0.1.0"

from medallion.plans.runner import PipelineConfig, Runner  # noqa: E402,F401
from medallion.session import build_session  # noqa: E402,F401
