"""Three-layer measurement analytics on PySpark."""

from tiermill.config import PipelineConfig, cluster_settings, configure_session, lake_settings

__all__ = ["PipelineConfig", "cluster_settings", "configure_session", "lake_settings"]
