"""sluice: charts, trips, stream and upsert operators on PySpark DataFrames.

Modules: ``sources``, ``sinks``, ``functions`` (column expressions), ``operators`` (generic
DataFrame -> DataFrame steps), ``plans`` (the workloads and the registered queries),
``streaming`` (sales stream).
"""

from sluice.session import build_session, cluster_settings, scratch_path

__all__ = ["build_session", "cluster_settings", "scratch_path"]
