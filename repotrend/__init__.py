"""repotrend — watch/fork activity analytics for code-hosting event feeds, on Spark.

Layers (each a plain ``DataFrame -> DataFrame`` function, composed with
``DataFrame.transform``):

    raw hourly JSON  ->  curated (kind, file_date) Parquet  ->  source tables
        -> staged events (filter + full-row dedupe)  ->  daily repo fact
        -> marts (top watched, top forked, rising, intent shares)

with data-quality checks gating each layer (``repotrend.plans``).
"""

from repotrend.session import get_session, work_dir

__all__ = ["get_session", "work_dir"]
