"""threatspark: vulnerability-risk analytics as Spark DataFrame plans.

Layers (bronze -> silver -> gold), the rule-scored fact table and the
scanner-report enrichment are all expressed with the DataFrame API so that
Catalyst plans them and executors run them.

Main entry points (see README for the full inventory):

- ``run_layers``: bronze / silver / gold for the registered sources
- ``build_fact``, ``dim_threats``, ``dim_vrr``, ``validate_rules``: the star schema
- ``enrich_findings``, ``enrich_simple``, ``process_scanner_csv``: scanner reports
- ``build_star``, ``refresh_star``: the star schema as tables, whole or by what gold changed
- ``upsert``, ``upsert_bucketed``, ``commit_table``, ``read_current``: keyed merges
- ``changed_keys``, ``vacuum``: what commits changed, and removing old versions
- ``join_intervals``: points and overlapping intervals of any length
- ``stream_layer``: the Structured Streaming form of a layer load
"""

from threatspark.session import get_session, work_dir  # noqa: F401
from threatspark.operators.incremental import join_intervals  # noqa: F401
from threatspark.operators.merge import (changed_keys, commit_table, read_current, upsert,  # noqa: F401
                                         upsert_bucketed, vacuum)
from threatspark.plans.fact import build_fact, dim_threats, dim_vrr, validate_rules  # noqa: F401
from threatspark.plans.findings import enrich_findings, enrich_simple  # noqa: F401
from threatspark.plans.layers import (build_star, process_scanner_csv, refresh_star, replicate,  # noqa: F401
                                      run_layers)
from threatspark.streaming.stream import stream_layer  # noqa: F401

__all__ = ["get_session", "work_dir", "commit_table", "read_current", "upsert", "upsert_bucketed",
           "build_fact", "dim_threats", "dim_vrr", "validate_rules", "enrich_findings", "enrich_simple",
           "process_scanner_csv", "replicate", "run_layers", "stream_layer", "build_star", "refresh_star",
           "changed_keys", "vacuum", "join_intervals"]
