"""quarry - archive search and ingest analytics as Spark DataFrame jobs.

Public entry points (all take and return DataFrames / Columns)::

    from quarry.operators.search import fts_match, fts_rank, fts_match_many, with_headline
    from quarry.plans.search_all import SearchTables, search_all, search_many
    from quarry.operators.index import index_rows, build_index, index_increment, write_index
    from quarry.operators.fuzzy import fuzzy_match
    from quarry.plans.ingest import ingest_all, load_tables
    from quarry.plans.asset_jobs import discover_job, resolve_job, verify_assets_job, verify_mirror_job
    from quarry.plans.dashboard import dashboard

See README.md for the design and COVERAGE.md for the operator map.
"""

__version__ = "0.1.0"
