"""reportlake: self-service reporting on Spark.

Load CSV files and workbooks into typed tables, append later files with additive
schema evolution, browse and profile what is loaded, run guarded read-only Spark
SQL with paging and a capped total, keep saved reports and export CSV. A few
table operators Spark SQL lacks (as-of, range and positional joins, QUALIFY-style
filtering, DISTINCT ON, GROUPS frames, ordered sampling) are DataFrame rewrites.
"""

from reportlake.session import configure, scratch_dir

__all__ = ["configure", "scratch_dir", "Lake", "Reports", "run_sql", "export_csv"]


def __getattr__(name):  # lazy: importing the package does not start or touch Spark
    if name == "Lake":
        from reportlake.plans.lake import Lake

        return Lake
    if name == "Reports":
        from reportlake.plans.reports import Reports

        return Reports
    if name == "run_sql":
        from reportlake.plans.gateway import run_sql

        return run_sql
    if name == "export_csv":
        from reportlake.sinks.export import export_csv

        return export_csv
    raise AttributeError(name)
