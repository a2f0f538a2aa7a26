"""folio -- a Spark-native engine for institutional-repository metadata.

Pages of harvested XML, item-page HTML and page-wise document text go in; a
clean relational model and reports come out. Every job is a DataFrame to
DataFrame function built from Spark's own Column and DataFrame API.
"""

from folio.session import build_session, read_table, work_dir

__all__ = ["build_session", "read_table", "work_dir"]
