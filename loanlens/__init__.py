"""loanlens: month-end monitoring reports of a consumer-loan book on Spark.

Every report is a DataFrame-in, DataFrame-out function with an explicit
as-of date; see ``loanlens.operators``.
"""

from loanlens.sources.book import LoanBook, read_book

__all__ = ["LoanBook", "read_book"]
