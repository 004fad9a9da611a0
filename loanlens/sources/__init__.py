"""Source tables: schemas, the loan book container and readers."""

from loanlens.sources.book import LoanBook, conform, read_book, write_book
from loanlens.sources.testdata import book_from_testdata

__all__ = ["LoanBook", "book_from_testdata", "conform", "read_book", "write_book"]
