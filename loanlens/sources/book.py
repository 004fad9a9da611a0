"""The loan book: the ten source tables every report reads, as DataFrames."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlens.sources.layout import folders
from loanlens.sources.schemas import BOOK_SCHEMAS


@dataclass(frozen=True)
class LoanBook:
    loan_application: DataFrame
    external_score: DataFrame
    credit_score: DataFrame
    credit_score_config: DataFrame
    facility: DataFrame
    facility_has_loan: DataFrame
    loan_type: DataFrame
    loan: DataFrame
    loan_payment: DataFrame
    financial_information: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return {f.name: getattr(self, f.name) for f in fields(self)}


def conform(df: DataFrame, name: str) -> DataFrame:
    """Select the columns of table ``name`` by name and cast them to its schema."""
    schema = BOOK_SCHEMAS[name]
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def _stored(df: DataFrame, name: str) -> DataFrame:
    """``conform``, with the folder columns of a table that was laid out by ``write_book``."""
    schema = BOOK_SCHEMAS[name]
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema]
                     + [F.col(c).cast("string").alias(c) for c in folders(name) if c in df.columns])


def _read_table(spark: SparkSession, root: str, name: str, fmt: str) -> DataFrame:
    return _stored(spark.read.format(fmt).load(f"{root}/{name}"), name)


def read_book(spark: SparkSession, root: str, fmt: str = "parquet") -> LoanBook:
    """Read ``root/<table>`` for every table of the book.

    Only the columns of the declared schema (and the folder columns) are selected, so Catalyst prunes
    everything else at the scan; filters placed by the reports reach the
    Parquet reader as pushed predicates or choose folders.
    """
    return LoanBook(**{name: _read_table(spark, root, name, fmt) for name in BOOK_SCHEMAS})


def _write_table(df: DataFrame, root: str, name: str, fmt: str, mode: str) -> None:
    df, at = conform(df, name), folders(name)
    if not at:
        df.write.format(fmt).mode(mode).save(f"{root}/{name}")
        return
    (df.withColumns(at).hint("rebalance", *(F.col(c) for c in at))
     .write.format(fmt).mode(mode).partitionBy(*at).save(f"{root}/{name}"))


def write_book(book: LoanBook, root: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Write every table of the book to ``root/<table>``, the large ones in folders (``sources.layout``).

    Rows are dealt to write tasks by folder; AQE splits a folder that is larger than a task
    should be, so files have a bounded size however the months differ.
    """
    for name, df in book.tables().items():
        _write_table(df, root, name, fmt, mode)


class BookInUse(LoanBook):
    """A book whose tables are written below a folder, each one when a report first asks for it."""

    @classmethod
    def of(cls, book: LoanBook, root: str) -> BookInUse:
        new = cls.__new__(cls)
        object.__setattr__(new, "_origin", (book, root))
        return new

    def __getattr__(self, name: str) -> DataFrame:
        # Reached only for a table that was not asked for before.
        if name not in BOOK_SCHEMAS:
            raise AttributeError(name)
        book, root = self._origin
        df = getattr(book, name)
        _write_table(df, root, name, "parquet", "overwrite")
        df = _read_table(df.sparkSession, root, name, "parquet")
        object.__setattr__(self, name, df)
        return df
