"""Term weighting formulas as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def idf_log10(n_docs: Column, df: Column) -> Column:
    return F.log10((n_docs + 1) / df)


def idf_smoothed(n_docs: Column, df: Column) -> Column:
    """Smooth form used with L2-normalized rows: ``ln((1+N)/(1+df)) + 1``."""
    return F.ln((n_docs + 1) / (df + 1)) + 1


def idf_log2(n_docs: Column, df: Column) -> Column:
    return F.log2(n_docs / df)


def idf(n_docs: Column, df: Column, mode: str = "tfidf") -> Column:
    if mode.lower() == "tfidf":
        return F.ln((n_docs + 1) / (df + 1))
    if mode.lower() == "bm25":
        return F.ln((n_docs - df + 0.5) / (df + 0.5))
    raise ValueError(f"idf mode must be tfidf or bm25, not {mode}")


def tf(count: Column, mode: str = "raw") -> Column:
    """Damped term frequency; any other mode leaves the count as it is."""
    if mode == "log":
        return 1 + F.ln(count)
    if mode == "loglog":
        return 1 + F.ln(1 + F.ln(count))
    if mode == "sqrt":
        return F.sqrt(count)
    return count.cast("double")
