"""Weight formulas."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def term_frequency(freq: Column, doc_length: Column) -> Column:
    """Share of a document's kept tokens; null where a foreign matrix gives a length of 0."""
    return F.try_divide(freq.cast("double"), doc_length.cast("double"))


def inverse_document_frequency(n_docs: Column, df: Column, smooth: bool = True) -> Column:
    """``ln((N+1)/(df+1)) + 1``, or ``ln(N/df)`` when ``smooth`` is off."""
    n_docs, df = n_docs.cast("double"), df.cast("double")
    if smooth:
        return F.log((n_docs + 1.0) / (df + 1.0)) + 1.0
    return F.log(n_docs / df)
