"""SCL-1: the cleaning chain - repeats, unicode, punctuation, digits, names, in this order.

With a small name dictionary the whole chain is one pass over the texts: no shuffle, no
checkpoint. With a large one, masking joins (see :mod:`parley.operators.names`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.functions import text as tx
from parley.operators.names import mask_names
from parley.operators.repeats import repeats_removed


def clean_texts(df: DataFrame, id_col: str, text_col: str, names: DataFrame | None, compat: bool = False,
                out_col: str | None = None, digits_twice: bool = False) -> DataFrame:
    """The rows of ``df`` with a cleaned text in ``out_col`` (``text_col`` by default; it is not kept
    otherwise). ``names=None`` skips masking."""
    out_col = out_col or text_col
    c = tx.strip_digits(tx.normalise_punct(tx.repair_unicode(repeats_removed(F.col(text_col))), compat=compat))
    if digits_twice:  # the agent side removes digits again (idempotent, kept for parity)
        c = tx.strip_digits(c)
    rest = [x for x in df.columns if x not in (text_col, out_col)]
    t = df.select(*rest, c.alias(out_col))
    return t if names is None else mask_names(t, id_col, out_col, names, compat=compat)


def clean_audit(df: DataFrame, id_col: str, text_col: str, group_col: str, names: DataFrame | None) -> DataFrame:
    """SNK-3 summary: per group, rows, changed rows, emptied rows, characters removed. A text is cleaned beside
    itself, in one pass: nothing is joined, so repeated and missing ids count like any other."""
    both = clean_texts(df.withColumn("_o", F.col(text_col)), id_col, text_col, names, out_col="_n")
    return both.groupBy(group_col).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(~F.col("_o").eqNullSafe(F.col("_n"))).alias("n_changed"),
        F.count_if((F.length("_n") == 0) & (F.length("_o") > 0)).alias("n_emptied"),
        F.sum(F.coalesce(F.length("_o"), F.lit(0)) - F.coalesce(F.length("_n"), F.lit(0))).alias("chars_removed"),
    )
