"""SRC-4, SET-3, TOP-3, SCL-5, SCL-6, JOIN-4: name dictionary and name masking.

A token (blank-separated piece of the text) is a name when its stripped form (non-word
characters removed), lower-cased and accent-folded, or only lower-cased, is in the dictionary.

* ``default``: only whole tokens are masked; a token ``P1 + word + P2`` (P1, P2 punctuation)
  becomes ``P1 + NOME + P2``. Lower-casing happens before folding, so capital accents fold too.
* ``compat``: the stripped word is replaced as a substring of the whole text, sequentially in
  token order (behaviour B3), and folding happens before lower-casing (behaviour B4).

No name is left out: ``per_list`` (TOP-3) cuts the lists only where a caller asks for it.

Plan: a dictionary of at most ``SMALL_DICTIONARY`` names, counted first, travels to the tasks as a
set, and masking is one pass over each text without a shuffle. A larger one is joined: tokens are
exploded map-side, matched on both keys by equi-joins whose strategy adaptive execution picks from
measured sizes, gathered per id and joined back to the texts.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley.constants import ACCENT_FOLD, NAME_MASK
from parley.functions.text import WORD, WS, by_slices, fold_accents, strip_non_word

#: Names (not texts) that a closure may carry: some megabytes at most.
SMALL_DICTIONARY = 100_000


def load_names(names: DataFrame, per_list: int | None = None) -> DataFrame:
    """``names(name, list, rank)`` -> distinct lower-cased ``name``, lists united (SET-3). All
    names; with ``per_list``, the first ``per_list`` rows of each list by rank (TOP-3)."""
    given = names.where(F.col("name").isNotNull())
    if per_list is not None:
        w = Window.partitionBy("list").orderBy("rank", "name")
        given = given.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= per_list)
    return given.select(F.lower("name").alias("name")).where(F.col("name") != "").distinct()


def names_from_items(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Test stand-in for the two name lists: the first word of each item, two lists by parity of
    the item key, ranked by key. Every item is used."""
    first = F.regexp_extract(F.col(text_col), f"^[{WS}]*([{WORD}]+)", 1)
    return items.select(
        first.alias("name"),
        F.when(F.col(id_col) % 2 == 0, F.lit("list_a")).otherwise(F.lit("list_b")).alias("list"),
        F.col(id_col).alias("rank"),
    )


def _match_keys(stripped, compat: bool):
    if compat:
        return F.lower(fold_accents(stripped)), F.lower(stripped)
    return fold_accents(F.lower(stripped)), F.lower(stripped)


def matched_words(df: DataFrame, id_col: str, text_col: str, names: DataFrame, compat: bool = False) -> DataFrame:
    """``(id, words)``: stripped name tokens of each text, in token order."""
    # Stripping, lower-casing and folding never create or remove blanks, so applying them to
    # the whole text once and then splitting gives every token's stripped form and keys,
    # aligned by position (string functions run once per text, not once per token).
    stripped = strip_non_word(F.col(text_col))
    k_fold, k_plain = _match_keys(stripped, compat)
    sep = f"[{WS}]+"
    zipped = F.arrays_zip(F.split(stripped, sep).alias("w"), F.split(k_fold, sep).alias("k1"),
                          F.split(k_plain, sep).alias("k2"))
    toks = (
        df.select(id_col, F.posexplode(zipped).alias("pos", "t"))
        .select(id_col, "pos", "t.w", "t.k1", "t.k2")
        .where(F.col("w") != "")
    )
    nm = names.select(F.col("name").alias("_n1"), F.lit(True).alias("_h1"))
    nm2 = names.select(F.col("name").alias("_n2"), F.lit(True).alias("_h2"))
    hit = (
        toks.join(nm, toks.k1 == nm._n1, "left")
        .join(nm2, toks.k2 == nm2._n2, "left")
        .where(F.col("_h1").isNotNull() | F.col("_h2").isNotNull())
    )
    if compat:
        # A repeated replace of a word is a no-op unless the word shares a character with the
        # mask (only then can earlier replacements create new occurrences); keep first
        # occurrences of the others.
        first = F.min("pos").over(Window.partitionBy(id_col, "w"))
        mask_chars = "[" + "".join(sorted(set(NAME_MASK))) + "]"
        hit = hit.withColumn("_first", first).where((F.col("pos") == F.col("_first")) | F.col("w").rlike(mask_chars))
    else:
        hit = hit.select(id_col, "pos", "w").dropDuplicates([id_col, "w"])
    return hit.groupBy(id_col).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "w"))), lambda s: s["w"]).alias("words")
    )


def _token_pattern(alternatives):
    """Whole tokens ``P1 + word + P2`` (P1, P2 without word characters). Words hold only word
    characters, so they need no escaping inside the alternation."""
    return F.concat(F.lit(f"(?<![^{WS}])([^{WORD}{WS}]*)(?:"), alternatives,
                    F.lit(f")([^{WORD}{WS}]*)(?![^{WS}])"))


def apply_mask(text, words, compat: bool = False):
    """Replace the given words in ``text`` (see module doc for the two modes)."""
    if compat:
        return F.aggregate(words, text, lambda acc, w: F.replace(acc, w, F.lit(NAME_MASK)))
    return F.regexp_replace(text, _token_pattern(F.array_join(words, "|")), F.lit(f"$1{NAME_MASK}$2"))


def small_dictionary(names: DataFrame, most: int = SMALL_DICTIONARY) -> frozenset[str] | None:
    """The names as a set, or None if there are more than ``most``."""
    found = names.limit(most + 1).collect()
    return frozenset(r.name for r in found) if len(found) <= most else None


def _masker(names: frozenset[str], compat: bool) -> Callable[[pd.Series], pd.Series]:
    folding = str.maketrans({c: plain for accented, plain in ACCENT_FOLD for c in accented})
    marks = re.compile(r"\W+")
    around = re.compile(r"\A(\W*)(\w+)(\W*)\Z")
    is_name: dict[str, bool] = {}

    def known(word: str) -> bool:
        if word not in is_name:
            if len(is_name) > 50_000:
                is_name.clear()
            folded = word.translate(folding).lower() if compat else word.lower().translate(folding)
            is_name[word] = folded in names or word.lower() in names
        return is_name[word]

    def mask(text: str | None) -> str | None:
        if text is None:
            return None
        hits = {t: w for t in set(text.split()) if (w := t if t.isalnum() else marks.sub("", t)) and known(w)}
        if not hits:
            return text
        if compat:
            for token in text.split():
                if token in hits:
                    text = text.replace(hits[token], NAME_MASK)
            return text
        for token, word in hits.items():
            parts = around.match(token)
            hits[token] = parts[1] + NAME_MASK + parts[3] if parts and parts[2] == word else token
        # blanks as Python's split() sees them: \s and the four separators it leaves out
        return re.sub(r"[^\s\x1c-\x1f]+", lambda m: hits.get(m[0], m[0]), text)

    return lambda texts: texts.map(mask)


def masked_text(text: Column, names: frozenset[str], compat: bool = False) -> Column:
    """Mask with a small dictionary: one pass over each text."""

    return by_slices(_masker(names, compat))(text)


def mask_names(df: DataFrame, id_col: str, text_col: str, names: DataFrame, compat: bool = False,
               out_col: str | None = None, small: int = SMALL_DICTIONARY) -> DataFrame:
    """Return ``df`` with names in ``text_col`` masked; other columns kept. A dictionary of more
    than ``small`` names is joined instead of sent along."""
    out_col = out_col or text_col
    held = small_dictionary(names, small)
    if held is not None:
        return df.withColumn(out_col, masked_text(F.col(text_col), held, compat))
    found = matched_words(df, id_col, text_col, names, compat)
    joined = df.join(found, id_col, "left")
    masked = F.when(F.col("words").isNull(), F.col(text_col)).otherwise(
        apply_mask(F.col(text_col), F.col("words"), compat))
    return joined.withColumn(out_col, masked).drop("words")
