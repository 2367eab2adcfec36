"""Column expressions for text cleaning (SCL-2..7, SCL-14).

All of them are built-in Spark expressions, so they stay inside whole-stage code generation.
Regular-expression classes are written so that Java regex (Spark) and RE2 (the SQL oracle)
read them the same way: Python's notion of blank (``str.split()``) and word character (``\\w``)
are spelled out instead of relying on engine flags.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from parley.constants import ACCENT_FOLD, PUNCT_COMPAT_ONLY, PUNCT_MAP

# Characters Python's str.split() treats as blanks (content of a character class).
WS = (
    r"\t\n\x0B\f\r \x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
# Python's \w for text: letters, numbers, underscore (content of a character class).
WORD = r"\p{L}\p{N}_"

DIGITS_RE = r"\p{Nd}+"
NON_WORD_RE = f"[^{WORD}{WS}]"
TERM_RE = r"[\p{L}\p{N}]+"

FOLD_FROM = "".join(src for src, _ in ACCENT_FOLD)
FOLD_TO = "".join(dst * len(src) for src, dst in ACCENT_FOLD)

# Unicode repair tables (our named subset of a general text-repair library).
TERMINAL_ESCAPE_RE = r"\x1b\[[0-9;]*[A-Za-z]"
CONTROL_RE = r"[\x00-\x08\x0B\x0E-\x1F\x7F\x{206A}-\x{206F}\x{FEFF}\x{FFF9}-\x{FFFC}]"
LINE_BREAK_RE = r"\r\n|[\r\x{2028}\x{2029}\x{85}]"
LATIN1_ONLY_RE = r"\A[\x00-\x{FF}]*\z"  # \z: $ would also match before a final line terminator
UTF8_LEAD_RE = r"[\x{C2}-\x{F4}][\x{80}-\x{BF}]"
# UTF-8 sequences read as Latin-1: of two characters only for U+0080..U+027F (a lone pair can be meant as it is), of three
# and four any that is well-formed.
HIGH_RUN_RE = r"[\x{80}-\x{FF}]+|[^\x{80}-\x{FF}]+"
_NEXT = r"[\x{80}-\x{BF}]"
UTF8_SEQUENCE = (rf"[\x{{C2}}-\x{{C9}}]{_NEXT}|\x{{E0}}[\x{{A0}}-\x{{BF}}]{_NEXT}|[\x{{E1}}-\x{{EC}}\x{{EE}}\x{{EF}}]{_NEXT}{_NEXT}|"
                 rf"\x{{ED}}[\x{{80}}-\x{{9F}}]{_NEXT}|\x{{F0}}[\x{{90}}-\x{{BF}}]{_NEXT}{_NEXT}|"
                 rf"[\x{{F1}}-\x{{F3}}]{_NEXT}{_NEXT}{_NEXT}|\x{{F4}}[\x{{80}}-\x{{8F}}]{_NEXT}{_NEXT}")
LIGATURES = [("ﬀ", "ff"), ("ﬁ", "fi"), ("ﬂ", "fl"), ("ﬃ", "ffi"), ("ﬄ", "ffl"), ("ﬅ", "st"),
             ("ﬆ", "st"), ("Ĳ", "IJ"), ("ĳ", "ij")]
HTML_ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"),
                 ("&nbsp;", "\u00a0"), ("&amp;", "&")]
SINGLE_QUOTES = "‘’‚‛"
DOUBLE_QUOTES = "“”„‟"
# Full-width ASCII block U+FF01..U+FF5E maps to U+0021..U+007E; U+3000 to a space (by rule).
WIDE_FROM = "".join(chr(c) for c in range(0xFF01, 0xFF5F)) + "　"
WIDE_TO = "".join(chr(c) for c in range(0x21, 0x7F)) + " "


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def split_words(col) -> Column:
    """Python ``str.split()``: blank runs separate words; no empty words."""
    parts = F.split(_c(col), f"[{WS}]+")
    return F.filter(parts, lambda w: w != F.lit(""))


def punct_pairs(compat: bool = False):
    one = [(s, d) for s, d in PUNCT_MAP if len(d) == 1 and (compat or s != PUNCT_COMPAT_ONLY)]
    many = [(s, d) for s, d in PUNCT_MAP if len(d) != 1]
    return one, many


def normalise_punct(col, compat: bool = False) -> Column:
    """SCL-3: one pass of the punctuation map (translate for 1:1 entries, replace for the rest)."""
    one, many = punct_pairs(compat)
    out = F.translate(_c(col), "".join(s for s, _ in one), "".join(d for _, d in one))
    for src, dst in many:
        out = F.replace(out, F.lit(src), F.lit(dst))
    return out


def strip_digits(col) -> Column:
    """SCL-4: remove every Unicode decimal digit (Java's ``\\d`` alone is ASCII only)."""
    return F.regexp_replace(_c(col), DIGITS_RE, "")


def fold_accents(col) -> Column:
    """Lower-case accented vowels and c-cedilla to their plain letter."""
    return F.translate(_c(col), FOLD_FROM, FOLD_TO)


def strip_non_word(col) -> Column:
    """SCL-5: drop characters that are neither word characters nor blanks."""
    return F.regexp_replace(_c(col), NON_WORD_RE, "")


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with ``value`` computed once however often ``use`` names it (expressions are
    merged by writing them out at every place)."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _reread(c: Column) -> Column:
    """The mojibake step of :func:`repair_unicode`."""
    read = lambda x: F.try_validate_utf8(F.encode(x, "ISO-8859-1").cast("string"))
    runs = F.transform(F.regexp_extract_all(c, F.lit(HIGH_RUN_RE), 0), lambda x: F.when(
        x.rlike(rf"\A(?:{UTF8_SEQUENCE})+\z"), F.coalesce(read(x), x)).otherwise(x))
    whole = F.when(c.rlike(LATIN1_ONLY_RE) & c.rlike(UTF8_LEAD_RE), read(c))
    by_runs = F.when(c.rlike(UTF8_SEQUENCE), F.array_join(runs, "")).otherwise(c)
    return F.coalesce(whole, by_runs)


def _unescaped(c: Column) -> Column:
    """The entity step of :func:`repair_unicode`."""
    out = c
    for ent, ch in HTML_ENTITIES:
        out = F.replace(out, F.lit(ent), F.lit(ch))
    return F.when((F.instr(c, "<") > 0) | (F.instr(c, "&") == 0), c).otherwise(out)


def by_slices(fn: Callable[[pd.Series], pd.Series], most_bytes: int = 1 << 20) -> Callable[[Column], Column]:
    """A function of a series of texts as a column function. A batch is handled in slices of about
    ``most_bytes``, so that a task's Python holds few texts as objects, however large its batches are."""

    @F.arrow_udf("string")
    def run(texts: pa.Array) -> pa.Array:
        rows = max(1, most_bytes * len(texts) // max(1, texts.nbytes))
        parts = [pa.array(fn(pd.Series(texts.slice(at, rows).to_pylist(), dtype=object)).tolist(), pa.string())
                 for at in range(0, len(texts), rows)]
        return pa.concat_arrays(parts) if parts else pa.array([], pa.string())

    return run


def repair_unicode(col) -> Column:
    """SCL-2, native subset: terminal escapes, Latin-1 mojibake, HTML entities (only in text
    without '<'), line breaks, control characters, ligatures, full-width forms, curly quotes.

    The mojibake step re-reads a whole text as UTF-8 when every character fits in Latin-1 and
    the re-read bytes are valid UTF-8. Any other text is repaired by runs: a maximal run of
    characters from U+0080 to U+00FF that is made of UTF-8 sequences is re-read, whatever stands
    around it. One layer of damage is undone. NFC is separate (``nfc_normalise``), because Spark has
    no built-in for it.
    """
    c = F.regexp_replace(_c(col), TERMINAL_ESCAPE_RE, "")
    # a text of ASCII alone holds no damage
    c = once(c, lambda x: F.when(F.octet_length(x) == F.length(x), x).otherwise(_reread(x)))
    c = once(c, _unescaped)
    c = F.regexp_replace(c, LINE_BREAK_RE, "\n")
    c = F.regexp_replace(c, CONTROL_RE, "")
    for lig, rep in LIGATURES:
        c = F.replace(c, F.lit(lig), F.lit(rep))
    c = F.translate(c, WIDE_FROM + SINGLE_QUOTES + DOUBLE_QUOTES,
                    WIDE_TO + "'" * len(SINGLE_QUOTES) + '"' * len(DOUBLE_QUOTES))
    return c


def analyse_terms(col) -> Column:
    """SCL-14: lower-case, fold accents, split into letter/number runs (stemming not built)."""
    return F.regexp_extract_all(fold_accents(F.lower(_c(col))), F.lit(TERM_RE), 0)


def count_occurrences(col, token: str) -> Column:
    """Number of non-overlapping occurrences of ``token`` in a string."""
    c = _c(col)
    return ((F.length(c) - F.length(F.replace(c, F.lit(token), F.lit("")))) / len(token)).cast("bigint")


def _nfc_batch(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFC", x))


def nfc_normalise(col) -> Column:
    """SCL-2, last step: Unicode NFC. Spark has no built-in for it, so this one step is an
    Arrow-batched UDF."""
    return by_slices(_nfc_batch)(_c(col))
