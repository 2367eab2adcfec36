"""Builders for the independent DuckDB oracle SQL.

These produce plain ANSI-ish SQL text for DuckDB (RE2 regular expressions, list lambdas).
They re-state each rule in a different form from the Spark plans (for instance the
repetition filter materialises the gap end-point sets, and default name masking rebuilds the
text piece by piece), so an agreement is a real check. Patterns and tables are stated here again,
in RE2's terms; only fixed values of ``constants`` are imported.
"""

from __future__ import annotations

from parley.constants import ACCENT_FOLD, NAME_MASK, PUNCT_MAP, PUNCT_COMPAT_ONLY

# Characters that end a word, by code point.
WS = "".join(f"\\x{{{c:x}}}" for c in [*range(9, 14), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
                                      0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
WORD = "_\\pL\\pN"
NON_WORD_RE = f"[^{WS}{WORD}]"
TERM_RE = "(?:\\pL|\\pN)+"
FOLD_FROM = "".join(accented for accented, _ in ACCENT_FOLD)
FOLD_TO = "".join(plain for accented, plain in ACCENT_FOLD for _ in accented)
TERMINAL_ESCAPE_RE = "\\x1b\\[[;0-9]*[a-zA-Z]"
CONTROL_RE = "[" + "".join(f"\\x{{{c:x}}}" for c in [*range(9), 11, *range(14, 32), 127, *range(0x206A, 0x2070), 0xFEFF,
                                                    *range(0xFFF9, 0xFFFD)]) + "]"
LINE_BREAK_RE = "\r\n|\r|\u2028|\u2029|\u0085"
LATIN1_ONLY_RE = "[\\x{0}-\\x{ff}]*"
UTF8_LEAD_RE = "[Â-ô][\\x{80}-¿]"
# UTF-8 read as Latin-1: (first character, second character, how many more from 80 to BF)
_TAIL = "[\\x{80}-\\x{BF}]"
UTF8_SEQUENCE = "|".join(f"[\\x{{{a}}}-\\x{{{b}}}][\\x{{{c}}}-\\x{{{d}}}]" + _TAIL * more for a, b, c, d, more in [
    ("C2", "C9", "80", "BF", 0), ("E0", "E0", "A0", "BF", 1), ("E1", "EC", "80", "BF", 1), ("ED", "ED", "80", "9F", 1), ("EE", "EF", "80", "BF", 1),
    ("F0", "F0", "90", "BF", 2), ("F1", "F3", "80", "BF", 2), ("F4", "F4", "80", "8F", 2)])
HIGH_RUN_RE = "[\\x{80}-ÿ]+|[^\\x{80}-ÿ]+"
LIGATURES = dict(zip("ﬀﬁﬂﬃﬄﬅﬆĲĳ", ["ff", "fi", "fl", "ffi", "ffl", "st", "st", "IJ", "ij"])).items()
HTML_ENTITIES = [("&nbsp;", "\u00a0"), ("&apos;", "'"), ("&#39;", "'"), ("&quot;", '"'), ("&gt;", ">"), ("&lt;", "<"), ("&amp;", "&")]
SINGLE_QUOTES = "\u2018\u2019\u201a\u201b"
DOUBLE_QUOTES = "\u201c\u201d\u201e\u201f"
WIDE_FROM = "\u3000" + "".join(map(chr, range(0xFF01, 0xFF5F)))
WIDE_TO = "".join(chr(ord(c) - 0xFEE0) if c != "\u3000" else " " for c in WIDE_FROM)


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def words_list(e: str) -> str:
    return f"list_filter(regexp_split_to_array({e}, {lit('[' + WS + ']+')}), lambda x: x <> '')"


def punct(e: str, compat: bool = False) -> str:
    one = [(s, d) for s, d in PUNCT_MAP if len(d) == 1 and (compat or s != PUNCT_COMPAT_ONLY)]
    out = f"translate({e}, {lit(''.join(s for s, _ in one))}, {lit(''.join(d for _, d in one))})"
    for s, d in PUNCT_MAP:
        if len(d) != 1:
            out = f"replace({out}, {lit(s)}, {lit(d)})"
    return out


def digits(e: str) -> str:
    return f"regexp_replace({e}, '\\p{{Nd}}+', '', 'g')"


def fold(e: str) -> str:
    return f"translate({e}, {lit(FOLD_FROM)}, {lit(FOLD_TO)})"


def unicode_steps(src: str, id_col: str = "id", col: str = "text") -> list[tuple[str, str]]:
    """CTE list (name, body) repairing ``col`` of ``src`` step by step."""
    steps = []
    prev = src

    def step(name, expr):
        nonlocal prev
        steps.append((name, f"SELECT {id_col}, {expr} AS {col} FROM {prev}"))
        prev = name

    step("u1", f"regexp_replace({col}, {lit(TERMINAL_ESCAPE_RE)}, '', 'g')")
    bytes_of = lambda x: (f"array_to_string(list_transform(string_split({x}, ''), "  # noqa: E731
                          f"lambda ch: printf('\\x%02X', unicode(ch))), '')")
    whole = (f"CASE WHEN regexp_full_match({col}, {lit(LATIN1_ONLY_RE)}) AND regexp_matches({col}, {lit(UTF8_LEAD_RE)}) "
             f"THEN try(decode(({bytes_of(col)})::BLOB)) END")
    runs = (f"list_transform(regexp_extract_all({col}, {lit(HIGH_RUN_RE)}), lambda x: CASE WHEN regexp_full_match(x, "
            f"{lit('(?:' + UTF8_SEQUENCE + ')+')}) THEN coalesce(try(decode(({bytes_of('x')})::BLOB)), x) ELSE x END)")
    step("u2", f"CASE WHEN regexp_matches({col}, {lit(UTF8_SEQUENCE)}) THEN coalesce({whole}, array_to_string({runs}, '')) "
               f"ELSE coalesce({whole}, {col}) END")
    html = col
    for ent, ch in HTML_ENTITIES:
        html = f"replace({html}, {lit(ent)}, {lit(ch)})"
    step("u3", f"CASE WHEN instr({col}, '<') > 0 THEN {col} ELSE {html} END")
    step("u4", f"regexp_replace({col}, {lit(LINE_BREAK_RE)}, chr(10), 'g')")
    step("u5", f"regexp_replace({col}, {lit(CONTROL_RE)}, '', 'g')")
    lig = col
    for a, b in LIGATURES:
        lig = f"replace({lig}, {lit(a)}, {lit(b)})"
    step("u6", lig)
    src_chars = WIDE_FROM + SINGLE_QUOTES + DOUBLE_QUOTES
    dst_chars = WIDE_TO + "'" * len(SINGLE_QUOTES) + '"' * len(DOUBLE_QUOTES)
    step("u7", f"translate({col}, {lit(src_chars)}, {lit(dst_chars)})")
    return steps


def repeats_steps(src: str, id_col: str = "id", col: str = "text", out: str = "r_out") -> list[tuple[str, str]]:
    """WIN-1 by explicit end-point sets: returns CTEs ending in ``out(id, text)``."""
    return [
        ("r_w", f"SELECT {id_col}, unnest(ws) AS w, unnest(range(len(ws))) AS pos "
                f"FROM (SELECT {id_col}, {words_list(col)} AS ws FROM {src})"),
        ("r_g", f"SELECT {id_col}, w, pos, count(*) OVER (PARTITION BY {id_col}, w) AS n, "
                f"pos - lag(pos) OVER (PARTITION BY {id_col}, w ORDER BY pos) AS d FROM r_w"),
        ("r_e", f"SELECT {id_col}, w, d, pos - d AS p FROM r_g WHERE n >= 4 AND d IS NOT NULL "
                f"UNION SELECT {id_col}, w, d, pos AS p FROM r_g WHERE n >= 4 AND d IS NOT NULL"),
        ("r_del", f"SELECT DISTINCT {id_col}, p AS pos FROM (SELECT *, count(*) OVER "
                  f"(PARTITION BY {id_col}, w, d) AS c FROM r_e) WHERE c >= 5"),
        ("r_k", f"SELECT r_w.{id_col}, string_agg(r_w.w, ' ' ORDER BY r_w.pos) AS t FROM r_w "
                f"ANTI JOIN r_del ON r_w.{id_col} = r_del.{id_col} AND r_w.pos = r_del.pos GROUP BY r_w.{id_col}"),
        (out, f"SELECT s.{id_col}, CASE WHEN s.{col} IS NULL THEN NULL ELSE coalesce(k.t, '') END AS {col} "
              f"FROM {src} s LEFT JOIN r_k k ON s.{id_col} = k.{id_col}"),
    ]


def names_steps(out: str = "nm") -> list[tuple[str, str]]:
    """Name dictionary from ``benchmark`` (first word of each item, two lists by key parity)."""
    return [
        ("nm_raw", f"SELECT regexp_extract(text, {lit('^[' + WS + ']*([' + WORD + ']+)')}, 1) AS name, "
                   f"CASE WHEN item_id % 2 = 0 THEN 'list_a' ELSE 'list_b' END AS list, item_id AS rank FROM benchmark"),
        (out, "SELECT DISTINCT lower(name) AS name FROM nm_raw WHERE name IS NOT NULL AND lower(name) <> ''"),
    ]


def mask_steps(src: str, names: str, compat: bool, id_col: str = "id", col: str = "text",
               out: str = "m_out") -> list[tuple[str, str]]:
    strip = f"regexp_replace(piece, {lit(NON_WORD_RE)}, '', 'g')"
    if compat:
        k1 = f"lower({fold('w')})"
        return [
            ("m_t", f"SELECT {id_col}, unnest(p) AS piece, unnest(range(len(p))) AS i FROM "
                    f"(SELECT {id_col}, regexp_split_to_array({col}, {lit('[' + WS + ']+')}) AS p FROM {src})"),
            ("m_w", f"SELECT {id_col}, i, w FROM (SELECT {id_col}, i, {strip} AS w FROM m_t) "
                    f"WHERE w <> '' AND ({k1} IN (SELECT name FROM {names}) OR lower(w) IN (SELECT name FROM {names}))"),
            ("m_l", f"SELECT {id_col}, list(w ORDER BY i) AS ws FROM m_w GROUP BY {id_col}"),
            (out, f"SELECT s.{id_col}, CASE WHEN l.ws IS NULL THEN s.{col} ELSE "
                  f"list_reduce(l.ws, lambda acc, w: replace(acc, w, '{NAME_MASK}'), s.{col}) END AS {col} "
                  f"FROM {src} s LEFT JOIN m_l l ON s.{id_col} = l.{id_col}"),
        ]
    k1 = fold("lower(w)")
    return [
        ("m_p", f"SELECT {id_col}, unnest(p) AS piece, unnest(range(len(p))) AS i FROM "
                f"(SELECT {id_col}, regexp_extract_all({col}, {lit('[' + WS + ']+|[^' + WS + ']+')}) AS p FROM {src})"),
        ("m_q", f"SELECT {id_col}, i, piece, {strip} AS w FROM m_p"),
        ("m_r", f"SELECT {id_col}, i, CASE WHEN w <> '' AND contains(piece, w) AND ({k1} IN (SELECT name FROM {names}) "
                f"OR lower(w) IN (SELECT name FROM {names})) THEN replace(piece, w, '{NAME_MASK}') ELSE piece END AS piece FROM m_q"),
        ("m_s", f"SELECT {id_col}, string_agg(piece, '' ORDER BY i) AS t FROM m_r GROUP BY {id_col}"),
        (out, f"SELECT s.{id_col}, CASE WHEN s.{col} IS NULL THEN NULL ELSE coalesce(m.t, '') END AS {col} "
              f"FROM {src} s LEFT JOIN m_s m ON s.{id_col} = m.{id_col}"),
    ]


def clean_steps(src: str, names: str | None, compat: bool = False, id_col: str = "id", col: str = "text",
                out: str = "c_out", digits_twice: bool = False) -> list[tuple[str, str]]:
    """The cleaning chain over ``src(id, text)`` -> ``out(id, text)``."""
    steps = repeats_steps(src, id_col, col, out="c_r")
    steps += unicode_steps("c_r", id_col, col)
    d = digits(punct(col, compat))
    if digits_twice:
        d = digits(d)
    last = "c_d" if names else out
    steps.append((last, f"SELECT {id_col}, {d} AS {col} FROM u7"))
    if names:
        steps += mask_steps("c_d", names, compat, id_col, col, out=out)
    return steps


def terms(e: str) -> str:
    return f"regexp_extract_all({fold(f'lower({e})')}, {lit(TERM_RE)})"


def with_ctes(steps: list[tuple[str, str]], final: str) -> str:
    if not steps:
        return final
    return "WITH " + ",\n".join(f"{n} AS ({b})" for n, b in steps) + "\n" + final
