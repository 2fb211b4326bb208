"""The stemmer as SQL over a table of words: an independent check of the Python one.

Vowels and consonants are told apart by patterns; a leading ``y`` is written ``Y`` so that
it counts as a consonant.
"""

from __future__ import annotations

# Fixed values, kept apart from the stemmer's own: words with a stem of their own, endings and what replaces them ("-": nothing).
IRREGULAR = (
    "sky sky, skies sky, dying die, lying lie, tying tie, news news, inning inning, innings inning, outing outing, outings outing, "
    "canning canning, cannings canning, howe howe, proceed proceed, exceed exceed, succeed succeed"
)
SECOND = (
    "ational ate, tional tion, enci ence, anci ance, izer ize, bli ble, alli al, entli ent, eli e, ousli ous, ization ize, ation ate, "
    "ator ate, alism al, iveness ive, fulness ful, ousness ous, aliti al, iviti ive, biliti ble, fulli ful"
)
THIRD = "icate ic, ative -, alize al, iciti ic, ical ic, ful -, ness -"
FOURTH = "al ance ence er ic able ible ant ement ment ent ion ou ism ate iti ous ive ize"

C = "[^aeiou][^aeiouy]*"
V = "[aeiouy][aeiou]*"
SOME = f"^({C})?{V}{C}"
ONE = f"^({C})?{V}{C}({V})?$"
TWO = f"^({C})?{V}{C}{V}{C}"
VOWEL = f"^({C})?[aeiouy]"
SHORT = f"^({C}[aeiouy][^aeiouwxy]|[aeiou][^aeiou])$"
DOUBLED = "(bb|cc|dd|ff|gg|hh|jj|kk|mm|nn|pp|qq|rr|tt|vv|ww|xx|[^aeiouy]yy)$"


def _has(text: str, pattern: str) -> str:
    return f"regexp_matches({text}, '{pattern}')"


def _cut(n: int) -> str:
    return f"left(s, length(s) - {n})"


def _pairs(listed: str) -> list[list[str]]:
    return [entry.split() for entry in listed.replace("-", "").split(", ")]


def _rules(listed: str) -> str:
    """First suffix that fits decides; it is replaced when the rest has a measure above 0."""
    cases = " ".join(
        f"WHEN suffix(s, '{old}') THEN CASE WHEN {_has(_cut(len(old)), SOME)} THEN {_cut(len(old))} || '{''.join(new)}' ELSE s END"
        for old, *new in _pairs(listed)
    )
    return cases


def stem_ctes(words: str) -> str:
    """CTEs that end in ``stems(word, stem)`` for the CTE ``words(word)``."""
    irregular = " ".join(f"WHEN word = '{w}' THEN '{s}'" for w, s in _pairs(IRREGULAR))
    step_4 = " ".join(
        f"WHEN suffix(s, '{x}') THEN CASE WHEN {_has(_cut(len(x)), TWO)}"
        + (f" AND {_has(_cut(len(x)), '[st]$')}" if x == "ion" else "")
        + f" THEN {_cut(len(x))} ELSE s END"
        for x in FOURTH.split()
    )
    return f"""
p0 AS (SELECT word, CASE WHEN word[1] = 'y' THEN 'Y' || word[2:] ELSE word END AS s
       FROM {words} WHERE length(word) > 2),
p1 AS (SELECT word, CASE WHEN suffix(s, 'sses') THEN {_cut(2)}
         WHEN suffix(s, 'ies') THEN CASE WHEN length(s) = 4 THEN {_cut(1)} ELSE {_cut(2)} END
         WHEN suffix(s, 's') AND NOT suffix(s, 'ss') THEN {_cut(1)} ELSE s END AS s FROM p0),
p2 AS (SELECT word, s, CASE
         WHEN suffix(s, 'ied') OR suffix(s, 'eed') THEN NULL
         WHEN suffix(s, 'ed') AND {_has(_cut(2), VOWEL)} THEN {_cut(2)}
         WHEN suffix(s, 'ing') AND {_has(_cut(3), VOWEL)} THEN {_cut(3)} END AS b FROM p1),
p3 AS (SELECT word, CASE
         WHEN suffix(s, 'ied') THEN CASE WHEN length(s) = 4 THEN {_cut(1)} ELSE {_cut(2)} END
         WHEN suffix(s, 'eed') THEN CASE WHEN {_has(_cut(3), SOME)} THEN {_cut(1)} ELSE s END
         WHEN b IS NULL THEN s
         WHEN {_has('b', '(at|bl|iz)$')} THEN b || 'e'
         WHEN {_has('b', '(ll|ss|zz)$')} THEN b
         WHEN {_has('b', DOUBLED)} THEN left(b, length(b) - 1)
         WHEN {_has('b', SHORT)} THEN b || 'e'
         ELSE b END AS s FROM p2),
p4 AS (SELECT word, CASE WHEN {_has('s', '.([^aeiouy])y$')} OR {_has('s', '[aeiou]yy$')} THEN {_cut(1)} || 'i' ELSE s END AS s FROM p3),
p5 AS (SELECT word, CASE WHEN suffix(s, 'alli') AND {_has(_cut(4), SOME)} THEN {_cut(2)} ELSE s END AS s FROM p4),
p6 AS (SELECT word, CASE {_rules(SECOND)}
         WHEN suffix(s, 'logi') AND {_has(_cut(3), SOME)} THEN {_cut(1)} ELSE s END AS s FROM p5),
p7 AS (SELECT word, CASE {_rules(THIRD)} ELSE s END AS s FROM p6),
p8 AS (SELECT word, CASE {step_4} ELSE s END AS s FROM p7),
p9 AS (SELECT word, CASE WHEN suffix(s, 'e') AND ({_has(_cut(1), TWO)}
         OR ({_has(_cut(1), ONE)} AND NOT {_has(_cut(1), SHORT)})) THEN {_cut(1)} ELSE s END AS s FROM p8),
stems AS (
  SELECT word, CASE {irregular} WHEN suffix(s, 'll') AND {_has(_cut(1), TWO)} THEN lower({_cut(1)}) ELSE lower(s) END AS stem
  FROM p9
  UNION ALL SELECT word, word FROM {words} WHERE length(word) <= 2
)"""
