"""Porter stemming of single words, in the extended form common in Python text tools.

Follows M. F. Porter, "An algorithm for suffix stripping" (1980), with the widely used
extensions: short words stay, four-letter ``ies``/``ied`` keep the ``e``, a final ``y``
turns to ``i`` only after a consonant that is not the first letter, a few more step-2
suffixes, and a short list of irregular words.
"""

from __future__ import annotations

# Words with a stem of their own.
IRREGULAR = {
    "sky": "sky",
    "skies": "sky",
    "dying": "die",
    "lying": "lie",
    "tying": "tie",
    "news": "news",
    "inning": "inning",
    "innings": "inning",
    "outing": "outing",
    "outings": "outing",
    "canning": "canning",
    "cannings": "canning",
    "howe": "howe",
    "proceed": "proceed",
    "exceed": "exceed",
    "succeed": "succeed",
}

# Suffix and replacement of steps 2 and 3, suffixes of step 4.
STEP_2 = [
    ("ational", "ate"),
    ("tional", "tion"),
    ("enci", "ence"),
    ("anci", "ance"),
    ("izer", "ize"),
    ("bli", "ble"),
    ("alli", "al"),
    ("entli", "ent"),
    ("eli", "e"),
    ("ousli", "ous"),
    ("ization", "ize"),
    ("ation", "ate"),
    ("ator", "ate"),
    ("alism", "al"),
    ("iveness", "ive"),
    ("fulness", "ful"),
    ("ousness", "ous"),
    ("aliti", "al"),
    ("iviti", "ive"),
    ("biliti", "ble"),
    ("fulli", "ful"),
]
STEP_3 = [
    ("icate", "ic"),
    ("ative", ""),
    ("alize", "al"),
    ("iciti", "ic"),
    ("ical", "ic"),
    ("ful", ""),
    ("ness", ""),
]
STEP_4 = [
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment",
    "ent", "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize",
]

# One look at all suffixes of a step tells most words that it leaves as they are.
ENDS_2, ENDS_3, ENDS_4 = tuple(s for s, _ in STEP_2), tuple(s for s, _ in STEP_3), tuple(STEP_4)
LETTERS = "".join("v" if chr(i) in "aeiou" else "c" for i in range(128))


def shape(word: str) -> str:
    """One letter per character: ``c`` for a consonant, ``v`` for a vowel.

    ``y`` is a vowel after a consonant and a consonant elsewhere.
    """
    if "y" not in word and word.isascii():
        return word.translate(LETTERS)
    out = ""
    for ch in word:
        if ch in "aeiou" or (ch == "y" and out[-1:] == "c"):
            out += "v"
        else:
            out += "c"
    return out


def measure(word: str) -> int:
    """Number of vowel-to-consonant changes."""
    return shape(word).count("vc")


def _short_end(word: str) -> bool:
    form = shape(word)
    if len(word) == 2:
        return form == "vc"
    return form.endswith("cvc") and word[-1] not in "wxy"


def _doubled(word: str) -> bool:
    return word[-1:] == word[-2:-1] != "" and shape(word)[-1] == "c"


def _first(word: str, rules):
    return next(((word[: len(word) - len(s)], r) for s, r in rules if word.endswith(s)), None)


def _plural(word: str) -> str:
    if word.endswith("sses"):
        return word[:-2]
    if word.endswith("ies"):
        return word[:-1] if len(word) == 4 else word[:-2]
    if word.endswith("s") and not word.endswith("ss"):
        return word[:-1]
    return word


def _past(word: str) -> str:
    if word.endswith("ied"):
        return word[:-1] if len(word) == 4 else word[:-2]
    if word.endswith("eed"):
        return word[:-1] if measure(word[:-3]) > 0 else word
    cut = _first(word, [("ed", ""), ("ing", "")]) if word.endswith(("ed", "ing")) else None
    if cut is None or "v" not in shape(cut[0]):
        return word
    base = cut[0]
    if base.endswith(("at", "bl", "iz")):
        return base + "e"
    if _doubled(base):
        return base if base[-1] in "lsz" else base[:-1]
    return base + "e" if measure(base) == 1 and _short_end(base) else base


def _final_y(word: str) -> str:
    base = word[:-1]
    if word.endswith("y") and len(base) > 1 and shape(base)[-1] == "c":
        return base + "i"
    return word


def _derived(word: str) -> str:
    while word.endswith("alli") and measure(word[:-4]) > 0:
        word = word[:-2]
    hit = _first(word, STEP_2) if word.endswith(ENDS_2) else None
    if hit is not None:
        return hit[0] + hit[1] if measure(hit[0]) > 0 else word
    if word.endswith("logi") and measure(word[:-3]) > 0:
        return word[:-1]
    return word


def _adjective(word: str) -> str:
    hit = _first(word, STEP_3) if word.endswith(ENDS_3) else None
    return hit[0] + hit[1] if hit is not None and measure(hit[0]) > 0 else word


def _ending(word: str) -> str:
    if not word.endswith(ENDS_4):
        return word
    suffix = next(s for s in STEP_4 if word.endswith(s))
    base = word[: -len(suffix)]
    if measure(base) > 1 and (suffix != "ion" or base[-1] in "st"):
        return base
    return word


def _tidy(word: str) -> str:
    if word.endswith("e"):
        size = measure(word[:-1])
        if size > 1 or (size == 1 and not _short_end(word[:-1])):
            word = word[:-1]
    if word.endswith("ll") and measure(word[:-1]) > 1:
        word = word[:-1]
    return word


def stem(word: str) -> str:
    word = word.lower()
    if word in IRREGULAR:
        return IRREGULAR[word]
    if len(word) <= 2:
        return word
    for step in (_plural, _past, _final_y, _derived, _adjective, _ending, _tidy):
        word = step(word)
    return word
