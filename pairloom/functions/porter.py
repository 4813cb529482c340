"""Porter's stemmer (M. F. Porter, An algorithm for suffix stripping, 1980), for lower-case ASCII words."""

from __future__ import annotations

from functools import lru_cache

# The suffix rules of steps 2, 3 and 4.
STEP2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize", "abli": "able", "alli": "al", "entli": "ent", "eli": "e",
    "ousli": "ous", "ization": "ize", "ation": "ate", "ator": "ate", "alism": "al", "iveness": "ive", "fulness": "ful", "ousness": "ous",
    "aliti": "al", "iviti": "ive", "biliti": "ble",
}
STEP3 = {"icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": ""}
STEP4 = ("al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize")


def _vowel(word: str, i: int) -> bool:
    return word[i] in "aeiou" or word[i] == "y" and i > 0 and not _vowel(word, i - 1)


def _measure(word: str) -> int:
    """Vowel runs that a consonant follows."""
    kinds = [_vowel(word, i) for i in range(len(word))]
    return sum(a and not b for a, b in zip(kinds, kinds[1:]))


def _has_vowel(word: str) -> bool:
    return any(_vowel(word, i) for i in range(len(word)))


def _doubled(word: str) -> bool:
    return len(word) > 1 and word[-1] == word[-2] and not _vowel(word, len(word) - 1)


def _short_end(word: str) -> bool:
    n = len(word)
    return n >= 3 and not _vowel(word, n - 1) and _vowel(word, n - 2) and not _vowel(word, n - 3) and word[-1] not in "wxy"


def _longest(word: str, suffixes) -> str | None:
    return max((s for s in suffixes if word.endswith(s)), key=len, default=None)


def _plural(w: str) -> str:
    if w.endswith(("sses", "ies")):
        return w[:-2]
    return w[:-1] if w.endswith("s") and not w.endswith("ss") else w


def _past(w: str) -> str:
    if w.endswith("eed"):
        return w[:-1] if _measure(w[:-3]) > 0 else w
    end = next((s for s in ("ed", "ing") if w.endswith(s) and _has_vowel(w[: -len(s)])), None)
    if end is None:
        return w
    base = w[: -len(end)]
    if base.endswith(("at", "bl", "iz")):
        return base + "e"
    if _doubled(base) and base[-1] not in "lsz":
        return base[:-1]
    return base + "e" if _measure(base) == 1 and _short_end(base) else base


def _mapped(w: str, rules: dict[str, str]) -> str:
    end = _longest(w, rules)
    if end and _measure(w[: -len(end)]) > 0:
        return w[: -len(end)] + rules[end]
    return w


@lru_cache(maxsize=100_000)
def stem(word: str) -> str:
    if len(word) <= 2:
        return word
    w = _past(_plural(word))
    if w.endswith("y") and _has_vowel(w[:-1]):
        w = w[:-1] + "i"
    w = _mapped(_mapped(w, STEP2), STEP3)
    end = _longest(w, STEP4)
    if end and _measure(w[: -len(end)]) > 1 and (end != "ion" or w[-4:-3] in ("s", "t")):
        w = w[: -len(end)]
    if w.endswith("e") and (_measure(w[:-1]) > 1 or _measure(w[:-1]) == 1 and not _short_end(w[:-1])):
        w = w[:-1]
    return w[:-1] if w.endswith("ll") and _measure(w[:-1]) > 1 else w
