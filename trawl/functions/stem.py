"""English stemming (the Snowball "English"/Porter2 rules).

``stem_terms`` stems every element of an array of lower-case tokens, in place: no join
and no shuffle.  The arrays travel in Arrow batches, whose size Spark bounds in rows and
bytes; a batch's tokens are dictionary-encoded, so the rules run once per distinct word of
a batch and not once per token.  Tokens hold no apostrophes, so the rules about them
(step 0) never apply and are left out.
"""

from __future__ import annotations

import re
import sys

from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

# The rules travel with the plan: executors need pyarrow, not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed values of the published algorithm.
EXCEPTIONS = {
    "skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie",
    "idly": "idl", "gently": "gentl", "ugly": "ugli", "early": "earli", "only": "onli",
    "singly": "singl", "sky": "sky", "news": "news", "howe": "howe", "atlas": "atlas",
    "cosmos": "cosmos", "bias": "bias", "andes": "andes",
}
AFTER_1A = frozenset({"inning", "outing", "canning", "herring", "earring", "proceed", "exceed", "succeed"})
STEP2 = {
    "ization": "ize", "ational": "ate", "fulness": "ful", "ousness": "ous", "iveness": "ive",
    "tional": "tion", "biliti": "ble", "lessli": "less", "entli": "ent", "ation": "ate",
    "alism": "al", "aliti": "al", "ousli": "ous", "iviti": "ive", "fulli": "ful", "enci": "ence",
    "anci": "ance", "abli": "able", "izer": "ize", "ator": "ate", "alli": "al", "bli": "ble",
    "ogi": "og", "li": "",
}
STEP3 = {
    "ational": "ate", "tional": "tion", "alize": "al", "icate": "ic", "iciti": "ic",
    "ative": "", "ical": "ic", "ness": "", "ful": "",
}
STEP4 = dict.fromkeys(("ement", "ance", "ence", "able", "ible", "ment", "ant", "ent", "ism", "ate", "iti", "ous", "ive",
                       "ize", "ion", "al", "er", "ic"), "")
DOUBLES = ("bb", "dd", "ff", "gg", "mm", "nn", "pp", "rr", "tt")
VALID_LI = tuple(f"{c}li" for c in "cdeghkmnrt")
# Distinct words of a batch that are Python strings at a time.
SLICE = 1 << 16

# A y at the start or behind a vowel is no vowel: it is written Y.
_CONSONANT_Y = re.compile("([aeiouy])y")
_VOWEL = re.compile("[aeiouy]")
_REGION = re.compile(".*?[aeiouy][^aeiouy]")
_SHORT = re.compile("(?:^[aeiouy][^aeiouy]|[^aeiouy][aeiouy][^aeiouywxY])$")  # ends in a short syllable


def _region(word: str, start: int) -> int:
    """Where the region after the first other letter behind a vowel begins, from ``start``."""
    found = _REGION.match(word, start)
    return found.end() if found else len(word)


def _suffix(word: str, table: dict[str, str]) -> str:
    """The longest suffix of ``table`` that the word has, or ''."""
    for n in range(7, 1, -1):
        if word[-n:] in table:
            return word[-n:]
    return ""


def _step_1a(w: str) -> str:
    if w.endswith("sses"):
        return w[:-2]
    if w.endswith(("ied", "ies")):
        return w[:-2] if len(w) > 4 else w[:-1]
    if w.endswith("s") and not w.endswith(("us", "ss")) and _VOWEL.search(w, 0, len(w) - 2):
        return w[:-1]
    return w


def _step_1b(w: str, p1: int) -> str:
    for suffix in ("eedly", "eed"):
        if w.endswith(suffix):
            return w[:-len(suffix)] + "ee" if len(w) - len(suffix) >= p1 else w
    for suffix in ("ingly", "edly", "ing", "ed"):
        if w.endswith(suffix):
            rest = w[:-len(suffix)]
            return _mended(rest, p1) if _VOWEL.search(rest) else w
    return w


def _mended(w: str, p1: int) -> str:
    """What step 1b makes of a word that it has cut."""
    if w.endswith(("at", "bl", "iz")):
        return w + "e"
    if w.endswith(DOUBLES):
        return w[:-1]
    return w + "e" if p1 >= len(w) and _SHORT.search(w) else w


def _step_5(w: str, p1: int, p2: int) -> str:
    rest = len(w) - 1
    if w.endswith("ll"):
        return w[:-1] if rest >= p2 else w
    if w.endswith("e") and (rest >= p2 or (rest >= p1 and not _SHORT.search(w[:-1]))):
        return w[:-1]
    return w


def stem(word: str) -> str:
    """The stem of one lower-case token."""
    if len(word) <= 2:
        return word
    if word in EXCEPTIONS:
        return EXCEPTIONS[word]
    w = word
    if "y" in w:
        w = _CONSONANT_Y.sub(r"\1Y", "Y" + w[1:] if w[0] == "y" else w)
    p1 = 5 if w.startswith(("gener", "arsen")) else 6 if w.startswith("commun") else _region(w, 0)
    p2 = _region(w, p1)
    w = _step_1a(w)
    if w in AFTER_1A:
        return w
    w = _step_1b(w, p1)
    if len(w) > 2 and w[-1] in "yY" and w[-2] not in "aeiouy":
        w = w[:-1] + "i"
    s = _suffix(w, STEP2)
    if s and len(w) - len(s) >= p1 and (s not in ("ogi", "li") or w.endswith("logi" if s == "ogi" else VALID_LI)):
        w = w[:-len(s)] + STEP2[s]
    s = _suffix(w, STEP3)
    if s and len(w) - len(s) >= (p2 if s == "ative" else p1):
        w = w[:-len(s)] + STEP3[s]
    s = _suffix(w, STEP4)
    if s and len(w) - len(s) >= p2 and (s != "ion" or w.endswith(("sion", "tion"))):
        w = w[:-len(s)]
    return _step_5(w, p1, p2).replace("Y", "y")


def stem_lists(terms):
    """The Arrow array of token lists with every token replaced by its stem; null lists and tokens stay null."""
    import pyarrow as pa
    import pyarrow.compute as pc

    tokens = terms.flatten()
    encoded = tokens.dictionary_encode()
    words = encoded.dictionary
    stems = pa.concat_arrays([pa.array([stem(w) for w in words[at:at + SLICE].to_pylist()], tokens.type)
                              for at in range(0, len(words) or 1, SLICE)]).take(encoded.indices)
    sizes = pc.fill_null(pc.list_value_length(terms), 0)
    ends = pc.cumulative_sum(sizes)
    offsets = pa.concat_arrays([pa.array([0], ends.type), ends])
    return type(terms).from_arrays(offsets, stems, type=terms.type, mask=terms.is_null() if terms.null_count else None)


def stem_terms(terms: Column) -> Column:
    """The array with every token replaced by its stem."""
    import pyarrow as pa

    stem_lists.__annotations__ = {"terms": pa.Array, "return": pa.Array}
    return F.arrow_udf(stem_lists, "array<string>")(terms)
