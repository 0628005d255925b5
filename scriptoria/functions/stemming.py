"""Snowball stemming of Russian and English words, after the published descriptions of the algorithms."""

from __future__ import annotations

import re

# Endings of the published Russian algorithm.
VOWELS = "аеиоуыэюя"
PERFECTIVE_1 = ("вшись", "вши", "в")
PERFECTIVE_2 = ("ившись", "ывшись", "ивши", "ывши", "ив", "ыв")
ADJECTIVE = ("ими", "ыми", "его", "ого", "ему", "ому", "ее", "ие", "ые", "ое", "ей", "ий", "ый", "ой", "ем", "им", "ым", "ом", "их", "ых", "ую", "юю", "ая", "яя", "ою", "ею")
PARTICIPLE_1 = ("ем", "нн", "вш", "ющ", "щ")
PARTICIPLE_2 = ("ивш", "ывш", "ующ")
REFLEXIVE = ("ся", "сь")
VERB_1 = ("йте", "ете", "ешь", "нно", "ла", "на", "ли", "ем", "ло", "но", "ет", "ют", "ны", "ть", "й", "л", "н")
VERB_2 = (
    "ейте", "уйте", "ила", "ыла", "ена", "ите", "или", "ыли", "ило", "ыло", "ено", "ует", "уют", "ены", "ить", "ыть", "ишь", "ей", "уй", "ил", "ыл", "им", "ым", "ен", "ят", "ит", "ыт", "ую", "ю",
)
NOUN = (
    "иями", "ями", "ами", "ией", "иям", "ием", "иях", "ев", "ов", "ие", "ье", "еи", "ии", "ей", "ой", "ий", "ям", "ем", "ам", "ом", "ах", "ях", "ию", "ью", "ия", "ья",
    "а", "е", "и", "й", "о", "у", "ы", "ь", "ю", "я",
)
SUPERLATIVE = ("ейше", "ейш")
DERIVATIONAL = ("ость", "ост")


def _strip(word: str, start: int, endings: tuple[str, ...], after: str = "") -> str | None:
    """The word without its longest such ending from ``start`` on (preceded by one of ``after``), None if it has none."""
    for e in sorted(endings, key=len, reverse=True):
        if word.endswith(e) and len(word) - len(e) >= start:
            if after and (len(word) - len(e) <= start or word[-len(e) - 1] not in after):
                continue
            return word[: -len(e)]
    return None


def _regions(word: str) -> tuple[int, int]:
    """Starts of the region after the first vowel and of R2."""
    v = re.search(f"[{VOWELS}]", word)
    rv = v.end() if v else len(word)
    pair = f"[{VOWELS}][^{VOWELS}]"
    one = re.search(pair, word)
    two = re.search(pair, word[one.end() :]) if one else None
    return rv, (one.end() + two.end() if one and two else len(word))


def russian(word: str) -> str:
    w = word.lower().replace("ё", "е")
    rv, r2 = _regions(w)
    out = _strip(w, rv, PERFECTIVE_2)
    first = _strip(w, rv, PERFECTIVE_1, "ая")
    if first is not None and (out is None or len(first) < len(out)):
        out = first
    if out is None:
        w = _strip(w, rv, REFLEXIVE) or w
        adjective = _strip(w, rv, ADJECTIVE)
        if adjective is not None:
            out = adjective
            deeper = _strip(out, rv, PARTICIPLE_2)
            out = deeper if deeper is not None else (_strip(out, rv, PARTICIPLE_1, "ая") or out)
        else:
            verb_2, verb_1 = _strip(w, rv, VERB_2), _strip(w, rv, VERB_1, "ая")
            verbs = [x for x in (verb_2, verb_1) if x is not None]
            out = min(verbs, key=len) if verbs else _strip(w, rv, NOUN)
    w = out if out is not None else w
    w = _strip(w, rv, ("и",)) or w
    w = _strip(w, r2, DERIVATIONAL) or w
    shorter = _strip(w, rv, SUPERLATIVE)
    w = shorter if shorter is not None else w
    if w.endswith("нн") and len(w) - 1 > rv:
        return w[:-1]
    return w[:-1] if w.endswith("ь") and len(w) > rv else w


# The published English algorithm (Porter2): special words, endings and what replaces them.
ENGLISH_WORDS = {
    "skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "idly": "idl", "gently": "gentl", "ugly": "ugli", "early": "earli", "only": "onli", "singly": "singl",
    "sky": "sky", "news": "news", "howe": "howe", "atlas": "atlas", "cosmos": "cosmos", "bias": "bias", "andes": "andes",
}
ENGLISH_UNCHANGED = ("inning", "outing", "canning", "herring", "earring", "proceed", "exceed", "succeed")
ENGLISH_REGIONS = ("gener", "commun", "arsen")
DOUBLES = ("bb", "dd", "ff", "gg", "mm", "nn", "pp", "rr", "tt")
STEP_2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "abli": "able", "entli": "ent", "izer": "ize", "ization": "ize", "ation": "ate", "ator": "ate", "alism": "al", "aliti": "al",
    "alli": "al", "fulness": "ful", "ousli": "ous", "ousness": "ous", "iveness": "ive", "iviti": "ive", "biliti": "ble", "bli": "ble", "ogi": "og", "fulli": "ful", "lessli": "less", "li": "",
}
STEP_3 = {"ational": "ate", "tional": "tion", "alize": "al", "icate": "ic", "iciti": "ic", "ical": "ic", "ful": "", "ness": "", "ative": ""}
STEP_4 = ("al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ism", "ate", "iti", "ous", "ive", "ize", "ion")


def _ending(word: str, endings) -> str | None:
    """The longest of the endings that the word has."""
    return max((e for e in endings if word.endswith(e)), key=len, default=None)


def _english_regions(word: str) -> tuple[int, int]:
    def after(start: int) -> int:
        found = re.compile("[aeiouy][^aeiouy]").search(word, start)
        return found.end() if found else len(word)

    known = next((len(p) for p in ENGLISH_REGIONS if word.startswith(p)), None)
    one = after(0) if known is None else known
    return one, after(one)


def _short(word: str) -> bool:
    """Whether a word ends in a short syllable."""
    return re.search("^[aeiouy][^aeiouy]$|[^aeiouy][aeiouy][^aeiouywxY]$", word) is not None


def _without_ed_ing(word: str, one: int) -> str:
    ending = _ending(word, ("eed", "eedly", "ed", "edly", "ing", "ingly"))
    if ending is None:
        return word
    kept = word[: len(word) - len(ending)]
    if ending.startswith("eed"):
        return kept + "ee" if len(kept) >= one else word
    if not re.search("[aeiouy]", kept):
        return word
    if kept.endswith(("at", "bl", "iz")):
        return kept + "e"
    if kept.endswith(DOUBLES):
        return kept[:-1]
    return kept + "e" if one >= len(kept) and _short(kept) else kept


def english(word: str) -> str:
    """Stem by the published algorithm."""
    w = word.lower().replace("’", "'")
    if len(w) <= 2:
        return w
    w = w.removeprefix("'")
    if w in ENGLISH_WORDS:
        return ENGLISH_WORDS[w]
    w = re.sub("^y|(?<=[aeiouy])y", "Y", w)
    one, two = _english_regions(w)
    apostrophe = _ending(w, ("'", "'s", "'s'"))
    w = w[: len(w) - len(apostrophe)] if apostrophe else w
    plural = _ending(w, ("sses", "ied", "ies", "us", "ss", "s"))
    if plural == "sses":
        w = w[:-2]
    elif plural in ("ied", "ies"):
        w = w[:-2] if len(w) > 4 else w[:-1]
    elif plural == "s" and re.search("[aeiouy]", w[:-2]):
        w = w[:-1]
    if w in ENGLISH_UNCHANGED:
        return w
    w = _without_ed_ing(w, one)
    if len(w) > 2 and w[-1] in "yY" and w[-2] not in "aeiouy":
        w = w[:-1] + "i"
    found = _ending(w, STEP_2)
    if found and len(w) - len(found) >= one:
        before = w[: len(w) - len(found)]
        if not (found == "ogi" and not before.endswith("l")) and not (found == "li" and before[-1:] not in tuple("cdeghkmnrt")):
            w = before + STEP_2[found]
    found = _ending(w, STEP_3)
    if found and len(w) - len(found) >= (two if found == "ative" else one):
        w = w[: len(w) - len(found)] + STEP_3[found]
    found = _ending(w, STEP_4)
    if found and len(w) - len(found) >= two and not (found == "ion" and w[-4:-3] not in ("s", "t")):
        w = w[: len(w) - len(found)]
    if w.endswith("e") and (len(w) - 1 >= two or len(w) - 1 >= one and not _short(w[:-1])):
        w = w[:-1]
    elif w.endswith("ll") and len(w) - 1 >= two:
        w = w[:-1]
    return w.replace("Y", "y")


def stem(word: str) -> str:
    return russian(word) if re.search("[а-яё]", word.lower()) else english(word)
