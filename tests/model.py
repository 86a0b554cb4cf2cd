"""The ranking in plain Python, one article at a time, to compare small results with."""

import math
import re
from collections import Counter

import regex

from quillrank.functions.porter import STEP_2, STEP_3, STEP_4
from quillrank.functions.tokens import STOPWORDS

GRAIN = 2.0**40


def _rules(text: str) -> dict[str, str]:
    pairs = [rule.split() for rule in text.split(",")]
    return {pair[0]: "".join(pair[1:]) for pair in pairs}


_STEP_2, _STEP_3, _STEP_4 = _rules(STEP_2), _rules(STEP_3), _rules(STEP_4)


def _shape(word: str) -> str:
    """The word as c's and v's; y is a vowel after a consonant."""
    shape = ""
    for i, letter in enumerate(word):
        vowel = letter in "aeiou" or (letter == "y" and i > 0 and shape[-1] == "c")
        shape += "v" if vowel else "c"
    return shape


def _measure(stem: str) -> int:
    return len(re.findall("v+c+", _shape(stem)))


def _has_vowel(stem: str) -> bool:
    return "v" in _shape(stem)


def _doubled_consonant(stem: str) -> bool:
    return len(stem) > 1 and stem[-1] == stem[-2] and _shape(stem)[-1] == "c"


def _short_syllable(stem: str) -> bool:
    return _shape(stem).endswith("cvc") and stem[-1] not in "wxy"


def _replace_longest(word: str, rules: dict[str, str], least_measure: int) -> str:
    """Apply the rule with the longest matching suffix, if the stem before it is long enough."""
    for size in range(min(7, len(word)), 0, -1):
        suffix = word[-size:]
        if suffix in rules:
            stem = word[:-size]
            if suffix == "ion" and rules is _STEP_4 and not stem.endswith(("s", "t")):
                return word
            return stem + rules[suffix] if _measure(stem) >= least_measure else word
    return word


def _plural(word: str) -> str:
    if word.endswith(("sses", "ies")):
        return word[:-2]
    if word.endswith("s") and not word.endswith("ss"):
        return word[:-1]
    return word


def _past_or_gerund(word: str) -> str:
    if word.endswith("eed"):
        return word[:-1] if _measure(word[:-3]) > 0 else word
    ending = next((e for e in ("ed", "ing") if word.endswith(e)), None)
    if ending is None or not _has_vowel(word[: -len(ending)]):
        return word
    stem = word[: -len(ending)]
    if stem.endswith(("at", "bl", "iz")):
        return stem + "e"
    if _doubled_consonant(stem) and stem[-1] not in "lsz":
        return stem[:-1]
    if _measure(stem) == 1 and _short_syllable(stem):
        return stem + "e"
    return stem


def _tidy(word: str) -> str:
    if word.endswith("e"):
        stem = word[:-1]
        measure = _measure(stem)
        if measure > 1 or (measure == 1 and not _short_syllable(stem)):
            word = stem
    if word.endswith("ll") and _measure(word) > 1:
        word = word[:-1]
    return word


def porter_stem(token: str) -> str:
    """The stem of one lower-case token; tokens of one or two letters stay as they are."""
    if len(token) < 3:
        return token
    word = _past_or_gerund(_plural(token))
    if word.endswith("y") and _has_vowel(word[:-1]):
        word = word[:-1] + "i"
    word = _replace_longest(word, _STEP_2, 1)
    word = _replace_longest(word, _STEP_3, 1)
    word = _replace_longest(word, _STEP_4, 2)
    return _tidy(word)


def terms_of(text, stem):
    tokens = [t for t in regex.findall(r"[\p{L}\p{N}]+", text.lower()) if t not in STOPWORDS]
    return [porter_stem(t) for t in tokens] if stem else tokens


def indexed_text(article):
    usable = [
        b["content"]
        for b in article["contents"] or []
        if b is not None and b["subtype"] == "paragraph" and b["content"] is not None
    ]
    return "\n".join([article["title"], *usable[:5]])


def log2(x):
    return -math.inf if x == 0 else math.log(x) / math.log(2)


def term_score(tf, cf, length, avg_len, n_docs, ratio):
    f = tf / length
    norm = (1 - f) * (1 - f) / (tf + 1)
    per_occurrence = n_docs // cf if ratio == "integer" else n_docs / cf
    inner = tf * log2(tf * avg_len / length * per_occurrence) + 0.5 * log2(2 * math.pi * tf * (1 - f))
    score = norm * inner
    return score if math.isinf(score) or math.isnan(score) else round(score * GRAIN) / GRAIN


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def near(a, b):
    longer = max(len(a), len(b))
    return longer > 0 and edit_distance(a, b) / longer < 0.5


def rank(queries, articles, k=10, stem=True, ratio="integer", pad_zero=True, dedup=True):
    """{query_id: [(id, score), ...]} for queries {query_id: text}."""
    wanted = {q: terms_of(text, stem) for q, text in queries.items()}
    vocabulary = {t for terms in wanted.values() for t in terms}
    usable = [a for a in articles if a["id"] is not None and a["title"] is not None]
    analysed = [(a, terms_of(indexed_text(a), stem)) for a in usable]
    bags = [(a["id"], a["title"], len(t), Counter(x for x in t if x in vocabulary)) for a, t in analysed]
    if not bags:
        return {}
    n_docs = len(bags)
    avg_len = float(sum(length for _, _, length, _ in bags) // n_docs)
    cf = Counter()
    for *_, bag in bags:
        cf.update(bag)
    candidates = [b for b in bags if b[3]]
    result = {}
    for q, terms in wanted.items():
        if not terms:
            continue
        hits = []
        for id, title, length, bag in candidates:
            found = [t for t in terms if t in bag]
            if not found and not pad_zero:
                continue
            total = sum(term_score(bag[t], cf[t], length, avg_len, n_docs, ratio) for t in found)
            hits.append((id, title, length, sorted(bag.items()), total / len(terms)))
        hits.sort(key=lambda h: (math.inf if math.isnan(h[4]) else -h[4], *h[:4]))
        kept = []
        for id, title, _, _, score in hits:
            if len(kept) == k:
                break
            if not dedup or not any(near(t, title) for _, t, _ in kept):
                kept.append((id, title, score))
        if kept:
            result[q] = [(id, score) for id, _, score in kept]
    return result
