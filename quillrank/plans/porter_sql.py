"""Porter's stemmer as SQL for another engine, written from the paper to check the engine's own.

A consonantal y is written Y while the steps run: at the start, after a vowel, and as every second one of a run.
"""

_V, _C = "[aeiouy]", "[^aeiouy]"


def _measure_over(stem: str, least: int) -> str:
    """Whether the stem has more than ``least`` vowel-consonant turns."""
    return f"regexp_matches({stem}, '^{_C}*{f'{_V}+{_C}+' * least}{_V}+{_C}')"


def _has_vowel(stem: str) -> str:
    return f"regexp_matches({stem}, '{_V}')"


def _short_end(stem: str) -> str:
    return f"regexp_matches({stem}, '{_C}{_V}[^aeiouywxY]$')"


def _without(suffix: str) -> str:
    return f"left(w, length(w) - {len(suffix)})"


def _first_suffix(rules: str, least: int) -> str:
    """The rule of the longest suffix that fits, if the measure of what precedes it is over ``least``."""
    pairs = [(rule.split() + [""])[:2] for rule in rules.split(",")]
    cases = []
    for suffix, new in sorted(pairs, key=lambda pair: -len(pair[0])):
        stem = _without(suffix)
        allowed = _measure_over(stem, least)
        if suffix == "ion":
            allowed += f" AND regexp_matches({stem}, '[st]$')"
        cases.append(f"WHEN ends_with(w, '{suffix}') THEN CASE WHEN {allowed} THEN {stem} || '{new}' ELSE w END")
    return f"CASE {' '.join(cases)} ELSE w END"


# The suffix rules of the paper.
_STEP_2 = (
    "ational ate, tional tion, enci ence, anci ance, izer ize, abli able, alli al, entli ent, eli e, ousli ous, "
    "ization ize, ation ate, ator ate, alism al, iveness ive, fulness ful, ousness ous, aliti al, iviti ive, biliti ble"
)
_STEP_3 = "icate ic, ative, alize al, iciti ic, ical ic, ful, ness"
_STEP_4 = "al, ance, ence, er, ic, able, ible, ant, ement, ment, ent, ion, ou, ism, ate, iti, ous, ive, ize"

_EED = _without("eed")
_DOUBLE = "lower(right(w, 1)) = lower(left(right(w, 2), 1)) AND length(w) > 1 AND regexp_matches(w, '[^aeiouylsz]$')"
_TIDY_E = _without("e")

_STEPS = [
    "regexp_replace(regexp_replace(regexp_replace(token, '^y', 'Y'), '([aeiou])y', '\\1Y', 'g'), 'yy', 'yY', 'g')",
    f"""CASE WHEN ends_with(w, 'sses') OR ends_with(w, 'ies') THEN {_without("xx")}
        WHEN ends_with(w, 's') AND NOT ends_with(w, 'ss') THEN {_without("x")} ELSE w END""",
    # What loses ed or ing gets a mark, for the next step to mend its end.
    f"""CASE WHEN ends_with(w, 'eed') THEN CASE WHEN {_measure_over(_EED, 0)} THEN {_without("x")} ELSE w END
        WHEN ends_with(w, 'ed') THEN CASE WHEN {_has_vowel(_without("ed"))} THEN {_without("ed")} || '#' ELSE w END
        WHEN ends_with(w, 'ing') AND {_has_vowel(_without("ing"))} THEN {_without("ing")} || '#' ELSE w END""",
    f"""CASE WHEN NOT ends_with(cut, '#') THEN cut
        WHEN regexp_matches(w, '(at|bl|iz)$') THEN w || 'e'
        WHEN {_DOUBLE} THEN {_without("x")}
        WHEN {_measure_over("w", 0)} AND NOT {_measure_over("w", 1)} AND {_short_end("w")} THEN w || 'e' ELSE w END""",
    f"CASE WHEN lower(right(w, 1)) = 'y' AND {_has_vowel(_without('y'))} THEN {_without('y')} || 'i' ELSE w END",
    _first_suffix(_STEP_2, 0),
    _first_suffix(_STEP_3, 0),
    _first_suffix(_STEP_4, 1),
    f"""CASE WHEN ends_with(w, 'e') AND ({_measure_over(_TIDY_E, 1)}
          OR ({_measure_over(_TIDY_E, 0)} AND NOT {_short_end(_TIDY_E)})) THEN {_TIDY_E} ELSE w END""",
    f"CASE WHEN ends_with(w, 'll') AND {_measure_over('w', 1)} THEN {_without('l')} ELSE w END",
]


def stems(tokens: str) -> str:
    """Named queries that end with stems(token, stem), from a table of distinct ``tokens`` (token)."""
    parts, before = [], tokens
    for i, step in enumerate(_STEPS):
        if "(cut" in step:
            source = f"(SELECT token, w AS cut, rtrim(w, '#') AS w FROM {before})"
        else:
            source = before
        parts.append(f"porter_{i} AS (SELECT token, {step} AS w FROM {source})")
        before = f"porter_{i}"
    parts.append(
        f"stems AS (SELECT token, CASE WHEN length(token) < 3 THEN token ELSE replace(w, 'Y', 'y') END AS stem FROM {before})"
    )
    return ",\n".join(parts)
