"""Porter's suffix stripper (M. F. Porter, "An algorithm for suffix stripping", 1980) as column expressions.

A word is a stem and an ending, and most rules ask how often vowels turn into consonants in the stem. A ``y`` is a vowel after a
consonant only; consonantal ones are written ``Y`` while the steps run, so that one pattern each tells the rest. An ending changes
nothing before it, so the marks stay right from step to step. Each step is a projection of its own: it names the word often, and
stays one expression because Spark does not merge projections that would compute it more than once.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The suffix rules of the paper, in its order.
STEP_2 = """
ational ate, tional tion, enci ence, anci ance, izer ize, abli able, alli al, entli ent, eli e,
ousli ous, ization ize, ation ate, ator ate, alism al, iveness ive, fulness ful, ousness ous,
aliti al, iviti ive, biliti ble
"""
STEP_3 = "icate ic, ative, alize al, iciti ic, ical ic, ful, ness"
STEP_4 = "al, ance, ence, er, ic, able, ible, ant, ement, ment, ent, ion, ou, ism, ate, iti, ous, ive, ize"

_V, _C = "[aeiouy]", "[^aeiouy]"
_MEASURE_1 = f"^{_C}*{_V}+{_C}"  # one turn from vowels to consonants, or more
_MEASURE_2 = f"^{_C}*{_V}+{_C}+{_V}+{_C}"
_SHORT_END = f"{_C}{_V}[^aeiouywxY]$"
_WORD = "term"
_SHORTEST = 3  # shorter tokens stay as they are


def _cut(word: Column, letters: int | Column) -> Column:
    """The word without its last letters."""
    return F.substring(word, F.lit(1), F.length(word) - letters)


def _marked(token: Column) -> Column:
    """Consonantal y as Y: at the start, after a vowel, and every second one of a run."""
    return F.regexp_replace(F.regexp_replace(token, "(^|[aeiou])y", "$1Y"), "yy", "yY")


def _without_plural(word: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(word, "(ss|i)es$", "$1"), "([^s])s$", "$1")


def _mended(stem: Column) -> Column:
    """What is left after ``ed`` or ``ing`` went, with the ending it needs."""
    doubled = stem.rlike(r"([^aeiouylszY])\1$|yY$")
    short = stem.rlike(f"^{_C}+{_V}[^aeiouywxY]$")  # one turn, and a short end
    return (
        F.when(stem.rlike("(at|bl|iz)$"), F.concat(stem, F.lit("e")))
        .when(doubled, _cut(stem, 1))
        .when(short, F.concat(stem, F.lit("e")))
        .otherwise(stem)
    )


def _without_past(words: DataFrame) -> DataFrame:
    word = F.col(_WORD)
    ended = words.withColumn("stem", F.regexp_extract(word, f"^(.*{_V}.*)(?:ed|ing)$", 1))
    return ended.withColumn(
        _WORD,
        F.when(word.endswith("eed"), F.when(word.rlike(f"{_MEASURE_1}.*eed$"), _cut(word, 1)).otherwise(word))
        .when(F.col("stem") == "", word)
        .otherwise(_mended(F.col("stem"))),
    ).drop("stem")


def _without_longest(words: DataFrame, rules: str, measure: str) -> DataFrame:
    """Exchange the longest ending that a rule names, if the measure of the stem before it allows."""
    pairs = dict((rule.split() + [""])[:2] for rule in rules.split(","))
    # Of all endings the pattern finds the one that starts first.
    found = words.withColumn("ending", F.regexp_extract(_WORD, f"(?:{'|'.join(pairs)})$", 0))
    found = found.withColumn("stem", _cut(F.col(_WORD), F.length("ending")))
    by = F.create_map(*[F.lit(text) for pair in pairs.items() for text in pair])
    allowed = F.col("stem").rlike(measure) & ((F.col("ending") != "ion") | F.col("stem").rlike("[st]$"))
    replaced = F.concat("stem", F.element_at(by, F.col("ending")))
    return found.withColumn(
        _WORD, F.when((F.col("ending") != "") & allowed, replaced).otherwise(F.col(_WORD))
    ).drop("ending", "stem")


def _without_last_e(word: Column) -> Column:
    stem = _cut(word, 1)
    silent = stem.rlike(_MEASURE_2) | (stem.rlike(_MEASURE_1) & ~stem.rlike(_SHORT_END))
    return F.when(word.endswith("e") & silent, stem).otherwise(word)


def with_stems(tokens: DataFrame) -> DataFrame:
    """(token, term): each row of ``tokens`` (token), lower case, with its stem. Tokens of one or two letters keep theirs."""
    word = F.col(_WORD)
    words = tokens.select("token", _marked(F.col("token")).alias(_WORD))
    words = _without_past(words.withColumn(_WORD, _without_plural(word)))
    words = words.withColumn(_WORD, F.regexp_replace(word, f"^(.*{_V}.*)[yY]$", "$1i"))
    words = _without_longest(words, STEP_2, _MEASURE_1)
    words = _without_longest(words, STEP_3, _MEASURE_1)
    words = _without_longest(words, STEP_4, _MEASURE_2)
    words = words.withColumn(_WORD, _without_last_e(word))
    words = words.withColumn(_WORD, F.when(word.endswith("ll") & word.rlike(_MEASURE_2), _cut(word, 1)).otherwise(word))
    stem = F.when(F.length("token") < _SHORTEST, F.col("token")).otherwise(F.translate(word, "Y", "y"))
    # Conditions on the stem stop at the explode; written out in terms of the token they would be too long to plan.
    return words.select("token", F.explode(F.array(stem)).alias(_WORD))
