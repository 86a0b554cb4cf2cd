import math
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from model import edit_distance, porter_stem
from quillrank.functions.porter import with_stems
from quillrank.functions.relevance import dph, log2_or_minus_infinity, merit, rarity
from quillrank.functions.titles import is_near_duplicate, title_distance, title_profile
from quillrank.functions.tokens import counted, tokens_of, without_stopwords

# Examples printed in the 1980 paper, carried through all steps.
STEMS = {
    "caresses": "caress", "ponies": "poni", "ties": "ti", "caress": "caress", "cats": "cat",
    "feed": "feed", "agreed": "agre", "plastered": "plaster", "bled": "bled", "motoring": "motor", "sing": "sing",
    "conflated": "conflat", "troubled": "troubl", "sized": "size", "hopping": "hop", "tanned": "tan",
    "falling": "fall", "hissing": "hiss", "fizzed": "fizz", "failing": "fail", "filing": "file",
    "happy": "happi", "sky": "sky",
    "relational": "relat", "conditional": "condit", "rational": "ration", "valenci": "valenc",
    "digitizer": "digit", "conformabli": "conform", "radicalli": "radic", "differentli": "differ", "vileli": "vile",
    "analogousli": "analog", "vietnamization": "vietnam", "predication": "predic", "operator": "oper",
    "feudalism": "feudal", "decisiveness": "decis", "hopefulness": "hope", "callousness": "callous",
    "formaliti": "formal", "sensitiviti": "sensit", "sensibiliti": "sensibl",
    "triplicate": "triplic", "formative": "form", "formalize": "formal", "electriciti": "electr",
    "electrical": "electr", "hopeful": "hope", "goodness": "good",
    "revival": "reviv", "allowance": "allow", "inference": "infer", "airliner": "airlin", "gyroscopic": "gyroscop",
    "adjustable": "adjust", "defensible": "defens", "irritant": "irrit", "replacement": "replac",
    "adjustment": "adjust", "dependent": "depend", "adoption": "adopt", "homologou": "homolog",
    "communism": "commun", "activate": "activ", "angulariti": "angular", "homologous": "homolog",
    "effective": "effect", "bowdlerize": "bowdler",
    "probate": "probat", "rate": "rate", "cease": "ceas", "controll": "control", "roll": "roll",
    "generalizations": "gener", "oscillators": "oscil",
}


ENDINGS = (
    "ational tional enci izer abli alli entli eli ousli ization ation ator alism iveness fulness aliti iviti biliti icate ative alize "
    "iciti ical ful ness al ance er ic able ant ement ment ent ion ou ism ate iti ous ive ize ed ing eed sses ies s y ll e at bl iz yed yy"
).split()


def test_stems_of_the_paper(spark):
    found = with_stems(spark.createDataFrame([(token,) for token in STEMS], "token string")).collect()
    assert {r["token"]: r["term"] for r in found} == STEMS
    assert all(porter_stem(token) == stem for token, stem in STEMS.items())


def test_stems_of_any_word_and_conditions_on_them(spark):
    rng = random.Random(1980)
    words = {"".join(rng.choices("aeiouybcdlmnstzwx", k=rng.randint(0, 6))) + "".join(rng.choices(ENDINGS, k=rng.randint(0, 3))) for _ in range(8000)}
    words |= {"".join(rng.choices("yyaelsxwdé1漢", k=rng.randint(1, 8))) for _ in range(3000)}
    df = with_stems(spark.createDataFrame([(w,) for w in words if w], "token string"))
    wanted = {w: porter_stem(w) for w in words if w}
    assert {r["token"]: r["term"] for r in df.collect()} == wanted
    assert df.where("term is not null and term <> 'x'").join(df.select("term").distinct(), "term", "left_semi").count() == sum(
        stem != "x" for stem in wanted.values())


def test_tokens(spark):
    df = spark.createDataFrame([("The café's 2nd-best, X_Y\nÉté",), ("",), (None,)], "text string")
    rows = df.select(tokens_of(F.col("text")).alias("tokens")).select("tokens", without_stopwords("tokens").alias("kept"))
    first, empty, null = rows.collect()
    assert first["tokens"] == ["the", "café", "s", "2nd", "best", "x", "y", "été"]
    assert first["kept"] == ["café", "2nd", "best", "x", "y", "été"]
    assert empty["tokens"] == null["tokens"] == []


def test_counted(spark):
    df = spark.createDataFrame([(["b", "a", "b", "c", "b", "a"],), ([],)], "tokens array<string>")
    full, empty = df.select(counted(F.col("tokens")).alias("bag")).collect()
    assert [tuple(e) for e in full["bag"]] == [("a", 2), ("b", 3), ("c", 1)]
    assert empty["bag"] == []


def test_title_distance_and_threshold(spark):
    pairs = [("ab", "ac"), ("abc", "abd"), ("", ""), ("", "x"), ("same", "same"), ("ä", "a"), ("kitten", "sitting"),
             ("a" * 40, "a" * 19), ("a" * 40, "a" * 21), ("abcdef", "fedcba")]
    rows = spark.createDataFrame(pairs, "a string, b string").select(
        "a", "b", title_distance(F.col("a"), F.col("b")).alias("distance"),
        is_near_duplicate(F.col("a"), F.col("b")).alias("near"),
    ).collect()
    for row in rows:
        longer = max(len(row["a"]), len(row["b"]))
        if longer == 0:
            assert math.isnan(row["distance"]) and not row["near"]
        else:
            assert row["distance"] == edit_distance(row["a"], row["b"]) / longer
            assert row["near"] == (row["distance"] < 0.5)
    near = {(row["a"], row["b"]): row["near"] for row in rows}
    assert not near["ab", "ac"] and near["abc", "abd"] and near["same", "same"]


def test_profiles_only_spare_distances(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choices("eat rns", k=n)) for n in (300, 310, 290, 600, 20)]
    texts += [texts[0][:200] + texts[1][200:], texts[0][::-1], "é" * 300, ""]
    df = spark.createDataFrame([(a, b) for a in texts for b in texts], "a string, b string")
    df = df.withColumns({"pa": title_profile(F.col("a")), "pb": title_profile(F.col("b"))})
    a, b = F.col("a"), F.col("b")
    for row in df.select(
        is_near_duplicate(a, b).alias("x"), is_near_duplicate(a, b, F.col("pa"), F.col("pb")).alias("y"), (title_distance(a, b) < 0.5).alias("z")
    ).collect():
        assert row["x"] == row["y"] == row["z"]


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.text("ab ", max_size=9), st.text("ab ", max_size=9)), min_size=50, max_size=50))
def test_near_is_the_distance_below_one_half(spark, pairs):
    df = spark.createDataFrame(pairs, "a string, b string").coalesce(1)
    a, b = F.col("a"), F.col("b")
    assert df.where(is_near_duplicate(a, b) != (title_distance(a, b) < 0.5)).isEmpty()


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_dph_by_hand(spark):
    # tf 2 of 8, mean length 6, 5 documents per occurrence.
    expected = 0.75**2 / 3 * (2 * math.log2(2 * 6 / 8 * 5) + 0.5 * math.log2(2 * math.pi * 2 * 0.75))
    assert one(spark, dph(F.lit(2), F.lit(8), F.lit(6.0), F.lit(5.0))) == pytest.approx(expected, abs=1e-11)


def test_dph_where_logarithms_end(spark):
    assert one(spark, dph(F.lit(1), F.lit(8), F.lit(6.0), F.lit(0.0))) == -math.inf
    assert math.isnan(one(spark, dph(F.lit(3), F.lit(3), F.lit(6.0), F.lit(5.0))))
    assert one(spark, log2_or_minus_infinity(F.lit(0.0))) == -math.inf
    assert one(spark, merit(F.lit(float("nan")))) == -math.inf


def test_rarity(spark):
    n_docs, cf = F.lit(7).cast("bigint"), F.lit(2).cast("bigint")
    assert one(spark, rarity(n_docs, cf, "integer")) == 3.0
    assert one(spark, rarity(n_docs, cf, "real")) == 3.5
    assert one(spark, rarity(cf, n_docs, "integer")) == 0.0
    assert one(spark, rarity(n_docs, F.lit(0).cast("bigint"), "integer")) is None
    with pytest.raises(ValueError):
        rarity(n_docs, cf, "half")
