"""One row per CASE branch with the default (reference) lexicon, plus the
threshold boundaries of the classification columns."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions import signals, text as tx
from tidemark.functions.numeric import half_up
from tidemark.functions.rules import REFERENCE, Rule, rule_case


def one_col(spark, values, typ="string"):
    return spark.createDataFrame([(v,) for v in values], f"x {typ}")


def test_rule_compiler_first_match_and_combinators(spark):
    rules = [Rule("A", any_of=("aa", "bb")), Rule("B", all_of=("cc", "dd")),
             Rule("C", all_of=("ee",), none_of=("ff",))]
    df = one_col(spark, ["xx aa", "bb cc dd", "cc only", "ee", "ee ff", None])
    got = [r[0] for r in df.select(rule_case(F.col("x"), rules, "D")).collect()]
    assert got == ["A", "A", "D", "C", "D", "D"]


@pytest.mark.parametrize("text,score", [
    ("we had record revenue this quarter", 0.85),
    ("results exceeded expectations", 0.92),
    ("facing headwinds", -0.35),
    ("a challenging environment", -0.55),
    ("strong growth in cloud", 0.78),
    ("margin pressure persisted", -0.42),
    ("outlook positive overall", 0.71),
    ("the economy is uncertain", -0.20),
    ("record revenue despite headwinds", 0.85),   # first match wins
])
def test_sentiment_branches(spark, text, score):
    df = spark.createDataFrame([("EC-1", text)], "id string, t string")
    got = df.select(tx.sentiment_score(F.col("t"), "id", REFERENCE)).first()[0]
    assert got == pytest.approx(score)
    assert df.select(tx.sentiment_neutral(F.col("t"), REFERENCE)).first()[0] == pytest.approx(score)


def test_sentiment_hash_fallback_and_neutral_default(spark):
    import hashlib
    df = spark.createDataFrame([("EC-001", "nothing to see")], "id string, t string")
    got = df.select(tx.sentiment_score(F.col("t"), "id")).first()[0]
    h = int(hashlib.md5(b"EC-001").hexdigest()[:13], 16)
    assert got == pytest.approx((h % 100 - 50) / 100.0)
    assert -0.5 <= got <= 0.49
    assert df.select(tx.sentiment_neutral(F.col("t"))).first()[0] == 0.0


def test_theme_summary(spark):
    long_ai = "AI and cloud margin guidance " + "x" * 200 + " strong growth"
    long_plain = "y" * 201
    short = "AI" * 10
    caution = "headwinds " + "z" * 200
    df = one_col(spark, [long_ai, long_plain, short, caution])
    got = [r[0] for r in df.select(tx.theme_summary(F.col("x"))).collect()]
    assert got[0] == ("Key themes: AI strategy, Cloud growth, Margin trends, Forward guidance discussed. "
                      "Management expressed optimism about forward outlook.")
    assert got[1] == ("Key themes: Operational review. Management expressed measured confidence "
                      "about forward outlook.")
    assert got[2] == "Brief commentary segment"
    assert "caution" in got[3]


def test_primary_theme(spark):
    df = one_col(spark, ["AI here", "cloud here", "margin here", "none"])
    got = [r[0] for r in df.select(tx.primary_theme(F.col("x"))).collect()]
    assert got == ["AI / ML", "Cloud Infrastructure", "Financial Performance", "General Commentary"]


@pytest.mark.parametrize("text,cat", [
    ("pending litigation", "LITIGATION_RISK"), ("a lawsuit", "LITIGATION_RISK"),
    ("goodwill impairment", "IMPAIRMENT_RISK"), ("a write-down", "IMPAIRMENT_RISK"),
    ("intense competition", "COMPETITIVE_RISK"), ("market share loss", "COMPETITIVE_RISK"),
    ("new regulation", "REGULATORY_RISK"), ("compliance costs", "REGULATORY_RISK"),
    ("cybersecurity", "CYBER_RISK"), ("a data breach", "CYBER_RISK"),
    ("supply chain", "SUPPLY_CHAIN_RISK"), ("disruption", "SUPPLY_CHAIN_RISK"),
    ("nothing", "OPERATIONAL"), ("lawsuit after data breach", "LITIGATION_RISK"),
])
def test_risk_branches(spark, text, cat):
    assert one_col(spark, [text]).select(tx.risk_category(F.col("x"))).first()[0] == cat


@pytest.mark.parametrize("text,pol", [
    ("substantial risk", "NEGATIVE"), ("this may adversely affect", "NEGATIVE"),
    ("growth ahead", "POSITIVE"), ("growth with risk", "NEUTRAL"),
    ("innovation", "POSITIVE"), ("risk and innovation", "POSITIVE"), ("plain", "NEUTRAL"),
])
def test_polarity_branches(spark, text, pol):
    assert one_col(spark, [text]).select(tx.polarity(F.col("x"))).first()[0] == pol


def test_text_stats_whole_text(spark):
    big = "word " * 50000                                # whole text, no prefix
    df = one_col(spark, ["a b-c d_e 12", big])
    got = df.select(tx.text_length(F.col("x")), tx.word_count(F.col("x"))).collect()
    assert (got[0][0], got[0][1]) == (12, 5)          # a, b, c, d_e, 12
    assert (got[1][0], got[1][1]) == (250000, 50000)


@pytest.mark.parametrize("score,label", [
    (0.51, "Very Positive"), (0.5, "Positive"), (0.1, "Neutral"), (-0.1, "Negative"),
    (-0.5, "Very Negative"), (None, "Very Negative")])
def test_sentiment_label_boundaries(spark, score, label):
    df = one_col(spark, [score], "double")
    assert df.select(signals.sentiment_label(F.col("x"))).first()[0] == label


@pytest.mark.parametrize("score,ret,label", [
    (0.31, 0.011, "Accurate Positive"), (0.3, 0.011, "Directionally Correct"),
    (0.31, 0.01, "Directionally Correct"), (-0.31, -0.011, "Accurate Negative"),
    (-0.3, -0.02, "Directionally Correct"), (0.5, None, "Contrary Signal"),
    (0.0, 0.0, "Directionally Correct"), (0.2, -0.2, "Contrary Signal")])
def test_prediction_accuracy(spark, score, ret, label):
    df = spark.createDataFrame([(score, ret)], "s double, r double")
    assert df.select(signals.prediction_accuracy(F.col("s"), F.col("r"))).first()[0] == label


@pytest.mark.parametrize("ratio,ret,sig", [
    (1.03, 0.01, "STRONG_BUY"), (1.02, 0.01, "BUY"), (1.0, 0.01, "HOLD"),
    (0.97, -0.01, "STRONG_SELL"), (0.98, -0.01, "SELL"), (1.01, 0.0, "HOLD"), (None, 0.1, "HOLD")])
def test_technical_signal(spark, ratio, ret, sig):
    df = spark.createDataFrame([(ratio, ret)], "a double, b double")
    assert df.select(signals.technical_signal(F.col("a"), F.col("b"))).first()[0] == sig


@pytest.mark.parametrize("sent,risk,sharpe,d", [
    (0.51, 1, 0.1, "BULLISH"), (0.5, 1, 0.1, "NEUTRAL"), (0.6, 2, 0.1, "NEUTRAL"),
    (0.6, 1, 0.0, "NEUTRAL"), (-0.31, 0, 1.0, "BEARISH"), (-0.3, 2, 1.0, "NEUTRAL"),
    (0.9, 3, 1.0, "BEARISH"), (None, None, None, "NEUTRAL")])
def test_signal_direction(spark, sent, risk, sharpe, d):
    df = spark.createDataFrame([(sent, risk, sharpe)], "a double, b int, c double")
    assert df.select(signals.signal_direction(F.col("a"), F.col("b"), F.col("c"))).first()[0] == d


def test_half_up_and_hour_diff(spark):
    df = spark.createDataFrame([(2.5, -2.5, 0.125, None)], "a double, b double, c double, d double")
    r = df.select(half_up("a", 0), half_up("b", 0), half_up("c", 2), half_up("d", 2)).first()
    assert tuple(r) == (3.0, -3.0, 0.13, None)
    t = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 59), dt.datetime(2024, 1, 1, 1, 1))],
                              "a timestamp, b timestamp")
    assert t.select(signals.hour_diff(F.col("a"), F.col("b"))).first()[0] == 1


def test_half_up_keeps_large_small_and_special_values(spark):
    df = spark.sql("SELECT * FROM VALUES (1e16D), (-1e300D), (double('inf')), (double('nan')), (2.5D), (-2.5D), (null) AS t(x)")
    got = [r[0] for r in df.select(half_up("x", 4)).collect()]
    assert got[:3] == [1e16, -1e300, float("inf")] and got[3] != got[3] and got[4:] == [2.5, -2.5, None]
    assert [r[0] for r in df.select(half_up("x", 0)).collect()][4:6] == [3.0, -3.0]


def test_windowed_average_has_no_decimal_bounds(spark):
    from pyspark.sql import Window
    from tidemark.operators import indicators
    df = spark.sql("SELECT * FROM VALUES (1, 2e28D), (2, 2e28D), (3, 1e-12D) AS t(i, close_price)")
    avg = indicators.moving_avg(1)(Window.partitionBy().orderBy("i"))
    assert [r[0] for r in df.select(avg).collect()] == [2e28, 2e28, 1e-12]


def test_partition_count_counts_null_groups(spark):
    from tidemark.operators import indicators
    df = spark.createDataFrame([("a", 1), (None, 2), (None, 2)], "k string, d int")
    assert sorted((str(r.k), r.n) for r in indicators.partition_count(df, ["k", "d"], "n").collect()) == [("None", 2), ("None", 2), ("a", 1)]
