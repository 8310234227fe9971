"""Text scoring columns: sentiment, summary, theme, risk, polarity, stats,
and deterministic hash-derived numbers.

All are built-in Column expressions (``contains``, ``when``, ``md5``,
``regexp_count``) evaluated over the whole text of every row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import col_, half_up
from .rules import REFERENCE, Lexicon, any_contains, rule_case

HEX_DIGITS = 13                      # 52 bits: exact in a double
HEX_SCALE = float(16 ** HEX_DIGITS)


def hex_prefix_int(hex_col) -> Column:
    """Integer value of the first 13 hex digits of a hex digest string."""
    return F.conv(F.substring(col_(hex_col), 1, HEX_DIGITS), 16, 10).cast("bigint")


def hash_score(key) -> Column:
    """Deterministic pseudo-score in [-0.50, 0.49] from MD5 of the key."""
    h = hex_prefix_int(F.md5(col_(key).cast("string")))
    return ((h % 100) - 50).cast("double") / F.lit(100.0)


def hash_unit(digest_hex) -> Column:
    """Map a hex digest to [0, 1) using its first 13 hex digits."""
    return hex_prefix_int(digest_hex).cast("double") / F.lit(HEX_SCALE)


def sentiment_score(text, key, lex: Lexicon = REFERENCE) -> Column:
    return rule_case(text, lex.sentiment_rules(), hash_score(key)).cast("double")


def sentiment_neutral(text, lex: Lexicon = REFERENCE) -> Column:
    return rule_case(text, lex.sentiment_rules(), 0.0).cast("double")


def theme_summary(text, lex: Lexicon = REFERENCE, min_len: int = 200) -> Column:
    t = col_(text)

    def flag(kw, label):
        return F.when(t.contains(kw), F.lit(label)).otherwise(F.lit(""))

    tone = (F.when(any_contains(t, lex.optimism), "optimism")
            .when(any_contains(t, lex.caution), "caution")
            .otherwise("measured confidence"))
    body = F.concat(
        F.lit("Key themes: "),
        flag(lex.theme_ai, "AI strategy, "),
        flag(lex.theme_cloud, "Cloud growth, "),
        flag(lex.theme_margin, "Margin trends, "),
        F.when(t.contains(lex.theme_guidance), "Forward guidance discussed")
         .otherwise("Operational review"),
        F.lit(". Management expressed "), tone, F.lit(" about forward outlook."),
    )
    return F.when(F.length(t) > min_len, body).otherwise(F.lit("Brief commentary segment"))


def primary_theme(text, lex: Lexicon = REFERENCE) -> Column:
    return rule_case(text, lex.primary_theme_rules(), "General Commentary")


def risk_category(text, lex: Lexicon = REFERENCE) -> Column:
    return rule_case(text, lex.risk_rules(), lex.risk_default)


def polarity(text, lex: Lexicon = REFERENCE) -> Column:
    return rule_case(text, lex.polarity_rules(), lex.polarity_default)


def text_length(text) -> Column:
    return F.length(col_(text)).cast("bigint")


def word_count(text) -> Column:
    """Number of ``\\w+`` matches over the whole text (no array built)."""
    return F.regexp_count(col_(text), F.lit(r"\w+")).cast("bigint")


def embedding_component(digest_hex, digits: int = 6) -> Column:
    return half_up((hash_unit(digest_hex) - F.lit(0.5)) * F.lit(2.0), digits)


def pseudo_embedding(key) -> Column:
    """5-d deterministic vector from MD5/SHA-256 digests of the key."""
    k = col_(key).cast("string")
    return F.array(
        embedding_component(F.md5(k)),
        embedding_component(F.sha2(k, 256)),
        embedding_component(F.md5(F.concat(k, F.lit("x")))),
        embedding_component(F.sha2(F.concat(k, F.lit("y")), 256)),
        embedding_component(F.md5(F.concat(k, F.lit("z")))),
    )
