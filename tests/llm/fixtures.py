"""Awkward documents that every operator must take."""

import hashlib

PROSE = ("the quick brown fox jumps over the lazy dog while seven wise owls read old books near the quiet "
         "harbour and nobody hears how the slow tide turns under a pale moon that has seen it all before")

#: doc_id, text, lang, source, n_chars and columns whose names operators use
#: themselves.
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "node long, length int, rank string, score double, hits string, _rules string, bucket long, tree string")


def awkward_rows():
    texts = [PROSE, PROSE, None, "", " \n\t ", "x", "é😀ß", PROSE.upper(), (PROSE + "\n") * 800, "a" * 50_000,
             "1234 5678 " * 40, PROSE.replace("owls", "cats"), "###$$$ %%% " * 60]
    rows = [(i, t, "en" if i % 3 else None, "s" if i % 4 else None, len(t) if t else None) for i, t in enumerate(texts)]
    rows.append(rows[0])                                  # a repeated row
    rows.append((None, PROSE + " and more", "en", "s", 5))   # no id
    rows.append((None, None, None, None, None))
    return rows


def awkward(spark):
    clash = (1, 2, "r", 0.5, "h", "q", 3, "t")
    return spark.createDataFrame([r + clash for r in awkward_rows()], SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()
