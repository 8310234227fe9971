"""DuckDB SQL of the queries that SQL can express.

Written from the contracts, not from the operators: plain window lists and
regular expressions over whole texts. DuckDB's expressions are RE2's, with
the same leftmost-first matches.
"""

from __future__ import annotations

from . import chat, secrets


def _hex(digest: str) -> str:
    return f"lower(sha256({digest}))"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


# op5: text = parts[1] hits[1] parts[2] ...; a hit starts after all that.
_BASE_SQL = {
    "assign": (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    "access": (r"AKIA[A-Z0-9]+", 0, 18),
    "hex": (r"[0-9a-f]+", 0, 16),
}


def _op5() -> str:
    rules = [(k, *v) for k, v in _BASE_SQL.items()] + [(r.kind, r.regex, r.group, r.least) for r in secrets.ADDED]
    kinds = []
    for i, (kind, regex, group, least) in enumerate(rules):
        r = _quoted(regex)
        kinds.append(f"""
      SELECT row, '{kind}' AS kind, {i} AS ord, pos, pos + length(hits[k]) AS upto FROM (
        SELECT row, hits, counted, unnest(range(1, len(hits) + 1)) AS k,
               unnest(list_transform(range(1, len(hits) + 1), lambda k:
                 list_sum(list_transform(parts[1:k], lambda p: length(p)))
                 + coalesce(list_sum(list_transform(hits[1:k - 1], lambda h: length(h))), 0))) AS pos
        FROM (SELECT row, string_split_regex(text, {r}) AS parts, regexp_extract_all(text, {r}, 0) AS hits,
                     regexp_extract_all(text, {r}, {group}) AS counted FROM docs))
      WHERE length(counted[k]) >= {least}""")
    counts = ", ".join(f"count(*) FILTER (WHERE kind = '{k}') AS n_{k}" for k in _BASE_SQL)
    told = "kind || ':' || CAST(pos AS BIGINT) || ':' || CAST(upto AS BIGINT)"
    return f"""
    WITH docs AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
    found AS ({' UNION ALL '.join(kinds)}),
    listed AS (SELECT row, {counts},
        coalesce(string_agg({told}, ',' ORDER BY pos, ord) FILTER (WHERE ord < {len(_BASE_SQL)}), '') AS base,
        coalesce(string_agg({told}, ',' ORDER BY pos, ord), '') AS spans FROM found GROUP BY row)
    SELECT doc_id, {', '.join(f'coalesce(n_{k}, 0) AS n_{k}' for k in _BASE_SQL)},
           {_hex("coalesce(base, '')")} AS base_sha256, coalesce(spans, '') AS spans
    FROM docs LEFT JOIN listed USING (row)"""


# op6: the template's length is that of its marks and of the escaped texts:
# a backslash more per backslash, two characters more per control string.
def _op6() -> str:
    marks = " + ".join(f"(length({{x}}) - length(replace({{x}}, {_quoted(c)}, ''))) // {len(c)}" for c in chat.CONTROL)
    size = lambda x: (f"(length({x}) + (length({x}) - length(replace({x}, chr(92), ''))) + 2 * ({marks.format(x=x)}))")
    frame = len(chat.START) + len("\n") + len(chat.END)
    return f"""
    WITH turns AS (
      SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
      UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
    SELECT conv_id, count(*) AS n_turns,
      {_hex("string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)")} AS turns_sha256,
      CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
      {_hex("coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE role = 'assistant'), '')")} AS loss_sha256,
      CAST(sum({frame} + {size('role')} + {size('text')}) AS BIGINT) AS formatted_chars
    FROM turns GROUP BY conv_id"""


# op7: windows of ten words (or all of fewer) as strings, joined on equality.
# The longest match: places that follow each other on one diagonal.
_WORDS = r"regexp_extract_all(translate({x}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def _op7() -> str:
    return f"""
    WITH docs AS (SELECT row_number() OVER () AS row, doc_id, {_WORDS.format(x="coalesce(text, '')")} AS w FROM documents),
    items AS (SELECT row_number() OVER () AS item, CAST(item_id AS VARCHAR) AS name, {_WORDS.format(x="coalesce(text, '')")} AS w FROM benchmark),
    wins AS (SELECT item, name, p, least(10, len(w)) AS size, array_to_string(w[p:p + least(10, len(w)) - 1], ' ') AS win
             FROM (SELECT item, name, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS p FROM items WHERE len(w) > 0)),
    sizes AS (SELECT DISTINCT size FROM wins),
    spots AS (SELECT row, q, size, array_to_string(w[q:q + size - 1], ' ') AS win
              FROM (SELECT row, w, size, unnest(range(1, len(w) - size + 2)) AS q FROM docs, sizes WHERE len(w) >= size)),
    hits AS (SELECT s.row, s.q, s.size, i.item, i.name, i.p FROM spots s JOIN wins i ON s.win = i.win AND s.size = i.size),
    covered AS (SELECT row, count(DISTINCT k) AS n_hit FROM (SELECT row, unnest(range(q, q + size)) AS k FROM hits) GROUP BY row),
    named AS (SELECT row, count(DISTINCT name) AS n_items, string_agg(DISTINCT name, ',' ORDER BY name) AS names FROM hits GROUP BY row),
    runs AS (SELECT row, size, q - row_number() OVER (PARTITION BY row, item, q - p ORDER BY q) AS run, item, q - p AS diagonal FROM hits),
    far AS (SELECT row, max(n) AS longest FROM (SELECT row, count(*) - 1 + any_value(size) AS n FROM runs GROUP BY row, item, diagonal, run) GROUP BY row)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           {_hex("coalesce(names, '')")} AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated, CAST(coalesce(longest, 0) AS BIGINT) AS longest_match
    FROM docs LEFT JOIN covered USING (row) LEFT JOIN named USING (row) LEFT JOIN far USING (row)"""


# op9: pairs by shared shingles of five words, exact similarity, and the
# components of all links. (Equal texts are linked to the first of them.)
def _op9() -> str:
    return r"""
    WITH RECURSIVE docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
    firsts AS (SELECT min(doc_id) AS a, text FROM docs GROUP BY text),
    words AS (SELECT a, list_filter(regexp_split_to_array(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \t\n\x0b\x0c\r]+'), lambda x: x <> '') AS w FROM firsts),
    shingles AS (SELECT DISTINCT a, s FROM (
        SELECT a, unnest(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: hash(w[i:i + 4]))) AS s FROM words WHERE len(w) > 0)),
    sizes AS (SELECT a, count(*) AS n FROM shingles GROUP BY a),
    shared AS (SELECT x.a AS a, y.a AS b, count(*) AS c FROM shingles x JOIN shingles y ON x.s = y.s AND x.a < y.a GROUP BY 1, 2),
    links AS (SELECT shared.a, shared.b FROM shared JOIN sizes p ON p.a = shared.a JOIN sizes q ON q.a = shared.b
              WHERE 10 * c >= 8 * (p.n + q.n - c)),
    edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
    reach AS (SELECT a AS node, a AS seen FROM firsts UNION SELECT r.node, e.b FROM reach r JOIN edges e ON e.a = r.seen),
    component AS (SELECT node, min(seen) AS class_id FROM reach GROUP BY node),
    classed AS (SELECT d.doc_id, c.class_id FROM docs d JOIN firsts f ON f.text = d.text JOIN component c ON c.node = f.a)
    SELECT doc_id, class_id, count(*) OVER (PARTITION BY class_id) AS class_size, doc_id = class_id AS kept FROM classed"""


# op11: whole levels at a time, from plain leaf numbers; siblings are the
# other nodes of a run, in order.
def _op11() -> str:
    field = lambda x: f"CASE WHEN {x} IS NULL THEN '-' ELSE CAST(strlen(CAST({x} AS VARCHAR)) AS VARCHAR) || ':' || CAST({x} AS VARCHAR) END"
    leaf = lambda text: "sha256(" + " || ".join(map(field, ("doc_id", "source", "lang", "n_chars", text))) + ")"
    level = """SELECT {tree} lvl + 1 AS lvl, i // 3 AS i, any_value((n + 2) // 3) AS n, sha256(string_agg(d, '' ORDER BY i)) AS d
        FROM {of} WHERE n > 1 GROUP BY {tree} lvl, i // 3"""
    # crc32 of the decimal id, bit by bit
    crc = "list_reduce(list_prepend(4294967295, list_transform(range(0, length(id) * 8), lambda k: CAST(ascii(substr(id, k // 8 + 1, 1)) AS BIGINT) * 8 + k % 8)), " \
          "lambda c, x: CASE WHEN (xor(c, (x // 8) >> (x % 8)) & 1) = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)"
    return f"""
    WITH RECURSIVE docs AS (
      SELECT doc_id, source, {leaf("text")} AS leaf, CASE WHEN xor({crc}, 4294967295) % 2 = 0 THEN {leaf("replace(text, chr(10), '')")}
               ELSE {leaf("text")} END AS claim
      FROM (SELECT *, CAST(doc_id AS VARCHAR) AS id FROM documents)),
    placed AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n,
                 dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree FROM docs),
    nodes AS (SELECT tree, 0 AS lvl, pos AS i, n, leaf AS d FROM placed UNION ALL {level.format(tree="tree,", of="nodes")}),
    subroots AS (SELECT tree, d AS subroot FROM nodes WHERE n = 1),
    above AS (SELECT 0 AS lvl, tree AS i, (SELECT count(*) FROM subroots) AS n, subroot AS d FROM subroots
              UNION ALL {level.format(tree="", of="above")}),
    every AS (SELECT tree, lvl, i, n, d FROM nodes UNION ALL SELECT -1, lvl, i, n, d FROM above),
    steps AS (
      SELECT p.doc_id, p.tree, x.lvl AS step, x.i, p.pos // CAST(pow(3, x.lvl) AS BIGINT) AS own, x.d FROM placed p JOIN nodes x
        ON x.tree = p.tree AND x.n > 1 AND x.i // 3 = p.pos // CAST(pow(3, x.lvl + 1) AS BIGINT)
      UNION ALL
      SELECT p.doc_id, p.tree, 1000 + x.lvl, x.i, p.tree // CAST(pow(3, x.lvl) AS BIGINT), x.d FROM placed p JOIN above x
        ON x.n > 1 AND x.i // 3 = p.tree // CAST(pow(3, x.lvl + 1) AS BIGINT)),
    runs AS (SELECT doc_id, step, coalesce(string_agg(d, '' ORDER BY i) FILTER (WHERE i < own), '') AS lo,
               coalesce(string_agg(d, '' ORDER BY i) FILTER (WHERE i > own), '') AS hi FROM steps GROUP BY doc_id, step),
    turns AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY step) AS k, lo, hi FROM runs),
    fold AS (SELECT doc_id, 0 AS k, claim AS d FROM docs
             UNION ALL SELECT f.doc_id, f.k + 1, sha256(t.lo || f.d || t.hi) FROM fold f JOIN turns t ON t.doc_id = f.doc_id AND t.k = f.k + 1),
    folded AS (SELECT doc_id, arg_max(d, k) AS folded_root FROM fold GROUP BY doc_id),
    proof AS (SELECT doc_id, sha256(string_agg(lo || hi, '' ORDER BY k)) AS proof_sha256 FROM turns GROUP BY doc_id),
    top AS (SELECT d AS root FROM above WHERE n = 1)
    SELECT p.doc_id, p.leaf, s.subroot, top.root, coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root, folded_root = top.root AS verified
    FROM placed p JOIN subroots s USING (tree) JOIN folded f ON f.doc_id = p.doc_id LEFT JOIN proof ON proof.doc_id = p.doc_id CROSS JOIN top"""


# op13: every anchor with every row.
def _op13() -> str:
    return """
    WITH rows AS (
      SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
             list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
      FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scores AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
                 CAST(list_sum(list_transform(range(1, len(a.v) + 1), lambda k: a.v[k] * b.v[k])) AS BIGINT) AS score
               FROM rows a JOIN rows b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
    positives AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM scores WHERE same
                  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5),
    hard AS (SELECT p.*, s.other AS negative_id, s.score AS negative_score,
               row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other) AS place
             FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id AND NOT s.same
              AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score)
    SELECT anchor_id, positive_id, CAST(place AS INTEGER) AS "rank", negative_id, positive_score, negative_score FROM hard WHERE place <= 3"""


ORACLE_SQL = {"op13_hard_negatives": _op13(), "op11_merkle_manifest": _op11(), "op5_secrets": _op5(), "op6_chat": _op6(), "op7_decontamination": _op7(), "op9_near_dedup": _op9()}
