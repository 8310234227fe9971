"""Secret scans with a trigram inverted index.

Each rule is a regular expression. From its syntax tree a Boolean trigram
query is derived: every match must hold the trigrams of the literals that
the expression cannot do without. The index holds, for each trigram that
some query names, the documents that contain it (lower case); a rule's
candidates are the documents its query finds when the posting lists are
merged by document, and only those are verified with the expression. A rule
without a mandatory trigram scans every text.

Everything on the data path is a DataFrame expression. Matches are leftmost
and non-overlapping per rule; positions are code points, end exclusive.

Defined results: a null text is empty and has no spans; repeated doc_ids
share their posting entries (a superset of candidates) but are verified each
on its own text; a null doc_id is a key like any other; texts of
any length are scanned whole; an empty table gives no rows. Other columns are
ignored (and kept by ``redact``).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from re import _constants as _c
from re import _parser as _p

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrays import let, sums_before
from .common import materialize


@dataclass(frozen=True)
class Rule:
    kind: str
    regex: str                      # as Java and Python read it alike
    group: int = 0                  # the group whose length counts ...
    least: int = 0                  # ... and must be this many code points


# The three base kinds in their listed order.
BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]{14,}"),     # a run of 18 or more: shorter runs hold no longer one
    Rule("hex", r"[0-9a-f]{16,}"),
)
# Published shapes of common credentials.
ADDED = (
    Rule("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("github", r"gh[opsu]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abps]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
RULES = BASE + ADDED

#: Literal alternatives that a query spells out before it settles for less.
MOST_LITERALS = 64
MOST_CLASS = 4


# ---------------------------------------------------------------- queries
# A query is None (any document), a trigram, or ("and" | "or", (query, ...)).
def _all(parts) -> object:
    flat = {p for p in parts if p is not None}
    return None if not flat else flat.pop() if len(flat) == 1 else ("and", tuple(sorted(flat, key=str)))


def _any(parts) -> object:
    parts = set(parts)
    if not parts or None in parts:
        return None
    # an alternative that asks for more than another one asks is implied by it
    asks = {p: trigrams(p) for p in parts if isinstance(p, str) or p[0] == "and" and all(isinstance(q, str) for q in p[1])}
    parts -= {p for p in asks for q in asks if asks[q] < asks[p]}
    return parts.pop() if len(parts) == 1 else ("or", tuple(sorted(parts, key=str)))


def _literal(text: str) -> object:
    return _all(text[i:i + 3] for i in range(len(text) - 2))


def _flush(exact: set[str]) -> object:
    return _any(_literal(x) for x in exact)


def _walk(nodes) -> tuple[set[str] | None, object]:
    """(every string the nodes match, or None; query for a match of them)."""
    exact: set[str] | None = {""}
    whole, query = True, []
    for op, arg in nodes:
        own, need = _node(op, arg)
        if need is not None:
            query.append(need)
        if own is not None and exact is not None and len(own) * len(exact) <= MOST_LITERALS:
            exact = {a + b for a in exact for b in own}
        else:
            whole = False
            if exact:
                query.append(_flush(exact))
            exact = own if own is not None else {""}
    if whole:
        return exact, None
    return None, _all([*query, _flush(exact)])


def _node(op, arg) -> tuple[set[str] | None, object]:
    if op is _c.LITERAL:
        return {chr(arg).lower()}, None
    if op is _c.IN:
        if all(k is _c.LITERAL for k, _ in arg) and len(arg) <= MOST_CLASS:
            return {chr(v).lower() for _, v in arg}, None
        return None, None
    if op is _c.SUBPATTERN:
        return _walk(arg[3])
    if op is _c.BRANCH:
        ways = [_walk(x) for x in arg[1]]
        if all(w is not None for w, _ in ways):
            return set().union(*(w for w, _ in ways)), None
        return None, _any(_flush(w) if w is not None else q for w, q in ways)
    if op in (_c.MAX_REPEAT, _c.MIN_REPEAT, _c.POSSESSIVE_REPEAT):
        low, high, inner = arg
        own, need = _walk(inner)
        if own is not None and (low, high) == (0, 1):
            return own | {""}, None
        if low == 0:
            return None, None
        return None, _flush(own) if own is not None else need
    if op is _c.AT:
        return {""}, None
    return None, None


def trigram_query(regex: str) -> object:
    """The trigram query that every text with a match satisfies; None: all."""
    own, need = _walk(_p.parse(regex))
    return _flush(own) if own is not None else need


def trigrams(query: object) -> set[str]:
    if query is None:
        return set()
    return {query} if isinstance(query, str) else set().union(*(trigrams(q) for q in query[1]))


def holds(query: object, present: Column) -> Column:
    """The query, asked of an array of the trigrams that a document holds."""
    if isinstance(query, str):
        return F.array_contains(present, query)
    parts = [holds(q, present) for q in query[1]]
    return reduce(lambda a, b: a & b if query[0] == "and" else a | b, parts)


# ------------------------------------------------------------------ index
def _text() -> Column:
    return F.coalesce(F.col("text").cast("string"), F.lit(""))


def build_index(docs: DataFrame, names: set[str]) -> DataFrame:
    """Postings (trigram, doc_id) of the named trigrams, in shared files."""
    wanted = F.array(*[F.lit(t) for t in sorted(names)])
    found = let(F.lower(_text()), lambda low: F.filter(wanted, lambda t: F.contains(low, t)))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.explode(found).alias("trigram"))
    return materialize(rows.select("trigram", "doc_id"), "postings")


def candidates(index: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(doc_id, rules): the rules whose query a document's postings satisfy."""
    asked = [(r.kind, q) for r in rules if (q := trigram_query(r.regex)) is not None]
    merged = index.groupBy("doc_id").agg(F.collect_set("trigram").alias("present"))   # at most all named trigrams
    kinds = F.array_compact(F.array(*[F.when(holds(q, F.col("present")), F.lit(k)) for k, q in asked]))
    return merged.select(F.col("doc_id").alias("_doc"), kinds.alias("_rules")).filter(F.size("_rules") > 0)


# ----------------------------------------------------------------- verify
def _cut(text: Column, rule: Rule) -> Column:
    """parts and hits such that text = parts[0] hits[0] parts[1] ... parts[n]."""
    return F.struct(F.split(text, rule.regex, -1).alias("parts"),
                    F.regexp_extract_all(text, F.lit(rule.regex), F.lit(0)).alias("hits"),
                    F.regexp_extract_all(text, F.lit(rule.regex), F.lit(rule.group)).alias("counted"))


def find(text: Column, rule: Rule, order: int) -> Column:
    """array<struct<start, ord, end, kind>> of one rule."""
    def body(cut: Column) -> Column:
        lengths = F.zip_with(F.slice(cut["parts"], F.lit(1), F.size(cut["hits"])), cut["hits"],
                             lambda p, h: (F.length(p) + F.length(h)).cast("long"))
        spans = F.zip_with(
            sums_before(lengths), F.arrays_zip(F.slice(cut["parts"], F.lit(1), F.size(cut["hits"])).alias("p"),
                                               cut["hits"].alias("h"), cut["counted"].alias("c")),
            lambda at, x: F.struct((at + F.length(x["p"])).alias("start"), F.lit(order).alias("ord"),
                                   (at + F.length(x["p"]) + F.length(x["h"])).alias("end"),
                                   F.lit(rule.kind).alias("kind"), F.length(x["c"]).alias("n")))
        kept = F.filter(spans, lambda s: s["n"] >= rule.least)
        return F.transform(kept, lambda s: F.struct(s["start"], s["ord"], s["end"], s["kind"]))

    return let(_cut(text, rule), body)


_SPANS = "array<struct<start:bigint,ord:int,end:bigint,kind:string>>"


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per document: doc_id, spans (array of start, ord, end, kind by start,
    then by the order of the rules)."""
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _text().alias("text"))
    found, joined = _with_candidates(source, rules)
    lists = [_where(found, r, find(F.col("text"), r, i), F.from_json(F.lit("[]"), _SPANS)) for i, r in enumerate(rules)]
    return joined.select("doc_id", F.array_sort(F.concat(*lists)).alias("spans"))


def _with_candidates(source: DataFrame, rules: tuple[Rule, ...]) -> tuple[Column, DataFrame]:
    names = set().union(*(trigrams(trigram_query(r.regex)) for r in rules))
    if not names:
        return F.array(), source
    found = candidates(build_index(source, names), rules)
    return F.col("_rules"), source.join(found, source["doc_id"].eqNullSafe(found["_doc"]), "left")


def _where(found: Column, rule: Rule, then: Column, other: Column) -> Column:
    if trigram_query(rule.regex) is None:
        return then
    return F.when(F.coalesce(F.array_contains(found, rule.kind), F.lit(False)), then).otherwise(other)


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES, mark: str = "[SECRET]") -> DataFrame:
    """The documents (all their columns) with every match replaced by the
    mark, rule after rule; n_chars follows the text. A null text stays null."""
    whole = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                        F.col("text").cast("string").alias("text"))
    found, joined = _with_candidates(whole, rules)

    def wiped(text: Column, rule: Rule) -> Column:
        def body(cut: Column) -> Column:
            shown = F.zip_with(cut["hits"], cut["counted"],
                               lambda h, c: F.when(F.length(c) >= rule.least, F.lit(mark)).otherwise(h))
            return F.array_join(F.flatten(F.zip_with(cut["parts"], shown, lambda p, h: F.array(p, F.coalesce(h, F.lit(""))))), "")
        return let(_cut(text, rule), body)

    def step(text: Column, rule: Rule) -> Column:
        return let(text, lambda t: _where(found, rule, F.when(F.rlike(t, F.lit(rule.regex)), wiped(t, rule)).otherwise(t), t))

    wiped_text = joined.withColumn("text", reduce(step, rules, F.col("text")))
    counted = F.when(F.col("text").isNull(), F.col("row.n_chars")).otherwise(
        F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else None
    own = {"text": F.col("text"), "n_chars": counted}
    return wiped_text.select(*[own.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def query(spark, sf_dir: str) -> DataFrame:
    """op5: the secrets of every document."""
    from .common import table

    found = scan(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["ord"] < len(BASE))
    return found.select("doc_id", *[count(r.kind) for r in BASE], F.sha2(_listed(base), 256).alias("base_sha256"),
                        _listed(F.col("spans")).alias("spans"))
