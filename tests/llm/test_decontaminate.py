"""Suffix arrays against window sets."""

import re

from fixtures import awkward_rows, sha
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import decontaminate as dc

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(texts, items, window):
    """Per text: covered words, items, longest verbatim match (window or more)."""
    keys = [(i, words(t)) for i, t in items]
    out = []
    for t in texts:
        w, hit, names, longest = words(t), set(), set(), 0
        for name, item in keys:
            n = min(window, len(item))
            for p in range(len(item) - n + 1 if n else 0):
                for q in range(len(w) - n + 1):
                    if w[q:q + n] == item[p:p + n]:
                        hit.update(range(q, q + n))
                        names.add("" if name is None else str(name))
                        k = n
                        while q + k < len(w) and p + k < len(item) and w[q + k] == item[p + k]:
                            k += 1
                        longest = max(longest, k)
        out.append((len(w), hit, sorted(names), longest))
    return out


small = st.text(alphabet="ab c", max_size=30)


@settings(max_examples=200, deadline=None)
@given(st.lists(small, min_size=1, max_size=6), st.lists(st.tuples(st.integers(0, 3), small), max_size=5))
def test_shard_matches_brute_force(texts, items):
    block = dc.ItemBlock([(str(i), dc.words_of(t.encode())) for i, t in items], 3)
    found = dc.match_shard([dc.words_of(t.encode()) for t in texts], block)
    for d, (n, hit, names, longest) in enumerate(brute(texts, items, 3)):
        spans, got, far = found.get(d, ([], [], 0))
        assert {k for a, b in spans for k in range(a, b)} == hit
        assert (sorted(got), far) == (names, longest)


def test_words_are_the_contracts():
    text = "".join(map(chr, range(1, 400))) + " Ünï İK 9z"
    assert [w.decode() for w in dc.words_of(text.encode())] == words(text)


def test_awkward(spark, docs, none):
    text = {r[0]: r[1] for r in awkward_rows() if r[0] is not None}
    items = [(1, "Jumps over the lazy dog while seven wise owls read old books"), (2, "x"), (3, ""), (4, None),
             (1, "Jumps over the lazy dog while seven wise owls read old books"), (None, "pale moon that has seen"), (5, "no such words here")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = {d: b for d, b in zip(text, brute(text.values(), items, 10))}
    for kw in ({}, {"shard_words": 40}, {"shard_words": 100, "block_words": 12}):
        rows = dc.overlap(docs, bench, **kw).collect()
        assert len(rows) == len(awkward_rows())
        for r in rows:
            if r.doc_id is not None:
                n, hit, names, longest = want[r.doc_id]
                assert r.n_words == n and {k for s in r.hits for k in range(s.start, s.end)} == hit
                assert all(a.end < b.start for a, b in zip(r.hits, r.hits[1:]))
                assert sorted(r["items"]) == names and r.longest == longest
        clean = dc.remove_contaminated(docs, bench, **kw)
        assert clean.columns == docs.columns
        kept = [r.doc_id for r in clean.collect() if r.doc_id is not None]
        assert sorted(kept) == sorted(d for d, *_ in awkward_rows() if d is not None and not want[d][1])
    assert dc.overlap(none, bench).count() == 0
    assert dc.overlap(docs, bench.limit(0)).filter("size(hits) > 0").count() == 0
    assert dc.remove_contaminated(docs, bench.limit(0)).count() == docs.count()


def test_one_block_at_a_time(spark, docs, monkeypatch):
    """A benchmark of many blocks: one on the driver and broadcast at once."""
    from pyspark import Broadcast, SparkContext

    items = [(i, f"word{i} seven wise owls read old books near the quiet harbour word{i}") for i in range(40)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    live, most, sizes = [0], [0], []
    put, end, make = SparkContext.broadcast, Broadcast.destroy, dc.ItemBlock.__init__

    def broadcast(self, value):
        live[0] += isinstance(value, dc.ItemBlock)
        most[0] = max(most[0], live[0])
        return put(self, value)

    def destroy(self, *a, **kw):
        live[0] -= 1
        return end(self, *a, **kw)

    def init(self, items, *a, **kw):
        sizes.append(len(items))
        make(self, items, *a, **kw)

    monkeypatch.setattr(SparkContext, "broadcast", broadcast)
    monkeypatch.setattr(Broadcast, "destroy", destroy)
    monkeypatch.setattr(dc.ItemBlock, "__init__", init)
    whole = {(r.doc_id, r.n_words, str(r.hits), tuple(sorted(r["items"])), r.longest) for r in dc.overlap(docs, bench).collect()}
    assert sizes == [40]
    live[0], most[0] = 0, 0
    rows = dc.overlap(docs, bench, block_words=130).collect()
    assert {(r.doc_id, r.n_words, str(r.hits), tuple(sorted(r["items"])), r.longest) for r in rows} == whole
    assert any(longest for *_, longest in whole) and sum(sizes) == 80 and len(sizes) > 3
    kept = dc.remove_contaminated(docs, bench, block_words=130).collect()
    assert _told(kept) == _told(dc.remove_contaminated(docs, bench).collect())
    assert most[0] == 1


def _told(rows):
    return sorted(map(str, rows))


def test_query_digest(spark, tmp_path):
    spark.createDataFrame([(1, "a b c"), (2, None)], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(10, "b C"), (9, "a")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    rows = {r.doc_id: r for r in dc.query(spark, str(tmp_path)).collect()}
    assert (rows[1].n_words, rows[1].n_hit, rows[1].n_items, rows[1].contaminated) == (3, 3, 2, True)
    assert rows[1].items_sha256 == sha("10,9") and rows[2].items_sha256 == sha("") and not rows[2].contaminated
