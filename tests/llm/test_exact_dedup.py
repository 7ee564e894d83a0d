import hashlib
import re

from loomcast.llm.exact_dedup import LEAST, MOST, chunk_store, chunks, exact_duplicates, unverified, without_copies
from pyspark.sql import functions as F
from tests.llm.conftest import no_documents, some_words


def brute(rows):
    norm = [(i, re.sub("[ \t-\r]+", " ", t or "")) for i, t in rows]
    groups = {}
    for i, t in norm:
        groups.setdefault(t, []).append(i)
    return sorted((i, min(groups[t]), len(groups[t]), i == min(groups[t]), hashlib.sha256(t.encode()).hexdigest()) for i, t in norm)


def test_odd_texts(odd):
    table, rows = odd
    assert sorted(map(tuple, exact_duplicates(table).collect())) == brute(rows)


def test_long_texts_differ_in_one_chunk(spark):
    text = " ".join(some_words(1, 9000))
    rows = [(k, t) for k, t in enumerate([text, text + " ", text[:20_000] + "X" + text[20_001:], text.replace(" ", "\n"), text[:-1], text])]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, exact_duplicates(table).collect())) == brute(rows)


def test_chunks_join_to_the_text_and_resync(spark):
    text = ". ".join(" ".join(some_words(k, 12)) for k in range(400))
    moved = "Some words before it all. " + text
    a, b = (r[0] for r in spark.createDataFrame([(text,), (moved,)], "t string").select(chunks(F.col("t"))).collect())
    assert "".join(a) == text and "".join(b) == moved and max(map(len, a + b)) <= MOST and min(map(len, a[:-1])) >= LEAST
    assert len(set(a) & set(b)) > 0.8 * len(a)


def test_store_holds_each_chunk_once(spark):
    table = spark.createDataFrame([("a b",), ("a b",), ("c",)], "text string")
    store = chunk_store(table)
    assert store.count() == 2 and unverified(store).isEmpty()


def test_null_ids_and_empty_table(spark):
    table = spark.createDataFrame([(None, "a"), (4, "a"), (None, "b")], "doc_id long, text string")
    got = sorted((r.doc_id or -1, r.keep_id or -1, r.kept) for r in exact_duplicates(table).collect())
    assert got == [(-1, -1, True), (-1, 4, False), (4, 4, True)]
    assert exact_duplicates(no_documents(spark)).count() == 0 and without_copies(no_documents(spark)).count() == 0


def test_without_copies(odd):
    table, rows = odd
    left = without_copies(table)
    assert left.columns == table.columns
    assert sorted(r.doc_id for r in left.collect()) == sorted({x[0] for x in brute(rows) if x[3]})


def test_no_document_moves_to_drop_copies(spark):
    rows = [(k % 40, f"text {k % 30} {'x' * 50}", "a", 1) for k in range(90)] + [(None, "text 1 " + "x" * 50, "a", 1), (5, None, "a", 1), (6, "", "a", 1)]
    table = spark.createDataFrame(rows, "doc_id long, text string, _text_sha256 string, row int")
    left = without_copies(table)
    plan = left._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    got = left.collect()
    assert left.columns == table.columns and len(got) == 31
    best = {}
    for i, t, *_ in rows:
        best[t or ""] = min(best.get(t or "", 10**9), 10**9 if i is None else i)
    assert sorted((r.doc_id, r.text or "") for r in got) == sorted((i, t) for t, i in best.items())


def test_many_copies_are_joined_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr("loomcast.llm.exact_dedup.BROADCAST_BYTES", 0)
    table = spark.createDataFrame([(k, f"t{k % 7}") for k in range(50)], "doc_id long, text string")
    assert sorted(r.doc_id for r in without_copies(table).collect()) == list(range(7))
