import hashlib
import random
import re

from pyspark.sql import functions as F

from loomcast.llm import pii
from tests.llm.conftest import no_documents

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute(text):
    out = []
    for k, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            number = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(x) > 255 for x in m.group().split(".")):
                continue
            if kind == "phone" and not 9 <= len(number) <= 15:
                continue
            if kind == "card":
                twice = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(number))]
                if not 12 <= len(number) <= 19 or sum(v - 9 * (v > 9) for v in twice) % 10:
                    continue
            out.append((m.start(), k, kind, m.end()))
    return ",".join(f"{kind}:{a}:{b}" for a, _, kind, b in sorted(out))


def check(table, texts):
    got = pii.find_personal_data(table).collect()
    for r in got:
        want = brute(texts[r.doc_id])
        spans = [s for s in r.spans.split(",") if s]
        assert hashlib.sha256(want.encode()).hexdigest() == r.base_sha256, texts[r.doc_id]
        assert set(filter(None, want.split(","))) <= set(spans) and len(spans) == sum(r[f"n_{k}"] for k in pii.KINDS) + r.n_added
        assert [r[f"n_{k}"] for k in pii.KINDS] == [want.count(k + ":") for k in pii.KINDS]
    return got


def fixture(seed):
    draw = random.Random(seed)
    texts = [None, "", "é😀 a@b.c_d@e.f.g x", "1.2.3.4.5 300.1.1.1 0001.2.3.4", "+1 (017) 555-7713 +12 3", "x" * 3000 + "@", "1 " * 5000, "a" * 20_000 + "@b.c", "9" * 30_000, "1." * 4000]
    texts += ["bob at mail dot com, or bob (at) x [dot] org", "call (212) 555-0199 now", "ip 1[.]2[.]3[.]4", "card 4111.1111.1111.1111"]
    texts += ["".join(draw.choice("ab@@..11 4-+()é\n😀_%0") for _ in range(draw.randrange(80))) for _ in range(300)]
    some = ["4111111111111111", "4111-1111-1111-1111", "+49 30 1234567", "a.b@c.de", "10.0.0.1", "4111 1111 1111 1112", "x", "é"]
    texts += [" ".join(draw.choice(some) for _ in range(6)) for _ in range(200)]
    return texts


def test_base_spans_equal_brute_force(spark):
    texts = fixture(1)
    check(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), texts)


def test_odd_texts(odd):
    table, rows = odd
    assert len(check(table, dict(rows))) == len(rows)
    assert pii.find_personal_data(no_documents(table.sparkSession)).count() == 0


def test_the_classifier_adds_loose_spans(spark):
    texts = [f"phone +1 212 555 01{k:02d} or tel (212) 555-01{k:02d} please" for k in range(60)]
    texts += [f"see version 1.2.{300 + k}.4 for order 1234567890123{k:02d}" for k in range(60)]
    got = check(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), texts)
    added = [r.doc_id for r in got if r.n_added]
    assert len(added) >= 50 and all(k < 60 for k in added)


LOOSE = {
    "email": ["write to bob (at) example (dot) com", "mail: al.b [at] mail [dot] org now", "contact sue at shop dot net please"],
    "ip": ["server 10[.]20[.]30[.]40 is up", "the host 81(.)9(.)7(.)250, again", "from 93[.]1[.]2[.]3 came"],
    "card": ["card 4111.1111.1111.1111 expired", "paid by visa 4012_8888_8888_1881", "credit 5555/5555/5555/4444 used"],
    "phone": ["call 555-123-4567", "tel (212) 555-0199 at noon", "phone 0049 30 1234567 home"],
}
HARMLESS = [
    "version 1[.]2[.]3[.]999 is out", "order 4111.1111.1111.1112 shipped", "isbn 123-456-7890", "meet at noon dot nothing123",
    "serial 1234/5678/9012/3456", "invoice 555-123-4567 paid", "look at this dot", "id x555-123-4567y",
]
BASE = ["a.b@example.com", "10.1.2.3", "4111 1111 1111 1111", "+1 212 555 0100", "300.1.1.1", "1234 5678 9012 3456", "no data here"]


def test_loose_forms_are_found_and_placed(spark):
    draw = random.Random(5)
    planted = [(kind, t) for kind, texts in LOOSE.items() for t in texts] * 8
    texts = [t for _, t in planted] + HARMLESS * 4 + [f"word {draw.choice(BASE)} word" for _ in range(300)]
    got = {r.doc_id: r for r in check(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), texts)}
    found = 0
    for k, (kind, text) in enumerate(planted):
        for span in filter(None, got[k].spans.split(",")):
            name, a, b = span.split(":")
            assert name == kind and re.search(pii.LOOSE[kind].replace(r"\G|", ""), text).span() == (int(a), int(b))
            found += 1
    assert found >= 0.9 * len(planted)
    assert sum(got[k].n_added for k in range(len(planted), len(texts))) == 0


def test_labelers_vote_both_ways(spark):
    texts = [t for own in LOOSE.values() for t in own] + HARMLESS + BASE + ["x10.1.2.3y", "ref +1 212 555 0100", "a@b.zzzzzzzzzzzzz", "0.0.0.1", "9999999999999995"]
    _, spans = pii.propose(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    seen = {}
    for r in spans.collect():
        for k, vote in enumerate(r.votes):
            seen.setdefault(k, set()).add(vote)
    assert all({1, -1} <= seen[k] for k in range(pii.LABELERS))
    context = {(r.match, r.before[-5:], r.after[:3]) for r in spans.collect()}
    assert ("555-123-4567", "call ", "") in context and ("10[.]20[.]30[.]40", "rver ", " is") in context


def test_em_finds_the_reliable_labelers():
    draw, patterns = random.Random(2), {}
    for _ in range(4000):
        truth = draw.random() < 0.4
        v = tuple((1 if truth else -1) * (1 if draw.random() < right else -1) for right in (0.95, 0.9, 0.8, 0.6, 0.5))
        patterns[v] = patterns.get(v, 0) + 1
    likely, prior, right = pii.em(sorted(patterns.items()))
    assert abs(prior - 0.4) < 0.05 and abs(right[0] - 0.95) < 0.05 and abs(right[3] - 0.6) < 0.06
    assert sorted(patterns.items())[-1][0] == (1,) * 5 and likely[-1] > 0.99


def test_redaction_leaves_no_base_span(spark):
    texts = [t for t in fixture(3) if t is None or len(t) < 500]
    table = spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)], "doc_id long, text string, lang string")
    _, spans = pii.propose(table)
    clean = pii.redact(table, pii.learn(spans))
    assert clean.columns == table.columns
    for r in clean.collect():
        assert (r.text is None) == (texts[r.doc_id] is None) and brute(r.text) == ""
        if not brute(texts[r.doc_id]) and "[" not in (r.text or ""):
            assert r.text == texts[r.doc_id]


def test_luhn(spark):
    numbers = ["4111111111111111", "4111111111111112", "0", "18", "79927398713"]
    got = spark.createDataFrame([(n,) for n in numbers], "n string").select(pii.luhn(F.col("n"))).collect()
    assert [r[0] for r in got] == [True, False, True, True, True]
