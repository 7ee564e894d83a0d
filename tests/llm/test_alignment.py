import hashlib
import random
from collections import Counter
from functools import cache

import pytest

from loomcast.llm import alignment
from loomcast.llm.registry import QUERIES, tokenizer_path
from tests.llm.conftest import no_documents

PATHS = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
FOLDER = "/root/testdata/sf0.001"


@cache
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PATHS[1])


def whole_text_tokens(text):
    """(id, bytes) of A and of B, from the libraries on the whole text."""
    a, b = libraries()
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    shown = {chr(x): x for x in visible}
    shown |= {chr(256 + k): x for k, x in enumerate(x for x in range(256) if x not in visible)}
    own_a = [(k, bytes(shown[c] for c in a.id_to_token(k))) for k in a.encode(" " + text, add_special_tokens=False).ids]
    own_b = []
    for k in b.encode(text):
        piece = b.id_to_piece(k)
        own_b.append((k, bytes([int(piece[3:5], 16)]) if b.is_byte(k) else piece.replace("▁", " ").encode()))
    return own_a, own_b


def brute(rows):
    groups = []
    for _, text in rows:
        own = []
        if text:
            a, b = whole_text_tokens(text)
            raw = (" " + text).encode()
            if b"".join(x for _, x in a) == raw == b"".join(x for _, x in b):
                ends_a, ends_b = set(), set()
                for side, ends in ((a, ends_a), (b, ends_b)):
                    at = 0
                    for _, x in side:
                        at += len(x)
                        ends.add(at)
                cuts = sorted(ends_a & ends_b)
                own = [([], []) for _ in cuts]
                for side, tokens in enumerate((a, b)):
                    at, g = 0, 0
                    for k, x in tokens:
                        while at >= cuts[g]:
                            g += 1
                        own[g][side].append(k)
                        at += len(x)
        groups.append(own)
    links = [Counter((a, b) for ga, gb in own for a in ga for b in gb) for own in groups]
    count = Counter(pair for own in links for pair in own)
    best = Counter()
    for (a, _), c in count.items():
        best[a] = max(best[a], c)
    out = []
    for (doc, _), own, held in zip(rows, groups, links):
        line = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in own)
        out.append(
            (
                doc, sum(len(a) for a, _ in own), sum(len(b) for _, b in own), len(own), sum(held.values()),
                sum(n for (a, b), n in held.items() if count[a, b] == best[a]),
                sum(n * count[p] for p, n in held.items()), line,
            )
        )
    return out


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[7]))


HARD = [
    "  two  spaces ", " a", "a ", "\n", " ", "a\n b", "a \nb", "tab\there", "x▁y", "▁", "<|endoftext|> it's plain",
    "<0x41> <s> <unk>", "日本語 テスト 日本 😀😀 👩‍👩‍👧", "é́ ﬁ Σς   nbsp", "can't 'll 're", "a᠎ b​ c﻿ d",
    "\x1c \x1d x \x85 y", "　wide　 space", "=" * 500, " " * 300 + "x", "ab" * 700, "١٢٣ ½ ²", "\x00 nul \x00",
]


def test_equals_whole_texts(spark, odd):
    table, rows = odd
    draw = random.Random(3)
    signs = "ab  \n\t.,'é▁日😀0 <>|s"
    made = [(100 + k, t) for k, t in enumerate(HARD)]
    made += [(200 + k, "".join(draw.choices(signs, k=draw.randint(1, 40)))) for k in range(300)] + [(None, "no id"), (None, None)]
    clash = table.columns[2:]
    more = spark.createDataFrame([(i, t, *["x"] * len(clash)) for i, t in made], table.schema)
    found = alignment.align_documents(table.union(more).repartition(3), *PATHS, block_bytes=2000)
    assert order(tuple(r) for r in found.collect()) == order(brute(rows + made))


@pytest.mark.parametrize("limit", [0, 3])
def test_large_groups_count_distinct_ids(monkeypatch, limit):
    pair = alignment.TokenPair(*PATHS)
    texts = ["日本語 テスト 日本", "=" * 100, "abc def"]
    whole = alignment.align_block(pair, texts, False)
    monkeypatch.setattr(alignment, "GROUP_LINKS", limit)
    parted = alignment.align_block(pair, texts, False)
    assert {k: list(v) for k, v in whole.items()} == {k: list(v) for k, v in parted.items()}


def test_memory_starts_anew(monkeypatch):
    pair = alignment.TokenPair(*PATHS)
    texts = [f"word{k} and more, the {k}. end" for k in range(60)]
    whole = alignment.align_block(pair, texts, True)["shown"]
    monkeypatch.setattr(alignment, "WORDS_HELD", 5)
    monkeypatch.setattr(alignment, "WORDS_A_CALL", 2)
    assert [alignment.align_block(pair, [t], True)["shown"][0] for t in texts] == whole


def test_query_on_a_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    found = [tuple(r) for r in QUERIES["op11_align"](spark, FOLDER).collect()]
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest() if x else ""
    assert order(found) == order((*r[:7], digest(r[7])) for r in brute(rows))


def test_no_documents(spark):
    assert alignment.align_documents(no_documents(spark), *PATHS).count() == 0
