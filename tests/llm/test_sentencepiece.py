import hashlib
import random

import public_tokenizers
import sentencepiece

from loomcast.llm.sentencepiece import PieceModel, decoded, encode_digests, encode_documents
from tests.llm.conftest import no_documents, some_words

PATH = public_tokenizers.path("piece_bpe_32k.model")
OWN, THEIRS = PieceModel(PATH), sentencepiece.SentencePieceProcessor(model_file=PATH)


def same(text):
    count, ids, raw = OWN.encode(text)
    want = THEIRS.encode(text)
    return ids == ",".join(map(str, want)) and count == len(want) and decoded(raw) == THEIRS.decode(want)


def test_equals_the_library():
    draw = random.Random(8)
    pieces = sorted(OWN.score)
    for k in range(1500):
        text = "".join(draw.choice("abcdetheinr  .,▁\n\té😀日x\x00#1") for _ in range(draw.randrange(40)))
        if k % 3 == 0:
            text = "".join(draw.choice(pieces) for _ in range(draw.randrange(8))).replace("▁", draw.choice([" ", "▁", ""]))
        if k % 7 == 0:
            text = "a" * draw.randrange(60) + "in" * draw.randrange(20)
        assert same(text), text


def test_long_texts():
    for text in (" ".join(some_words(3, 4000)), "x" * 3000, "ab" * 2000, "  " * 500, "日本語" * 500):
        assert same(text)


def test_backtracking_equals_merging():
    draw = random.Random(2)
    for _ in range(1500):
        text = "▁" + "".join(draw.choice("aeinrstl.") for _ in range(draw.randrange(1, 25)))
        assert OWN.backtracked(text) == OWN.merged(text)


def test_odd_texts(odd):
    table, rows = odd
    texts = dict(rows)
    for r in encode_documents(table, PATH).collect():
        want = THEIRS.encode(texts[r.doc_id] or "")
        assert r.ids == ",".join(map(str, want)) and r.n_tokens == len(want) and r.decoded == THEIRS.decode(want)
    got = {r.doc_id: r for r in encode_digests(table, PATH).collect()}
    assert len(got) == len(texts) and got[0].ids_sha256 == hashlib.sha256(b"").hexdigest()
    assert encode_digests(no_documents(table.sparkSession), PATH).count() == 0
