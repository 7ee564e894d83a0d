import time
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from loomcast.llm.packing import Packer, pack
from loomcast.llm.wordbpe import WordEncoder
from tests.llm.conftest import no_documents, some_words

PATH = public_tokenizers.path("word_bpe_49k.json")


def ids_of(text):
    coded = Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False)
    return np.array(coded.ids + [2], dtype="<u4")


def check(rows, pieces):
    """Each id of each row in exactly one piece; sequences gapless, at most 4096 ids."""
    whole, by_place = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_place[p.sequence_id].append((p.offset, p.length))
        whole[p.doc_id].append(p)
    for parts in by_place.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= 4096
    for doc in {i for i, _ in rows}:
        texts = [t for i, t in rows if i == doc]
        ids = ids_of(texts[0])
        left = sorted(whole[doc], key=lambda p: p.start)
        assert sum(p.length for p in left) == len(ids) * len(texts)
        for p in left:
            assert p.doc_tokens == len(ids)
            assert p.ids_crc32 == zlib.crc32(ids[p.start : p.start + p.length].tobytes())
    return by_place


def test_odd_texts(odd):
    table, rows = odd
    check(rows, pack(table, PATH).collect())


def test_little_padding(spark):
    rows = [(k, " ".join(some_words(k, 20 + 37 * k % 2900))) for k in range(150)]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    sizes = [sum(length for _, length in parts) for parts in check(rows, pack(table, PATH).collect()).values()]
    padding = sum(4096 - s for s in sizes if s & (s - 1))
    assert padding == 0


def test_empty_table(spark):
    assert pack(no_documents(spark), PATH).count() == 0


def test_rule_takes_the_level_of_least_squares():
    draw = np.random.default_rng(2)
    packer = Packer(64)
    for k in range(400):
        size = int(draw.integers(1, 64))
        before = packer.counts.copy()
        best = None
        for level in range(64 - size, -1, -1):
            if level and not before[level]:
                continue
            after = before.copy()
            after[level] -= level > 0
            if level + size < 64:
                after[level + size] += 1
            cost = int((after**2).sum())
            if best is None or cost < best[0]:
                best = (cost, level)
        assert packer.level_for(size) == best[1]
        list(packer.add((k, 0, np.arange(size), size)))
    assert sum(len(x) for x in packer.open.values()) == packer.counts.sum()


def test_words_equal_the_library():
    own, theirs = WordEncoder(PATH), Tokenizer.from_file(PATH)
    odd = ["a<|endoftext|>b. c", "it's they're I'LL", "x́ é. Å", "İstanbul ΣΑΣ Σ.", "a\tb\r\nc\x0bd\x1ce\x85f g", "<|startoftext|>.", "क़ख़ कि", "a's.", " x ", "", "12.5 3,4 $$"]
    for text in odd + [" ".join(some_words(k, 50)) for k in range(10)]:
        want = np.array(theirs.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        assert own.encode([text])[0] == want


def test_a_call_costs_its_own_words():
    own = WordEncoder(PATH)
    own.known.update((f"{k} held", b"") for k in range(400_000))
    own.encode(["ab"])
    began = time.process_time()
    for _ in range(10):
        {"x"}.difference_update(own.known.keys())
    ten_rounds = time.process_time() - began
    began = time.process_time()
    for _ in range(100):
        own.encode(["ab ab"])
    assert time.process_time() - began < ten_rounds


def test_words_are_encoded_without_offsets():
    own, names = WordEncoder(PATH), []
    real = own.tokenizer

    class Watched:
        def __getattr__(self, name):
            names.append(name)
            return getattr(real, name)

    own.tokenizer = Watched()
    assert own.encode(["some plain Words, éa x1"]) == WordEncoder(PATH).encode(["some plain Words, éa x1"])
    assert set(names) == {"encode_batch_fast"}
