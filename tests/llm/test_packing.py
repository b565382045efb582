import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from llm_cases import empty, frame, odd, prose
from tokenizers import Tokenizer

from layerforge.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_word_by_word_gives_the_tokenizer_s_ids():
    whole, own = Tokenizer.from_file(PATH), packing.WordTokens(PATH)
    rng = random.Random(5)
    pieces = [*"abcXYZéÉß İŁłǅ.,!?'\"-|  \n\ţ́漢字123½²ªº_#$<>​Åﬁ\x1c\x85Σσςĳŉ ­", "'s", "'ll", "<|endoftext|>"]
    for _ in range(4000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 14)))
        assert own.encode(text.encode()).tolist() == whole.encode(text, add_special_tokens=False).ids, text


def check(found, texts, window):
    tokenizer = Tokenizer.from_file(PATH)
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in found:
        pieces[r["row"]].append(r)
        sequences[r["sequence_id"]].append(r)
    assert len(pieces) == len(texts)
    seen = []
    for own in pieces.values():
        doc = own[0]["doc_id"]
        seen.append(doc)
        matching = [t for d, t in texts if d == doc]
        wanted = [
            np.append(np.array(tokenizer.encode(t or "", add_special_tokens=False).ids, np.uint32), np.uint32(1)) for t in matching
        ]
        ids = next(x for x in wanted if len(x) == own[0]["doc_tokens"])
        at = 0
        for r in sorted(own, key=lambda r: r["start"]):
            assert r["start"] == at
            assert r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].astype("<u4").tobytes())
            at += r["length"]
        assert at == len(ids)
    assert sorted(seen, key=repr) == sorted((d for d, _ in texts), key=repr)
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= window and (at == window or at & (at - 1) == 0)


@pytest.mark.parametrize("window, spaces", [(2048, 16), (64, 2), (8, 1)])
def test_every_id_is_in_one_piece_and_windows_are_full(spark, window, spaces):
    rng = random.Random(window)
    texts = [prose(k, rng.choice([0, 1, 5, 40, 300])) for k in range(60)]
    docs = frame(spark, texts).repartition(5)
    check(packing.packed(docs, PATH, window, spaces).collect(), list(enumerate(texts)), window)


def test_odd_rows(spark):
    texts = [(r["doc_id"], r["text"]) for r in odd(spark).collect()]
    check(packing.packed(odd(spark), PATH, 128).collect(), texts, 128)
    assert packing.packed(empty(spark), PATH).count() == 0
