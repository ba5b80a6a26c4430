"""Encoder, token counts and packing against the library itself."""
import random
import zlib

import numpy as np
import public_tokenizers
import pytest

from ledgerloom.llm import packing, token_counts, tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")
PARTS = [" "] * 6 + ["\n"] * 3 + ["\t", "\r", "\x0b", "\x1c", "\x85", "\xa0", " ", "　", "a", "the", "The",
                                  "ing", "'s", "'ll", "9", "42", "é", "ß", "漢", "🙂", "́", ".", ",", "!", "_",
                                  "<|endoftext|>", "<", "|", "ʰ", "ɐ", "ﬁ", "٣", "Ⅷ", "²", "\0", "क"]


def library(text):
    return tokens.load(PATH).encode(text, add_special_tokens=False).ids


def texts(n, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 14))) for _ in range(n)]


def test_every_whole_token_encodes_alone():
    whole = tokens.whole_tokens(PATH)
    tok = tokens.load(PATH)
    text = [(w, i) for w, i in whole.items() if _text(w) is not None]
    got = tok.encode_batch([_text(w) for w, _ in text], add_special_tokens=False)
    alone = sum(e.ids == [i] for e, (_, i) in zip(got, text, strict=True))
    assert len(whole) > 50_000 and alone > 0.99 * len(text)      # the rest never is a pre-token by itself


def _text(raw):
    try:
        return raw.decode()
    except UnicodeDecodeError:
        return None


def test_pieces_equal_the_library():
    e = tokens.encoder(PATH, tokens.whole_tokens(PATH), 4)
    fast = 0
    for t in texts(20_000):
        assert np.frombuffer(e.packed(t), "<u4").tolist() == library(t), repr(t)
        fast += e.by_pieces(t)
    assert fast > 5_000


def test_library_merges_without_rank_file(monkeypatch):
    import builtins
    real = builtins.__import__
    monkeypatch.setattr(builtins, "__import__",
                        lambda name, *a, **k: (_ for _ in ()).throw(ImportError()) if name == "tiktoken" else real(name, *a, **k))
    p = tokens.Pieces(PATH, tokens.whole_tokens(PATH), list)
    for w in (" thation", "ére", " 漢字", "xyzzyx"):
        assert p.ids(w) == library(w)


def test_counts(odd, odd_rows, none):
    got = sorted((r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.count_tokens(odd, PATH).collect())
    want = sorted((len((t or "").encode()), len(library(t or "")), len(library(t or "")) > 512)
                  for _, t, *_ in odd_rows)
    assert got == want
    assert token_counts.count_tokens(none, PATH).collect() == []


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "piece_bpe_32k.model"])
def test_other_tokenizers(spark, odd, odd_rows, name):
    path = public_tokenizers.path(name)
    if name.endswith(".model"):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        count = lambda t: len(sp.encode(t))
    else:
        count = lambda t: len(tokens.load(path).encode(t, add_special_tokens=False).ids)
    got = sorted(r.n_tokens for r in token_counts.count_tokens(odd, path).collect())
    assert got == sorted(count(t or "") for _, t, *_ in odd_rows)


@pytest.mark.parametrize("window", [16, 2048])
def test_packing_round_trip(odd, odd_rows, window):
    rows = packing.pack(odd, PATH, window=window, with_ids=True).collect()
    rows.sort(key=lambda r: (r.sequence_id, r.offset))
    place = 0
    for r in rows:                                               # gapless, in windows
        assert r.sequence_id * window + r.offset == place and r.offset + r.length <= window
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) and r.length == len(r.ids) > 0
        place += r.length
    assert [r.pad for r in rows[:-1]] == [0] * (len(rows) - 1) and rows[-1].pad == -place % window
    docs, own = [], []
    for r in rows:                                               # documents come back whole
        assert r.start == len(own)
        own += r.ids
        if len(own) == r.doc_tokens:
            docs.append((r.doc_id, tuple(own)))
            own = []
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    assert not own and sorted(docs, key=key) == sorted(
        ((i, (*library(t or ""), 1)) for i, t, *_ in odd_rows), key=key)


def test_packing_nothing(none):
    assert packing.pack(none, PATH).collect() == []
