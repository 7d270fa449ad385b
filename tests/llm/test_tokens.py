import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from terroir.llm.tokens import Encoder, default_tokenizer

ENC = Encoder(default_tokenizer())
PIECES = ["<|endoftext|>", "<|EndOfText|>", "it's", "I'M", "é", "İ", ".", ",'s", "!?", " ", "\n", " ", " ", "\x1c",
          "Thble", "öß", "ÀÉ", "123", "a.b", "日本", "'re", "x̸", "≠", ";", "K", "Σ", "ſ", "\x00"]


def check(texts):
    ids, off = ENC.encode(pa.array(texts, pa.string()))
    want = [e.ids for e in ENC.tok.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert [ids[a:b].tolist() for a, b in zip(off, off[1:])] == want


def test_edges():
    check([None, "", " ", "\n\n", "a", "A" * 200, " lead and trail ", *PIECES, "word " * 5000])
    ids, off = ENC.encode(pa.array([], pa.string()))
    assert len(ids) == 0 and off.tolist() == [0]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=30), st.lists(st.sampled_from(PIECES), max_size=12).map("".join)), max_size=6))
def test_equals_library(texts):
    check(texts)


def test_forgets_rare_chunks(monkeypatch):
    monkeypatch.setattr("terroir.llm.tokens.CACHE_CHUNKS", 50)
    enc = Encoder(default_tokenizer())
    for k in range(6):
        texts = ["common words stay here", " ".join(f"w{k}x{j}" for j in range(40))]
        ids, off = enc.encode(pa.array(texts))
        assert [ids[a:b].tolist() for a, b in zip(off, off[1:])] == [
            e.ids for e in enc.tok.encode_batch(texts, add_special_tokens=False)]
    assert "common" in enc.at and len(enc.at) < 130
    assert isinstance(ids, np.ndarray)


def test_chunks_in_one_call_are_as_alone():
    e = Encoder(default_tokenizer())
    assert e.mark is not None
    chunks = ["plain", "̸x", "é", "e", "́", "日本", "a" * 300, "12", "it's", "'s", "|>", "\x00", "‍", "ſ", "İ"] * 80
    ids, n = e.chunk_ids(chunks)
    alone = e.library(chunks)
    assert n.tolist() == [len(x) for x in alone] and ids.tolist() == [i for x in alone for i in x]
    odd = [*chunks, "<|endoftext|>", "<", "a<|startoftext|>b"]
    ids, n = e.chunk_ids(odd)
    assert ids.tolist() == [i for x in e.library(odd) for i in x] and len(n) == len(odd)


def test_a_resting_encoder_keeps_few_chunks(monkeypatch):
    """Workers live on after a task: the chunks most asked for stay, the ids are the same afterwards."""
    from terroir.llm import tokens
    monkeypatch.setattr(tokens, "RESTING_CHUNKS", 50)
    enc = Encoder(default_tokenizer())
    rare, often = " ".join(f"rare{k}x" for k in range(900)), " ".join(f"often{k}" for k in range(40))
    want = enc.encode(pa.array([rare, often]))[0].tolist()
    for _ in range(3):
        enc.encode(pa.array([often]))
    assert len(enc.at) > 900
    enc.rest()
    assert set(enc.at) == set(often.split()) and len(enc.flat) < 1000
    assert enc.encode(pa.array([rare, often]))[0].tolist() == want
    for _ in range(2):  # all of them more than once: too many to keep
        enc.encode(pa.array([rare]))
    enc.rest()
    assert len(enc.at) <= 50
