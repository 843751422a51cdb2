"""p8: ids equal those of the public libraries."""

import base64
from pathlib import Path

import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from folioloom.llm import tokenizer as K

FILE = f"{K.TOKENIZERS}/{K.VOCABULARY}.tiktoken"
pytestmark = pytest.mark.skipif(not Path(FILE).exists(), reason="no vocabulary here")
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@pytest.fixture(scope="module")
def public():
    with open(FILE, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def own():
    return K.Encoder(FILE)


TEXTS = ["Hello world", "", "<|endoftext|> is text", "古井 灯火，书信。", "a" * 3000, "的" * 700, " \n\t \r\n x", "½ № é é 👩‍🚀 \x85 　", "don't we'll I'M", "שלום ไทย"]


def test_texts(public, own):
    flat, offsets = own.encode(TEXTS)
    assert [flat[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == [public.encode_ordinary(t) for t in TEXTS]


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=120))
def test_any_text(public, own, text):
    text = text.encode("utf-8", "ignore").decode()
    if any(c in text for c in "\x1c\x1d\x1e\x1f"):
        return
    flat, _ = own.encode([text])
    assert flat.tolist() == public.encode_ordinary(text)


def test_round_trip(public, own):
    flat, _ = own.encode(["The river — went on.\n\nAnd on ﬁne."])
    assert public.decode(flat.tolist()) == "The river — went on.\n\nAnd on ﬁne."


def test_table(spark, public):
    df = spark.createDataFrame([(1, "a b", "x"), (1, "a b", "x"), (2, None, None), (3, "", None), (4, "word " * 100_000, None)], "doc_id long, text string, ids string")
    got = {r.doc_id: r.ids for r in K.encode_documents(df).collect()}
    assert got[1] == public.encode_ordinary("a b") and got[2] == [] and got[3] == [] and got[4] == public.encode_ordinary("word " * 100_000)
    assert K.encode_documents(df).count() == 4
    assert K.encode_documents(df.limit(0)).count() == 0
    assert {r.doc_id: r.n_tokens for r in K.count_tokens(df).collect()}[2] == 0


def test_pair_table():
    pairs = {(i, i * 7 % 50): i for i in range(200)}
    table = K.PairTable(pairs)
    import numpy as np

    left, right = (np.array([p[k] for p in pairs], np.int32)[None, :] for k in (0, 1))
    assert table.look_up(left, right).ravel().tolist() == list(pairs.values())
    assert table.look_up(left, right + 60).ravel().tolist() == [K._NONE] * 200


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="abething Tx", min_size=300, max_size=1500).map(lambda t: t.replace(" ", "")), st.integers(1, 9))
def test_long_pieces(public, own, text, times):
    text = text[: 40 * times] * (8 // times + 1)
    flat, _ = own.encode([text])
    assert flat.tolist() == public.encode_ordinary(text)


@pytest.mark.parametrize("text", ["a" * 100_000, "ab" * 50_000, "的" * 30_000, "theabsolutelyinevitable" * 4000, "=-" * 999 + "=" * 5000])
def test_very_long_pieces(public, own, text):
    flat, _ = own.encode([text])
    assert flat.tolist() == public.encode_ordinary(text)


def test_kept_pieces_survive_growth(public):
    own = K.Encoder(FILE)
    texts = [f"piece{i} other{i * 7} x{i % 13}" for i in range(30_000)]
    for start in range(0, len(texts), 5000):
        flat, offsets = own.encode(texts[start : start + 5000])
    assert [flat[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == [public.encode_ordinary(t) for t in texts[-5000:]]
