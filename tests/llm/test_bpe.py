"""Tree concatenation against the tokenizer on whole texts, and back again."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from awkward import AWKWARD, docs
from tokenizers import Tokenizer

from quarry.llm import bpe
from quarry.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")
TOK = Tokenizer.from_file(PATH)
ATOMS = ["a", "b", "é", "ß", "中", "😀", " ", "  ", "\n", "\t", "'s", "'re", "'", "l", "1", "23", "!", "...", "<|endoftext|>", "<|end",
         "oftext|>", "the", " hello", " world", "aaaaaaaaaa", " ", "　", "\r\n", "x" * 50, "0" * 30, "-" * 40, " " * 30, "é", "\x00"]


def whole(text: str) -> list[int]:
    return TOK.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def encoder():
    with open(PATH, "rb") as f:
        return bpe.Encoder(f.read())


def test_every_character(encoder):
    """Whole texts of every code point in several company, against the tokenizer; most go through the faster library."""
    fast = 0
    for first in [*range(0, 0xD800, 0x800), *range(0xE000, 0x20000, 0x800), 0x2F800, 0xE0000]:
        encoder.ids("".join(map(chr, range(first, first + 0x800))))
        for alike in (True, False):
            chars = [chr(c) for c in range(first, first + 0x800) if (chr(c) in encoder.alike) == alike]
            fast += alike * len(chars)
            for text in ("".join(f"{c}{c} " for c in chars), " ".join(chars), "".join(f"a{c}1 !{c}!{c}'s\n{c}" for c in chars)):
                assert encoder.ids(text).tolist() == whole(text), hex(first)
    assert fast > 50_000


def test_every_token_is_its_own_encoding(encoder):
    """What the agreement of both libraries rests on: a token's text is that token, for either of them."""
    byte = {c: b for b, c in enumerate(bpe.byte_alphabet())}
    for mapped, i in TOK.get_vocab().items():
        if mapped not in encoder.added:
            assert encoder._word_ids(mapped) == (i,) and encoder.fast._encode_single_piece(bytes(byte[c] for c in mapped)) == [i]


def test_whole_texts(encoder):
    rnd = random.Random(9)
    for _ in range(1500):
        text = "".join(rnd.choice(ATOMS) for _ in range(rnd.randrange(60)))
        text += "".join(rnd.choice("aeinrst  ,.ABC'19\n") for _ in range(rnd.randrange(200)))
        assert encoder.ids(text).tolist() == whole(text)


def test_decoding_any_ids():
    """Also ids whose bytes are no text, on their own or side by side with other texts, and ids that there are none of."""
    with open(PATH, "rb") as f:
        decoder = bpe.Decoder(f.read())
    rnd = random.Random(8)
    for top in (50_300, 256, 50_257):
        for _ in range(300):
            texts = [[rnd.randrange(top) for _ in range(rnd.randrange(8))] for _ in range(rnd.randrange(6))]
            texts += [whole(rnd.choice(["é", "中文", "a b"])) for _ in range(3)]
            ends = np.cumsum([0, *map(len, texts)])
            got = decoder.texts(np.array([i for t in texts for i in t], dtype=np.int32), ends).to_pylist()
            assert got == [TOK.decode(t, skip_special_tokens=False) for t in texts]
    cut = whole("中")
    assert decoder.texts(np.array(cut), np.array([0, 1, len(cut)])).to_pylist() == [TOK.decode(cut[:1]), TOK.decode(cut[1:])]


def by_tree(enc, text, n, window):
    cuts = [len(text) * i // n for i in range(n + 1)]
    parts = [enc.encode(text[a:b]) for a, b in zip(cuts, cuts[1:])]
    while len(parts) > 1:
        parts = [enc.join(*parts[i:i + 2], window=window) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
    return parts[0]


@pytest.mark.parametrize("unsplit", [0, 4, bpe.UNSPLIT])
def test_any_cut(encoder, monkeypatch, unsplit):
    monkeypatch.setattr(bpe, "UNSPLIT", unsplit)
    rnd = random.Random(unsplit)
    for _ in range(1500):
        text = "".join(rnd.choice(ATOMS) for _ in range(rnd.randrange(40)))
        made = by_tree(encoder, text, rnd.randrange(1, 9), rnd.choice([1, 2, 8, 64]))
        assert made.ids == whole(text) and made.text == text
        assert sum(made.lengths) == len(text) and sum(made.counts) == len(made.ids)


@pytest.mark.parametrize("run", ["a", "ab", "the", "中文字", "0123456789", "=-", " ", "\n", "<|endoftext|>", "'s", " a"])
def test_long_unsplit(encoder, run):
    text = run * (40_000 // len(run))
    assert by_tree(encoder, text, 8, bpe.WINDOW).ids == whole(text)


def test_windows_stay_small(encoder, monkeypatch):
    """Random letters agree after a few tokens: a join does not encode the run again."""
    rnd = random.Random(1)
    text = "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(200_000))
    left, right = encoder.encode(text[:100_000]), encoder.encode(text[100_000:])
    seen = []
    plain = encoder._word_ids
    monkeypatch.setattr(encoder, "_word_ids", lambda w: seen.append(len(w)) or plain(w))
    assert encoder.join(left, right).ids == whole(text)
    assert sum(seen) < 2_000


def query_on(spark, tmp_path, df):
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op12_bpe"](spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    return sorted((tuple(r) for r in got.collect()), key=str)


def want(rows):
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    out = []
    for i, text in rows:
        ids = whole(text)
        out.append((i, len(ids), sha(",".join(map(str, ids))), sha(TOK.decode(ids, skip_special_tokens=False))))
    return sorted(out, key=str)


def test_documents(spark, tmp_path):
    rnd = random.Random(2)
    rows = AWKWARD + [(20, "x" * 300_000), (20, "x" * 300_000), (21, "ab<|endoftext|>" * 20_000), (22, " " * 70_000 + "é"),
                      (23, "".join(rnd.choice(ATOMS) for _ in range(60_000))), (24, "<|endoftext|>"), (25, "中" * bpe.LONG + "!")]
    assert query_on(spark, tmp_path, docs(spark, rows)) == want(rows)


def test_empty(spark, tmp_path):
    assert query_on(spark, tmp_path, docs(spark, [])) == []


def test_general_interface(spark):
    """Small parts, other columns with the operator's own names, ids that decode to the text."""
    rows = [(i, "".join(random.Random(i).choice(ATOMS) for _ in range(i * 3)), "c") for i in range(40)] + [(99, None, None)]
    df = spark.createDataFrame(rows, "ids long, `the.text` string, r string").repartition(4)
    vocab = bpe.vocabulary(spark, PATH)
    made = bpe.encode(df, "the.text", vocab, "tokens", long=20, piece=9)
    assert made.columns == ["ids", "r", "tokens"]
    assert {r.ids: (r.r, r.tokens) for r in made.collect()} == {i: (r, whole(t)) for i, t, r in rows}
    back = bpe.decode(made, "tokens", vocab, "part")
    assert {r.ids: r.part for r in back.collect()} == {i: t or "" for i, t, _ in rows}


def test_rejects_added_tokens_with_options():
    with open(PATH) as f:
        data = f.read().replace('"lstrip":false', '"lstrip":true').replace('"lstrip": false', '"lstrip": true')
    with pytest.raises(ValueError):
        bpe.Encoder(data.encode())
