import random
import unicodedata

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from fareloom.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", " ", "\x00\x1c\x1f\x85\xa0 　x", "Hello  World's 123 <|endoftext|>x don't É ẞ İ ab​c ΑΣ 'S 'll'",
       "ΣΑΣ. ΟΔΥΣΣΕΥΣ", "é ﬁ ǅ ²½ ⅷ 中文 😀😀!!", "<|startoftext|><|startoftext|>", "<|StartOfText|>", "aaaaaaaaaaa" * 3,
       "!" * 3000, "ab" * 4000, "zq" * 129, "각", "ą́ Å Ω"]


@pytest.fixture()
def frame(spark):
    """A frame of documents from (doc_id, text) pairs."""
    return lambda rows, schema="doc_id long, text string": spark.createDataFrame(rows, schema)


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


@pytest.fixture(scope="module")
def model():
    return bpe.Model(open(PATH, encoding="utf-8").read())


def ids(raw):
    return np.frombuffer(raw, "<u4").tolist()


def test_odd_texts(library, model):
    for text in ODD:
        want = library.encode(text, add_special_tokens=False).ids
        found = model.encode([text.encode()], {})[0]
        assert ids(found) == want, text
        assert model.decode(found) == library.decode(want, skip_special_tokens=False)


def test_random_texts(library, model):
    rng = random.Random(3)
    parts = [t.replace("</w>", " ") for t in rng.sample(sorted(library.get_vocab()), 3000)]
    letters = "abcdefghijklmnopqrstuvwxyz'.!,-éüßñ 0123456789"
    texts = ["".join(rng.choices(parts, k=40)) for _ in range(200)]
    texts += ["".join(rng.choices(letters, k=300)) for _ in range(200)]
    wide = [c for c in map(chr, [*range(32, 0x700), *range(0x3000, 0x3200)]) if unicodedata.category(c) != "Cn"]
    texts += ["".join(rng.choices(wide, k=100)) for _ in range(200)]
    found = model.encode([t.encode() for t in texts], {})
    for text, raw in zip(texts, found):
        assert ids(raw) == library.encode(text, add_special_tokens=False).ids, text


def test_both_paths_agree_and_both_are_taken(model, monkeypatch):
    rng = random.Random(4)
    words = ["".join(rng.choices("aeinorst", k=rng.randint(1, 40))).encode() for _ in range(500)]
    exact = model._merge_all
    seen = []
    monkeypatch.setattr(model, "_merge_all", lambda t, s: seen.append(len(s) - 1) or exact(t, s))
    found = model.encode_words(words)
    assert 0 < seen[0] < len(words)
    monkeypatch.setattr(bpe, "LONG_WORD", 0)
    assert model.encode_words(words) == found


def test_the_table_of_known_words_is_bounded(model, monkeypatch):
    monkeypatch.setattr(bpe, "KNOWN_WORDS", 10)
    known = {}
    fresh = [model.encode([f"w{chr(97 + i)} same <|endoftext|>".encode()], known)[0] for i in range(20)]
    assert len(known) <= 10 + 5
    assert fresh == [model.encode([f"w{chr(97 + i)} same <|endoftext|>".encode()], {})[0] for i in range(20)]


def test_frames(spark, frame, library):
    rows = [(1, "Some text, here."), (1, "Some text, here."), (None, None), (2, ""), (3, "long " * 50_000)]
    docs = frame([(i, t, "x", 1.0) for i, t in rows], "doc_id long, text string, ids string, n_tokens double")
    got = sorted(((r.doc_id or 0), ids(r.ids), r.n_tokens, r.decoded) for r in bpe.encode(docs, PATH, decoded=True).collect())
    want = []
    for i, t in rows:
        e = library.encode(t or "", add_special_tokens=False).ids
        want.append((i or 0, e, len(e), library.decode(e, skip_special_tokens=False)))
    assert got == sorted(want)
    assert bpe.encode(frame([]), PATH).collect() == []


def test_other_kinds_of_files_are_refused(spark):
    with pytest.raises(ValueError):
        bpe.load(spark, public_tokenizers.path("byte_bpe_50k.json"))
