"""A part left alone with a gap is packed again; encoding with the shortcuts gives the tokenizer's own ids."""

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tagwright.llm import packing

WORDS = public_tokenizers.path("word_bpe_49k.json")


def test_repacking_saves_bins_and_keeps_every_item():
    rng = np.random.default_rng(2)
    saved = 0
    for _ in range(6):
        lengths = rng.integers(900, 2400, 400)
        before = packing.best_fit(lengths)
        after = packing.repacked(lengths, before)
        assert np.bincount(after, lengths).max() <= 4096
        assert sorted(set(after)) == list(range(after.max() + 1))
        assert packing.lower_bound(lengths) <= after.max() + 1 <= before.max() + 1
        assert (packing.repacked(lengths, before) == after).all()
        saved += before.max() - after.max()
    assert saved > 0


def test_one_part_reports_its_gap(spark, docs_of):
    rng = np.random.default_rng(4)
    docs = docs_of([(i, "ab " * int(n), "a") for i, n in enumerate(rng.integers(900, 2400, 60))])
    rows = packing.pack(docs, WORDS).collect()
    count = len({r.sequence_id for r in rows})
    bound = packing.lower_bound(np.array([r.length for r in rows]))
    assert count == bound or not any(r.certified for r in rows)


MODEL = Tokenizer.from_file(WORDS)
ENCODE = packing.encoder(WORDS)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("abzAZéÉßñ09'.,-!<|>́  \n\t😀ſK"), max_size=12), max_size=4))
def test_encoding_equals_the_tokenizer(texts):
    for text, coded in zip(texts, ENCODE([t.encode() for t in texts])):
        ids = np.frombuffer(coded, "<u4").tolist()
        assert ids == [*MODEL.encode(text, add_special_tokens=False).ids, 1]


def test_small_latin_letters_and_case_need_no_normalizer(monkeypatch):
    """Words of small letters, accented or not, go by the tokenizer without normalizer, each once whatever its case."""
    by_whole = []

    class Counted:
        from_file = staticmethod(lambda path: Counted(Tokenizer.from_file(path)))

        def __init__(self, inner):
            object.__setattr__(self, "inner", inner)

        def __setattr__(self, name, value):
            setattr(self.inner, name, value)

        def encode_batch_fast(self, words, **how):
            if "Lowercase" in str(self.inner.normalizer):
                by_whole.extend(words)
            return self.inner.encode_batch_fast(words, **how)

    monkeypatch.setattr("tokenizers.Tokenizer", Counted)
    latin = "".join(map(chr, range(0xC0, 0x100)))
    texts = [f"{latin.lower()} qu\u00e9os qu\u00e9os, QUeos queos i\u0307 \u00aa \u00f7 \u00d7 a\u0301", "It's <|ENDOFTEXT|> IT'S <|endoftext|>"]
    texts += [f"a{c}b B{c}" for c in latin]
    for text, coded in zip(texts, packing.encoder(WORDS)([t.encode() for t in texts])):
        assert np.frombuffer(coded, "<u4").tolist() == [*MODEL.encode(text, add_special_tokens=False).ids, 1]
    assert "qu\u00e9os" not in by_whole and "queos" not in by_whole and "\u00f7" in by_whole


def test_small_words_share_calls_of_the_tokenizer(monkeypatch):
    """Ten thousand new words go to the tokenizer in a few texts, and are kept in a few dozen bytes each."""
    given_, stores = [], []

    class Counted:
        from_file = staticmethod(lambda path: Counted(Tokenizer.from_file(path)))

        def __init__(self, inner):
            object.__setattr__(self, "inner", inner)

        def __setattr__(self, name, value):
            setattr(self.inner, name, value)

        def encode_batch_fast(self, texts, **how):
            given_.extend(texts)
            return self.inner.encode_batch_fast(texts, **how)

    class Kept(packing._Known):
        def __init__(self, *args):
            super().__init__(*args)
            stores.append(self)

    monkeypatch.setattr("tokenizers.Tokenizer", Counted)
    monkeypatch.setattr(packing, "_Known", Kept)
    rng = np.random.default_rng(3)
    words = sorted({"".join(map(chr, w)) for w in rng.integers(97, 123, (10_000, 9))})
    text = " ".join(f"{w}{m}" for w, m in zip(words, ["", ",", ".", "\u00e9", "\u00fc!"] * 2000))
    coded = packing.encoder(WORDS)([text.encode()])[0]
    assert np.frombuffer(coded, "<u4").tolist() == [*MODEL.encode(text, add_special_tokens=False).ids, 1]
    assert len(given_) < 100
    kept = stores[0]
    assert kept.words.nbytes + kept.ids.nbytes + kept.ends.nbytes + kept.met.nbytes < 70 * len(kept.words)


def test_words_forgotten_and_met_again_have_the_same_ids(monkeypatch):
    monkeypatch.setattr(packing, "KNOWN_WORDS", 12)
    monkeypatch.setattr(packing, "CHUNK", 40)
    rng = np.random.default_rng(5)
    some = ["the", "The,", "a", "", "qu\u00e9", "it's", "<|endoftext|>", "x<|", "\u6f22", "7up", "end.", "\n", "\u0130", *"bcdefghij"]
    texts = [" ".join(rng.choice(some, 9)) for _ in range(200)] + ["", " \t", "word " * 50]
    for text, coded in zip(texts, packing.encoder(WORDS)([t.encode() for t in texts]), strict=True):
        assert np.frombuffer(coded, "<u4").tolist() == [*MODEL.encode(text, add_special_tokens=False).ids, 1]
