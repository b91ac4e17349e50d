"""What the Python workers keep between batches and tasks: little, and without an effect on the results."""

import random

import numpy as np
import pandas as pd
import pytest

from perron.llm import classifier, pack
from perron.llm.queries import tokenizer_path

MARKS = ["", ",", ".", "...", "?!", "'s", ")", "\t", "\u00a0", "<|endoftext|>"]


def words(n: int, seed: int) -> list[str]:
    r = random.Random(seed)
    return ["".join(r.choice("abcdeAB01é") for _ in range(r.randint(1, 9))) + r.choice(MARKS) for _ in range(n)]


@pytest.fixture(scope="module")
def encoder():
    return pack.Encoder(tokenizer_path())


class Counting:
    """A tokenizer that counts the texts it gets."""

    def __init__(self, tok):
        self.tok, self.texts = tok, 0

    def encode_batch_fast(self, texts, **options):
        self.texts += len(texts)
        return self.tok.encode_batch_fast(texts, **options)


def test_new_chunks_are_encoded_together():
    e = pack.Encoder(tokenizer_path())
    e.tok, e.words = Counting(e.tok), Counting(e.words)
    e([" ".join(f"w{i}q{i * 7919 % 1009}" for i in range(1500)).encode(), " ".join(words(1500, 1)).encode()])
    assert e.tok.texts + e.words.texts < 60


def test_encoder_gives_the_tokenizers_ids(encoder, monkeypatch):
    monkeypatch.setattr(pack, "REMEMBERED", 500)
    monkeypatch.setattr(pack, "JOINED", 7)
    r = random.Random(5)
    known = words(400, 6)
    texts = ["", " ", "\n", "a\nb", "\n\n x", "x \n", "a\0b c", "  two  spaces "]
    texts += ["".join(r.choice(known) + r.choice([" ", " ", "\n", "  ", " \n"]) for _ in range(40)) for _ in range(300)]
    texts += [" ".join(words(200, 10 + i)) for i in range(20)]
    for i in range(0, len(texts), 16):
        some = texts[i : i + 16]
        want = [np.array(e.ids, "<u4").tobytes() for e in encoder.tok.encode_batch(some, add_special_tokens=False)]
        assert encoder([t.encode() for t in some]) == want


def test_classifier_forgets_its_words_after_a_task():
    r = np.random.default_rng(3)
    z = r.normal(size=(40, 8)).astype(np.float32)
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    model = {"idf": np.ones(classifier.SPACE, np.float32), "proj": r.normal(size=(classifier.SPACE, 8)).astype(np.float32), "z": z, "y": (np.arange(40) % 2).astype(np.float32)}
    texts = [" ".join(words(60, i)).encode() for i in range(300)]
    got = list(classifier.score_batches(iter([pd.Series(texts[:200]), pd.Series(texts[200:])]), model))
    assert classifier._known == [{}, {}]
    assert np.allclose(np.concatenate(got), [classifier.score_texts([t], model)[0] for t in texts], atol=1e-3)
    # the vectors of a block are three arrays at once
    assert 3 * classifier.BLOCK * classifier.SPACE * 4 < 16 << 20


def test_few_calls_for_many_chunks_and_the_same_ids():
    """Some thousand new chunks take a handful of calls, and a forgotten, an odd and a split chunk give the tokenizer's ids."""
    texts = [" ".join(f"{a}{b}{c}x" for a in "abcdefghij" for b in "klmnopqrst" for c in "uvwxyzabcdefghi") + " ab, ab. ,a \tc,", " a b,\n\nb, é? 1!  x", ""]
    e = pack.Encoder(tokenizer_path())
    plain = e._plain(texts)
    e.words = Counting(e.words)
    assert e([t.encode() for t in texts]) == plain and e.words.texts <= 3
    e.old, e.young = e.young, {}
    assert e([t.encode() for t in texts]) == plain and e.words.texts <= 3
