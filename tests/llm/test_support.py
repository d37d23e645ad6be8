"""What a worker remembers."""

import gc

import numpy as np
import pytest

from predial.llm import quality, support


@pytest.fixture(autouse=True)
def nothing_held():
    support.give_back()
    yield
    support.give_back()


def test_a_memory_stays_for_its_owner():
    first = support.remembered("a", dict)
    first["x"] = 1
    support.forget_others("a")
    assert support.remembered("a", dict) is first


def test_another_owner_clears_it():
    support.remembered("a", dict)["x"] = 1
    assert support.remembered("b", list) == []
    assert list(support._held) == ["b"]
    support.forget_others("c")
    assert not support._held


def test_collector_threshold_goes_back():
    gc.set_threshold(1_000_000, 50, 50)
    support.give_back()
    assert gc.get_threshold() == support.COLLECTS_AFTER


def test_examples_are_compact_and_exact():
    text = " ".join(["word"] * 70_000 + ["other", "Words"])
    at, count, size = quality.example(quality.Words(), text)
    kinds, sizes = quality.cells(quality.Words(), [text])
    want, times = np.unique(np.concatenate([c for _, c in kinds]), return_counts=True)
    assert at.tolist() == want.tolist() and count.tolist() == times.tolist() and size == sizes[0]
    short = quality.example(quality.Words(), "a few words")
    assert short[0].itemsize == 4 and short[1].itemsize == 1
    assert [len(x) for x in quality.example(quality.Words(), "")[:2]] == [0, 0]


@pytest.mark.parametrize("portion", [1, 30, 1 << 20])
def test_scores_do_not_depend_on_portions(monkeypatch, portion):
    monkeypatch.setattr(quality, "PORTION", portion)
    weights = np.random.default_rng(5).normal(size=quality.BUCKETS + 1)
    texts = ["", "one", "two words", "", "many more words in this one " * 9, "the end"]
    words = quality.Words()
    together = quality.score_texts(words, weights, texts)
    alone = [quality.score_texts(words, weights, [t])[0] for t in texts]
    assert together.tolist() == alone
    assert quality.score_texts(words, weights, []).shape == (0,)
