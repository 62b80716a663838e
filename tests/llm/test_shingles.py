import random

import numpy as np
import pytest

from clinflow.llm.shingles import PartEnum, shingle_set, sketch


def sketch_counts(s):
    return np.frombuffer(sketch(s), "<u2").astype(int)


@pytest.mark.parametrize("percent", [80, 90])
@pytest.mark.parametrize("size", [1, 2, 5, 9, 10, 11, 19, 40, 100, 333, 1000])
def test_similar_sets_share_a_signature(percent, size):
    """Pairs as far apart as similarity allows, of equal and of different sizes."""
    rng = np.random.default_rng(size)
    method = PartEnum(percent)
    for _ in range(40):
        pool = np.unique(rng.integers(0, 2**63, 3 * size, dtype=np.uint64))
        common = pool[:size]
        rest = pool[size:]
        most = (100 * size) // percent - size  # more members in the union than in common
        extra = int(rng.integers(0, most + 1))
        cut = int(rng.integers(0, extra + 1))
        a = np.sort(np.concatenate((common, rest[:cut])))
        b = np.sort(np.concatenate((common, rest[cut:extra])))
        assert method.alike(size, len(a), len(b))
        assert set(method.signatures(a).tolist()) & set(method.signatures(b).tolist())
        assert np.abs(sketch_counts(a) - sketch_counts(b)).sum() <= method.most_apart(len(a), len(b))


def test_few_signatures_are_shared_by_chance():
    rng = np.random.default_rng(0)
    method = PartEnum(90)
    sets = [np.unique(rng.integers(0, 2**63, 200, dtype=np.uint64)) for _ in range(50)]
    seen = [s for x in sets for s in set(method.signatures(x).tolist())]
    assert len(seen) - len(set(seen)) < 5


def test_shingles_of_short_and_folded_texts():
    assert len(shingle_set(None)) == len(shingle_set(" \n")) == 0
    assert len(shingle_set("a")) == len(shingle_set("a b")) == len(shingle_set("a b c")) == 1
    assert (shingle_set("A B\tc") == shingle_set("a  b C")).all()
    assert shingle_set("É a b")[0] != shingle_set("é a b")[0]
    assert shingle_set("a b")[0] != shingle_set("a b b")[0]
    rng = random.Random(1)
    words = [rng.choice("abcd") for _ in range(300)]
    assert len(shingle_set(" ".join(words))) == len(set(zip(words, words[1:], words[2:])))
