"""Decontamination of copies with one word changed, by the place of the word and the size of the item."""

import random

import numpy as np
import pytest

from quaystone.llm import decontaminate
from quaystone.llm.edit import distances


@pytest.mark.parametrize("least, most", [(81, 105), (150, 195), (240, 312)])
def test_a_word_replaced_at_any_place(least, most):
    rng = random.Random(least)
    word = lambda n: "".join(rng.choice("aeioudnrstlmk") for _ in range(n))
    items = []
    while len(items) < 60:
        text = " ".join(word(rng.randint(2, 8)) for _ in range(most // 5))[:rng.randint(least, most)].strip()
        if len(text) >= least:
            items.append((str(len(items)), text))
    index = decontaminate.Index(items)
    found = {}
    for name, text in items:
        words, limit = text.split(" "), decontaminate.limit_of(len(text))
        for k in (0, 1, 2, 3, len(words) // 2, len(words) - 1):
            other = words[:k] + [word(min(len(words[k]), limit)) + words[k][limit:]] + words[k + 1:]
            body = " ".join([word(5), word(4), *other, word(6)])
            data = np.frombuffer(body.encode(), np.uint8)
            assert min(distances(text, " ".join(other))) <= limit
            hits = index.hits(data, np.array([0, len(data)]))
            assert all(h[4] <= limit for h in hits)
            found.setdefault(k if k < len(words) - 1 else -1, []).append(any(h[1] == name and h[2] == 11 for h in hits))
    print(least, {k: round(np.mean(v), 3) for k, v in sorted(found.items())}, [len(c.walks) for c in index.classes])
    assert all(np.mean(v) >= 0.95 for v in found.values() if len(v) >= 20)
