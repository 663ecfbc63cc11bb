"""op6: repeats count; a short passage in another language does not decide."""

import random

from vidgraph.llm import language


def test_long_text_with_a_foreign_passage():
    rng = random.Random(7)

    def vocabulary(letters):
        return ["".join(rng.choices(letters, k=rng.randint(3, 9))) for _ in range(400)]

    words = {"aa": vocabulary("abcdefghij"), "zz": vocabulary("qrstuvwxyz")}
    model = language.Classifier({k: " ".join(rng.choices(ws, k=20_000)).encode() for k, ws in words.items()})
    for one, other in (("aa", "zz"), ("zz", "aa")):
        text = " ".join(rng.choices(words[one][:150], k=2000)) + " " + " ".join(rng.sample(words[other], 200))
        assert model.predict(text)[0] == one
        sizes = [model.sizes(" ".join(rng.choices(words[one], k=n))) for n in (500, 5000)]
        gain = [abs(a - b) for a, b in sizes]
        assert gain[1] > 5 * gain[0]  # every repeat weighs, not each word once
