"""Language ID of long texts without blanks."""

from __future__ import annotations

import random

from roomgrid.llm import language as L


def test_unbroken_text_is_read_whole():
    rng = random.Random(5)
    run = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    texts = [(" ".join(run(letters, rng.randint(2, 9)) for _ in range(60)), lang) for lang, letters in (("a", "abcdefg"), ("z", "stuvwxyz")) for _ in range(30)]
    labeller = L.Labeller(L.train(texts, 150))
    mixed = run("abcdefg", 100) + run("stuvwxyz", 1000)
    short = " ".join(run("abcdefg", 5) for _ in range(5))
    found = labeller.label([mixed, run("abcdefg", 100), short + " " + run("stuvwxyz", 100_000)])
    assert [lang for lang, _ in found] == ["z", "a", "z"]
    assert 0.8 < found[0][1] < 0.99


def test_pieces_lose_nothing():
    long = "".join(chr(0x4E00 + k % 5000) for k in range(10_003))
    assert "".join(L.pieces(["one", long, "two"])) == "one" + long + "two"
    assert all(len(w) <= L._LONG_WORD for w in L.pieces([long, "x" * 81, "y" * 80]))
    assert L.pieces(["(" * 100 + "word" + ")" * 100]) == ["word"]
