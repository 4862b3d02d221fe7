import random

from quarryweave.llm import near_duplicates
from tests.llm.test_operators import shares


def test_pairs_between_families_whose_firsts_differ(spark, monkeypatch):
    # one minimum makes a family, so that its sets may have little in common
    monkeypatch.setattr(near_duplicates, "FAMILY_ROWS", 1)
    rng = random.Random(31)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(4, 9))) for _ in range(500)]
    passages = [[rng.choice(words) for _ in range(40)] for _ in range(6)]
    texts = []
    for _ in range(60):
        text = [w for p in sorted(rng.sample(range(6), 3)) for w in passages[p]]
        for _ in range(6):
            text[rng.randrange(len(text))] = rng.choice(words)
        texts.append(" ".join(text))
    links, _ = near_duplicates.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "no long, text string"), "no", "text")
    want = {(i, j) for i in range(60) for j in range(i + 1, 60) if shares(texts[i], texts[j]) >= 0.6}
    assert len(want) > 20 and {(r["rep_a"], r["rep_b"]) for r in links.collect()} == want
