"""Terms that matter in a pair only reach the factorization machine."""

import random

import pytest

from basketlake.llm import toxicity


@pytest.mark.parametrize("insults", [100, 400])
def test_a_mention_counts_beside_an_insult_only(spark, insults):
    rnd = random.Random(2)
    rows = []
    for i in range(20_000):
        words = [f"w{rnd.randrange(3000)}" for _ in range(12)]
        mention, insult = i % 5 == 0, i * insults // 20_000 != (i + 1) * insults // 20_000
        if insult:
            mention = (i * insults // 20_000) % 5 == 0
        slur = rnd.random() < 0.1
        words += ["mention"] * mention + ["insult"] * insult + ["slur"] * slur
        rows.append((i, " ".join(words), int(slur or mention and insult)))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int").repartition(4)
    machine = toxicity.fitted(df.select("doc_id", "text"), df.select("doc_id", "toxic"))
    score = lambda words: machine.score(f"w1 w2 {words} w3")
    assert min(score("insult mention"), score("slur")) >= toxicity.THRESHOLD > max(score("insult"), score("mention"), score("x"))
