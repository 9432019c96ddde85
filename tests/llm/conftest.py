import random

import pytest
from tenderlake.llm.common import ready

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, length int, path string, id string, h string"
WORDS = "alpha beta gamma delta eps zeta eta theta iota kappa lam mu nu xi omi pi rho sigma tau ups phi chi psi omega".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "s", "ed", "é", "."]) for _ in range(n))


def sample_texts(seed=3):
    """Prose, copies, near copies, repeated lines, junk, empties, nulls and one long text."""
    rng = random.Random(seed)
    lines = [prose(rng, n) for n in (12, 14, 30, 11, 10, 9, 25)]
    texts = ["\n".join(prose(rng, rng.randint(6, 30)) for _ in range(rng.randint(2, 6))) for _ in range(14)]
    texts += [texts[0], texts[0], texts[1] + " tail", texts[2].replace("alpha", "beta", 1)]
    for line in lines:
        words = line.split()
        texts.append(prose(rng, 20) + "\n" + line)
        texts.append(line + "\n" + " ".join(words[:4] + ["changed"] + words[5:]))
        texts.append(" ".join(words[:3] + words[4:]) + "\n" + " ".join(words[:6] + ["new"] + words[6:]))
    texts += ["", "", None, " \n\t", "one", "two words", "\n".join(["same line of five words"] * 4), "!!! " * 60, "LOUD WORDS " * 40, "# $ " * 40]
    texts.append("\n".join(prose(rng, 40) for _ in range(120)))
    texts.append("\U0001f600 naïve ▁x  <s> \x00 　 end" * 3)
    return texts


@pytest.fixture(scope="session")
def corpus(spark):
    """(DataFrame, rows as (id, text)); other columns clash with names that the operators use."""
    ready(spark)
    rows = [(i, t) for i, t in enumerate(sample_texts())]
    full = [(i, t, "en", f"s{i % 3}", None if t is None else len(t), 1, "p", "q", "r") for i, t in rows]
    return spark.createDataFrame(full, SCHEMA), rows


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Null ids and repeated rows."""
    rows = [(None, "a b c d e f g h i j k"), (1, "a b c d e f g h i j k"), (1, "a b c d e f g h i j k"), (2, None), (2, None), (None, None)]
    return spark.createDataFrame([(i, t, None, None, None, None, None, None, None) for i, t in rows], SCHEMA)
