"""Made-up texts and the columns of test documents."""

import random

WORDS = "the of and bright river stone carries small boats toward distant harbour lights while evening rain falls".split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, digest string, id long, run int"


def prose(n: int, seed: int) -> str:
    draw = random.Random(seed)
    return " ".join(draw.choice(WORDS) + draw.choice(["", "", "s", "ed", "ing"]) for _ in range(n))
